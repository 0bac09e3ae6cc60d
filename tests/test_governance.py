"""Checks, registries, schedules, drift and runs on cases that each rule names."""

import datetime

import pytest
from ledgerline.functions import schedules
from ledgerline.operators import load, ops, registry, sheets, validation
from ledgerline.sources import files
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


PUBS = "code string, name string, urls array<struct<period:string,url:string>>, url_template string, discovery_mode string, landing_page string, periods array<string>"


def test_configurations(spark):
    pubs = [
        ("a", "A", [("2024-01", "https://x"), (None, "https://x"), ("2024-02", None), ("2024-03", ""), ("soon", "ftp://x")], None, None, None, None),
        ("b", None, None, "{landing_page}/x", None, " ", ["2024-01"]),
        ("c", "C", None, None, "template", "https://x", []),
        ("d", "D", None, None, None, None, None),
    ]
    assert rows(validation.config_findings(spark.createDataFrame(pubs, PUBS))) == sorted([
        ("a", "error", "Entry 2 missing 'period' field"), ("a", "error", "Period 2024-02 has no URL (None)"), ("a", "error", "Period 2024-03 has empty URL"), ("a", "error", "Period soon has invalid URL: ftp://x"),
        ("a", "warning", "Period 'soon' has unusual format"), ("b", "error", "Template mode requires 'landing_page'"), ("b", "warning", "Missing 'name' field"), ("c", "warning", "No periods defined"),
    ], key=str)
    assert rows(validation.config_findings(spark.createDataFrame([], PUBS))) == [(None, "error", "No publications defined in config")]


def test_manifests(spark):
    schema = "manifest string, position int, code string, name string, `table` string, enabled boolean, files array<struct<url:string>>, columns array<string>"
    given = [("m", 0, "x", "X", "t", True, [("u",)], ["c"]), ("m", 1, "x", "X", "t", True, [], ["c"]), ("m", 2, None, "N", "t", None, [("u",), (None,)], None), ("m", 3, "Summary_1", "S", None, False, None, None)]
    df = spark.createDataFrame(given, schema)
    plain = [("m", "source_2", "error", "Missing required field 'code'"), ("m", "source_2", "error", "Missing required field 'enabled'"), ("m", "source_2", "error", "file 1: Missing 'url'"), ("m", "Summary_1", "error", "Missing required field 'files'"), ("m", "Summary_1", "error", "Missing required field 'table'"), ("m", "x", "error", "'files' must be non-empty array"), ("m", "x", "error", "Duplicate source code: 2 sources")]
    assert rows(validation.manifest_findings(df)) == sorted(plain, key=str)
    more = [("m", "Summary_1", "warning", "Generic code pattern"), ("m", None, "warning", "1 enabled sources missing 'columns' metadata")]
    assert rows(validation.manifest_findings(df, strict=True, enriched=True)) == sorted([*plain, *more], key=str)


def test_loaded_tables(spark, monkeypatch):
    monkeypatch.setattr(validation, "VERY_LARGE", 3)
    df = spark.createDataFrame([(1, None, "x", 7, "2024-01"), (2, None, None, 7, "2024-01"), (3, None, None, 7, "2024-01"), (4, None, None, 7, None)], "id long, gone string, few string, _load_id int, _period string")
    told = [("t", "warning", m) for m in ("Missing audit columns: _loaded_at, _manifest_file_id", "Column 'gone' is 100% NULL (4 rows)", "Very large table: 4 rows")]
    assert rows(validation.table_checks(df, "t", df)) == sorted(told)
    strict = [("t", "warning", m) for m in ("Column 'few' has high NULL rate: 75.0%", "Only 1 period loaded: 2024-01", "No column metadata found")]
    assert rows(validation.table_checks(df, "t", df, tracked=0, strict=True)) == sorted(told + strict)
    assert rows(validation.table_checks(df.limit(0), "t", df, tracked=0, strict=True)) == [("t", "error", "Table is empty (0 rows)")]
    assert rows(validation.table_checks(None, "t", df)) == [("t", "error", "Table does not exist")]
    assert rows(validation.table_checks(df.select(), "t", df)) == [("t", "error", "Table has no columns")]


def test_columns_are_put_right(spark):
    df = spark.createDataFrame([("A - ", "12Ä x", " DATE ", "YES", "0"), ("a b a b", "y" * 70, None, None, "1")], "original_name string, semantic_name string, data_type string, is_dimension string, is_measure string")
    got = {r["original_name"]: r for r in validation.fixed_columns(df).collect()}
    assert (got["A"]["pg_name"], got["A"]["data_type"], got["A"]["is_dimension"], got["A"]["is_measure"]) == ("__x", "date", True, False)
    assert got["a b a b"]["pg_name"] == "y" * 63 and got["a b a b"]["data_type"] == "varchar" and got["a b a b"]["is_measure"]


COLUMNS = "source string, position int, name string, code string, semantic_name string, original_name string, description string, data_type string, is_measure boolean, is_dimension boolean, query_keywords array<string>, metadata struct<measure:string,dimension:string,tags:array<string>>"


def test_metadata_by_fallbacks(spark):
    given = [
        ("s", 1, "n", "c", "x", "N!", "d", "DATE", True, None, ["k"], ("count", "date", ["t"])),
        ("s", 2, "", "c", "x", None, None, None, None, False, [], ("count", None, ["t"])),
        ("s", 3, None, None, "x", None, None, None, False, False, ["k"], (None, "date", ["t"])),
        ("s", 4, None, None, None, "lost", None, None, True, True, None, None),
        ("s", 5, "n", None, None, None, "later", None, None, None, None, None),
        ("only", 1, None, None, None, None, None, None, None, None, None, None),
    ]
    new = spark.createDataFrame(given, COLUMNS)
    got = {r["column_name"]: tuple(r)[2:] for r in registry.column_metadata(new).collect()}
    assert got == {"n": ("n", "later", "VARCHAR", False, False, [], "enrichment", 0.95), "c": ("c", None, "VARCHAR", True, False, ["t"], "enrichment", 0.95), "x": ("x", None, "VARCHAR", False, True, ["k"], "enrichment", 0.95)}
    old = registry.column_metadata(spark.createDataFrame([(s, 1, "o", *[None] * 9) for s in ("s", "only", "other")], COLUMNS), "old")
    assert sorted((r["source"], r["column_name"]) for r in registry.stored_metadata(old, new).collect()) == [("other", "o"), ("s", "c"), ("s", "n"), ("s", "x")]


def test_sources_are_registered_once_and_loads_logged(spark):
    known = spark.createDataFrame([("a", "A", datetime.datetime(2024, 1, 1)), ("b", "B", None)], "code string, name string, created_at timestamp")
    new = spark.createDataFrame([("a", "again", datetime.datetime(2025, 1, 1)), ("c", "C2", datetime.datetime(2025, 1, 1)), ("c", "C1", datetime.datetime(2025, 1, 1))], known.schema)
    all_sources = registry.registered(known, new)
    history = registry.logged(spark.createDataFrame([("a", datetime.datetime(2024, 5, 5))], "source string, loaded_at timestamp"), spark.createDataFrame([("a", datetime.datetime(2024, 6, 6)), ("b", None)], "source string, loaded_at timestamp"))
    listed = registry.listed(all_sources, history).collect()
    assert [(r["code"], r["name"]) for r in listed] == [("c", "C1"), ("a", "A"), ("b", "B")]
    assert listed[1]["last_load_at"] == datetime.datetime(2024, 6, 6) and listed[2]["last_load_at"] is not None and listed[0]["last_load_at"] is None
    assert registry.one_source(all_sources, "b").count() == 1
    with pytest.raises(ValueError, match="no source z"):
        registry.one_source(all_sources, "z")


def test_manifests_after_editing(spark):
    original = spark.createDataFrame([("u1", 1, "p1", "s1", None), ("u1", 2, "p2", None, "e"), ("u2", 3, "p", "s", None)], "url string, position int, period string, sheet string, extract string")
    edited = spark.createDataFrame([("u1", None), ("u2", "own"), ("u3", None)], "url string, period string")
    assert rows(registry.restored(original, edited).select("url", "period", "sheet", "extract", "restored")) == [("u1", "p2", None, "e", 2), ("u2", "own", "s", None, 1), ("u3", None, None, None, 0)]
    assert rows(registry.url_findings(original, edited)) == [("u3", "extra")]
    with pytest.raises(ValueError, match="missing u2, extra u3"):
        registry.require_same_urls(original, edited.where("url <> 'u2'"))
    registry.require_same_urls(original, edited.where("url <> 'u3'"))
    sources = spark.createDataFrame([("a", "A", "tbl_a", "d"), ("b", "B", "tbl_b", "d")], "code string, name string, `table` string, description string")
    edits = spark.createDataFrame([("a", 1, "a2", None, "new"), ("z", 2, None, None, None)], "code string, position int, new_code string, name string, description string")
    assert rows(registry.edited_sources(sources, edits).select("code", "name", "table", "description", "original_code")) == [("a2", "A", "tbl_a2", "new", "a"), ("b", "B", "tbl_b", "d", None)]
    assert rows(registry.edit_report(sources, edits)) == [("a", "changed", "a2"), ("b", "source without edit", None), ("z", "edit without source", "z")]


def naive_schedule(c, today):
    """Month by month, and quarter by quarter, until one isn't out."""
    lag = datetime.timedelta(weeks=c["lag_weeks"] if c["lag_weeks"] is not None else 6)
    out = []
    if c["type"] == "fiscal_quarter":
        fy, q = c["start_fy"] or 2025, 1
        while len(out) <= 50:
            end = {1: datetime.date(fy - 1, 6, 30), 2: datetime.date(fy - 1, 9, 30), 3: datetime.date(fy - 1, 12, 31), 4: datetime.date(fy, 3, 31)}[q]
            if end + lag > today:
                break
            out.append(f"FY{fy % 100:02d}-Q{q}")
            q, fy = (1, fy + 1) if q == 4 else (q + 1, fy)
        return out
    y, m = int(c["start"][:4]), int(c["start"][5:])
    end = today - lag if c["end"] in (None, "current") else (datetime.date(int(c["end"][:4]) + int(c["end"][5:]) // 12, int(c["end"][5:]) % 12 + 1, 1) - datetime.timedelta(days=1))
    while datetime.date(y, m, 1) <= end:
        k = y * 12 + m - 1 + (c["offset_months"] or 0)
        if (c["months"] is None or m in c["months"]) and (not c["offset_months"] or datetime.date(k // 12, k % 12 + 1, 1) <= today):
            out.append(f"{y}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def test_schedules(spark):
    fields = ("publication", "type", "start", "end", "months", "lag_weeks", "offset_months", "start_fy")
    today = datetime.date(2025, 3, 14)
    configs = [
        ("a", "monthly", "2024-01", "current", None, None, None, None), ("b", None, "2023-11", "2024-02", None, 1, None, None), ("c", "monthly", "2023-01", None, [2, 5], 0, None, None), ("d", "monthly", "2024-06", "2025-12", None, None, 5, None),
        ("e", "fiscal_quarter", None, None, None, None, None, 2024), ("f", "fiscal_quarter", None, None, None, 60, None, 2000), ("g", "monthly", "2026-01", "current", None, None, None, None), ("h", "fiscal_quarter", None, None, None, 0, None, None),
    ]
    df = spark.createDataFrame(configs, "publication string, type string, start string, end string, months array<int>, lag_weeks int, offset_months int, start_fy int")
    want = sorted((c[0], p) for c in configs for p in naive_schedule(dict(zip(fields, c, strict=True)), today))
    assert rows(schedules.scheduled(df, F.lit(today))) == want


def test_urls_of_periods(spark):
    pubs = [("t", "https://l/", "{landing_page}/{month_name}/{day}-{pub_year}{pub_month}", {"2024-02": "odd-{year}"}, None, 5), ("q", None, "q{quarter}-{fy}", None, None, None), ("l", None, None, None, {"2024-01": "x"}, None), ("n", "h", "{pub_year}", None, None, 0)]
    schema = "publication string, landing_page string, template string, exceptions map<string,string>, urls map<string,string>, offset_months int"
    periods = spark.createDataFrame([(p, c) for p in "tqln" for c in ("2024-01", "2024-02", "FY25-Q3", "later")], "publication string, period string")
    got = {(r["publication"], r["period"]): r["url"] for r in schedules.resolved_urls(periods, spark.createDataFrame(pubs, schema)).collect()}
    assert got[("t", "2024-01")] == "https://l/january/31-202406" and got[("t", "2024-02")] == "odd-2024" and got[("q", "FY25-Q3")] == "q3-25"
    assert got[("l", "2024-01")] == "x" and ("l", "2024-02") not in got and ("t", "later") not in got and got[("n", "2024-01")] == "{pub_year}"
    assert {p for _, p in [(r["publication"], r["period"]) for r in schedules.resolved_urls(periods, spark.createDataFrame(pubs, schema), "2024-01").collect()]} == {"2024-01"}


def test_fiscal_years(spark):
    periods = spark.createDataFrame([("a", 202403), ("a", 202505), ("b", 202404), ("b", 202503)], "source string, sort_key int")
    years = schedules.fiscal_years(periods, "source")
    assert rows(years) == [("a", "23/24"), ("a", "24/25"), ("a", "25/26"), ("b", "24/25")]
    assert rows(schedules.sort_range(years, "source")) == [("a", 202304, 202603), ("b", 202404, 202503)]
    often = spark.createDataFrame([("q", p) for p in ("2023-02", "2023-05", "2024-02")] + [("m", f"2024-0{k}") for k in range(1, 6)] + [("two", "2024-01"), ("two", "2024-02")], "source string, period string")
    assert {r["source"]: (r["n_periods"], r["frequency"]) for r in schedules.frequencies(often, "source").collect()} == {"q": (3, "quarterly"), "m": (5, "monthly"), "two": (2, "monthly")}


def test_wide_dates_are_drift(spark):
    schema = "table string, column string, type string"
    stored = spark.createDataFrame([("t", "id", "int"), ("t", "old", "int"), ("u", "id", "int")], schema)
    found = spark.createDataFrame([("t", "id", "text"), ("t", "Jan 2024", "int"), ("t", "Feb 2024", "int"), ("t", "2024-03", "int"), ("t", "more", "int"), ("u", "id", "int"), ("u", "Q1 2024", "int"), ("u", "Q2 2024", "int")], schema)
    assert rows(load.drift(found, stored)) == sorted([("t", "new_columns", "2024-03,Feb 2024,Jan 2024,more"), ("t", "missing_columns", "old"), ("t", "type_change", "id"), ("t", "wide_date_detected", "2024-03,Feb 2024,Jan 2024"), ("u", "new_columns", "Q1 2024,Q2 2024")])


def test_what_was_loaded(spark):
    part = spark.createDataFrame([("u", None, None), ("u", "S", None), ("u", "S", "m.csv"), ("u", "", None)], "url string, sheet string, member string")
    assert [r[0] for r in part.select(load.tracking_id(F.col("url"), F.col("sheet"), F.col("member"))).collect()] == ["u", "u#S", "u#m.csv", "u"]
    at = lambda d: datetime.datetime(2024, 1, d)
    history = spark.createDataFrame([("s", "u", 1, 10, at(1), "append"), ("s", "u", 2, 20, at(3), "replace"), ("s", "u", 3, 30, at(3), "append")], "source string, url string, id long, rows_loaded long, loaded_at timestamp, mode string")
    work = spark.createDataFrame([("s", "u"), ("s", "v"), ("t", "u")], "source string, url string")
    assert rows(load.loaded_state(work, history).select("source", "url", "load_id", "rows", "mode", "loaded")) == [("s", "u", 3, 30, "append", True), ("s", "v", None, None, None, False), ("t", "u", None, None, None, False)]


def test_runs(spark):
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    schema = "run_id string, event_type string, timestamp timestamp, level string, publication string, period string, stage string, message string, details map<string,string>"
    e = lambda run, kind, m, level="INFO", stage=None, message=None, pub="p", **d: (run, kind, at(m), level, pub, None, stage, message, d or None)
    events = [
        e("ok", "run_started", 0), e("ok", "stage_completed", 1, stage="load", message="Load completed for x: 12 rows in 5ms"), e("ok", "stage_completed", 2, stage="load", message="nothing"), e("ok", "stage_completed", 2, stage="export", message="9 rows"), e("ok", "llm_call", 2),
        e("ok", "reference_matched", 3, matched="4"), e("ok", "warning", 3, "WARNING"), e("ok", "warning", 3), e("ok", "run_completed", 5, processed="1", failed="0"),
        e("bad", "run_started", 0), e("bad", "stage_failed", 4, "ERROR", stage="later", error="e2"), e("bad", "stage_failed", 2, "ERROR", message="boom", pub="q", error="e1"), e("bad", "run_completed", 6, failed="1", processed="3"),
        e("idle", "run_started", 0), e("idle", "run_completed", 1, processed="0"), e("open", "run_started", 0), e("odd", "error", 0),
    ]
    df = spark.createDataFrame(events, schema)
    runs = ops.analysed_runs(df)
    got = {r["run_id"]: r for r in runs.collect()}
    assert {k: r["status"] for k, r in got.items()} == {"ok": "SUCCESS", "bad": "FAILED", "idle": "NO_WORK", "open": "INCOMPLETE", "odd": "UNKNOWN"}
    ok, bad = got["ok"], got["bad"]
    assert (ok["seconds"], ok["rows_loaded"], ok["sources_loaded"], ok["reference_matches"], ok["calls"], ok["warnings"], ok["errors"], ok["publications"]) == (300, 12, 1, 4, 1, 1, 0, 1)
    assert (bad["failed_stage"], bad["failed_publication"], bad["failed_message"], bad["failed_error"], bad["errors"]) == ("unknown", "q", "boom", "e1", 2)
    assert rows(ops.restart_list(runs, df)) == [("bad", "p"), ("bad", "q"), ("open", "p")]
    assert ("bad", "unknown", 0, 0, 1) in rows(ops.run_stages(df)) and ("ok", "load", 0, 2, 0) in rows(ops.run_stages(df))


def test_external_verdicts(spark):
    columns = spark.createDataFrame([("a", "ytd"), ("b", "x"), ("c", "x"), ("d", "x")], "table string, column string")
    told = spark.createDataFrame([("a", "event_log", None), ("b", "event_log", 0.6), ("c", "event_log", 0.4)], "table string, verdict string, sure double")
    got = {r["table"]: (r["pattern"], r["confidence"]) for r in load.load_modes(columns, columns.select("table", F.lit("").alias("description")), told).collect()}
    assert got == {"a": ("event_log", 0.8), "b": ("event_log", 0.6), "c": ("unknown", 0.5), "d": ("unknown", 0.5)}


def test_footers_end_the_rows(spark):
    cells = [("f", "s", r, c, v, "s") for r, line in enumerate([["Area", "N"], ["a", "1"], ["* few", "2"], ["* " + "long " * 12, None], ["b", "3"]], 1) for c, v in enumerate(line, 1) if v]
    df = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string, ctype string")
    extents = spark.createDataFrame([("f", "s", 2, 5)], "file string, sheet string, data_start int, data_end int")
    names = spark.createDataFrame([("f", "s", 1, "area"), ("f", "s", 2, "n")], "file string, sheet string, col int, name string")
    assert sorted({r["row"] for r in sheets.extracted(df, extents, names).collect()}) == [2, 3]


def test_event_lines(spark, tmp_path):
    lines = ['{"event_type": "a", "timestamp": "2024-01-01T00:00:01", "details": {"k": [1, {"x": "y"}]}}', "", "  ", '{"event_type": "b", "details": 3', "[1]", '{"no": "type"}']
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    good, bad = files.event_lines(spark, str(tmp_path))
    one = good.select("event_type", "timestamp", F.expr("variant_get(details, '$.k[1].x', 'string')").alias("x")).collect()
    assert [tuple(r) for r in one] == [("a", datetime.datetime(2024, 1, 1, 0, 0, 1), "y")]
    assert sorted(r["line"] for r in bad.collect()) == sorted([lines[3], "[1]"])
