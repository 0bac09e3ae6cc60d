"""Operators on the small cases that define them."""

import datetime
import io
import zipfile

import pytest
from ledgerline.functions import clean, names, periods
from ledgerline.operators import analytics, export, load, match, metadata, ops, reshape, sheets
from ledgerline.plans import api
from ledgerline.sources import files
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def values(spark, given, expression):
    rows = spark.createDataFrame(list(enumerate(given)), "i int, x string").select("i", expression(F.col("x")).alias("y"))
    return [r["y"] for r in rows.orderBy("i").collect()]


def test_names(spark):
    given = ["Age 0 to 4", "Date", "£ Cost Per Unit", "2024 Total", "", None, "Ünit", "x" * 100]
    assert values(spark, given, names.schema_name) == ["age_0_to_4", "date_val", "cost_per_unit", "col_2024_total", "col_unnamed", "col_unnamed", "nit", "x" * 63]
    codes = ["adhd_may25_data", "pcn_workforce_apr2024", "mhsds_historic_2025_05"]
    assert values(spark, codes, names.undated_code) == ["adhd_data", "pcn_workforce", "mhsds_historic"]
    assert values(spark, ["Patient Count", "Total Number of Patients (FTE)", None], names.matching_name) == ["patient_count", "total_number_of_patients_fte", ""]
    assert values(spark, ["Incomplete-Provider-Apr25-XLSX-9M-77252.xlsx", "x-revised.csv"], names.stable_url) == ["Incomplete-Provider-PERIOD-XLSX-9M-FILEID.xlsx", "x-FILEID.csv"]
    assert values(spark, ["March 2020", "Jan-25", "Q1 2025", "Age 0 to 4", "Region Code", "24/25", None], names.is_date_header) == [True, True, True, False, False, True, False]


def test_collisions_are_numbered(spark):
    headers = ["Age (0-4)", "Age 0 to 4", "Age 0-4", "Age: 0-4"]
    rows = spark.createDataFrame(list(enumerate(headers)), "i int, h string").withColumn("n", names.schema_name(F.col("h")))
    got = [r["column_name"] for r in names.numbered(rows, "n", "i", []).orderBy("i").collect()]
    assert got == ["age_0_4", "age_0_to_4", "age_0_4_2", "age_0_4_3"]


def test_periods(spark):
    given = ["november-2025", "Q1 2024-25", "2024-25", "nov-25", "q4-2024-25", "2011-12", "none", None]
    assert values(spark, given, lambda c: periods.period_of(c)["code"]) == ["2025-11", "FY24-Q1", "FY2024-25", "2025-11", "FY24-Q4", "2011-12", None, None]
    assert values(spark, given, lambda c: periods.period_of(c)["sort_key"]) == [202511, 202406, 202503, 202511, 202503, 201112, 0, 0]
    codes = ["2025-11", "FY24-Q4", "FY2024-25", "2025-13", "FY25-Q5", None]
    day = datetime.date
    assert values(spark, codes, periods.period_start) == [day(2025, 11, 1), day(2025, 1, 1), day(2024, 4, 1), None, None, None]
    assert values(spark, codes, periods.period_end) == [day(2025, 11, 30), day(2025, 3, 31), day(2025, 3, 31), None, None, None]
    assert values(spark, codes, periods.period_display) == ["Nov 2025", "Q4 FY24", "FY 2024-25", "2025-13", "Q5 FY25", "Unknown"]
    headers = ["March 2020", "Nov-25", "September_2021", "2025-11", "Q1 2025", "Age 0 to 4", "24/25"]
    assert values(spark, headers, periods.header_date) == ["2020-03-01", "2025-11-01", "2021-09-01", "2025-11-01", "2025-01-01", None, "2024-04-01"]
    assert len(values(spark, ["2025-11"], periods.month_spellings)[0]) == 14


def test_values(spark):
    given = ["1,006", "12.7", "*", "n/a", "", None, "NaN", "50%", "x1"]
    assert values(spark, given, clean.to_integer) == [1006, 12, None, None, None, None, None, None, None]
    assert values(spark, given, clean.to_float) == [1006.0, 12.7, None, None, None, None, None, 50.0, None]
    days = ["2024-03-01", "01/03/2024", "20240301", "MAR2024", "March2024", "13/13/2024", "-"]
    assert values(spark, days, clean.to_date) == [datetime.date(2024, 3, 1)] * 5 + [None, None]


def test_wide_table_becomes_long(spark):
    columns = ["Staff_Group", "Age_Band", "March_2020", "June_2020", "September_2020", "October_2025", "November_2025"]
    rows = [("All GPs", "Under 30", 100, 110, 120, 180, 190), ("All GPs", "30-34", 200, 210, 220, None, 290)]
    long, wide = reshape.unpivoted_if_wide(spark.createDataFrame(rows, columns), "headcount")
    assert wide and long.count() == 10 and long.columns == ["Staff_Group", "Age_Band", "period", "_raw_period", "headcount"]
    assert long.where("headcount is null").first()["period"] == "2025-10-01"
    with pytest.raises(ValueError):
        reshape.unpivoted(long, ["absent"], ["period"])


def test_drift(spark):
    def events(found, stored):
        tables = [spark.createDataFrame([("t", c, "int") for c in x], "`table` string, `column` string, type string") for x in (found, stored)]
        return {r["event"]: r["columns"] for r in load.drift(*tables).collect()}

    assert events(["id", "name"], ["id", "name", "_load_id"]) == {}
    assert events(["id", "b", "a"], ["id"]) == {"new_columns": "a,b"}
    assert events(["id"], ["id", "value"]) == {"missing_columns": "value"}


def test_load_checks_and_grades(spark):
    rows = spark.createDataFrame([(True, 1000), (True, 0), (True, 50), (False, 7)], "success boolean, rows_loaded int")
    assert [r["verdict"] for r in load.checked(rows).collect()] == ["ok", "error", "warning", "failed"]
    cases = {"a": ([44000, 45000, 43000, 46000, 44000, 0], 0, False, "critical"), "b": ([12000, 13000, 12000, 11000, 13000, 0], 0, True, "warning"), "c": ([2_100_000] * 5 + [150], 0, False, "critical"), "d": ([520000, 534000, 510000, 540000, 527000, 534000], 5, False, "warning"), "e": ([44000, 45000, 43000, 46000, 44000, 45234], 0, False, "normal")}
    rows = [(s, k, n, added if k == 5 else 0, error and k == 5) for s, (ns, added, error, _) in cases.items() for k, n in enumerate(ns)]
    table = spark.createDataFrame(rows, "source string, k int, n long, added int, error boolean")
    got = {r["source"]: r["grade"] for r in load.anomalies(table, "source", ["k"], "n", F.col("added"), F.col("error")).where("k = 5").collect()}
    assert got == {s: grade for s, (*_, grade) in cases.items()}


def test_replacing_a_period_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "2025-01"), (2, "2025-02")], "v int, _period string")
    load.append(rows, path)
    for _ in range(2):
        load.replace_periods(rows.where("_period = '2025-01'").withColumn("v", F.lit(9)), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 9]
    with pytest.raises(ValueError):
        load.replace_periods(rows.drop("_period"), path)


def test_widening(spark):
    ints = spark.createDataFrame([(1,)], "v int")
    for other, kind in ((("1.5",), "decimal(38,6)"), (("x",), "string")):
        a, b = load.widened(ints, spark.createDataFrame([other], "v string"))
        assert dict(a.dtypes)["v"] == dict(b.dtypes)["v"] == kind


def test_column_match_uses_each_reference_once(spark):
    draft = spark.createDataFrame([("s", 1, "Patient Count"), ("s", 2, "Patient Counts"), ("s", 3, "Region")], "source string, position long, `column` string")
    reference = spark.createDataFrame([("s", "patient_count"), ("s", "patient_countz"), ("s", "other")], "source string, `column` string")
    got = {r["column"]: (r["reference"], round(r["score"], 2)) for r in match.matched_columns(draft, reference).collect()}
    assert got == {"Patient Count": ("patient_count", 1.0), "Patient Counts": ("patient_countz", 0.93)}


def test_fingerprints_do_not_depend_on_order(spark):
    rows = [("a", "x"), ("a", "Y"), ("b", "y"), ("b", "X"), ("b", "x")]
    got = [r["fingerprint"] for r in match.fingerprints(spark.createDataFrame(rows, "t string, c string"), "t", "c").collect()]
    assert got[0] == got[1]


def test_reference_is_strictly_before(spark):
    work = spark.createDataFrame([("p", "2025-04"), ("p", "2025-06"), ("p", "2025-01")], "pub string, period string")
    known = spark.createDataFrame([("p", "2025-06"), ("p", "2025-05"), ("q", "2024-12")], "pub string, period string")
    got = {r["period"]: r["reference"] for r in match.reference_before(work, known, "pub", "period").collect()}
    assert got == {"2025-04": None, "2025-06": "2025-05", "2025-01": None}


def test_url_for_period(spark):
    urls = ["https://x/a-november-2025-provisional.csv", "https://x/long-name-nov-2025.csv", "https://x/Nov25.csv", "https://x/2025-12.csv"]
    wanted = spark.createDataFrame([("2025-11",), ("2025-12",), ("2024-01",)], "code string")
    got = {r["code"]: r["url"] for r in match.urls_by_period(spark.createDataFrame([(u,) for u in urls], "url string"), wanted).collect()}
    assert got == {"2025-11": urls[2], "2025-12": urls[3]}


def test_shares_of_bands(spark):
    rows = spark.createDataFrame([(1, 53395), (2, 142490), (3, 145910), (4, 185180)], "band int, n int")
    got = [(r["share_pct"], r["cumulative_pct"]) for r in analytics.cumulative_share(rows, "band", "n").orderBy("band").collect()]
    assert got == [(10.1, 10.1), (27.0, 37.2), (27.7, 64.9), (35.1, 100.0)]


def test_snapshots_compared(spark):
    rows = [("now", "a", 3225), ("then", "a", 1890), ("now", "b", 156790), ("then", "b", 128000)]
    got = {r["band"]: r["growth_pct"] for r in analytics.snapshot_comparison(spark.createDataFrame(rows, "s string, band string, n int"), "s", "band", "n", "now", "then").collect()}
    assert got == {"a": 70.6, "b": 22.5}


def test_sequential_columns(spark):
    rows = [("t", f"week_{i}_{i + 1}") for i in range(104)] + [("t", "provider_code"), ("t", "total")]
    got = reshape.sequential_groups(spark.createDataFrame(rows, "t string, c string"), ["t"], "c").collect()
    assert [(r["prefix"], r["members"]) for r in got] == [("week", 104)]


def test_minimal_sheet(spark):
    grid = [("Period", "Organisation", "Count"), ("2025-01", "Trust A", "10"), ("2025-01", "Trust B", "20")]
    rows = [("f", "Data", r, c, v, "n" if v.isdigit() else "s") for r, row in enumerate(grid, 1) for c, v in enumerate(row, 1)]
    cells = spark.createDataFrame(rows, "file string, sheet string, row int, col int, value string, ctype string")
    starts = sheets.data_starts(cells, sheets.header_rows(cells))
    extents = sheets.data_ends(cells, starts)
    got = extents.first()
    assert (got["first_header"], got["last_header"], got["data_start"], got["data_end"]) == (1, 1, 2, 3)
    columns = sheets.column_names(cells, starts)
    assert [r["name"] for r in columns.orderBy("col").collect()] == ["period", "organisation", "count"]
    assert sheets.extracted(cells, extents, columns).count() == 6
    assert sheets.structures(cells).first()["is_valid"]


def test_archives_and_workbooks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "a\n1\n")
        z.writestr("notes.txt", "-")
    got = files.zip_members(spark, str(tmp_path)).collect()
    assert [(r["member"], bytes(r["content"])) for r in got] == [("x.csv", b"a\n1\n")]
    with pytest.raises(ValueError, match="x.csv"):
        files.zip_member(spark, str(tmp_path), "y.csv")
    from ledgerline.plans.reading import workbook

    pandas = pytest.importorskip("pandas")
    (tmp_path / "b.xlsx").write_bytes(workbook(pandas.DataFrame({"p_partkey": [7], "p_name": ["bolt"], "p_size": [3]})))
    cells = files.read_cells(spark, str(tmp_path)).orderBy("row", "col").collect()
    assert [(c["row"], c["col"], c["value"], c["ctype"]) for c in cells] == [(1, 1, "Part", "s"), (1, 2, "Name", "s"), (1, 3, "Size", "s"), (2, 1, "7", "n"), (2, 2, "bolt", "s"), (2, 3, "3", "n")]
    assert not zipfile.is_zipfile(io.BytesIO(b"no archive"))


def test_manifests_need_their_sections(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"manifest": {"name": "m"}, "sources": [{"code": "c", "files": [{"url": "u"}]}, {"code": "d"}]}')
    assert files.read_manifests(spark, str(tmp_path)).count() == 2
    (tmp_path / "bad.json").write_text('{"manifest": {"name": "m"}}')
    with pytest.raises(Exception, match="sections"):
        files.read_manifests(spark, str(tmp_path)).collect()


def test_export_checks_find_mutations(spark, tmp_path):
    table = spark.createDataFrame([(i, i * 2) for i in range(20)], "a int, b int")
    assert export.exported(table, str(tmp_path / "e")).first()["n_rows"] == 20
    good = spark.read.parquet(str(tmp_path / "e"))
    assert export.verification(table, good).first()["different_rows"] == 0
    assert export.verification(table, good.where("a > 0")).first()["different_rows"] == 1
    assert export.verification(table, good.withColumn("b", F.when(F.col("a") == 3, F.col("b") + 9999).otherwise(F.col("b")))).first()["different_rows"] == 2


def test_questions(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "band string, n int")
    assert api.ask(df, "how many rows?").first()[0] == 2
    assert api.ask(df, "total please").first()[0] == 3
    assert api.ask(df, "select max(n) from data").first()[0] == 2
    with pytest.raises(ValueError):
        api.ask(df, "drop table data")
    assert api.ask(df.withColumnRenamed("n", "created_at"), "select created_at from data").count() == 2
    with pytest.raises(ValueError):
        api.metric(df, "absent", {})


def test_roles_of_columns(spark):
    rows = [("t", "patient_count", None, "INTEGER"), ("t", "period", None, "TEXT"), ("t", "provider_code", None, "TEXT")]
    got = {r["column"]: (r["is_measure"], r["is_dimension"]) for r in metadata.described(spark.createDataFrame(rows, "`table` string, `column` string, description string, data_type string")).collect()}
    assert got == {"patient_count": (True, False), "period": (False, True), "provider_code": (False, True)}


def test_cascade_leaves_other_sources(spark):
    sources = spark.createDataFrame([("a", "tbl_x"), ("b", "tbl_y")], "code string, table_name string")
    counts, kept = ops.cascade(sources, {"ledger": spark.createDataFrame([("a",), ("b",), ("b",)], "source string")}, "tbl_y")
    assert {r["what"]: r["n"] for r in counts.collect()} == {"sources": 1, "ledger": 2}
    assert kept["ledger"].count() == 1 and kept["sources"].count() == 1


def test_matched_columns_equal_a_naive_match(spark):
    """Every draft column in turn against every unused reference, on the registered query's own rows."""
    from difflib import SequenceMatcher

    from ledgerline.functions import names
    from ledgerline.plans.inputs import given
    from ledgerline.plans.loading import J14_DRAFT, J14_REF
    from ledgerline.plans.registry import load

    sf = "/root/testdata/sf0.001"
    draft, reference = ([(r["source"], r["c"], r["k"]) for r in given(spark, sf, sql).withColumn("k", names.matching_name(F.col("c"))).collect()] for sql in (J14_DRAFT, J14_REF))
    want = set()
    for source in {s for s, _, _ in draft}:
        mine = [(k, c, key) for k, (c, key) in enumerate(sorted((c, key) for s, c, key in draft if s == source), 1)]
        free = dict(sorted((c, key) for s, c, key in reference if s == source))
        first: dict[str, str] = {}
        for c, key in free.items():
            first.setdefault(key, c)
        left, used = [], set()
        for k, c, key in mine:
            if key in first and key not in used:
                used.add(key)
                want.add((source, k, c, first[key], 1.0))
            else:
                left.append((k, c, key))
        free = {c: key for c, key in free.items() if not (key in used and first[key] == c)}
        for k, c, key in left:
            score, best = max(((SequenceMatcher(None, key, other).ratio(), own) for own, other in free.items()), key=lambda x: x[0], default=(0.0, None))
            if score >= 0.8:
                del free[best]
                want.add((source, k, c, best, round(score, 9)))
    got = {(r["source"], r["position"], r["column"], r["reference"], round(r["score"], 9)) for r in load()["j14_matched_columns"].run(spark, sf).collect()}
    assert got == want and any(x[4] < 1 for x in want)


def test_similar_names_of_any_length_meet(spark):
    import random
    from difflib import SequenceMatcher

    from ledgerline.operators.match import similar_names

    rng = random.Random(6)
    words = sorted({"".join(rng.choices("abc_", k=rng.randrange(1, 9))) for _ in range(150)})
    a, b = words[::2], words[1::2]
    left = spark.createDataFrame([("s", k, w, w) for k, w in enumerate(a)], "source string, position int, column string, key string")
    free = spark.createDataFrame([("s", w, w) for w in b], "source string, reference string, other string")
    got = {(r["column"], r["reference"]) for r in similar_names(left, free, "source", 0.8).collect()}
    assert got == {(x, y) for x in a for y in b if SequenceMatcher(None, x, y).ratio() >= 0.8} and got


def test_a_true_reference_is_found_among_tables_that_share_common_names(spark):
    from ledgerline.operators.match import best_jaccard, best_overlap

    common = ["name", "date", "code"]
    draft = spark.createDataFrame([(f"d{t}", c) for t in range(30) for c in [*common, f"own{t}", f"other{t}"]], "table string, column string")
    reference = spark.createDataFrame([(f"r{t}", c) for t in range(30) for c in [*common, f"own{t}", f"other{t}"]] + [("bare", c) for c in common], "table string, column string")
    assert {(r["draft"], r["reference"], r["score"]) for r in best_overlap(draft, reference, 0.8).collect()} == {(f"d{t}", f"r{t}", 1.0) for t in range(30)}
    assert {(r["draft"], r["reference"]) for r in best_jaccard(draft, reference, 0.8).collect()} == {(f"d{t}", f"r{t}") for t in range(30)}
    assert best_overlap(draft.where("table = 'd1'"), reference.where("table = 'bare'"), 0.6).collect()[0]["score"] == 0.6


def test_unknown_registry_codes_are_refused(spark):
    from ledgerline.sources.files import registry_columns

    rows = spark.createDataFrame([("a", '{"x": "first"}')], "code string, columns string")
    assert [tuple(r) for r in registry_columns(rows, "a").collect()] == [("a", "x", "first")]
    with pytest.raises(ValueError):
        registry_columns(rows, "b")


def test_ranks_are_those_of_windows(spark):
    rows = [(i, None if i % 11 == 0 else f"r{i % 3}", None if i % 7 == 0 else float(i * i % 40)) for i in range(200)]
    rows += [(1000, "alone", 5.0), (1001, "empty", None)] + [(2000 + i, "same", 1.0) for i in range(50)]
    given = spark.createDataFrame(rows, "id int, region string, v double")
    own = Window.partitionBy("region")
    want = given.select("id", F.avg("v").over(own).alias("a"), F.percent_rank().over(own.orderBy("v")).alias("p"), F.rank().over(own.orderBy(F.desc("v"))).alias("k"))
    got = analytics.benchmark(given, "region", "v").select("id", "region_avg", "percentile", "place")
    rounded = [sorted((r[0], None if r[1] is None else round(r[1], 9), round(r[2], 12), r[3]) for r in x.collect()) for x in (got, want)]
    assert rounded[0] == rounded[1]
    for ranges in (2, 5):
        ranks = analytics.counted_ranks(given.where("region = 'r1'"), "region", "v", ranges)
        values = [r[2] for r in rows if r[1] == "r1"]
        low = {v: sum(1 for x in values if x is None or (v is not None and x < v)) for v in set(values)}
        low[None] = 0
        assert {r["v"]: (r["n"], r["smaller"], r["total"]) for r in ranks.collect()} == {v: (values.count(v), n, len(values)) for v, n in low.items()}


def test_quantiles(spark):
    rows = [(k, None if i % 9 == 0 else float(i * 37 % 101)) for k, n in (("a", 100), ("b", 3), ("c", 1)) for i in range(n)] + [("d", 2.5)]
    given = spark.createDataFrame(rows, "k string, v double")
    want = given.where("v is not null").groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("m"), F.percentile("v", F.lit(0.95)).alias("p"))
    got = analytics.quantiles(given, "k", "v", {"m": 0.5, "p": 0.95})
    assert {r["k"]: tuple(r)[1:] for r in got.collect()} == {r["k"]: pytest.approx(tuple(r)[1:]) for r in want.collect()}


def test_previews_of_columns(spark):
    tables = {
        "small": [f"week_{i}" for i in range(50)],
        "sequence": ["code", "name"] + [f"week_{i}_{i + 1}" for i in range(60)] + [f"later_{i}" for i in range(20)],
        "medium": [f"x{'abcde'[i % 5]}{'abcdefghijklmno'[i // 5]}y" for i in range(75)],
        "large": [f"{'abcdefgh'[i % 8]}{'abcdefghijklm'[i // 8]}{s}" for i, s in enumerate((["_id"] * 20 + ["_date"] * 20 + ["_name"] * 20 + ["_count"] * 20 + [""] * 24))],
    }
    rows = [(t, n, i) for t, names in tables.items() for i, n in enumerate(names)]
    got = reshape.sampled_columns(spark.createDataFrame(rows, "t string, c string, i int"), ["t"], "c", "i").orderBy("t", "i").collect()
    kept = {t: [r["c"] for r in got if r["t"] == t] for t in tables}
    large = tables["large"]
    assert kept["small"] == tables["small"] and kept["medium"] == tables["medium"]
    assert kept["sequence"] == ["code", "name", "week_0_1", "week_30_31", "week_59_60"] + [f"later_{i}" for i in range(20)]
    # 20 ids, three dates, three names, three measures, and one of the rest
    assert kept["large"] == large[:20] + [large[i] for i in (20, 30, 39, 40, 50, 59, 60, 70, 79, 80)]
    assert {r["t"]: r["strategy"] for r in got} == {"small": "full", "sequence": "sequence", "medium": "full", "large": "strata"}
