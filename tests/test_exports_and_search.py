"""Exports with sizes and order, verification by buckets, dictionaries, profiles that merge, the keyword index, assignment by rounds."""

import os
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from ledgerline.operators import analytics, export, keywords, match, profiles
from ledgerline.plans import api
from ledgerline.sources import files
from pyspark.sql import functions as F


def test_exports_are_sorted_sized_and_failures_are_rows(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 11).alias("k"), F.col("id").alias("v"), F.create_map(F.lit("a"), "id").alias("m")).repartition(5)

    def read(code):
        if code == "x_gone":
            raise ValueError("no such table\nsecond line")
        return rows if code == "x_rows" else spark.read.parquet(f"{tmp_path}/nowhere")

    done = {r["code"]: r for r in export.exported_all(spark, ["y", "x_rows", "x_gone", "x_lost"], read, "x_", str(tmp_path)).collect()}
    assert sorted(done) == ["x_gone", "x_lost", "x_rows"]
    assert not done["x_gone"]["success"] and done["x_gone"]["error"] == "no such table"
    assert not done["x_lost"]["success"] and "PATH_NOT_FOUND" in done["x_lost"]["error"]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(Path(tmp_path, "x_rows").glob("*.parquet"))
    ok = done["x_rows"]
    assert (ok["n_rows"], ok["n_columns"], ok["n_files"]) == (5000, 3, len(parts))
    assert ok["size_bytes"] == sum(os.path.getsize(p) for p in parts)
    keys = [tuple(x.values()) for p in parts for x in pq.read_table(p, columns=["k", "v"]).to_pylist()]
    assert keys == sorted(keys)
    assert sum(7 in pq.read_table(p, columns=["k"])["k"].to_pylist() for p in parts) > 1  # the frequent key lies in several files
    totals = export.export_totals(spark.createDataFrame(list(done.values()), export.RESULT)).first()
    assert (totals["exports"], totals["succeeded"], totals["size_bytes"]) == (3, 1, ok["size_bytes"])


def test_differences_are_found_whatever_the_order(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "a").alias("x"), F.when(F.col("id") % 3 == 0, "a").alias("y"))
    twice = rows.unionByName(rows.where("id < 10"))
    assert export.differences(twice, twice.repartition(7, "y")).collect() == []
    swapped = twice.withColumns({"x": F.when(F.col("id") == 3, F.col("y")).otherwise(F.col("x")), "y": F.when(F.col("id") == 3, F.col("x")).otherwise(F.col("y"))})
    got = sorted(((r["id"], r["x"], r["y"], r["side"]) for r in export.differences(twice, swapped).collect()), key=str)
    assert got == sorted([(3, None, "a", "table"), (3, "a", None, "export")] * 2, key=str)
    assert [tuple(r) for r in export.differences(twice, rows.unionByName(rows.where("id < 9"))).collect()] == [(9, None, "a", "table")]
    assert export.differences(rows.limit(0), rows.limit(0)).collect() == []


def test_a_true_copy_is_compared_by_its_sums_alone(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    found = export.differences(rows, rows.repartition(5, "l_shipdate"))
    assert found.count() == 0
    least = rows.agg(F.min(F.struct("l_orderkey", "l_linenumber"))).first()[0]
    spoilt = (F.col("l_orderkey") == least["l_orderkey"]) & (F.col("l_linenumber") == least["l_linenumber"])
    changed = rows.withColumn("l_tax", F.when(spoilt, 0.99).otherwise(F.col("l_tax")))
    assert sorted((r["l_orderkey"], r["side"]) for r in export.differences(rows, changed).collect()) == [(least["l_orderkey"], "export"), (least["l_orderkey"], "table")]


def test_dictionaries_come_back(spark):
    schema = "code string, column string, original_name string, data_type string, description string, least string, most string, null_rate double, distinct_values long, search_terms array<string>, is_dimension boolean, is_measure boolean, confidence double, metadata_source string"
    rows = [("d", "n", "N of x", "INTEGER", "How many", "1", "9", 12.345, 7, ["count", "many"], False, True, 0.95, "enrichment"), ("d", "area", "area", None, None, None, None, None, None, [], True, False, 0.7, "llm"), ("d", "_id", "_id", "INTEGER", "Load", None, None, None, None, None, False, False, 0.9, "x")]
    purposes = spark.createDataFrame([("d", "What it is for.\nTwo lines", 12)], "code string, purpose string, n_rows long")
    text = export.full_dictionaries(spark.createDataFrame(rows, schema), "code", purposes)
    markdown = text.first()["markdown"]
    assert [x for x in markdown.split("\n") if x.startswith("#")] == ["# d", "## Purpose", "## Columns", "### Dimensions", "#### `area`", "### Measures", "#### `n`", "### System", "#### `_id`"]
    for line in ("**Original Name:** N of x", "**Range:** 1 to 9", "**Null Rate:** 12.3%", "**Distinct Values:** 7", "**Search Terms:** count, many", "**Metadata Quality:** ✓ enrichment (confidence: 0.95)", "**Metadata Quality:** ~ llm (confidence: 0.70)"):
        assert line in markdown
    back = {r["column"]: r for r in files.dictionary_columns(text.withColumnRenamed("markdown", "value"), keys=("code",)).collect()}
    assert sorted(back) == ["_id", "area", "n"]
    assert (back["n"]["code"], back["n"]["description"], back["n"]["data_type"], back["n"]["search_terms"]) == ("d", "How many", "INTEGER", ["count", "many"])
    assert back["n"]["purpose"] == "What it is for.\nTwo lines"
    columns = spark.createDataFrame([("d", "n"), ("d", "area"), ("d", "_id"), ("d", "more"), ("e", "x")], "code string, column string")
    assert sorted((r["code"], r["level"], r["finding"], r["detail"]) for r in export.dictionary_findings(text, columns).collect()) == [("d", "warning", "undocumented column", "more"), ("e", "error", "no dictionary", "")]


def test_profiles_merge_over_periods(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"p{i % 10}", rng.randrange(5000), f"t{rng.randrange(300)}" if rng.random() < 0.9 else None, rng.random(), rng.random() < 0.5) for i in range(20_000)]
    df = spark.createDataFrame(rows, "period string, n long, t string, x double, b boolean")
    path = str(tmp_path / "sketches")
    for k in range(10):  # a period at a time
        profiles.sketched(df.where(F.col("period") == f"p{k}"), "period").write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 10
    told = {r["column_name"]: r for r in profiles.profile_of(stored).collect()}
    exact = {r["column_name"]: r for r in analytics.profile(df.drop("period")).collect()}
    for name, e in exact.items():
        assert all(told[name][c] == e[c] for c in ("total", "non_null", "nulls", "null_rate", "least", "most")), name
        assert abs(told[name]["distinct_values"] - e["distinct_values"]) <= 0.05 * e["distinct_values"] + 1
    ordered = sorted(r[1] for r in rows)
    below = sum(v < told["n"]["quantile"] for v in ordered) / len(ordered)
    assert abs(below - 0.5) < 0.02 and told["t"]["quantile"] is None
    assert profiles.profile_of(stored.limit(0)).where("total > 0").count() == 0


def test_keyword_index(spark):
    rows = [(f"t{i}", "patient_count", f"People of area{i}", ["rate"]) for i in range(25)] + [("u", "wait", None, None), ("u", "patient_id", "Key", ["own key"])]
    columns = spark.createDataFrame(rows, "table string, column string, description string, keywords array<string>")
    tags = spark.createDataFrame([("u", ["Waiting", "Two words"])], "table string, tags array<string>")
    index = keywords.postings(columns, tags)
    details = columns.groupBy("table").agg(F.count("*").alias("n"))
    wide = keywords.discovered(index, ["patient"], details).collect()
    assert [r["rank"] for r in sorted(wide, key=lambda r: r["rank"])] == list(range(1, 11)) and all(r["answer"] == "narrow" and r["found"] == 26 and r["n"] is None for r in wide)
    assert [(r["answer"], r["found"], r["table"], r["hits"], r["n"]) for r in keywords.discovered(index, ["wait"], details).collect()] == [("datasets", 1, "u", 2, 2)]
    assert [r["table"] for r in keywords.discovered(index, ["area7", "two words"], details).orderBy("table").collect()] == ["t7", "u"]
    assert keywords.discovered(index, ["nothing"], details).collect() == []
    named = columns.withColumns({"data_type": F.lit("INTEGER"), "role": F.when(F.col("column") == "patient_count", "measure").otherwise("dimension")})
    assert [(r["table"], r["column"]) for r in keywords.searched(index, "PATIENT", named, "dimension").collect()] == [("u", "patient_id")]
    assert keywords.searched(index, "waiting", named).collect() == []  # a tag is no column
    assert len(keywords.searched(index, "count", named, most=3).collect()) == 3


def test_metrics_that_miss(spark):
    rows = spark.createDataFrame([("2024-01", "a", 1.0), ("2024-02", "b", 2.0)], "period string, area string, patient_count double")
    with pytest.raises(ValueError, match="like it are patient_count"):
        api.metric_context(rows, "count", {}, rows)
    kpis = spark.createDataFrame([("patient_count", "Patients", "people")], "column string, label string, unit string")
    one = api.metric_context(rows, "patient_count", {"area": "c", "x": 1}, kpis).first()
    assert (one["label"], one["unit"], one["rows_found"], one["invalid_filters"], one["latest_period"]) == ("Patients", "people", 0, "x", "2024-02")
    assert api.metric_context(rows, "patient_count", {"area": "a"}, kpis, most=0).first()["truncated"]


def test_assignment_by_rounds_is_the_greedy_one(spark):
    rng = random.Random(2)
    pairs = [(f"s{s}", p, f"c{p}", f"r{r}", rng.choice([0.8, 0.85, 0.9, 1.0])) for s in range(12) for p in range(9) for r in range(9) if rng.random() < 0.6]
    pairs += [("same", p, f"c{p}", f"r{r}", 1.0 - r / 100) for p in range(6) for r in range(6)]  # all want the same
    want, taken = [], set()
    for s, p, c, r, score in sorted(pairs, key=lambda x: (x[0], x[1], x[2], -x[4], x[3])):
        if (s, p, c) not in taken and (s, r) not in taken:
            taken |= {(s, p, c), (s, r)}
            want.append((s, p, c, r, score))
    got = match.assigned(spark.createDataFrame(pairs, "source string, position long, column string, reference string, score double"), "source")
    assert sorted(map(tuple, got.select("source", "position", "column", "reference", "score").collect())) == sorted(want)
