"""What grows with the tables: estimated sizes, conditions on repeats, passes, rounds and what one task holds."""

from __future__ import annotations

import re

from pyspark.sql import functions as F


def test_stored_tables_are_estimated_as_large_as_they_are(spark):
    """A table of few repeated texts must not seem small enough to broadcast: c15 ran out of the driver's memory so."""
    from ledgerline.plans.sheets import stored

    cells = spark.range(200_000).select(F.concat(F.lit("a sheet of some name "), F.col("id") % 3).alias("sheet"), (F.col("id") % 50).cast("int").alias("row"))
    back = stored(cells, "cells")
    assert int(back._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > 200_000 * 24
    assert back.exceptAll(cells).isEmpty() and back.count() == 200_000


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_meet_orders_and_parts_without_sorts_or_broadcasts(spark):
    """d08 to d23, a32, k05, w18: what sorted the lines grew with them; repeats go before codes are spelt, and lines are joined once."""
    from ledgerline.plans.inputs import CODES, FILES, given

    for sql in (CODES, FILES):
        plan = given(spark, "/root/testdata/sf0.001", sql)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan


def test_conditions_on_distinct_values_are_tested_after_the_repeats_go(spark):
    """p09 read every order's five codes by patterns before it dropped repeats."""
    from ledgerline.plans.registry import load

    for name in ("p09_filled_url", "p10_month_spellings"):
        plan = plan_of(load()[name].run(spark, "/root/testdata/sf0.001"))
        below = plan[plan.rindex("Aggregate [", 0, plan.index("Union")):]
        assert "regexp_extract" not in below and "RLIKE" not in below, name


def test_matched_sources_works_file_names_out_once(spark):
    """j15 read all tables for every way, and tested every pattern of every line."""
    from ledgerline.plans.registry import load

    plan = plan_of(load()["j15_matched_sources"].run(spark, "/root/testdata/sf0.001"))
    assert "Relation" not in plan and "regexp_replace" not in plan


def test_profiles_do_not_gather_all_columns_values_in_one_task(spark):
    """a08 sorted every row, once for each column, in the task that read it."""
    from ledgerline.operators.analytics import profile

    rows = spark.createDataFrame([(1, "b", 0.0), (1, None, -0.0), (2, "a", None), (None, "a", float("nan"))], "i int, s string, x double")
    profiled = profile(rows)
    plan = profiled._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate(" in line and not re.search("keys?=\\[\\]", line)]
    assert grouped and all("HashAggregate" in line for line in grouped) and "Expand" not in plan
    found = {r["column_name"]: (r["total"], r["non_null"], r["nulls"], r["distinct_values"], r["least"], r["most"], r["null_rate"]) for r in profiled.collect()}
    assert found == {"i": (4, 3, 1, 2, "1", "2", 25.0), "s": (4, 3, 1, 2, "a", "b", 25.0), "x": (4, 3, 1, 2, found["x"][4], "NaN", 25.0)}
    empty = profile(rows.where("i > 9")).collect()
    assert [(r["total"], r["non_null"], r["distinct_values"], r["least"], r["null_rate"]) for r in empty] == [(0, 0, 0, None, None)] * 3


def test_latency_means_do_not_depend_on_the_order_of_adding_up(spark, tmp_path):
    """a38 and its SQL added doubles up: of a mean in the middle between two results each gave either."""
    import random

    import duckdb

    from ledgerline.plans.registry import load

    rows = []
    for seed, kind in enumerate(("click", "view", "purchase", "signup")):
        cents = [random.Random(seed * 100_000 + k).randrange(0, 10_000) for k in range(19_999)]
        rows += [(kind, c / 100) for c in cents] + [(kind, (100_000_100 - sum(cents)) / 100)]  # 20,000 values, mean 50.00005
    spark.createDataFrame(rows, "event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    entry = load()["a38_latency"]
    found = {r["event_type"]: (r["mean"], r["middle"], r["p95"]) for r in entry.run(spark, str(tmp_path)).collect()}
    assert [found[k][0] for k in sorted(found)] == [50.0001] * 4
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert {k: (mean, middle, p95) for k, _, mean, middle, p95 in con.execute(entry.sql).fetchall()} == found


def test_quantiles_do_not_depend_on_ranges_that_change_when_worked_out_again(spark, monkeypatch):
    """a38: approximate quantiles differ from one evaluation to the next on a cluster; values and their ranges' sizes were placed by two of them."""
    from ledgerline.operators import analytics
    from pyspark.sql import functions as F

    @F.udf("array<double>")
    def drawn(values):
        import random

        return sorted(random.SystemRandom().sample(values, 20))

    monkeypatch.setattr(analytics.F, "percentile_approx", lambda value, marks, accuracy: drawn.asNondeterministic()(F.collect_list(value)))
    calls = spark.range(4000).selectExpr("concat('t', id % 2) kind", "cast(id div 2 as double) value")
    reuse = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        found = analytics.quantiles(calls, "kind", "value", {"middle": 0.5, "p95": 0.95}).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
    assert sorted((r["kind"], r["middle"], round(r["p95"], 6)) for r in found) == [("t0", 999.5, 1899.05), ("t1", 999.5, 1899.05)]


def test_names_of_many_sources_are_compared_once(spark):
    """j14 compared the same two names anew in each source that had both."""
    from ledgerline.operators.match import similar_names

    left = spark.createDataFrame([(s, 1, "Large ring", "large_ring") for s in "abc"], "source string, position int, column string, key string")
    free = spark.createDataFrame([(s, "Large rings", "large_rings") for s in "abd"], "source string, reference string, other string")
    pairs = similar_names(left, free, "source", 0.8)
    assert sorted((r["source"], r["position"], r["reference"], round(r["score"], 4)) for r in pairs.collect()) == [("a", 1, "Large rings", 0.9524), ("b", 1, "Large rings", 0.9524)]
    assert re.search(r"ArrowEvalPython[^\n]*\n[^\n]*RepartitionByExpression[^\n]*\n[^\n]*Aggregate \[key#\d+, other#\d+\]", plan_of(pairs))
