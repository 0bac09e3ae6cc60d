"""Queries of reshaping, windows, aggregates and top rows, on orders by month and priority."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators import analytics as A
from ledgerline.operators import profiles as PR
from ledgerline.operators import reshape as R

from .inputs import given, plain, total_sql
from .registry import query
from .shared import folder

BANDS = ["urgent", "high", "medium", "unspecified", "low"]
PRIORITY = dict(zip(BANDS, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], strict=True))


def monthly(spark, d):
    """day and a count of orders for each band."""
    rows = given(spark, d, "SELECT o_orderdate, o_orderpriority FROM {orders}").select(F.trunc("o_orderdate", "month").cast("date").alias("day"), "o_orderpriority")
    wide = rows.groupBy("day").pivot("o_orderpriority", list(PRIORITY.values())).agg(F.count(F.lit(1)))
    return wide.select("day", *[F.coalesce(F.col(f"`{p}`"), F.lit(0)).alias(b) for b, p in PRIORITY.items()])


def long(spark, d):
    return R.melted(monthly(spark, d), ["day"], BANDS, "band", "n")


MONTHLY = "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS day, " + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS {b}" for b, p in PRIORITY.items()) + " FROM orders GROUP BY 1"
LONG = f"SELECT * FROM (UNPIVOT ({MONTHLY}) ON {', '.join(BANDS)} INTO NAME band VALUE n)"


@query(f"SELECT day, band, n, lag(n) OVER w AS previous, round((n - lag(n) OVER w) * 100 / nullif(lag(n) OVER w, 0), 2) AS growth_pct FROM ({LONG}) WINDOW w AS (PARTITION BY band ORDER BY day)")
def n01_band_growth(spark, d):
    return A.growth(long(spark, d), "day", "n", ("band",))


@query(f"""SELECT day, n, lag(n) OVER w AS previous, round((n - lag(n) OVER w) * 100 / nullif(lag(n) OVER w, 0), 2) AS growth_pct FROM (SELECT day, CAST(sum(n) AS BIGINT) AS n FROM ({LONG}) GROUP BY 1) WINDOW w AS (ORDER BY day)""")
def n01_total_growth(spark, d):
    return A.growth(long(spark, d).groupBy("day").agg(F.sum("n").alias("n")), "day", "n")


@query(f"""SELECT day, band, n, round(n * 100 / sum(n) OVER (PARTITION BY day), 1) AS share_pct, round(sum(n) OVER (PARTITION BY day ORDER BY band ROWS UNBOUNDED PRECEDING) * 100 / sum(n) OVER (PARTITION BY day), 1) AS cumulative_pct FROM ({LONG})""")
def n02_cumulative_share(spark, d):
    return A.cumulative_share(long(spark, d), "band", "n", ("day",))


@query(f"SELECT * FROM ({MONTHLY}) WHERE day = (SELECT max(day) FROM ({MONTHLY}))")
def n03_latest_snapshot(spark, d):
    return A.latest(monthly(spark, d), "day")


@query(f"SELECT day, round((urgent + high) * 100 / nullif(urgent + high + medium + unspecified + low, 0), 2) AS short_pct, round((medium + unspecified + low) * 100 / nullif(urgent + high + medium + unspecified + low, 0), 2) AS long_pct FROM ({MONTHLY})")
def n04_short_and_long(spark, d):
    return A.share_of(monthly(spark, d), ["day"], {"short_pct": ["urgent", "high"], "long_pct": ["medium", "unspecified", "low"]})


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def n05_latest_per_key(spark, d):
    rows = given(spark, d, "SELECT o_custkey, o_orderkey, o_orderdate FROM {orders}")
    return A.latest_per_key(rows, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey"))


@query("SELECT p_name, p_partkey, CASE WHEN r > 1 THEN p_name || '_' || r ELSE p_name END AS label FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r FROM part)")
def n06_ordinal_suffix(spark, d):
    from ledgerline.functions.names import numbered

    return numbered(given(spark, d, "SELECT p_name, p_partkey FROM {part}"), "p_name", "p_partkey", []).select("p_name", "p_partkey", F.col("column_name").alias("label"))


@query("SELECT p_type, p_name, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY contains(p_name, 'red'), length(p_name), p_name, p_partkey) = 1")
def n07_best_candidate(spark, d):
    rows = given(spark, d, "SELECT p_type, p_name, p_partkey FROM {part}")
    return A.latest_per_key(rows, ["p_type"], F.contains("p_name", F.lit("red")), F.length("p_name"), F.col("p_name"), F.col("p_partkey"))


@query("SELECT l_orderkey, l_partkey, lead(l_partkey) OVER w - l_partkey AS step, coalesce(lead(l_partkey) OVER w - l_partkey <= 2, false) AS small FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber)")
def n08_steps(spark, d):
    each = Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_linenumber")
    rows = given(spark, d, "SELECT l_orderkey, l_partkey, l_linenumber FROM {lineitem}").withColumn("step", F.lead("l_partkey").over(each) - F.col("l_partkey"))
    return rows.select("l_orderkey", "l_partkey", "step", F.coalesce(F.col("step") <= 2, F.lit(False)).alias("small"))


@query(f"""SELECT day, band, n, round(avg(n) OVER (PARTITION BY band ORDER BY day ROWS 2 PRECEDING), 4) AS moving_avg, round(stddev_samp(n) OVER (PARTITION BY band ORDER BY day ROWS 2 PRECEDING), 4) AS volatility,
lead(n) OVER (PARTITION BY band ORDER BY day) AS following, rank() OVER (PARTITION BY band ORDER BY n DESC) AS place FROM ({LONG})""")
def n09_moving(spark, d):
    return A.moving(long(spark, d), "day", "n", 3, ("band",))


@query(f"""SELECT band, round((pow(last_n / nullif(first_n, 0), 1.0 / nullif(k - 1, 0)) - 1) * 100, 4) AS growth_rate_pct FROM (SELECT band, count(*) AS k, CAST(arg_min(n, day) AS DOUBLE) AS first_n, CAST(arg_max(n, day) AS DOUBLE) AS last_n FROM ({LONG}) GROUP BY 1)""")
def n09_compound_growth(spark, d):
    ends = long(spark, d).groupBy("band").agg(F.count("*").alias("k"), F.min_by("n", "day").alias("first_n"), F.max_by("n", "day").alias("last_n"))
    return ends.select("band", F.round((F.pow(F.try_divide("last_n", "first_n"), F.try_divide(F.lit(1.0), F.col("k") - 1)) - 1) * 100, 4).alias("growth_rate_pct"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_orderkey - lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS gap FROM orders)
SELECT o_custkey, o_orderkey, gap, CAST(sum(CASE WHEN gap >= 2000 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM r""")
def n10_blank_runs(spark, d):
    each = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    rows = given(spark, d, "SELECT o_custkey, o_orderkey FROM {orders}").withColumn("gap", F.col("o_orderkey") - F.lag("o_orderkey").over(each))
    return rows.withColumn("island", F.sum(F.when(F.col("gap") >= 2000, 1).otherwise(0)).over(each.rowsBetween(Window.unboundedPreceding, 0)))


@query(f"""SELECT day, band, n, f AS fiscal, round(avg(n) OVER (PARTITION BY band ORDER BY day ROWS 2 PRECEDING), 4) AS quarter_avg, CAST(sum(n) OVER (PARTITION BY band, f ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS to_date,
round((n - lag(n, 12) OVER (PARTITION BY band ORDER BY day)) * 100 / nullif(lag(n, 12) OVER (PARTITION BY band ORDER BY day), 0), 2) AS year_on_year_pct FROM (SELECT *, CAST(year(day) - CASE WHEN month(day) < 4 THEN 1 ELSE 0 END AS INT) AS f FROM ({LONG}))""")
def n11_year_to_date(spark, d):
    return A.year_to_date(long(spark, d), "day", "n", ("band",))


# --- reshaping -------------------------------------------------------------------------------------------

YEARS = [str(y) for y in range(1996, 2001)]
WIDE_SQL = "SELECT p_type, " + ", ".join(f"count(*) FILTER (year(l_shipdate) = {y}) AS \"Jan-{y}\"" for y in YEARS) + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"


def wide(spark, d):
    rows = given(spark, d, "SELECT p_type, concat('Jan-', year(l_shipdate)) AS y FROM {lineitem} JOIN {part} ON l_partkey = p_partkey")
    return rows.groupBy("p_type").pivot("y", [f"Jan-{y}" for y in YEARS]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT p_partkey AS part_id, p_name AS part_name FROM part")
def r01_renamed(spark, d):
    return R.renamed(given(spark, d, "SELECT p_partkey, p_name FROM {part}"), {"p_partkey": "part_id", "p_name": "part_name", "absent": "x"})


UNPIVOT_SQL = f"SELECT p_type, substr(raw, 5) || '-01-01' AS period, raw AS _raw_period, value FROM (UNPIVOT ({WIDE_SQL}) ON COLUMNS('Jan.*') INTO NAME raw VALUE value)"


@query(UNPIVOT_SQL)
def r02_unpivot_dates(spark, d):
    return R.unpivoted(wide(spark, d), ["p_type"], [f"Jan-{y}" for y in YEARS])


@query(UNPIVOT_SQL)
def r03_unpivot_if_wide(spark, d):
    return R.unpivoted_if_wide(wide(spark, d))[0]


@query(LONG)
def r04_melted_bands(spark, d):
    return long(spark, d)


@query("SELECT c_nationkey, max(c_acctbal) FILTER (c_mktsegment = 'BUILDING') AS \"BUILDING\", max(c_acctbal) FILTER (c_mktsegment = 'MACHINERY') AS \"MACHINERY\" FROM customer GROUP BY 1")
def r05_pivoted_measures(spark, d):
    return R.pivoted(given(spark, d, "SELECT c_nationkey, c_mktsegment, c_acctbal FROM {customer}"), ["c_nationkey"], "c_mktsegment", ["BUILDING", "MACHINERY"], "c_acctbal")


@query("""SELECT 'c_acctbal' AS measure, 'money' AS unit, CAST(c_nationkey AS VARCHAR) AS dimension, c_acctbal AS value, 'customer' AS source FROM customer
UNION ALL SELECT 's_acctbal', 'money', CAST(s_nationkey AS VARCHAR), s_acctbal, 'supplier' FROM supplier UNION ALL SELECT 'p_size', 'count', p_brand, CAST(p_size AS DOUBLE), 'part' FROM part""")
def r06_harmonised(spark, d):
    t = {n: given(spark, d, f"SELECT * FROM {{{n}}}") for n in ("customer", "supplier", "part")}
    return R.harmonised({"customer": (t["customer"], "c_nationkey", "c_acctbal", "money"), "supplier": (t["supplier"], "s_nationkey", "s_acctbal", "money"), "part": (t["part"], "p_brand", "p_size", "count")})


@query("SELECT p_partkey, p_size FROM part WHERE p_type = 'ECONOMY' AND p_size = 11")
def r08_equal_filters(spark, d):
    return R.where_equal(given(spark, d, "SELECT * FROM {part}"), {"p_type": "ECONOMY", "p_size": 11, "unknown": 1})[0].select("p_partkey", "p_size")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE day(o_orderdate) = 1")
def r10_first_of_month(spark, d):
    return given(spark, d, "SELECT o_orderkey, o_orderdate FROM {orders}").where(F.dayofmonth("o_orderdate") == 1)


NUMBERED = "SELECT concat(source, '_', doc_id % 60) AS name, lang FROM {documents} GROUP BY source, lang, doc_id % 60 UNION ALL SELECT concat(p_brand, '_id'), 'pt' FROM {part} GROUP BY p_brand UNION ALL SELECT concat(replace(p_name, ' ', '_'), '_count'), 'pt' FROM {part} GROUP BY p_name"


#: Besides numbered columns, a table of part names and one of 75 columns without a sequence.
SAMPLED = NUMBERED + " UNION ALL SELECT concat(replace(p_name, ' ', '_'), CASE p_size % 5 WHEN 0 THEN '_date' WHEN 1 THEN '_name' WHEN 2 THEN '_score' ELSE '' END), 'parts' FROM {part} GROUP BY 1 UNION ALL SELECT concat('diagnosis_', translate(n_name, '0123456789', 'abcdefghij'), k), 'nations' FROM {nation}, (SELECT '_x' AS k UNION ALL SELECT '_date' UNION ALL SELECT '_id')"


@query(f"""WITH k AS (SELECT lang, name, CASE WHEN regexp_matches(lower(name), '_id|_code') AND NOT contains(lower(name), 'diagnosis') THEN 'ids' WHEN regexp_matches(lower(name), '_date|_time') THEN 'dates' WHEN regexp_matches(lower(name), '_name|_description') THEN 'names'
 WHEN regexp_matches(lower(name), '_count|_total|_percentage|_score|_number') THEN 'measures' WHEN regexp_matches(lower(name), 'diagnosis_|procedure_|medication_') THEN 'codes' ELSE 'other' END AS kind,
 regexp_extract(name, '(?i)^([a-z_]+?)_*([0-9]+)', 1) AS prefix, try_cast(regexp_extract(name, '(?i)^([a-z_]+?)_*([0-9]+)', 2) AS BIGINT) AS number FROM ({plain(SAMPLED)})),
 s AS (SELECT *, lead(number) OVER (PARTITION BY lang, prefix ORDER BY number, name) - number AS step FROM k WHERE prefix <> ''),
 p AS (SELECT lang, prefix AS pattern FROM (SELECT lang, prefix, min(name) AS first FROM s GROUP BY ALL HAVING count(*) >= 10 AND count(*) FILTER (step <= 2) > 0.7 * count(step)) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY first) = 1),
 c AS (SELECT k.*, pattern IS NOT NULL AS patterned, coalesce(prefix = pattern, false) AS member, count(*) OVER (PARTITION BY lang) AS a FROM k LEFT JOIN p USING (lang)),
 r AS (SELECT *, CASE WHEN a <= 50 OR (a <= 75 AND NOT patterned) THEN 'full' WHEN patterned THEN 'sequence' ELSE 'strata' END AS strategy,
  CASE WHEN patterned THEN member::VARCHAR ELSE kind END AS part, count(*) OVER (PARTITION BY lang, part) AS n, row_number() OVER (PARTITION BY lang, part ORDER BY name) AS k FROM c),
 t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY list_position(['ids', 'dates', 'names', 'measures', 'codes', 'other'], kind), name) AS place FROM r
  WHERE strategy = 'full' OR (strategy = 'sequence' AND NOT member) OR (strategy = 'strata' AND kind = 'ids') OR n <= 2 OR k IN (1, n // 2 + 1, n))
SELECT lang, name, kind, strategy FROM t WHERE strategy <> 'strata' OR place <= 30""")
def r14_sampled_columns(spark, d):
    return R.sampled_columns(given(spark, d, SAMPLED), ["lang"], "name", "name")


@query(f"""WITH p AS (SELECT lang, name, regexp_extract(name, '(?i)^([a-z_]+?)_*([0-9]+)', 1) AS prefix, try_cast(regexp_extract(name, '(?i)^([a-z_]+?)_*([0-9]+)', 2) AS BIGINT) AS number FROM ({plain(NUMBERED)})),
 s AS (SELECT *, lead(number) OVER (PARTITION BY lang, prefix ORDER BY number, name) - number AS step FROM p WHERE prefix <> '')
SELECT lang, prefix, count(*) AS members FROM s GROUP BY ALL HAVING count(*) >= 10 AND count(*) FILTER (step <= 2) > 0.7 * count(step)""")
def r15_sequential_groups(spark, d):
    return R.sequential_groups(given(spark, d, NUMBERED), ["lang"], "name")


# --- aggregates ------------------------------------------------------------------------------------------


@query(f"SELECT count(*) AS n, {total_sql('o_totalprice')} AS total, {total_sql('o_totalprice')} / count(*) AS mean FROM orders")
def a01_count_sum_avg(spark, d):
    return given(spark, d, "SELECT o_totalprice FROM {orders}").agg(F.count("*").alias("n"), A.exact_sum("o_totalprice").alias("total"), (A.exact_sum("o_totalprice") / F.count("*")).alias("mean"))


@query(f"SELECT c_mktsegment, {total_sql('c_acctbal')} AS total FROM customer GROUP BY 1")
def a02_sum_by_group(spark, d):
    return given(spark, d, "SELECT c_mktsegment, c_acctbal FROM {customer}").groupBy("c_mktsegment").agg(A.exact_sum("c_acctbal").alias("total"))


@query(f"SELECT l_returnflag, l_linestatus, count(*) AS n, {total_sql('l_extendedprice')} AS total, {total_sql('l_extendedprice')} / count(*) AS mean, min(l_extendedprice) AS least, max(l_extendedprice) AS most FROM lineitem GROUP BY ALL")
def a03_summary(spark, d):
    p = "l_extendedprice"
    return given(spark, d, "SELECT l_returnflag, l_linestatus, l_extendedprice FROM {lineitem}").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), A.exact_sum(p).alias("total"), (A.exact_sum(p) / F.count("*")).alias("mean"), F.min(p).alias("least"), F.max(p).alias("most"))


@query(f"SELECT CAST(month(day) AS INT) AS month, count(*) AS periods, round(avg(n), 2) AS mean, min(n) AS least, max(n) AS most, round(stddev_samp(n), 2) AS spread FROM ({LONG}) GROUP BY 1")
def a04_seasonality(spark, d):
    return A.seasonality(long(spark, d), "day", "n")


@query(f"SELECT band, CAST(sum(n) AS BIGINT) AS total, round(avg(n), 4) AS mean, min(n) AS least, max(n) AS most FROM ({LONG}) GROUP BY 1")
def a05_band_totals(spark, d):
    return A.band_totals(long(spark, d), "band", "n")


@query(f"SELECT band, round(stddev_samp(n) / avg(n), 6) AS variation FROM ({LONG}) GROUP BY 1")
def a06_variation(spark, d):
    return A.variation(long(spark, d), "band", "n")


@query("""SELECT l_returnflag, round(var_samp(l_quantity), 4) AS variance, median(l_quantity) AS middle, quantile_cont(l_quantity, 0.9) AS p90, round(corr(l_quantity, l_extendedprice), 6) AS correlation, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope FROM lineitem GROUP BY 1""")
def a07_spread_and_slope(spark, d):
    rows = given(spark, d, "SELECT l_returnflag, l_quantity, l_extendedprice FROM {lineitem}")
    middle = A.quantiles(rows, "l_returnflag", "l_quantity", {"middle": 0.5, "p90": 0.9}).withColumnRenamed("l_returnflag", "_flag")
    spread = rows.groupBy("l_returnflag").agg(F.round(F.var_samp("l_quantity"), 4).alias("variance"), F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("correlation"), F.round(F.regr_slope("l_extendedprice", "l_quantity"), 3).alias("slope"))
    return spread.join(middle, F.col("l_returnflag").eqNullSafe(F.col("_flag"))).drop("_flag")


@query("""SELECT day, band, n, round((n - avg(n) OVER (PARTITION BY band)) / stddev_samp(n) OVER (PARTITION BY band), 4) AS z FROM ({})""".format(LONG))
def a07_z_scores(spark, d):
    own = Window.partitionBy("band")
    return long(spark, d).withColumn("z", F.round((F.col("n") - F.avg("n").over(own)) / F.stddev_samp("n").over(own), 4))


PROFILED = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS total, count({c}) AS non_null, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS most, round((count(*) - count({c})) * 100 / count(*), 2) AS null_rate FROM part" for c in PROFILED))
def a08_profile(spark, d):
    return A.profile(given(spark, d, "SELECT * FROM {part}"), PROFILED)


BY_PERIOD = "SELECT o_orderkey, o_totalprice, o_orderpriority, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END AS customer, concat(year(o_orderdate), '-', month(o_orderdate)) AS period FROM {orders}"


@query(" UNION ALL ".join(f"SELECT '{name}' AS column_name, count(*) AS total, count({c}) AS non_null, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS most, true AS near FROM orders" for name, c in (("o_orderkey", "o_orderkey"), ("o_orderpriority", "o_orderpriority"), ("customer", "CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END"))))
def a08_period_profiles(spark, d):
    """The profile of all periods from a stored row of sketches for each; near: the estimates lie within 5 % of the exact figures."""
    rows = given(spark, d, BY_PERIOD)
    path = folder(spark, "sketches")
    PR.sketched(rows, "period").write.parquet(path)
    told = PR.profile_of(spark.read.parquet(path)).where("column_name <> 'o_totalprice'")
    exact = A.profile(rows.drop("period")).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact") + 1
    return told.join(exact, "column_name").select("column_name", "total", "non_null", "nulls", "least", "most", near.alias("near"))


@query("SELECT count(*) AS total_rows, 5 AS total_columns FROM customer")
def a09_dataset_stats(spark, d):
    rows = given(spark, d, "SELECT * FROM {customer}")
    return rows.agg(F.count("*").alias("total_rows")).withColumn("total_columns", F.lit(len(rows.columns)))


@query("SELECT count(*) AS total, count(DISTINCT (o_custkey, o_orderdate)) AS distinct_rows FROM orders")
def a31_duplicates(spark, d):
    rows = given(spark, d, "SELECT o_custkey, o_orderdate FROM {orders}")
    return rows.agg(F.count("*").alias("total"), F.count_distinct("o_custkey", "o_orderdate").alias("distinct_rows"))


@query("SELECT p_brand, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def a30_modal_value(spark, d):
    return A.modal(given(spark, d, "SELECT p_brand FROM {part}"), "p_brand")


@query("SELECT l_returnflag, sum(CAST(l_quantity AS BIGINT))::DOUBLE / count(*) AS mean FROM lineitem WHERE l_linestatus = 'F' AND year(l_shipdate) = 1998 GROUP BY 1")
def a34_metric_by_dimension(spark, d):
    rows = given(spark, d, "SELECT l_returnflag, l_quantity, l_linestatus, l_shipdate FROM {lineitem}").where("l_linestatus = 'F' and year(l_shipdate) = 1998")
    return rows.groupBy("l_returnflag").agg((F.sum(F.col("l_quantity").cast("long")).cast("double") / F.count("*")).alias("mean"))


@query("""SELECT event_type, calls, sign(s) * ((2 * abs(s) + 100 * n) // (200 * n))::DOUBLE / 10000 AS mean, middle, p95
FROM (SELECT event_type, count(*) AS calls, count(value) AS n, sum(CAST(round(value * 1000000) AS BIGINT)) AS s, round(median(value), 6) AS middle, round(quantile_cont(value, 0.95), 6) AS p95 FROM events WHERE event_type <> 'error' GROUP BY 1)""")
def a38_latency(spark, d):
    calls = given(spark, d, "SELECT event_type, value FROM {events} WHERE event_type <> 'error'")
    means = calls.groupBy("event_type").agg(F.count("*").alias("calls"), A.exact_mean("value").alias("mean"))
    found = A.quantiles(calls, "event_type", "value", {"middle": 0.5, "p95": 0.95})
    return means.join(found.withColumns({c: F.round(c, 6) for c in ("middle", "p95")}), "event_type", "left")


@query("""SELECT s_suppkey, s_nationkey, s_acctbal, round(avg(s_acctbal) OVER (PARTITION BY s_nationkey), 4) AS region_avg, percent_rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) AS percentile, rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS place, round(avg(s_acctbal) OVER (), 4) AS overall_avg FROM supplier""")
def a39_benchmark(spark, d):
    rows = A.benchmark(given(spark, d, "SELECT s_suppkey, s_nationkey, s_acctbal FROM {supplier}"), "s_nationkey", "s_acctbal")
    return rows.withColumns({c: F.round(c, 4) for c in ("region_avg", "overall_avg")})


@query(f"""WITH b AS (SELECT band, CAST(sum(n) FILTER (year(day) = 2000) AS BIGINT) AS now, CAST(sum(n) FILTER (year(day) = 1999) AS BIGINT) AS "then" FROM ({LONG}) WHERE year(day) IN (1999, 2000) GROUP BY 1)
SELECT band, now, "then", now - "then" AS change, round((now - "then") * 100 / "then", 1) AS growth_pct, round(now * 100 / sum(now) OVER (), 1) AS share_now, round(now * 100 / sum(now) OVER () - "then" * 100 / sum("then") OVER (), 1) AS share_change FROM b""")
def j24_year_over_year(spark, d):
    return A.snapshot_comparison(long(spark, d).withColumn("y", F.year("day")), "y", "band", "n", 2000, 1999)


# --- top rows and sets -----------------------------------------------------------------------------------


@query(f"SELECT day, n, round(n * 100 / sum(n) OVER (), 2) AS share_pct FROM (SELECT day, CAST(sum(n) AS BIGINT) AS n FROM ({LONG}) GROUP BY 1) QUALIFY row_number() OVER (ORDER BY day DESC) <= 6")
def k01_recent_periods(spark, d):
    return A.top_share(long(spark, d).groupBy("day").agg(F.sum("n").alias("n")), "n", [F.desc("day")], 6)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5")
def k02_sample_rows(spark, d):
    return given(spark, d, "SELECT p_partkey, p_name FROM {part}").orderBy("p_partkey").limit(5)


@query("SELECT DISTINCT p_name FROM part ORDER BY 1 LIMIT 20")
def k03_distinct_values(spark, d):
    return given(spark, d, "SELECT p_name FROM {part}").distinct().orderBy("p_name").limit(20)


@query("SELECT source, n, round(n * 100 / sum(n) OVER (), 2) AS share_pct FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1) QUALIFY row_number() OVER (ORDER BY n DESC, source) <= 5")
def k04_largest_datasets(spark, d):
    return A.top_share(given(spark, d, "SELECT source, count(*) AS n FROM {documents} GROUP BY source"), "n", [F.desc("n"), F.col("source")], 5)


@query("SELECT o_orderkey, o_custkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 100) EXCEPT ALL SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN -1 ELSE o_custkey END AS o_custkey FROM orders ORDER BY o_orderkey LIMIT 100)")
def k06_ordered_compare(spark, d):
    rows = given(spark, d, "SELECT o_orderkey, o_custkey FROM {orders}")
    changed = rows.withColumn("o_custkey", F.when(F.col("o_orderkey") % 40 == 0, -1).otherwise(F.col("o_custkey")))
    return rows.orderBy("o_orderkey").limit(100).exceptAll(changed.orderBy("o_orderkey").limit(100))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount = 0")
def k08_zero_rows(spark, d):
    return given(spark, d, "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_discount = 0")


@query("SELECT c_nationkey AS nation, 'customer' AS kind FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier")
def u01_union_all(spark, d):
    return given(spark, d, "SELECT c_nationkey AS nation, 'customer' AS kind FROM {customer}").unionByName(given(spark, d, "SELECT 'supplier' AS kind, s_nationkey AS nation FROM {supplier}"))


@query("SELECT 'both' AS side, c_nationkey AS nation FROM (SELECT c_nationkey FROM customer WHERE c_acctbal > 9800 INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'customer', * FROM (SELECT c_nationkey FROM customer WHERE c_acctbal > 9800 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def u02_set_operations(spark, d):
    rich = given(spark, d, "SELECT c_nationkey AS nation FROM {customer} WHERE c_acctbal > 9800")
    both = rich.intersect(given(spark, d, "SELECT s_nationkey AS nation FROM {supplier}")).withColumn("side", F.lit("both"))
    return both.unionByName(rich.subtract(given(spark, d, "SELECT s_nationkey AS nation FROM {supplier} WHERE s_acctbal > 5000")).withColumn("side", F.lit("customer")))


# --- arrays, maps and JSON -------------------------------------------------------------------------------


@query("SELECT conv_id, turn, list_contains(string_split(lower(text), ' '), 'the') AS has_the, list_has_any(string_split(lower(text), ' '), ['la', 'und']) AS has_any FROM conversations")
def x01_array_tests(spark, d):
    words = F.split(F.lower("text"), " ")
    return given(spark, d, "SELECT conv_id, turn, text FROM {conversations}").select("conv_id", "turn", F.array_contains(words, "the").alias("has_the"), F.arrays_overlap(words, F.array(F.lit("la"), F.lit("und"))).alias("has_any"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_extract_string(props, '$.absent') IS NOT NULL AS has_absent FROM events")
def x02_json_values(spark, d):
    return given(spark, d, "SELECT event_id, props FROM {events}").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.get_json_object("props", "$.absent").isNotNull().alias("has_absent"))


@query("SELECT c_nationkey, array_to_string(list_slice(list_sort(list_distinct(list(c_mktsegment))), 1, 3), '|') AS segments FROM customer GROUP BY 1")
def x03_array_aggregates(spark, d):
    return given(spark, d, "SELECT c_nationkey, c_mktsegment FROM {customer}").groupBy("c_nationkey").agg(F.array_join(F.slice(F.array_sort(F.collect_set("c_mktsegment")), 1, 3), "|").alias("segments"))


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders")
def x04_nest_and_explode(spark, d):
    nested = given(spark, d, "SELECT o_custkey, o_orderkey, o_orderstatus FROM {orders}").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("files"))
    return nested.select("o_custkey", F.explode_outer("files").alias("f")).select("o_custkey", "f.*")


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS first_key, arg_min(o_orderstatus, o_orderkey) AS first_status FROM orders GROUP BY 1")
def x05_first_of_json(spark, d):
    files = F.to_json(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))))
    packed = given(spark, d, "SELECT o_custkey, o_orderkey, o_orderstatus FROM {orders}").groupBy("o_custkey").agg(files.alias("metadata"))
    first = F.element_at(F.from_json("metadata", "array<struct<o_orderkey:bigint,o_orderstatus:string>>"), 1)
    return packed.select("o_custkey", first["o_orderkey"].alias("first_key"), first["o_orderstatus"].alias("first_status"))
