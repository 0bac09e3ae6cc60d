"""Queries of reports on loads, runs, metadata, catalogs and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import names
from ledgerline.operators import analytics as A
from ledgerline.operators import export as E
from ledgerline.operators import metadata as MD
from ledgerline.operators import ops as O
from ledgerline.sources.tables import table

from .inputs import CODES, given, plain
from .loading import HISTORY_SQL, LEDGER_SQL, SOURCES, SOURCES_SQL, history, ledger
from .registry import query
from .shared import folder
from .sheets import stored

EVENTS = "SELECT event_id, ts, user_id AS run_id, event_type, value, CAST(get_json_object(props, '$.k') AS INT) AS k FROM {events}"
EVENTS_SQL = "SELECT event_id, ts, user_id AS run_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"


def events(spark, d):
    return given(spark, d, EVENTS)


@query(f"SELECT manifest_name, count(*) FILTER (status = 'loaded') AS loaded, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'pending') AS pending FROM ({LEDGER_SQL}) GROUP BY 1")
def a10_status_counts(spark, d):
    return O.status_counts(ledger(spark, d), "manifest_name", ["loaded", "failed", "skipped", "pending"])


@query(f"SELECT period, count(*) AS files, CAST(sum(rows_loaded) FILTER (status = 'loaded') AS BIGINT) AS total_rows, max(updated_at) AS last_load, count(*) FILTER (status <> 'loaded') AS pending FROM ({LEDGER_SQL}) GROUP BY 1")
def a11_load_status(spark, d):
    return O.load_status(ledger(spark, d))


@query(f"SELECT CAST(updated_at AS DATE) AS day, count(*) AS files, CAST(sum(rows_loaded) AS BIGINT) AS total_rows, count(DISTINCT manifest_name) AS manifests, count(*) FILTER (status = 'failed') AS failures FROM ({LEDGER_SQL}) WHERE updated_at >= TIMESTAMP '2000-01-01' GROUP BY 1")
def a12_daily_summary(spark, d):
    return O.daily_summary(ledger(spark, d), F.expr("timestamp_ntz '2000-01-01 00:00:00'"))


@query(f"SELECT s.code, count(DISTINCT l.period) AS periods, CAST(coalesce(sum(l.rows_loaded), 0) AS BIGINT) AS total_rows, max(l.updated_at) AS last_load, CASE WHEN max(l.updated_at) >= TIMESTAMP '2000-06-01' THEN 'Active' ELSE 'Stale' END AS health FROM ({SOURCES_SQL}) s LEFT JOIN ({LEDGER_SQL}) l ON l.source = s.code GROUP BY 1")
def a13_publication_health(spark, d):
    return O.publication_health(given(spark, d, SOURCES), ledger(spark, d), F.lit("2000-06-01").cast("timestamp_ntz"))


@query(f"SELECT k % 5 AS error_type, count(*) AS errors, array_to_string(list_sort(list_distinct(list(CAST(run_id AS VARCHAR)))), ',') AS runs FROM ({EVENTS_SQL}) WHERE event_type = 'error' GROUP BY 1")
def a14_error_breakdown(spark, d):
    return events(spark, d).where("event_type = 'error'").groupBy((F.col("k") % 5).alias("error_type")).agg(F.count("*").alias("errors"), F.array_join(F.array_sort(F.collect_set(F.col("run_id").cast("string"))), ",").alias("runs"))


@query(f"SELECT event_type, count(*) AS calls, round(avg(value), 4) AS mean, max(value) AS most FROM ({EVENTS_SQL}) GROUP BY 1")
def a15_stage_performance(spark, d):
    return O.stage_performance(events(spark, d), "event_type", "value")


@query(f"SELECT date_trunc('day', ts) AS day, count(*) AS calls, CAST(sum(k) AS BIGINT) AS tokens, CAST(sum(k) AS BIGINT) * 0.000001 AS cost FROM ({EVENTS_SQL}) GROUP BY 1")
def a16_a18_cost_per_day(spark, d):
    return O.cost_per_day(events(spark, d), "ts", "k", 0.000001)


@query("SELECT md5(text) AS prompt, count(*) AS uses, count(DISTINCT conv_id) AS conversations FROM conversations GROUP BY 1 HAVING count(*) > 1")
def a17_prompt_reuse(spark, d):
    return O.prompt_reuse(given(spark, d, "SELECT conv_id, text FROM {conversations}"), "text", "conv_id")


@query(f"SELECT source, CAST(sum(rows_loaded) AS BIGINT) AS total_rows, count(DISTINCT period) AS periods, min(period) AS first_period, max(period) AS last_period FROM ({LEDGER_SQL}) GROUP BY 1")
def a19_completeness(spark, d):
    return O.completeness(ledger(spark, d))


@query(f"SELECT manifest_name, count(*) AS total, count(*) FILTER (status = 'loaded') AS loaded, count(*) FILTER (status = 'failed') AS failed, CAST(coalesce(sum(rows_loaded) FILTER (status = 'loaded'), 0) AS BIGINT) AS total_rows, date_diff('month', CAST(max(period) || '-01' AS DATE), DATE '2001-01-01') AS age_months, date_diff('month', CAST(max(period) || '-01' AS DATE), DATE '2001-01-01') <= 2 AS current FROM ({LEDGER_SQL}) GROUP BY 1")
def a24_batch_statistics(spark, d):
    return O.batch_statistics(ledger(spark, d), F.lit("2001-01-01").cast("date"))


RUN = f"""SELECT run_id, min(ts) AS began, max(ts) AS ended, count(*) FILTER (event_type = 'signup') AS started, count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'error' AND k < 10) AS failed, arg_min(k, CASE WHEN event_type = 'error' AND k < 10 THEN ts END) AS first_failure FROM ({EVENTS_SQL}) GROUP BY 1"""
STATUS = f"SELECT *, CASE WHEN failed > 0 THEN 'FAILED' WHEN started = 0 THEN 'NO_WORK' WHEN completed >= started THEN 'SUCCESS' ELSE 'INCOMPLETE' END AS status FROM ({RUN})"


def runs(spark, d):
    kind = F.when((F.col("event_type") == "error") & (F.col("k") >= 10), "notice").otherwise(F.col("event_type"))
    return O.run_analysis(events(spark, d).withColumn("kind", kind), "run_id", "k", "kind", "ts", "signup", "purchase", "error")


@query(STATUS)
def a25_run_analysis(spark, d):
    return runs(spark, d)


@query(f"SELECT status, count(*) AS runs, array_to_string(list_sort(list(CAST(run_id AS VARCHAR)) FILTER (status = 'FAILED')), ',') AS restart FROM ({STATUS}) GROUP BY 1".replace("array_to_string(list", "coalesce(array_to_string(list").replace("',') AS restart", "','), '') AS restart"))
def a26_all_runs(spark, d):
    failed = F.array_sort(F.collect_set(F.when(F.col("status") == "FAILED", F.col("run_id").cast("string"))))
    return runs(spark, d).groupBy("status").agg(F.count("*").alias("runs"), F.array_join(failed, ",").alias("restart"))


@query(f"SELECT manifest_name, count(DISTINCT file_url) AS sheets, CAST(sum(rows_loaded) AS BIGINT) AS total_rows, array_to_string(list_sort(list_distinct(list(period))), ',') AS periods FROM ({LEDGER_SQL}) GROUP BY 1")
def a27_evidence(spark, d):
    return ledger(spark, d).groupBy("manifest_name").agg(F.count_distinct("file_url").alias("sheets"), F.sum("rows_loaded").alias("total_rows"), F.array_join(F.array_sort(F.collect_set("period")), ",").alias("periods"))


@query("SELECT s.n_nationkey AS nation, catalog_rows, actual_rows, abs(catalog_rows - actual_rows) > 5 OR abs(catalog_rows - actual_rows) > 0.05 * actual_rows AS inconsistent, actual_rows > 0 AS filled FROM (SELECT n_nationkey, 60 AS catalog_rows FROM nation) s JOIN (SELECT c_nationkey, count(*) AS actual_rows FROM customer GROUP BY 1) a ON a.c_nationkey = s.n_nationkey")
def a29_consistency(spark, d):
    told = given(spark, d, "SELECT n_nationkey AS nation, 60 AS catalog_rows FROM {nation}")
    real = given(spark, d, "SELECT c_nationkey AS nation, count(*) AS actual_rows FROM {customer} GROUP BY c_nationkey")
    gap = F.abs(F.col("catalog_rows") - F.col("actual_rows"))
    return told.join(real, "nation").withColumns({"inconsistent": (gap > 5) | (gap > 0.05 * F.col("actual_rows")), "filled": F.col("actual_rows") > 0})


@query(f"SELECT code, last_load, round(date_diff('second', last_load, TIMESTAMP '2001-12-31') / 3600.0, 2)::DOUBLE AS age_hours, date_diff('second', last_load, TIMESTAMP '2001-12-31') / 3600.0 > 1000 AS stale FROM (SELECT source AS code, max(loaded_at) AS last_load FROM ({HISTORY_SQL}) GROUP BY 1)")
def a29_freshness(spark, d):
    last = history(spark, d).groupBy(F.col("source").alias("code")).agg(F.max("loaded_at").alias("last_load"))
    return O.freshness(last, "last_load", F.lit("2001-12-31").cast("timestamp"), 1000)


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("customer", "part", "supplier", "orders")))
def a35_row_counts(spark, d):
    out = None
    for t in ("customer", "part", "supplier", "orders"):
        one = given(spark, d, f"SELECT '{t}' AS table_name, count(*) AS n FROM {{{t}}}")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT (SELECT count(*) FROM ({SOURCES_SQL})) AS sources, (SELECT count(*) FROM ({HISTORY_SQL})) AS loads, (SELECT count(*) FROM ({LEDGER_SQL})) AS files, (SELECT count(*) FROM ({LEDGER_SQL}) WHERE status = 'failed') AS failed")
def a36_store_overview(spark, d):
    one = given(spark, d, SOURCES).agg(F.count("*").alias("sources"))
    files = ledger(spark, d).agg(F.count("*").alias("files"), F.count_if(F.col("status") == "failed").alias("failed"))
    return one.crossJoin(history(spark, d).agg(F.count("*").alias("loads"))).crossJoin(files)


# --- metadata --------------------------------------------------------------------------------------------

META = f"SELECT DISTINCT concat('t_', c_nationkey) AS tbl, concat(lower(c_mktsegment), CASE c_custkey % 8 WHEN 0 THEN '_count' WHEN 1 THEN '_code' WHEN 2 THEN '_date' WHEN 3 THEN '_rate' WHEN 4 THEN '_weeks' WHEN 5 THEN '_band' WHEN 6 THEN '_provider_name' ELSE '_x' END) AS col, CASE c_custkey % 3 WHEN 0 THEN 'Number of items, by region' WHEN 1 THEN 'The cost to the target group' END AS description, CASE c_custkey % 4 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'TEXT' WHEN 2 THEN 'DATE' ELSE 'NUMERIC' END AS data_type FROM {{customer}}".replace("{{", "{").replace("}}", "}")
META_SQL = plain(META)


def meta(spark, d):
    return given(spark, d, META).withColumnsRenamed({"tbl": "table", "col": "column"})


N = ", ".join(f"'{x}'" for x in MD.NUMERIC)
MEASURE = f"((regexp_matches(lower(col), '(^|_)({MD.MEASURES})$|^({MD.MEASURES})_') AND NOT regexp_matches(lower(col), '_id|_code|_key')) OR (data_type IN ({N}) AND NOT regexp_matches(lower(col), '_id|_code|_key|identifier') AND regexp_matches(lower(coalesce(description, '')), '{MD.MEASURES}')))"
DIMENSION = f"(data_type IN ('DATE', 'TIMESTAMP') OR regexp_matches(lower(col), '{MD.TIMES}') OR regexp_matches(lower(col) || chr(10) || lower(coalesce(description, '')), '{MD.PLACES}|{MD.PEOPLE}') OR regexp_matches(lower(col), '{MD.KINDS}') OR regexp_matches(lower(col), '(_code|_name|_id)$'))"
UNIT = "CASE WHEN regexp_matches(lower(coalesce(description, '')), 'percentage|percent|rate|proportion') THEN 'percentage' WHEN regexp_matches(lower(col) || chr(10) || lower(coalesce(description, '')), 'count|number of|total') THEN 'count' WHEN contains(lower(col), 'week') THEN 'weeks' WHEN regexp_matches(lower(col), 'days|time.*day|day.*time') THEN 'days' WHEN regexp_matches(lower(col), 'months|time.*month|month.*time') THEN 'months' WHEN regexp_matches(lower(col), 'years|time.*year|year.*time') THEN 'years' WHEN contains(lower(col), 'time') THEN 'time_period' WHEN regexp_matches(lower(coalesce(description, '')), '£|gbp|pounds|cost|spend') THEN 'GBP' WHEN data_type IN ('INTEGER', 'BIGINT') THEN 'count' WHEN data_type IN ('NUMERIC', 'DECIMAL') THEN 'numeric' ELSE 'unknown' END"


@query(f"""SELECT tbl AS "table", col AS "column", data_type, description, {MEASURE} AS is_measure, {DIMENSION} AS is_dimension, {UNIT} AS unit, regexp_matches(lower(col || ' ' || coalesce(description, '')), '{MD.TARGETS}') AS has_target FROM ({META_SQL})""")
def d24_column_roles(spark, d):
    return MD.described(meta(spark, d)).select("table", "column", "data_type", "description", "is_measure", "is_dimension", "unit", "has_target")


TARGET = f"regexp_matches(lower(col || ' ' || coalesce(description, '')), '{MD.TARGETS}')"
TOLD = f"""SELECT *, CASE WHEN unit IN ('percentage', 'rate') THEN 'weighted_average' WHEN unit = 'count' OR contains(lower(col), 'count') THEN 'sum' WHEN unit IN ('weeks', 'days', 'months', 'years') AND contains(lower(col), 'median') THEN 'median' ELSE 'average' END AS aggregation, CASE WHEN target THEN 'performance' ELSE 'intelligence' END AS metric_type
FROM (SELECT tbl, col, {MEASURE} AS is_measure, {DIMENSION} AND NOT {MEASURE} AS is_dimension, {UNIT} AS unit, {TARGET} AS target FROM ({META_SQL}))"""


def first_sql(pattern: str) -> str:
    return f"min(replace(col, '_', ' ')) FILTER (is_dimension AND regexp_matches(lower(col), '{pattern}'))"


@query(f"""WITH t AS (SELECT tbl, list({{'c': col, 'u': unit, 'a': aggregation, 'm': metric_type}} ORDER BY col, unit, aggregation, metric_type) FILTER (is_measure) AS k, list({{'c': col, 'n': n}} ORDER BY col) FILTER (is_dimension) AS g,
 {first_sql('^provider')} AS provider, {first_sql(MD.TIMES)} AS timed, {first_sql(MD.PLACES)} AS place, {first_sql(MD.PEOPLE)} AS people, {', '.join(f"{first_sql(x)} AS lens_{x}" for x in MD.LENSES)} FROM ({TOLD}) JOIN (SELECT tbl, col, count(*) AS n FROM ({META_SQL}) GROUP BY ALL) USING (tbl, col) GROUP BY tbl),
q AS (SELECT *, replace(k[1].c, '_', ' ') AS label FROM t)
SELECT tbl AS "table", '[' || coalesce(array_to_string(list_transform(k, lambda x: '{{"column":"' || x.c || '","unit":"' || x.u || '","aggregation":"' || x.a || '","metric_type":"' || x.m || '"}}'), ','), '') || ']' AS kpis,
 '[' || coalesce(array_to_string(list_transform(g, lambda x: '{{"column":"' || x.c || '","distinct_values":' || x.n || '}}'), ','), '') || ']' AS dimensions, CAST(coalesce(len(k), 0) AS INT) AS n_kpis, CAST(coalesce(len(g), 0) AS INT) AS n_dimensions,
 concat_ws(',', {', '.join(f"CASE WHEN lens_{x} IS NOT NULL THEN '{x}' END" for x in MD.LENSES)}) AS lenses,
 CASE WHEN provider IS NULL AND timed IS NULL THEN 'unknown' ELSE concat_ws('_', CASE WHEN provider IS NOT NULL THEN 'provider' END, CASE WHEN timed IS NOT NULL THEN 'periodic' END) END AS granularity,
 concat_ws(' | ', CASE WHEN timed IS NOT NULL THEN label || ' trend over time' END, label || ' by ' || place, label || ' by ' || people, label || ' compared with ' || replace(k[2].c, '_', ' ')) AS typical_queries FROM q""")
def a20_metadata_roll_up(spark, d):
    known = meta(spark, d).groupBy("table", "column").agg(F.count("*").alias("distinct_values"))
    return MD.rolled_up(meta(spark, d), known)


@query(f"""SELECT tbl AS "table", count(*) AS columns, count(*) FILTER (description IS NULL) AS no_description, count(*) FILTER (data_type IS NULL) AS no_type, count(*) FILTER (NOT ({DIMENSION} OR {MEASURE})) AS no_role,
CASE WHEN count(*) FILTER (description IS NULL) + count(*) FILTER (NOT ({DIMENSION} OR {MEASURE})) > 3 THEN 'WARNINGS' ELSE 'OK' END AS verdict FROM ({META_SQL}) GROUP BY 1""")
def a22_metadata_audit(spark, d):
    return O.metadata_audit(MD.described(meta(spark, d)), "table")


@query(f"""SELECT tbl AS "table", count(*) FILTER ({MEASURE}) AS measures, count(*) FILTER ({DIMENSION}) AS dimensions, round(count(description) * 100 / count(*), 2) AS described_pct, count(description) * 100 >= 80 * count(*) AS enough FROM ({META_SQL}) GROUP BY 1""")
def a28_a37_field_shares(spark, d):
    n = F.count("*")
    return MD.described(meta(spark, d)).groupBy("table").agg(F.count_if("is_measure").alias("measures"), F.count_if("is_dimension").alias("dimensions"), F.round(F.count("description") * 100 / n, 2).alias("described_pct"), (F.count("description") * 100 >= 80 * n).alias("enough"))


@query("SELECT 'p_comment' AS column_name, 'error' AS level, 'no values' AS finding UNION ALL SELECT 'p_note', 'warning', 'mostly empty'")
def a21_table_findings(spark, d):
    rows = given(spark, d, "SELECT p_partkey, CAST(NULL AS STRING) AS p_comment, CASE WHEN p_partkey % 10 = 0 THEN p_name END AS p_note FROM {part}")
    return O.table_findings(A.profile(rows), rows.count(), strict=True)


@query(f"""SELECT tbl AS "table", sum(CASE WHEN contains(col, 'building') THEN 1 ELSE 0 END)::BIGINT AS hits FROM ({META_SQL}) GROUP BY 1 HAVING sum(CASE WHEN contains(col, 'building') THEN 1 ELSE 0 END) > 0 ORDER BY 2 DESC, 1 LIMIT 50""")
def j13_q05_keyword_sources(spark, d):
    from ledgerline.plans.api import discover

    return discover(meta(spark, d), ["building"])


# --- catalogs and exports --------------------------------------------------------------------------------

EXPORTED = ("customer", "orders", "part")


@query("SELECT 'orders' AS code, count(*) AS n_rows, 6 AS n_columns, CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date FROM orders UNION ALL SELECT 'customer', count(*), 5, NULL, NULL FROM customer UNION ALL SELECT 'part', count(*), 6, NULL, NULL FROM part")
def w09_catalog(spark, d):
    return E.catalog({t: given(spark, d, f"SELECT * FROM {{{t}}}") for t in EXPORTED})


@query("SELECT 'part' AS code, count(*) AS n_rows, 6 AS n_columns FROM part")
def w07_export_by_prefix(spark, d):
    return E.exported_all(spark, EXPORTED, lambda t: given(spark, d, f"SELECT * FROM {{{t}}}"), "pa", folder(spark, "w07")).select("code", "n_rows", "n_columns")


@query("""SELECT 'customer' AS code, true AS success, count(*) AS n_rows, 5 AS n_columns, true AS sized, false AS failed FROM customer UNION ALL SELECT 'nowhere', false, 0, 0, false, true
UNION ALL SELECT 'part', true, count(*), 6, true, false FROM part""")
def w07_export_results(spark, d):
    """Exports with their sizes, and one of a source that has no table."""
    done = E.exported_all(spark, ["part", "customer", "nowhere"], lambda t: table(spark, d, t), "", folder(spark, "w07r"))
    return done.select("code", "success", "n_rows", "n_columns", (F.col("size_bytes") > 0).alias("sized"), F.col("error").isNotNull().alias("failed"))


@query("SELECT 'orders' AS code, count(*) AS n_rows, 6 AS n_columns, CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date, true AS sized FROM orders UNION ALL SELECT 'customer', count(*), 5, NULL, NULL, true FROM customer")
def w09_sized_catalog(spark, d):
    return E.sized_catalog(spark, {t: f"{d}/{t}.parquet" for t in ("orders", "customer")}).withColumn("sized", F.col("size_kb") > 0).drop("size_kb")


@query(f"""WITH r AS (SELECT tbl, col, CASE WHEN {DIMENSION} THEN 0 WHEN {MEASURE} THEN 1 ELSE 2 END AS g, data_type, description, n FROM (SELECT tbl, col, min(data_type) AS data_type, min(description) AS description, count(*) AS n FROM ({META_SQL}) GROUP BY ALL)),
l AS (SELECT *, '#### `' || col || '`' || chr(10) || '  ' || chr(10) || '**Type:** ' || coalesce(data_type, '?') || coalesce('  ' || chr(10) || '**Description:** ' || nullif(description, ''), '') || '  ' || chr(10) || '**Distinct Values:** ' || n || '  ' || chr(10) || '**Search Terms:** ' || replace(col, '_', ', ') || '  ' || chr(10) || '**Metadata Quality:** ~ enrichment (confidence: 0.85)' || chr(10) AS line FROM r)
SELECT tbl AS "table", '# ' || tbl || chr(10) || chr(10) || '**Rows:** ' || sum(n) || chr(10) || '**Columns:** ' || count(*) || chr(10) || chr(10) || '## Purpose' || chr(10) || chr(10) || 'Columns of ' || tbl || chr(10) || chr(10) || '## Columns' || chr(10) || chr(10) ||
 concat_ws(chr(10), {', '.join(f"'### {t}' || chr(10) || string_agg(line, chr(10) ORDER BY col) FILTER (g = {k})" for k, t in enumerate(("Dimensions", "Measures", "Other")))}) AS markdown FROM l GROUP BY tbl""")
def w08_full_dictionaries(spark, d):
    columns = meta(spark, d).groupBy("table", "column").agg(F.min("data_type").alias("data_type"), F.min("description").alias("description"), F.count("*").alias("distinct_values"))
    told = MD.described(columns).withColumns({"original_name": F.col("column"), "least": F.lit(None).cast("string"), "most": F.lit(None).cast("string"), "null_rate": F.lit(None).cast("double"), "search_terms": F.split("column", "_"), "confidence": F.lit(0.85), "metadata_source": F.lit("enrichment")})
    purposes = columns.groupBy("table").agg(F.sum("distinct_values").alias("n_rows")).withColumn("purpose", F.concat(F.lit("Columns of "), "table"))
    return E.full_dictionaries(told, "table", purposes)


@query(f"""SELECT DISTINCT 'd' || p_partkey % 50 AS code, 'error' AS level, 'section missing' AS finding, 'Search Terms:' AS detail FROM part WHERE p_partkey % 50 % 7 = 0
UNION ALL SELECT DISTINCT 'd' || p_partkey % 50, 'error', 'documented column absent', 'c' || p_size FROM part WHERE p_size % 10 = 3
UNION ALL SELECT DISTINCT 'd' || p_partkey % 50, 'warning', 'undocumented column', 'c' || p_size FROM part WHERE p_size % 10 = 4""")
def u03_dictionary_findings(spark, d):
    """Dictionaries that document a column too many where its number ends in 3, and one too few where it ends in 4."""
    columns = given(spark, d, "SELECT DISTINCT concat('d', p_partkey % 50) AS code, p_partkey % 50 AS k, concat('c', p_size) AS `column`, p_size FROM {part}")
    block = F.concat(F.lit("#### `"), "column", F.lit("`\n**Description:** x\n**Type:** INTEGER\n"), F.when(F.col("k") % 7 == 0, "").otherwise("**Search Terms:** y\n"))
    blocks = columns.withColumn("block", F.when(F.col("p_size") % 10 != 4, block)).groupBy("code", "k").agg(F.array_join(F.array_sort(F.collect_list("block")), "\n").alias("blocks"))
    head = F.concat(F.lit("# x\n## Columns\nType: Description: "), F.when(F.col("k") % 7 == 0, "\n").otherwise("Search Terms:\n"))
    texts = blocks.select("code", F.concat(head, F.col("blocks")).alias("markdown"))
    return E.dictionary_findings(texts, columns.where("p_size % 10 <> 3"))


SECTIONS = tuple((t, k) for k, t in enumerate(E.TITLES))


@query(f"""WITH r AS (SELECT tbl, col, CASE WHEN col LIKE '\\_%' ESCAPE '\\' THEN 3 WHEN {DIMENSION} THEN 0 WHEN {MEASURE} THEN 1 ELSE 2 END AS g, '#### `' || col || '` ✓' || chr(10) || '- ' || coalesce(description, '') || chr(10) || '- type: ' || coalesce(data_type, '?') AS line FROM ({META_SQL}))
SELECT tbl AS "table", concat_ws(chr(10), '# ' || tbl, {', '.join(f"'### {t}' || chr(10) || string_agg(line, chr(10) ORDER BY col, line) FILTER (g = {k})" for t, k in SECTIONS)}) AS markdown FROM r GROUP BY tbl""")
def w08_dictionaries(spark, d):
    return E.dictionaries(MD.described(meta(spark, d)).withColumn("confidence", F.lit(0.95)), "table")


@query("SELECT (SELECT count(*) FROM part) AS table_rows, (SELECT count(*) FROM part) - 2 AS export_rows, '' AS different_columns, (SELECT 2 + 2 * count(*) FROM part WHERE p_partkey % 100 = 7) AS different_rows")
def u03_export_verification(spark, d):
    rows = given(spark, d, "SELECT * FROM {part}")
    spoilt = rows.where("p_partkey > 1").withColumn("p_size", F.when(F.col("p_partkey") % 100 == 7, F.col("p_size") + 9999).otherwise(F.col("p_size")))
    return E.verification(rows, stored(spoilt, "u03"))


@query("SELECT *, deleted = 1 AND spoilt = 2 AND untouched = 0 AS detected FROM (SELECT 1 AS deleted, 2 AS spoilt, 0 AS untouched FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part))")
def u04_verifier_self_test(spark, d):
    """Rows that the export check finds wrong after one row is deleted, after 9999 is added to one value, and in a true copy."""
    rows = given(spark, d, "SELECT * FROM {part}")
    least = F.broadcast(rows.agg(F.min("p_partkey").alias("least")))  # one row
    marked = rows.join(least, F.col("p_partkey") == F.col("least"), "left")
    cases = {"deleted": marked.where("least is null").drop("least"), "spoilt": marked.withColumn("p_size", F.col("p_size") + F.when(F.col("least").isNotNull(), 9999).otherwise(0)).drop("least"), "untouched": rows}
    found = None
    for name, case in cases.items():
        one = E.differences(rows, stored(case, "u04")).agg(F.count("*").cast("int").alias(name))
        found = one if found is None else found.crossJoin(one)  # of one row each
    return found.withColumn("detected", (F.col("deleted") == 1) & (F.col("spoilt") == 2) & (F.col("untouched") == 0))


@query(f"""SELECT domain, count(*) AS datasets, string_agg(code, ',' ORDER BY code) AS codes FROM (SELECT code, CASE WHEN regexp_matches(lower(code), 'widget|bolt') THEN 'Hardware' WHEN regexp_matches(lower(code), 'historic') THEN 'Archive' ELSE 'Other' END AS domain FROM ({plain(CODES)})) GROUP BY 1""")
def w18_registry_by_domain(spark, d):
    rows = given(spark, d, CODES).withColumn("domain", names.domain(F.col("code"), [("widget|bolt", "Hardware"), ("historic", "Archive")]))
    return rows.groupBy("domain").agg(F.count("*").alias("datasets"), F.array_join(F.array_sort(F.collect_list("code")), ",").alias("codes"))


# --- work lists, catalogs and rankings -------------------------------------------------------------------


@query(f"SELECT code, domain FROM ({SOURCES_SQL}) WHERE (domain = 'BUILDING' OR contains(code, '99')) AND weight >= 1000")
def r07_catalog_filter(spark, d):
    return given(spark, d, SOURCES).where(((F.col("domain") == "BUILDING") | F.contains("code", F.lit("99"))) & (F.col("weight") >= 1000)).select("code", "domain")


@query(f"SELECT l.id, l.source FROM ({LEDGER_SQL}) l JOIN ({SOURCES_SQL}) s ON s.code = l.source WHERE s.weight > 0 AND l.status <> 'loaded'")
def r11_work_list(spark, d):
    return O.work_list(ledger(spark, d), given(spark, d, SOURCES).where("weight > 0")).select("id", "source")


@query(f"""SELECT id, level, finding FROM (SELECT id, 'error' AS level, 'failed file' AS finding FROM ({LEDGER_SQL}) WHERE status = 'failed' UNION ALL SELECT id, 'warning', 'few rows' FROM ({LEDGER_SQL}) WHERE rows_loaded < 5000 UNION ALL SELECT id, 'warning', 'odd period' FROM ({LEDGER_SQL}) WHERE period LIKE '%-13' UNION ALL
SELECT id, 'error', 'duplicate file' FROM (SELECT id, count(*) OVER (PARTITION BY manifest_name, file_url) AS n FROM ({LEDGER_SQL})) WHERE n > 1)""")
def r12_manifest_findings(spark, d):
    twice = ledger(spark, d).groupBy("manifest_name", "file_url").agg((F.count("*") > 1).alias("twice"))
    rows = ledger(spark, d).join(twice, ["manifest_name", "file_url"])
    rules = [("error", "failed file", F.col("status") == "failed"), ("warning", "few rows", F.col("rows_loaded") < 5000), ("warning", "odd period", F.endswith("period", F.lit("-13"))), ("error", "duplicate file", F.col("twice"))]
    return O.rule_findings(rows, rules, ["id"])


@query(f"""SELECT source, count(*) AS files, bool_or(status = 'loaded') AS enabled, string_agg(period, ',' ORDER BY period NULLS LAST, id) AS periods, CASE WHEN bool_or(status = 'failed') THEN 'append' ELSE 'replace' END AS mode FROM ({LEDGER_SQL}) GROUP BY 1""")
def r13_r16_grouped_files(spark, d):
    return O.grouped_files(ledger(spark, d))


@query(f"SELECT code FROM (SELECT code, CASE WHEN contains(lower(code), 'widget') THEN 1.0 ELSE 0.0 END + CASE WHEN contains(lower(code), 'red') THEN 1 ELSE 0 END + CASE WHEN length(code) > 18 THEN 0.5 ELSE 0 END AS score FROM ({plain(CODES)})) ORDER BY score DESC, code LIMIT 1")
def k05_best_dataset(spark, d):
    return O.best_for(given(spark, d, CODES), ["widget", "red"], F.length("code") > 18)


@query(f"SELECT id, manifest_name, period FROM ({LEDGER_SQL}) WHERE manifest_name = 'm7'")
def k07_manifest_files(spark, d):
    return O.manifest_files(ledger(spark, d), "m7").select("id", "manifest_name", "period")
