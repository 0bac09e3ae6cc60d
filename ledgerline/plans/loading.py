"""Queries of loads, ledgers and matches, on orders as file ledger, lineitem as load history and customers as sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import names
from ledgerline.operators import export as E
from ledgerline.operators import load as L
from ledgerline.operators import match as M
from ledgerline.operators import ops as O
from ledgerline.sources.tables import kept

from .inputs import CODES, FILES, given, plain, settled
from .registry import query
from .scalar import stable_sql
from .shared import folder

PERIOD = "concat(year(o_orderdate), '-', substr(concat('0', month(o_orderdate)), -2, 2))"
LEDGER = f"""SELECT concat('m', o_custkey % 40) AS manifest_name, concat('https://f.example.org/', o_orderkey % 3000, '.csv') AS file_url, concat('s', o_custkey) AS source,
CASE o_orderstatus WHEN 'F' THEN 'loaded' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, {PERIOD} AS period, CAST(floor(o_totalprice) AS BIGINT) AS rows_loaded, o_orderdate AS updated_at, o_orderkey AS id FROM {{orders}}"""
SOURCES = "SELECT c_custkey AS id, concat('s', c_custkey) AS code, concat('tbl_', lower(c_mktsegment), '_', c_custkey) AS table_name, c_mktsegment AS domain, c_acctbal AS weight, c_nationkey AS nation FROM {customer}"
HISTORY = "SELECT concat('s', l_suppkey) AS source, concat('https://f.example.org/', l_orderkey % 3000, '.csv') AS url, CAST(floor(l_extendedprice) AS BIGINT) AS rows_loaded, l_shipdate AS loaded_at, l_orderkey AS id, l_linenumber AS line FROM {lineitem}"
COLUMNS = "SELECT DISTINCT concat('t', p_brand) AS \"table\", concat(replace(p_name, ' ', '_'), '_', p_type, CASE WHEN p_partkey % 3 {0} END) AS \"column\", CASE WHEN p_size > 48 THEN 'text' ELSE 'int' END AS type FROM {part}"
SPARK_COLUMNS = COLUMNS.replace('"', "`")
ONE_TYPE = "SELECT \"table\", \"column\", min(type) AS type FROM ({}) c GROUP BY ALL"


def columns(spark, d, which):
    rows = given(spark, d, SPARK_COLUMNS.replace("{0}", which))
    return rows.groupBy("table", "column").agg(F.min("type").alias("type"))


def columns_sql(which):
    return ONE_TYPE.format(plain(COLUMNS.replace("{0}", which)))


def ledger(spark, d):
    return given(spark, d, LEDGER)


def history(spark, d):
    return given(spark, d, HISTORY)


LEDGER_SQL, HISTORY_SQL, SOURCES_SQL = plain(LEDGER), plain(HISTORY), plain(SOURCES)


@query(f"SELECT id, source, rows_loaded, CASE WHEN lower(trim(status)) = 'pending' THEN status ELSE status END AS status, 7 AS _load_id, period AS _period, make_date(CAST(substr(period, 1, 4) AS INT), CAST(substr(period, 6) AS INT), 1) AS _period_start, last_day(make_date(CAST(substr(period, 1, 4) AS INT), CAST(substr(period, 6) AS INT), 1)) AS _period_end FROM ({LEDGER_SQL})")
def w01_append_with_lineage(spark, d):
    path = folder(spark, "w01")
    rows = ledger(spark, d).select("id", "source", "rows_loaded", "status", "period")
    L.append(L.stamped(rows, 7, F.lit("2024-01-01").cast("timestamp"), F.col("period")).drop("period"), path)
    return spark.read.parquet(path).select("id", "source", "rows_loaded", "status", "_load_id", F.col("_period").cast("string").alias("_period"), "_period_start", "_period_end")


@query(f"SELECT period AS _period, count(*) AS n, CAST(sum(rows_loaded + CASE WHEN period LIKE '1998-%' THEN 1 ELSE 0 END) AS BIGINT) AS total FROM ({LEDGER_SQL}) GROUP BY 1")
def w02_replace_period(spark, d):
    path = folder(spark, "w02")
    rows = ledger(spark, d).select("id", "rows_loaded", F.col("period").alias("_period"))
    L.append(rows, path)
    L.replace_periods(rows.where("_period like '1998-%'").withColumn("rows_loaded", F.col("rows_loaded") + 1), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("_period").cast("string").alias("_period")).agg(F.count("*").alias("n"), F.sum("rows_loaded").alias("total"))


STAGED = "p_partkey:bigint p_name:string p_brand:string p_type:string p_size:int p_retailprice:decimal(18,6) _load_id:int _loaded_at:timestamp _period:string _period_start:date _period_end:date _manifest_file_id:int"


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{t}', {k}, 0)" for k, (n, t) in enumerate((x.split(":") for x in STAGED.split()), 1)) + ") t(column_name, type, position, n_rows)")
def w03_staging_schema(spark, d):
    """The columns of a staging table that is made from the types inferred of all parts."""
    from ledgerline.functions.clean import stored_types

    # one row for each column
    types = {r["column_name"]: r["stored_type"] for r in stored_types(given(spark, d, "SELECT * FROM {part}")).collect()}
    made = L.staging_schema([(n, types[n]) for n in given(spark, d, "SELECT * FROM {part}").columns])
    path = folder(spark, "w03")
    spark.createDataFrame([], made).write.parquet(path)
    stored = spark.read.parquet(path)
    columns = spark.createDataFrame([(n, t, k) for k, (n, t) in enumerate(stored.dtypes, 1)], "column_name string, type string, position int")
    return columns.crossJoin(stored.agg(F.count("*").cast("int").alias("n_rows")))


@query("SELECT c_custkey AS id, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS note FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier")
def w04_evolved(spark, d):
    return L.evolved(given(spark, d, "SELECT c_custkey AS id, c_acctbal AS balance FROM {customer}"), given(spark, d, "SELECT s_suppkey AS id, s_name AS note FROM {supplier}"))


@query("SELECT CAST(p_size AS DECIMAL(38,6)) AS v FROM part UNION ALL SELECT CAST(s_acctbal AS DECIMAL(38,6)) FROM supplier")
def w05_widened(spark, d):
    old, new = L.widened(given(spark, d, "SELECT p_size AS v FROM {part}"), given(spark, d, "SELECT CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING) AS v FROM {supplier}"))
    return old.unionByName(new)


@query("SELECT p_brand, p_partkey FROM part")
def w06_sorted_export(spark, d):
    path = folder(spark, "w06")
    E.exported(given(spark, d, "SELECT p_brand, p_partkey FROM {part}"), path)
    return spark.read.parquet(path)


@query(f"""SELECT manifest_name, file_url, status, period, rows_loaded, updated_at, id, first_seen, last_loaded FROM (SELECT *, row_number() OVER (PARTITION BY manifest_name, file_url ORDER BY updated_at DESC, id DESC) AS n,
min(updated_at) OVER (PARTITION BY manifest_name, file_url) AS first_seen, max(CASE WHEN status = 'loaded' THEN updated_at END) OVER (PARTITION BY manifest_name, file_url) AS last_loaded FROM ({LEDGER_SQL})) WHERE n = 1""")
def w10_ledger_upsert(spark, d):
    rows = ledger(spark, d).withColumns({"first_seen": F.col("updated_at"), "last_loaded": F.col("updated_at")}).drop("source")
    return L.upserted(rows, ["manifest_name", "file_url"], [F.desc("updated_at"), F.desc("id")], "first_seen", ("last_loaded", F.col("status") == "loaded"))


@query("SELECT l_suppkey AS source, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal < 5000 GROUP BY ALL UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal < 5000)")
def w11_metadata_replace(spark, d):
    old = given(spark, d, "SELECT s_suppkey AS source, s_name AS name FROM {supplier}")
    new = given(spark, d, "SELECT DISTINCT l_suppkey AS source, p_name AS name FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey WHERE s_acctbal < 5000")
    return L.replaced_for(old, new, "source")


@query(f"SELECT s.code, s.domain, h.last_load_at FROM ({SOURCES_SQL}) s LEFT JOIN (SELECT source, max(loaded_at) AS last_load_at FROM ({HISTORY_SQL}) GROUP BY 1) h ON s.code = h.source")
def w12_registry_with_last_load(spark, d):
    last = history(spark, d).groupBy("source").agg(F.max("loaded_at").alias("last_load_at"))
    return given(spark, d, SOURCES).join(last, F.col("code") == F.col("source"), "left").select("code", "domain", "last_load_at")


@query(f"""SELECT 'sources' AS what, count(*) AS n FROM ({SOURCES_SQL}) WHERE table_name LIKE 'tbl_build%' UNION ALL SELECT 'ledger', count(*) FROM ({LEDGER_SQL}) WHERE source IN (SELECT code FROM ({SOURCES_SQL}) WHERE table_name LIKE 'tbl_build%')
UNION ALL SELECT 'history', count(*) FROM ({HISTORY_SQL}) WHERE source IN (SELECT code FROM ({SOURCES_SQL}) WHERE table_name LIKE 'tbl_build%')""")
def w14_cascade_delete_counts(spark, d):
    counts, _ = O.cascade(given(spark, d, SOURCES), {"ledger": ledger(spark, d), "history": history(spark, d)}, "tbl_build%")
    return counts


@query(f"SELECT * FROM ({HISTORY_SQL}) WHERE source IN (SELECT code FROM ({SOURCES_SQL}) WHERE domain <> 'BUILDING')")
def w15_orphans_removed(spark, d):
    kept = given(spark, d, SOURCES).where("domain <> 'BUILDING'").select(F.col("code").alias("source"))
    return history(spark, d).join(kept, "source", "left_semi").select(*history(spark, d).columns)


@query(f"SELECT source, period, id FROM ({LEDGER_SQL}) QUALIFY row_number() OVER (PARTITION BY source, period ORDER BY updated_at DESC, id DESC) = 1")
def w16_lineage_upsert(spark, d):
    return L.upserted(ledger(spark, d), ["source", "period"], [F.desc("updated_at"), F.desc("id")]).select("source", "period", "id")


@query("SELECT p_partkey, '{\"p_partkey\":' || p_partkey || ',\"p_name\":\"' || p_name || '\",\"p_size\":' || p_size || '}' AS json FROM part")
def w17_json_rows(spark, d):
    from ledgerline.operators.export import json_rows

    return json_rows(given(spark, d, "SELECT p_partkey, p_name, p_size FROM {part}"), keep=["p_partkey"])


# --- joins -----------------------------------------------------------------------------------------------

NEW, OLD = "<> 0 THEN '' ELSE '_new'", "<> 1 THEN '' ELSE '_old'"


@query(f"""WITH f AS ({columns_sql(NEW)}), s AS ({columns_sql(OLD)}), b AS (SELECT coalesce(f."table", s."table") AS "table", coalesce(f."column", s."column") AS "column", CASE WHEN s."column" IS NULL THEN 'new_columns' WHEN f."column" IS NULL THEN 'missing_columns' WHEN f.type <> s.type THEN 'type_change' END AS event
FROM f FULL JOIN s ON f."table" = s."table" AND f."column" = s."column") SELECT "table", event, string_agg("column", ',' ORDER BY "column") AS columns FROM b WHERE event IS NOT NULL GROUP BY ALL""")
def j01_drift(spark, d):
    return L.drift(columns(spark, d, NEW), columns(spark, d, OLD))


@query(f"SELECT source, file_url AS url, id FROM ({LEDGER_SQL}) l WHERE NOT EXISTS (SELECT 1 FROM ({HISTORY_SQL}) h WHERE h.source = l.source AND h.url = l.file_url)")
def j02_pending_work(spark, d):
    return L.pending(ledger(spark, d).select("source", F.col("file_url").alias("url"), "id"), history(spark, d))


@query(f"SELECT code FROM ({SOURCES_SQL}) WHERE code NOT IN (SELECT source FROM ({HISTORY_SQL}))")
def j03_sources_without_tables(spark, d):
    return O.without_source(given(spark, d, SOURCES), history(spark, d), "code", "source").select("code")


@query(f"SELECT source, url, id, line FROM ({HISTORY_SQL}) WHERE source NOT IN (SELECT code FROM ({SOURCES_SQL}) WHERE nation > 5)")
def j04_history_without_source(spark, d):
    return O.without_source(history(spark, d), given(spark, d, SOURCES).where("nation > 5"), "source").select("source", "url", "id", "line")


@query(f"SELECT source, id FROM ({LEDGER_SQL}) WHERE source NOT IN (SELECT code FROM ({SOURCES_SQL}) WHERE nation > 5)")
def j05_ledger_without_source(spark, d):
    return O.without_source(ledger(spark, d), given(spark, d, SOURCES).where("nation > 5"), "source").select("source", "id")


@query("SELECT 'p' || page_id || '.parquet' AS file, page_id % 2 = 0 AS has_dictionary FROM pages WHERE page_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey > 10)")
def j06_files_without_source(spark, d):
    files = given(spark, d, "SELECT page_id, concat('p', page_id, '.parquet') AS file, page_id % 2 = 0 AS has_dictionary FROM {pages}")
    known = given(spark, d, "SELECT c_custkey FROM {customer} WHERE c_nationkey > 10")
    return O.without_source(files, known, "page_id", "c_custkey").select("file", "has_dictionary")


@query(f"SELECT DISTINCT \"table\" FROM ({columns_sql(NEW)}) WHERE \"table\" NOT IN (SELECT concat('tBrand#', c_nationkey) FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000)")
def j07_tables_without_source(spark, d):
    known = given(spark, d, "SELECT concat('tBrand#', c_nationkey) AS code FROM {customer} WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000")
    return O.without_source(columns(spark, d, NEW).select("table").distinct(), known, "table")


@query(f"SELECT a.\"table\", a.\"column\", b.type AS told FROM ({columns_sql(NEW)}) a LEFT JOIN ({columns_sql(OLD)}) b ON lower(a.\"table\") = lower(b.\"table\") AND lower(a.\"column\") = lower(b.\"column\")")
def j08_columns_with_metadata(spark, d):
    told = columns(spark, d, OLD).select(F.lower("table").alias("t"), F.lower("column").alias("c"), F.col("type").alias("told"))
    return columns(spark, d, NEW).join(told, (F.lower("table") == F.col("t")) & (F.lower("column") == F.col("c")), "left").select("table", "column", "told")


J09 = "SELECT DISTINCT concat(replace(p_name, ' ', '_'), CASE p_size % 4 WHEN 0 THEN '_val' WHEN 1 THEN '_total' WHEN 2 THEN '' ELSE '_x' END) AS c FROM {part}"
J09_KNOWN = "SELECT DISTINCT concat(replace(p_name, ' ', '_'), CASE p_size % 3 WHEN 0 THEN '_val' ELSE '_count' END) AS name, p_name AS description FROM {part} WHERE p_name < 'm'"
BARE = "'^(col_|n_)|(_val|_total|_count|_pct)$', '', 'g'"


@query(f"""WITH c AS (SELECT c AS "column" FROM ({plain(J09)})), k AS (SELECT name, description, unnest([lower(name), '~' || regexp_replace(lower(name), {BARE})]) AS key FROM ({plain(J09_KNOWN)})),
t AS (SELECT "column", unnest([{{'p': 0, 'key': lower("column")}}, {{'p': 1, 'key': regexp_replace(lower("column"), '_val$', '')}}, {{'p': 2, 'key': lower("column") || '_val'}}, {{'p': 3, 'key': '~' || regexp_replace(lower("column"), {BARE})}}]) AS x FROM c),
h AS (SELECT "column", name, description, x.p AS priority FROM t JOIN k ON x.key = k.key QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY x.p, name) = 1)
SELECT c."column", name, description, priority FROM c LEFT JOIN h ON c."column" = h."column" """)
def j09_forgiving_match(spark, d):
    return M.forgiving(given(spark, d, J09).withColumnRenamed("c", "column"), given(spark, d, J09_KNOWN))


@query(f"SELECT l.id, l.source, l.status, s.domain, h.n AS loads FROM ({LEDGER_SQL}) l LEFT JOIN ({SOURCES_SQL}) s ON s.code = l.source LEFT JOIN (SELECT source, count(*) AS n FROM ({HISTORY_SQL}) GROUP BY 1) h ON h.source = s.code WHERE l.status = 'loaded'")
def j10_lineage(spark, d):
    return O.lineage(ledger(spark, d), given(spark, d, SOURCES), history(spark, d)).select("id", "source", "status", "domain", "loads")


@query(f"SELECT s.code, coalesce(c.n, 0) AS n_files, CASE WHEN nation < 5 THEN 'north' WHEN nation < 15 THEN 'middle' ELSE 'south' END AS region FROM ({SOURCES_SQL}) s LEFT JOIN (SELECT source, count(*) AS n FROM ({LEDGER_SQL}) GROUP BY 1) c ON c.source = s.code WHERE coalesce(c.n, 0) > 0")
def j11_catalog(spark, d):
    counts = ledger(spark, d).groupBy(F.col("source").alias("code")).agg(F.count("*").alias("n_files"))
    region = F.when(F.col("nation") < 5, "north").when(F.col("nation") < 15, "middle").otherwise("south")
    return given(spark, d, SOURCES).join(counts, "code", "left").na.fill(0, ["n_files"]).where("n_files > 0").select("code", "n_files", region.alias("region"))


@query(f"SELECT s.code, CAST(coalesce(sum(h.rows_loaded), 0) AS BIGINT) AS total_rows, count(h.source) AS loads, max(h.loaded_at) AS last_load FROM ({SOURCES_SQL}) s LEFT JOIN ({HISTORY_SQL}) h ON h.source = s.code GROUP BY 1")
def j12_source_stats(spark, d):
    stats = history(spark, d).groupBy(F.col("source").alias("code")).agg(F.sum("rows_loaded").alias("total_rows"), F.count("*").alias("loads"), F.max("loaded_at").alias("last_load"))
    return given(spark, d, SOURCES).select("code").join(stats, "code", "left").na.fill(0, ["total_rows", "loads"])


J14_DRAFT = "SELECT DISTINCT p_brand AS source, concat(p_name, ' ', p_type) AS c FROM {part}"
J14_REF = "SELECT DISTINCT p_brand AS source, concat(p_name, ' ', p_type, CASE p_size % 2 WHEN 0 THEN 's' ELSE ' old' END) AS c FROM {part}"


@query(None)
def j14_matched_columns(spark, d):
    from pyspark.sql.window import Window

    draft = given(spark, d, J14_DRAFT).withColumnRenamed("c", "column").withColumn("position", F.row_number().over(Window.partitionBy("source").orderBy("column")))
    return M.matched_columns(draft, given(spark, d, J14_REF).withColumnRenamed("c", "column"))


J15 = f"SELECT url, concat('sheet', length(url) % 3) AS sheet, concat('m', length(url) % 2) AS member FROM ({FILES}) x"


def file_keys(url):
    return f"regexp_extract({url}, '([^/]*)$', 1) AS file, {stable_sql()} AS pattern"


J15_WAYS = (("file",), ("pattern", "sheet"), ("pattern", "member"), ("pattern",))
J15_SQL = f"""WITH d AS (SELECT *, {file_keys('url')} FROM ({plain(J15)})), r AS (SELECT *, {file_keys('url')} FROM (SELECT md5(url) AS code, sheet, member, regexp_replace(url, '(-revised)?\\.csv$', '-final.csv') AS url FROM ({plain(J15)}))),
h AS ({' UNION ALL '.join(f"SELECT url, x.code, {k} AS priority FROM d JOIN (SELECT {', '.join(w)}, min(code) AS code FROM r GROUP BY ALL) x USING ({', '.join(w)})" for k, w in enumerate(J15_WAYS))})
SELECT DISTINCT url, code, priority FROM h QUALIFY row_number() OVER (PARTITION BY url ORDER BY priority, code) = 1"""


@query(J15_SQL)
def j15_matched_sources(spark, d):
    rows = kept(given(spark, d, J15))
    return M.matched_sources(rows, rows.withColumns({"url": F.regexp_replace("url", "(-revised)?\\.csv$", "-final.csv"), "code": F.md5("url")}))


def overlap_sql(score, least):
    return f"""WITH d AS (SELECT DISTINCT "table", lower("column") AS c FROM ({columns_sql(NEW)})), r AS (SELECT DISTINCT replace("table", 't', 'r') AS "table", lower("column") AS c FROM ({columns_sql(OLD)})),
s AS (SELECT d."table" AS draft, r."table" AS reference, count(*) AS shared, (SELECT count(*) FROM d x WHERE x."table" = d."table") AS n_draft, (SELECT count(*) FROM r x WHERE x."table" = r."table") AS n_reference FROM d JOIN r ON d.c = r.c GROUP BY d."table", r."table")
SELECT draft, reference, {score} AS score FROM s WHERE {score} >= {least} QUALIFY row_number() OVER (PARTITION BY draft ORDER BY {score} DESC, reference) = 1"""


def referenced(spark, d):
    return columns(spark, d, OLD).withColumn("table", F.replace("table", F.lit("t"), F.lit("r")))


@query(overlap_sql("CAST(shared AS DOUBLE) / n_draft", 0.5))
def j16_best_overlap(spark, d):
    return M.best_overlap(columns(spark, d, NEW), referenced(spark, d), 0.5)


@query(overlap_sql("CAST(shared AS DOUBLE) / (n_draft + n_reference - shared)", 0.3))
def j17_best_jaccard(spark, d):
    return M.best_jaccard(columns(spark, d, NEW), referenced(spark, d), 0.3)


@query(f"""SELECT "table", CAST(count(*) AS INT) AS n_columns, md5(string_agg(c, '|' ORDER BY c)) AS fingerprint, substr(md5(count(*) || '|' || string_agg(c, '|' ORDER BY c)), 1, 12) AS sheet_fingerprint FROM (SELECT DISTINCT "table", lower("column") AS c FROM ({columns_sql(NEW)})) GROUP BY 1""")
def j18_fingerprints(spark, d):
    return M.fingerprints(columns(spark, d, NEW), "table", "column")


@query(f"""WITH w AS (SELECT DISTINCT source, period FROM ({LEDGER_SQL})), r AS (SELECT DISTINCT source, period FROM ({LEDGER_SQL}) WHERE status = 'loaded')
SELECT source, period, CASE WHEN period NOT LIKE '%-04' THEN (SELECT max(r.period) FROM r WHERE r.source = w.source AND r.period < w.period) END AS reference FROM w""")
def j19_reference_before(spark, d):
    return M.reference_before(ledger(spark, d), ledger(spark, d).where("status = 'loaded'"), "source", "period")


NAMED = "|".join(names.MONTHS_LONG + names.MONTHS_SHORT)
SPELT = ("%b%y", "%b%Y", "%B-%Y", "%B_%Y", "%B %Y", "%b %Y", "%b-%Y", "%Y%m", "%Y-%m", "%Y_%m", "%m-%Y")


@query(f"""WITH p AS (SELECT url, lower(unnest(regexp_extract_all(url, '(?i)((?:{NAMED})[-_ ]?(?:\\d{{4}}|\\d{{2}})|\\d{{4}}[-_]?\\d{{2}}|\\d{{2}}-\\d{{4}})', 1))) AS part FROM ({plain(FILES)})),
w AS (SELECT DISTINCT period AS code, CAST(period || '-01' AS DATE) AS s FROM ({LEDGER_SQL})), k AS (SELECT DISTINCT code, lower(unnest([{', '.join(f"strftime(s, '{x}')" for x in SPELT)}])) AS part FROM w),
h AS (SELECT DISTINCT code, url FROM p JOIN k USING (part))
SELECT code, url FROM h QUALIFY row_number() OVER (PARTITION BY code ORDER BY contains(lower(url), 'prov'), length(url), url) = 1""")
def j20_url_for_period(spark, d):
    return M.urls_by_period(given(spark, d, FILES), ledger(spark, d).select(F.col("period").alias("code")).distinct())


@query(f"""WITH a AS (SELECT source AS code, count(*) AS f FROM ({LEDGER_SQL}) WHERE period < '1999-01' GROUP BY 1), b AS (SELECT source AS code, count(*) AS f FROM ({LEDGER_SQL}) WHERE period >= '1998-06' GROUP BY 1),
n AS (SELECT count(*) FILTER (a.code IS NOT NULL AND b.code IS NOT NULL) AS common, count(*) FILTER (b.code IS NULL) AS removed, count(*) FILTER (a.code IS NULL) AS added, count(*) FILTER (a.f <> b.f) AS files_changed FROM a FULL JOIN b ON a.code = b.code)
SELECT *, round(common * 100 / (common + removed), 2) AS consistency_pct, CASE WHEN removed = 0 AND added = 0 THEN 'STABLE' WHEN removed = 0 THEN 'GROWTH' WHEN added = 0 THEN 'REDUCTION' ELSE 'RESTRUCTURE' END AS verdict,
CASE WHEN round(common * 100 / (common + removed), 2) > 95 THEN 'high' WHEN round(common * 100 / (common + removed), 2) > 80 THEN 'medium' ELSE 'low' END AS band FROM n""")
def j21_manifest_comparison(spark, d):
    rows = ledger(spark, d)
    return M.compared_manifests(*[rows.where(w).groupBy(F.col("source").alias("code")).agg(F.count("*").alias("files")) for w in ("period < '1999-01'", "period >= '1998-06'")])


@query(f"""WITH p AS (SELECT source, min(period) AS a, max(period) AS b FROM ({LEDGER_SQL}) GROUP BY 1), e AS (SELECT source, strftime(unnest(generate_series(CAST(a || '-01' AS DATE), CAST(b || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS period FROM p)
SELECT source, period FROM e EXCEPT SELECT source, period FROM ({LEDGER_SQL})""")
def j22_missing_periods(spark, d):
    from ledgerline.operators.ops import missing_periods

    return missing_periods(ledger(spark, d), "source", "period")


@query(f"SELECT id, line, source, rows_loaded FROM (SELECT *, avg(rows_loaded) OVER (PARTITION BY source) AS m, stddev_samp(rows_loaded) OVER (PARTITION BY source) AS s FROM ({HISTORY_SQL})) WHERE rows_loaded > m + 2 * s")
def j23_outliers(spark, d):
    from ledgerline.operators.ops import outliers

    return outliers(history(spark, d), "source", "rows_loaded", 2.0).select("id", "line", "source", "rows_loaded")


@query(f"""WITH a AS (SELECT DISTINCT "table", lower("column") AS c FROM ({columns_sql(NEW)})), t AS (SELECT DISTINCT "table", lower("column") AS c FROM ({columns_sql(OLD)})), b AS (SELECT coalesce(a."table", t."table") AS "table", a.c AS ac, t.c AS tc FROM a FULL JOIN t ON a."table" = t."table" AND a.c = t.c)
SELECT "table", count(*) FILTER (ac IS NOT NULL AND tc IS NOT NULL) AS covered, count(ac) AS actual, coalesce(string_agg(ac, ',' ORDER BY ac) FILTER (tc IS NULL), '') AS missing, coalesce(string_agg(tc, ',' ORDER BY tc) FILTER (ac IS NULL), '') AS orphaned,
round(count(*) FILTER (ac IS NOT NULL AND tc IS NOT NULL) * 100 / count(ac), 2) AS coverage_pct FROM b GROUP BY 1""")
def j25_coverage(spark, d):
    return M.coverage(columns(spark, d, NEW), columns(spark, d, OLD), "table")


@query(f"SELECT l.id, l.file_url, coalesce(o.period, l.period) AS period FROM ({LEDGER_SQL}) l LEFT JOIN (SELECT file_url, min(period) AS period FROM ({LEDGER_SQL}) GROUP BY 1) o ON l.file_url = o.file_url")
def j26_restored_fields(spark, d):
    known = ledger(spark, d).groupBy("file_url").agg(F.min("period").alias("original"))
    return ledger(spark, d).join(known, "file_url", "left").select("id", "file_url", F.coalesce("original", "period").alias("period"))


@query(f"SELECT s.code, coalesce(e.note, s.domain) AS note, e.code IS NOT NULL AS applied FROM ({SOURCES_SQL}) s LEFT JOIN (SELECT concat('s', s_suppkey) AS code, s_name AS note FROM supplier WHERE s_suppkey % 2 = 0) e ON e.code = s.code")
def j27_applied_edits(spark, d):
    edits = given(spark, d, "SELECT concat('s', s_suppkey) AS e_code, s_name AS edit FROM {supplier} WHERE s_suppkey % 2 = 0")
    return given(spark, d, SOURCES).join(edits, F.col("code") == F.col("e_code"), "left").select("code", F.coalesce("edit", "domain").alias("note"), F.col("e_code").isNotNull().alias("applied"))


@query(f"SELECT h.id, h.line, s.code, h.loaded_at FROM ({HISTORY_SQL}) h JOIN ({SOURCES_SQL}) s ON s.code = h.source ORDER BY loaded_at DESC, h.id, line LIMIT 25")
def j28_recent_loads(spark, d):
    return history(spark, d).withColumnRenamed("id", "load").join(given(spark, d, SOURCES).select("code"), F.col("source") == F.col("code")).orderBy(F.desc("loaded_at"), "load", "line").limit(25).select(F.col("load").alias("id"), "line", "code", "loaded_at")


# --- checks of loads -------------------------------------------------------------------------------------


@query(f"SELECT id, rows_loaded, CASE WHEN status = 'failed' THEN 'failed' WHEN rows_loaded = 0 THEN 'error' WHEN rows_loaded < 50000 THEN 'warning' ELSE 'ok' END AS verdict FROM ({LEDGER_SQL})")
def a23_load_check(spark, d):
    return L.checked(ledger(spark, d).withColumn("success", F.col("status") != "failed"), 50000).select("id", "rows_loaded", "verdict")


@query(f"""WITH c AS (SELECT regexp_extract(code, '^[a-z0-9]+') AS t, code FROM ({plain(CODES)})), k AS (SELECT t, count(*) FILTER (regexp_matches(lower(code), '{L.DATED}')) AS dated, count(*) FILTER (regexp_matches(lower(code), '{L.SNAPSHOT}')) AS snap, count(*) FILTER (regexp_matches(lower(code), '{L.INCREMENTAL}')) AS incr FROM c WHERE t <> '' GROUP BY 1)
SELECT t AS "table", CASE WHEN dated >= 6 THEN 'time_series_wide' WHEN snap > 0 THEN 'point_in_time_snapshot' WHEN incr > 0 THEN 'incremental_transactional' WHEN regexp_matches(lower('History over time ' || t), 'historical|time series|trend|over time') THEN 'time_series_wide' ELSE 'unknown' END AS pattern,
CASE WHEN dated >= 6 THEN 0.95 WHEN snap > 0 THEN 0.8 WHEN incr > 0 THEN 0.75 ELSE 0.7 END::DOUBLE AS confidence, CASE WHEN dated < 6 AND snap > 0 THEN 'append' ELSE 'replace' END AS mode FROM k""")
def a32_load_mode(spark, d):
    rows = settled(given(spark, d, CODES)).select(F.regexp_extract("code", "^[a-z0-9]+", 0).alias("table"), F.col("code").alias("column")).where("`table` <> ''")
    return L.load_modes(rows, rows.select("table").distinct().withColumn("description", F.lit("History over time")))


@query(f"""WITH w AS (SELECT *, median(rows_loaded) OVER (PARTITION BY source ORDER BY loaded_at, id, line, rows_loaded ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS typical FROM (SELECT id, line, source, loaded_at, CASE WHEN id % 50 = 0 THEN 0 ELSE rows_loaded END AS rows_loaded FROM ({HISTORY_SQL})))
SELECT id, line, rows_loaded, typical, CASE WHEN rows_loaded = 0 AND line = 7 THEN 'warning' WHEN rows_loaded = 0 AND typical > 0 THEN 'critical' WHEN rows_loaded / nullif(typical, 0) < 0.1 THEN 'critical' WHEN line = 7 OR rows_loaded / nullif(typical, 0) < 0.5 OR rows_loaded / nullif(typical, 0) > 2 OR line = 6 THEN 'warning' ELSE 'normal' END AS grade FROM w""")
def a33_anomaly_grade(spark, d):
    rows = history(spark, d).withColumn("rows_loaded", F.when(F.col("id") % 50 == 0, 0).otherwise(F.col("rows_loaded")))
    out = L.anomalies(rows, "source", ["loaded_at", "id", "line", "rows_loaded"], "rows_loaded", F.when(F.col("line") == 6, 5).otherwise(0), F.col("line") == 7)
    return out.select("id", "line", "rows_loaded", "typical", "grade")
