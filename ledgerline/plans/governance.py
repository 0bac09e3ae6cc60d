"""Queries of checks, registries, schedules, runs and sizes, each held against the whole of its rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import schedules as SC
from ledgerline.operators import export as E
from ledgerline.operators import load as L
from ledgerline.operators import match as M
from ledgerline.operators import ops as O
from ledgerline.operators import registry as R
from ledgerline.operators import validation as V
from ledgerline.sources.tables import table

from .inputs import HEADERS, given, plain
from .loading import HISTORY, HISTORY_SQL, LEDGER, NEW, OLD, SOURCES, columns, columns_sql
from .registry import query

# --- configurations and manifests (R12) ------------------------------------------------------------------

CONFIG = """SELECT concat('pub', c_nationkey) AS code, CASE WHEN c_nationkey % 3 > 0 THEN concat('N', c_nationkey) END AS name, c_nationkey AS k, c_custkey AS i,
CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN concat('20', c_custkey % 90 + 10, '-13') ELSE concat(2000 + c_custkey % 20, '-0', c_custkey % 9 + 1) END AS period,
CASE c_custkey % 5 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN concat('ftp://x.example.org/', c_custkey) ELSE concat('https://x.example.org/', c_custkey) END AS url FROM {customer}"""
ENTRIES = f"SELECT *, row_number() OVER (PARTITION BY code ORDER BY i) AS n FROM ({plain(CONFIG)}) WHERE k % 4 < 2"
PERIOD_OK = "regexp_full_match(period, '\\d{4}-(0[1-9]|1[0-2])|FY\\d{2}-Q[1-4]|FY\\d{4}-\\d{2}|\\d{4}')"


@query(f"""SELECT DISTINCT code AS publication, 'warning' AS level, 'Missing ''name'' field' AS message FROM ({plain(CONFIG)}) WHERE name IS NULL
UNION ALL SELECT code, 'error', 'Entry ' || n || ' missing ''period'' field' FROM ({ENTRIES}) WHERE period = ''
UNION ALL SELECT code, 'error', 'Period ' || period || ' has no URL (None)' FROM ({ENTRIES}) WHERE period <> '' AND url IS NULL
UNION ALL SELECT code, 'error', 'Period ' || period || ' has empty URL' FROM ({ENTRIES}) WHERE period <> '' AND url = ''
UNION ALL SELECT code, 'error', 'Period ' || period || ' has invalid URL: ' || substr(url, 1, 50) FROM ({ENTRIES}) WHERE period <> '' AND url LIKE 'ftp%'
UNION ALL SELECT code, 'warning', 'Period ''' || period || ''' has unusual format' FROM ({ENTRIES}) WHERE period <> '' AND NOT {PERIOD_OK}
UNION ALL SELECT DISTINCT code, 'error', 'Template mode requires ''landing_page''' FROM ({plain(CONFIG)}) WHERE k % 4 = 2
UNION ALL SELECT DISTINCT code, 'warning', 'No periods defined' FROM ({plain(CONFIG)}) WHERE k % 4 >= 2 AND k % 5 > 0""")
def r12_config_findings(spark, d):
    """Publications with lists of URLs, with templates, and some of either that break rules."""
    rows = given(spark, d, CONFIG)
    entries = F.transform(F.array_sort(F.collect_list(F.struct("i", "period", "url"))), lambda e: F.struct(e["period"].alias("period"), e["url"].alias("url")))
    k = F.col("k")
    pubs = rows.groupBy("code", "name", "k").agg(entries.alias("all")).select(
        "code", "name", F.when(k % 4 < 2, F.col("all")).alias("urls"), F.when(k % 4 == 2, "{landing_page}/x").alias("url_template"), F.when(k % 4 == 3, "template").alias("discovery_mode"),
        F.when(k % 4 == 3, "https://x").alias("landing_page"), F.when(k % 5 == 0, F.array(F.lit("2024-01"))).alias("periods"),
    )
    return V.config_findings(pubs)


MANIFEST = """SELECT concat('m', c_nationkey) AS manifest, c_custkey AS k, CASE WHEN c_custkey % 11 > 0 THEN concat(CASE c_custkey % 4 WHEN 0 THEN 'summary_' WHEN 1 THEN 'wait_' ELSE 'n' END, c_custkey % 40) END AS code,
CASE WHEN c_custkey % 7 > 0 THEN 'N' END AS name, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 2 = 0 END AS enabled FROM {customer}"""
MANIFESTS = f"SELECT *, coalesce(code, 'source_' || k) AS source FROM ({plain(MANIFEST)})"


@query(f"""SELECT manifest, source, 'error' AS level, 'Missing required field ''code''' AS message FROM ({MANIFESTS}) WHERE code IS NULL
UNION ALL SELECT manifest, source, 'error', 'Missing required field ''name''' FROM ({MANIFESTS}) WHERE name IS NULL
UNION ALL SELECT manifest, source, 'error', 'Missing required field ''enabled''' FROM ({MANIFESTS}) WHERE enabled IS NULL
UNION ALL SELECT manifest, source, 'error', 'Missing required field ''files''' FROM ({MANIFESTS}) WHERE k % 13 = 0
UNION ALL SELECT manifest, source, 'error', '''files'' must be non-empty array' FROM ({MANIFESTS}) WHERE k % 13 = 1
UNION ALL SELECT manifest, source, 'warning', 'Generic code pattern' FROM ({MANIFESTS}) WHERE code LIKE 'summary%'
UNION ALL SELECT manifest, source, 'error', 'file 1: Missing ''url''' FROM ({MANIFESTS}) WHERE k % 13 = 2
UNION ALL SELECT manifest, code, 'error', 'Duplicate source code: ' || count(*) || ' sources' FROM ({MANIFESTS}) WHERE code IS NOT NULL GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT manifest, NULL, 'warning', count(*) || ' enabled sources missing ''columns'' metadata' FROM ({MANIFESTS}) WHERE coalesce(enabled, true) AND k % 2 = 0 GROUP BY manifest""")
def r12_manifest_rules(spark, d):
    k = F.col("k")
    link = lambda url: F.struct(url.cast("string").alias("url"))
    files = F.when(k % 13 == 1, F.array().cast("array<struct<url:string>>")).when(k % 13 == 2, F.array(link(F.lit("a")), link(F.lit(None)))).when(k % 13 > 2, F.array(link(F.lit("a"))))
    rows = given(spark, d, MANIFEST).withColumns({"position": k, "table": F.lit("t"), "files": files, "columns": F.when(k % 2 == 1, F.array(F.lit("c")))})
    return V.manifest_findings(rows, "manifest", strict=True, enriched=True)


@query("""WITH n AS (SELECT count(*) AS n, count(*) FILTER (p_partkey % 10 = 0) AS noted FROM part)
SELECT 'staged' AS "table", 'warning' AS level, unnest(['Missing audit columns: _loaded_at, _manifest_file_id', 'Column ''p_comment'' is 100% NULL (' || n || ' rows)', 'Column ''p_note'' has high NULL rate: ' || format('{:.1f}', (n - noted) * 100.0 / n) || '%', 'Partial metadata coverage: 2/3 columns', 'Only 1 period loaded: 2024-01']) AS message FROM n
UNION ALL SELECT 'blank', 'error', 'Table is empty (0 rows)' UNION ALL SELECT 'gone', 'error', 'Table does not exist'""")
def a21_table_checks(spark, d):
    rows = given(spark, d, "SELECT p_partkey, CAST(NULL AS STRING) AS p_comment, CASE WHEN p_partkey % 10 = 0 THEN p_name END AS p_note, 7 AS _load_id, '2024-01' AS _period FROM {part}")
    found = V.table_checks(rows, "staged", rows, tracked=2, strict=True)
    return found.unionByName(V.table_checks(rows.where("p_partkey < 0"), "blank", rows, tracked=0)).unionByName(V.table_checks(None, "gone", rows))


@query(f"""SELECT h, CASE WHEN len(w) >= 3 AND len(list_distinct(w)) * 2 < len(w) THEN array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ') ELSE q END AS original_name, length(h) % 3 = 0 AS is_dimension, length(h) % 4 = 1 AS is_measure,
CASE length(h) % 5 WHEN 0 THEN 'integer' WHEN 1 THEN 'date' ELSE 'varchar' END AS data_type, substr(regexp_replace(regexp_replace(lower(h), '[^a-z0-9_]', '_', 'g'), '^[0-9]+', ''), 1, 63) AS pg_name
FROM (SELECT *, string_split(q, ' ') AS w FROM (SELECT h, regexp_replace(trim(h), '\\s*-\\s*$', '') AS q FROM ({plain(HEADERS)})))""")
def d07_fixed_columns(spark, d):
    n = F.length("h")
    told = given(spark, d, HEADERS).withColumns({
        "original_name": F.col("h"), "semantic_name": F.col("h"), "data_type": F.when(n % 5 == 0, " Integer ").when(n % 5 == 1, "DATE").when(n % 5 == 2, "text"),
        "is_dimension": F.when(n % 3 == 0, "Yes").when(n % 3 == 1, "no"), "is_measure": F.when(n % 4 == 1, "true").otherwise("2"),
    })
    return V.fixed_columns(told)


# --- registry and metadata (W11, W12, W18, R07, J26, J27) ------------------------------------------------

STORED = "SELECT concat('s', s_suppkey) AS source, s_name AS column_name FROM {supplier}"
ENRICHED = """SELECT concat('s', l_suppkey) AS source, min(l_orderkey) AS position, p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS name, CASE WHEN p_partkey % 3 = 1 THEN concat('code ', p_size) WHEN p_partkey % 3 = 0 THEN 'unused' END AS code, CASE WHEN p_partkey % 5 > 0 THEN concat('sem_', p_size) ELSE '' END AS semantic_name
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_suppkey % 2 = 0 GROUP BY l_suppkey, p_partkey, p_name, p_size"""


@query(f"""WITH e AS (SELECT *, coalesce(nullif(name, ''), nullif(code, ''), nullif(semantic_name, '')) AS column_name FROM ({plain(ENRICHED)})),
o AS (SELECT * FROM e WHERE column_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, column_name ORDER BY position * 100000 + k DESC) = 1)
SELECT source, column_name, column_name AS original_name, CASE WHEN k % 2 = 0 THEN k % 4 = 0 ELSE k % 7 = 0 END AS is_measure, CASE WHEN k % 2 = 0 THEN k % 4 <> 0 ELSE k % 7 = 1 END AS is_dimension,
CASE WHEN k % 2 = 0 THEN 'direct' WHEN k % 7 < 2 THEN 'tag' ELSE '' END AS words, 'enrichment' AS metadata_source, 0.95::DOUBLE AS confidence FROM o
UNION ALL SELECT 's' || s_suppkey, s_name, s_name, false, false, '', 'old', 0.5 FROM supplier WHERE s_suppkey % 2 = 1 OR s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)""")
def w11_stored_metadata(spark, d):
    """Metadata of suppliers replaced by that of their parts: names by fallback, flags direct or from the older form."""
    k = F.col("k")
    tags = F.when(k % 7 < 2, F.array(F.lit("tag")))
    old_form = F.struct(F.when(k % 7 == 0, "count").alias("measure"), F.when(k % 7 == 1, "date").alias("dimension"), tags.alias("tags"))
    new = given(spark, d, ENRICHED).withColumns({
        "position": F.col("position") * 100_000 + k, "original_name": F.lit(None).cast("string"), "description": F.lit("d"), "data_type": F.lit(None).cast("string"),
        "is_measure": F.when(k % 2 == 0, k % 4 == 0), "is_dimension": F.when(k % 2 == 0, k % 4 != 0), "query_keywords": F.when(k % 2 == 0, F.array(F.lit("direct"))), "metadata": old_form,
    })
    old = given(spark, d, STORED).select("source", "column_name", F.col("column_name").alias("original_name"), F.lit("d").alias("description"), F.lit("VARCHAR").alias("data_type"), F.lit(False).alias("is_measure"), F.lit(False).alias("is_dimension"), F.array().cast("array<string>").alias("query_keywords"), F.lit("old").alias("metadata_source"), F.lit(0.5).cast("double").alias("confidence"))
    out = R.stored_metadata(old, new)
    return out.select("source", "column_name", "original_name", "is_measure", "is_dimension", F.array_join("query_keywords", ",").alias("words"), "metadata_source", F.col("confidence").cast("double").alias("confidence"))


CREATED = "SELECT concat('s', c_custkey) AS code, c_name AS name, c_custkey AS k FROM {customer}"


@query(f"""WITH s AS (SELECT 's' || c_custkey AS code, c_name AS name, TIMESTAMP '2001-01-01' + INTERVAL (c_custkey % 50) DAY AS created_at FROM customer WHERE c_custkey % 2 = 0),
n AS (SELECT 's' || s_suppkey AS code, s_name AS name, TIMESTAMP '2002-01-01' AS created_at FROM supplier WHERE 's' || s_suppkey NOT IN (SELECT code FROM s)),
h AS (SELECT source AS code, max(loaded_at) AS last_load_at FROM (SELECT source, loaded_at FROM ({HISTORY_SQL}) UNION ALL SELECT 's' || s_suppkey, TIMESTAMP '2003-05-05' FROM supplier WHERE s_suppkey % 3 = 0) GROUP BY 1)
SELECT code, name, created_at, last_load_at FROM (SELECT * FROM s UNION ALL SELECT * FROM n) LEFT JOIN h USING (code)""")
def w12_sources_listed(spark, d):
    """Sources, further ones registered unless their code is taken, loads logged, and all listed with their last load."""
    day = F.expr("timestamp_ntz '2001-01-01 00:00:00' + make_interval(0, 0, 0, k % 50)")
    known = given(spark, d, CREATED).where("k % 2 = 0").select("code", "name", day.alias("created_at"))
    new = given(spark, d, "SELECT concat('s', s_suppkey) AS code, s_name AS name, timestamp_ntz '2002-01-01 00:00:00' AS created_at, s_suppkey AS k FROM {supplier}")
    loads = new.where("k % 3 = 0").select(F.col("code").alias("source"), F.expr("timestamp_ntz '2003-05-05 00:00:00'").alias("loaded_at"))
    history = R.logged(given(spark, d, HISTORY).select("source", "loaded_at"), loads)
    return R.listed(R.registered(known, new.drop("k")), history)


@query("""WITH c AS (SELECT 'd' || p_partkey AS code, p_partkey AS k, p_size, p_name, lower(p_type) AS t FROM part)
SELECT code, CASE WHEN k % 3 = 0 THEN 'output/' || code || '.parquet' ELSE 'output/' || 'x/' || code || '.parquet' END AS path, CASE WHEN k % 2 = 0 THEN 'Even' ELSE 'Other' END AS domain, CASE WHEN k % 4 = 0 THEN 'About ' || p_name WHEN k % 4 = 1 THEN p_name ELSE 'Source: ' || code END AS purpose,
CAST(p_size AS BIGINT) AS row_count, CASE WHEN k % 4 = 0 THEN 2 ELSE 0 END AS n_columns, CASE WHEN k % 4 = 0 THEN 'c' || p_size END AS first_column FROM c""")
def w18_registry(spark, d):
    rows = given(spark, d, "SELECT p_partkey AS k, p_size, p_name FROM {part}").withColumn("code", F.concat(F.lit("d"), F.col("k").cast("string")))
    catalog = rows.select("code", F.when(F.col("k") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("x/"), "code", F.lit(".parquet"))).alias("file_path"), F.col("p_size").cast("long").alias("row_count"), F.lit(2).alias("column_count"), F.when(F.col("k") % 4 == 1, F.col("p_name")).alias("description"))
    text = F.concat(F.lit("# x\n## Purpose\nAbout "), "p_name", F.lit("\n\n## Columns\n#### `c"), F.col("p_size").cast("string"), F.lit("`\n**Type:** INTEGER\n**Description:** n\n#### `z`\n**Type:** DATE\n"))
    texts = rows.where("k % 4 = 0").select("code", text.alias("markdown"))
    out = R.registry_of(catalog, texts, [("[02468]$", "Even")])
    return out.select("code", "path", "domain", "purpose", "row_count", F.size("columns").alias("n_columns"), F.get("columns", F.lit(0))["column"].alias("first_column"))


@query("SELECT 's' || c_custkey AS code FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 1000 AND (contains('s' || c_custkey, '1') OR contains(lower(c_name), '1')) AND c_nationkey % 2 = 0 ORDER BY 1 LIMIT 50")
def r07_filtered_catalog(spark, d):
    rows = given(spark, d, "SELECT concat('s', c_custkey) AS code, c_name AS description, c_mktsegment AS domain, array('all', CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END) AS tags, floor(c_acctbal) AS row_count FROM {customer}")
    return R.filtered_catalog(rows, domain="building", keyword="1", min_rows=1000, tags=("all", "even")).select("code")


FILES_LOST = "SELECT DISTINCT concat('https://f.example.org/', o_orderkey % 3000) AS url, o_orderkey % 3000 AS k FROM {orders}"


@query(f"""SELECT url, CASE WHEN k % 2 = 0 THEN 'p' || k ELSE 'own' END AS period, CASE WHEN k % 5 > 0 THEN 's' || k END AS sheet, CAST(CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 5 > 0 THEN 1 ELSE 0 END AS INT) AS restored FROM ({plain(FILES_LOST)}) WHERE k % 7 > 0""")
def j26_restored_by_url(spark, d):
    rows = given(spark, d, FILES_LOST)
    original = rows.select("url", F.col("k").alias("position"), F.concat(F.lit("p"), "k").alias("period"), F.when(F.col("k") % 5 > 0, F.concat(F.lit("s"), "k")).alias("sheet"))
    edited = rows.where("k % 7 > 0").select("url", F.when(F.col("k") % 2 == 1, "own").alias("period"))
    return R.restored(original, edited)


@query(f"SELECT url, 'missing' AS finding FROM ({plain(FILES_LOST)}) WHERE k % 7 = 0 UNION ALL SELECT url || '/new', 'extra' FROM ({plain(FILES_LOST)}) WHERE k % 11 = 0 AND k % 7 > 0")
def j26_url_findings(spark, d):
    rows = given(spark, d, FILES_LOST)
    kept = rows.where("k % 7 > 0")
    return R.url_findings(rows, kept.select("url").unionByName(kept.where("k % 11 = 0").select(F.concat("url", F.lit("/new")).alias("url"))))


def edits(spark, d):
    rows = given(spark, d, "SELECT concat('s', s_suppkey) AS code, s_suppkey AS position, s_name AS name, CAST(NULL AS STRING) AS description FROM {supplier} UNION ALL SELECT 'nowhere', 0, 'x', 'y'")
    return rows.withColumn("new_code", F.when(F.col("position") % 3 == 0, F.concat(F.lit("new_"), "code")))


@query("""WITH e AS (SELECT 's' || s_suppkey AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'new_s' || s_suppkey ELSE 's' || s_suppkey END AS new_code FROM supplier UNION ALL SELECT 'nowhere', 'new_nowhere'), s AS (SELECT 's' || c_custkey AS code FROM customer)
SELECT coalesce(s.code, e.code) AS code, CASE WHEN s.code IS NULL THEN 'edit without source' WHEN e.code IS NULL THEN 'source without edit' WHEN new_code <> s.code THEN 'changed' ELSE 'kept' END AS outcome, new_code FROM s FULL JOIN e ON s.code = e.code""")
def j27_edit_report(spark, d):
    return R.edit_report(given(spark, d, SOURCES), edits(spark, d))


@query("""WITH e AS (SELECT 's' || s_suppkey AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'new_s' || s_suppkey ELSE 's' || s_suppkey END AS new_code, s_name AS name FROM supplier)
SELECT coalesce(new_code, c.code) AS code, CASE WHEN e.code IS NULL THEN t ELSE 'tbl_' || new_code END AS "table", coalesce(e.name, domain) AS name, e.code AS original_code FROM (SELECT 's' || c_custkey AS code, 'tbl_' || lower(c_mktsegment) || '_' || c_custkey AS t, c_mktsegment AS domain FROM customer) c LEFT JOIN e ON e.code = c.code""")
def j27_edited_sources(spark, d):
    rows = given(spark, d, SOURCES).select("code", F.col("table_name").alias("table"), F.col("domain").alias("name"), F.lit("d").alias("description"))
    return R.edited_sources(rows, edits(spark, d)).select("code", "table", "name", "original_code")


# --- drift, loads and modes (J01, J02, J18, A32) ---------------------------------------------------------


@query(f"""WITH f AS ({columns_sql(NEW)} UNION ALL SELECT DISTINCT 't' || p_brand, unnest(['jan_2024', 'feb_2024', 'mar_2024']), 'int' FROM part WHERE p_brand LIKE '%1%'), s AS ({columns_sql(OLD)}), b AS (SELECT coalesce(f."table", s."table") AS "table", coalesce(f."column", s."column") AS "column", CASE WHEN s."column" IS NULL THEN 'new_columns' WHEN f."column" IS NULL THEN 'missing_columns' WHEN f.type <> s.type THEN 'type_change' END AS event
FROM f FULL JOIN s ON f."table" = s."table" AND f."column" = s."column") SELECT "table", event, string_agg("column", ',' ORDER BY "column") AS columns FROM b WHERE event IS NOT NULL GROUP BY ALL
UNION ALL SELECT DISTINCT 't' || p_brand, 'wide_date_detected', 'feb_2024,jan_2024,mar_2024' FROM part WHERE p_brand LIKE '%1%'""")
def j01_wide_drift(spark, d):
    """Drift in which some tables got a column for each of three months."""
    wide = given(spark, d, "SELECT DISTINCT concat('t', p_brand) AS `table`, explode(array('jan_2024', 'feb_2024', 'mar_2024')) AS `column`, 'int' AS type FROM {part} WHERE p_brand LIKE '%1%'")
    return L.drift(columns(spark, d, NEW).unionByName(wide), columns(spark, d, OLD))


@query(f"""WITH h AS (SELECT source, url || CASE WHEN id % 2 = 0 THEN '#Sheet ' || id % 3 ELSE '' END AS url, id * 10 + line AS load_id, rows_loaded AS rows, loaded_at FROM ({HISTORY_SQL}) QUALIFY row_number() OVER (PARTITION BY source, url || CASE WHEN id % 2 = 0 THEN '#Sheet ' || id % 3 ELSE '' END ORDER BY loaded_at DESC, id * 10 + line DESC) = 1),
w AS (SELECT DISTINCT 's' || l_suppkey AS source, 'https://f.example.org/' || (l_orderkey % 3000) || '.csv' || CASE WHEN l_orderkey % 2 = 0 THEN '#Sheet ' || l_orderkey % 3 ELSE '' END AS url FROM lineitem UNION ALL SELECT 's1', 'https://f.example.org/none.csv')
SELECT w.source, w.url, load_id, rows, loaded_at, load_id IS NOT NULL AS loaded FROM w LEFT JOIN h ON h.source = w.source AND h.url = w.url""")
def j02_loaded_state(spark, d):
    """Whether files, and sheets of files, were loaded, and the newest load of each."""
    sheet = F.when(F.col("id") % 2 == 0, F.concat(F.lit("Sheet "), (F.col("id") % 3).cast("string")))
    tracked = given(spark, d, HISTORY).withColumns({"url": L.tracking_id(F.col("url"), sheet, F.lit(None).cast("string")), "mode": F.lit("append"), "id": F.col("id") * 10 + F.col("line")})
    new = spark.createDataFrame([("s1", "https://f.example.org/none.csv")], "source string, url string")
    return L.loaded_state(tracked.select("source", "url").distinct().unionByName(new), tracked).drop("mode")


@query(f"""WITH n AS (SELECT p_brand, h, i, CASE WHEN w IN ({', '.join(f"'{x}'" for x in ('size',))}) THEN w ELSE w END AS w FROM (SELECT p_brand, p_type || ' ' || p_size AS h, p_partkey AS i, lower(replace(p_type, ' ', '_')) || '_' || p_size AS w FROM part))
SELECT p_brand, substr(md5(string_agg(w, '|' ORDER BY w)), 1, 8) AS short_fingerprint, substr(sha256(string_agg(w, '|' ORDER BY i)), 1, 16) AS ordered_fingerprint FROM n GROUP BY 1""")
def j18_header_fingerprints(spark, d):
    rows = given(spark, d, "SELECT p_brand, p_partkey, concat(p_type, ' ', p_size) AS h FROM {part} UNION ALL SELECT DISTINCT p_brand, 0, ' - ' FROM {part}").where("h <> ' - '")
    return M.header_fingerprints(rows, "p_brand", "h", "p_partkey")


@query("""WITH t AS (SELECT DISTINCT 't' || c_nationkey AS "table", c_nationkey AS k FROM customer)
SELECT "table", CASE WHEN k % 4 = 0 THEN 'point_in_time_snapshot' WHEN k % 2 = 0 THEN 'cumulative_ytd' WHEN k % 4 = 1 THEN 'event_log' ELSE 'unknown' END AS pattern,
CASE WHEN k % 4 = 0 THEN 0.9 WHEN k % 2 = 0 THEN 0.85 WHEN k % 4 = 1 THEN 0.6 ELSE 0.5 END::DOUBLE AS confidence, CASE WHEN k % 4 = 0 THEN 'append' ELSE 'replace' END AS mode FROM t""")
def a32_external_verdict(spark, d):
    """Columns that say year to date, or nothing; verdicts that are trusted, weak, or surer than a guess."""
    k = given(spark, d, "SELECT DISTINCT concat('t', c_nationkey) AS `table`, c_nationkey AS k FROM {customer}")
    named = k.select("table", F.when(F.col("k") % 2 == 0, "ytd_total").otherwise("plain").alias("column"))
    verdicts = k.where("k % 4 < 2 or k % 4 = 2").select("table", F.when(F.col("k") % 4 == 0, "point_in_time_snapshot").when(F.col("k") % 4 == 1, "event_log").otherwise("weak").alias("verdict"), F.when(F.col("k") % 4 == 0, 0.9).when(F.col("k") % 4 == 1, 0.6).otherwise(0.7).cast("double").alias("sure"))
    return L.load_modes(named, k.select("table", F.lit("x").alias("description")), verdicts).withColumn("confidence", F.col("confidence").cast("double"))


# --- schedules (P08, P09, P11) ---------------------------------------------------------------------------


@query("""WITH c AS (SELECT 'p' || c_custkey AS publication, c_custkey AS k, make_date(CAST(2022 + c_custkey % 2 AS INT), CAST(1 + c_custkey % 12 AS INT), 1) AS a FROM customer),
m AS (SELECT publication, k, unnest(generate_series(a, CASE WHEN k % 4 = 1 THEN DATE '2023-12-31' WHEN k % 4 = 2 THEN DATE '2024-06-15' - 56 ELSE DATE '2024-06-15' - 42 END, INTERVAL 1 MONTH)) AS m FROM c WHERE k % 4 < 3)
SELECT publication, strftime(m, '%Y-%m') AS period FROM m WHERE (k % 3 > 0 OR month(m) IN (2, 5, 8, 11)) AND (k % 5 > 0 OR m + INTERVAL 5 MONTH <= DATE '2024-06-15')
UNION ALL SELECT publication, 'FY' || lpad(CAST((2020 + k % 3 + n // 4) % 100 AS VARCHAR), 2, '0') || '-Q' || (n % 4 + 1) FROM c, range(51) r(n) WHERE k % 4 = 3 AND last_day(CAST(make_date(CAST(2019 + k % 3 AS INT), 6, 1) + to_months(CAST(3 * n AS INT)) AS DATE)) + 42 <= DATE '2024-06-15'""")
def p08_schedules(spark, d):
    """Monthly schedules with an end, until now, with a longer lag, some months or an offset; and fiscal quarters."""
    k = F.col("k")
    rows = given(spark, d, "SELECT concat('p', c_custkey) AS publication, c_custkey AS k FROM {customer}").withColumns({
        "type": F.when(k % 4 == 3, "fiscal_quarter").otherwise("monthly"), "start": F.concat((k % 2 + 2022).cast("string"), F.lit("-"), F.lpad((k % 12 + 1).cast("string"), 2, "0")),
        "end": F.when(k % 4 == 1, "2023-12").when(k % 4 == 0, "current"), "months": F.when(k % 3 == 0, F.array(*[F.lit(m) for m in (2, 5, 8, 11)])), "lag_weeks": F.when(k % 4 == 2, 8).cast("int"),
        "offset_months": F.when(k % 5 == 0, 5).cast("int"), "start_fy": F.when(k % 4 == 3, k % 3 + 2020).cast("int"),
    })
    return SC.scheduled(rows, F.lit("2024-06-15").cast("date"))


@query("""WITH p AS (SELECT 'p' || c_custkey AS publication, c_custkey AS k, make_date(2023, CAST(1 + c_custkey % 12 AS INT), 1) AS m FROM customer), r AS (SELECT *, strftime(m, '%Y-%m') AS period FROM p)
SELECT publication, period, CASE WHEN k % 3 = 0 THEN 'https://list/' || k WHEN month(m) = 6 THEN 'https://odd/' || year(m) ELSE 'https://x/' || k || '/' || lower(strftime(m, '%B')) || '-' || CASE WHEN k % 2 = 0 THEN strftime(m + INTERVAL 5 MONTH, '%Y%m') ELSE '{pub_year}{pub_month}' END || '.csv' END AS url FROM r WHERE k % 3 > 0 OR k % 6 = 0""")
def p09_resolved_urls(spark, d):
    """Templates with an exception for June, with and without an offset, and publications that list their URLs, some without the period."""
    k = F.col("k")
    rows = given(spark, d, "SELECT concat('p', c_custkey) AS publication, c_custkey AS k FROM {customer}")
    rows = rows.withColumn("period", F.concat(F.lit("2023-"), F.lpad((k % 12 + 1).cast("string"), 2, "0")))
    listed = F.create_map(F.when(k % 6 == 0, F.col("period")).otherwise("1999-01"), F.concat(F.lit("https://list/"), k.cast("string")))
    pubs = rows.select("publication", F.concat(F.lit("https://x/"), k.cast("string"), F.lit("/")).alias("landing_page"), F.lit("{landing_page}/{month_name}-{pub_year}{pub_month}.csv").alias("template"), F.create_map(F.lit("2023-06"), F.lit("https://odd/{year}")).alias("exceptions"), F.when(k % 3 == 0, listed).alias("urls"), F.when(k % 2 == 0, 5).cast("int").alias("offset_months"))
    return SC.resolved_urls(rows.select("publication", "period"), pubs)


APPEARED = "SELECT c_mktsegment AS source, year(o_orderdate) * 100 + month(o_orderdate) AS sort_key FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' OR month(o_orderdate) BETWEEN 2 AND 3"


@query(f"""WITH e AS (SELECT source, min(sort_key) AS a, max(sort_key) AS b FROM ({plain(APPEARED)}) GROUP BY 1), y AS (SELECT source, unnest(range(a // 100 - CASE WHEN a % 100 >= 4 THEN 0 ELSE 1 END, b // 100 - CASE WHEN b % 100 >= 4 THEN 0 ELSE 1 END + 1)) AS y FROM e)
SELECT source, lpad(CAST(y % 100 AS VARCHAR), 2, '0') || '/' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS fiscal_year FROM y""")
def p11_fiscal_years(spark, d):
    return SC.fiscal_years(given(spark, d, APPEARED), "source")


@query(f"""SELECT source, CAST(min((2000 + f) * 100 + 4) AS INT) AS from_key, CAST(max((2000 + t) * 100 + 3) AS INT) AS to_key FROM (SELECT source, (sort_key // 100) % 20 AS f, ((sort_key // 100) % 20 + 1) % 100 AS t FROM ({plain(APPEARED)})) GROUP BY 1""")
def p11_sort_range(spark, d):
    y = F.floor(F.col("sort_key") / 100) % 20
    two = lambda n: F.lpad((n % 100).cast("string"), 2, "0")
    return SC.sort_range(given(spark, d, APPEARED).select("source", F.concat(two(y), F.lit("/"), two(y + 1)).alias("fiscal_year")), "source")


# --- runs and errors (A14, A25, A26) ---------------------------------------------------------------------

STEPS = """SELECT concat('r', user_id) AS run_id, event_id, ts, event_type AS was, CAST(get_json_object(props, '$.k') AS INT) AS k FROM {events}"""
STEPS_SQL = "SELECT 'r' || user_id AS run_id, event_id, ts, event_type AS was, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"
LOGGED = f"""SELECT *, CASE was WHEN 'view' THEN CASE WHEN k % 3 = 0 THEN 'run_started' ELSE 'stage_started' END WHEN 'click' THEN 'stage_completed' WHEN 'purchase' THEN CASE WHEN k % 4 = 0 THEN 'run_completed' ELSE 'stage_completed' END WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'stage_failed' ELSE 'warning' END ELSE 'llm_call' END AS event_type,
CASE WHEN k % 5 > 0 THEN 'load' END AS stage, CASE WHEN was = 'error' AND k % 2 = 1 THEN 'WARNING' WHEN was = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'pub' || k % 7 AS publication FROM ({STEPS_SQL})"""


def log(spark, d):
    kind = F.expr("CASE was WHEN 'view' THEN CASE WHEN k % 3 = 0 THEN 'run_started' ELSE 'stage_started' END WHEN 'click' THEN 'stage_completed' WHEN 'purchase' THEN CASE WHEN k % 4 = 0 THEN 'run_completed' ELSE 'stage_completed' END WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'stage_failed' ELSE 'warning' END ELSE 'llm_call' END")
    k = F.col("k")
    return given(spark, d, STEPS).select(
        "run_id", kind.alias("event_type"), F.col("ts").alias("timestamp"), F.when((F.col("was") == "error") & (k % 2 == 1), "WARNING").when(F.col("was") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("pub"), (k % 7).cast("string")).alias("publication"), F.lit(None).cast("string").alias("period"), F.when(k % 5 > 0, "load").alias("stage"),
        F.concat(F.lit("Load completed: "), k.cast("string"), F.lit(" rows in 5ms")).alias("message"), F.create_map(F.lit("failed"), (k % 3).cast("string"), F.lit("processed"), (k % 2).cast("string"), F.lit("error"), F.concat(F.lit("e"), (k % 5).cast("string"))).alias("details"),
    )


@query(f"""WITH l AS ({LOGGED}), r AS (SELECT run_id, min(ts) FILTER (event_type = 'run_started') AS began, max(ts) FILTER (event_type = 'run_completed') AS ended, max({{'ts': ts, 'f': k % 3, 'p': k % 2}}) FILTER (event_type = 'run_completed') AS told, count(DISTINCT publication) AS publications,
count(*) FILTER (level = 'ERROR') AS errors, count(*) FILTER (event_type = 'warning' AND level = 'WARNING') AS warnings, count(*) FILTER (event_type = 'stage_completed' AND stage = 'load') AS sources_loaded, CAST(coalesce(sum(k) FILTER (event_type = 'stage_completed' AND stage = 'load'), 0) AS BIGINT) AS rows_loaded,
count(*) FILTER (event_type = 'llm_call') AS calls, min({{'ts': ts, 's': coalesce(stage, 'unknown'), 'p': publication, 'e': 'e' || k % 5}}) FILTER (event_type = 'stage_failed') AS failure FROM l GROUP BY 1)
SELECT run_id, began, ended, CASE WHEN ended IS NULL THEN CASE WHEN began IS NULL THEN 'UNKNOWN' ELSE 'INCOMPLETE' END WHEN told.f > 0 THEN 'FAILED' WHEN told.p > 0 THEN 'SUCCESS' ELSE 'NO_WORK' END AS status, CAST(epoch(date_trunc('second', ended)) - epoch(date_trunc('second', began)) AS BIGINT) AS seconds, publications, errors, warnings, sources_loaded, rows_loaded, calls, failure.s AS failed_stage, failure.p AS failed_publication, failure.e AS failed_error FROM r""")
def a25_analysed_runs(spark, d):
    out = O.analysed_runs(log(spark, d))
    return out.select("run_id", "began", "ended", "status", "seconds", "publications", "errors", "warnings", "sources_loaded", "rows_loaded", "calls", "failed_stage", "failed_publication", "failed_error")


@query(f"""SELECT run_id, coalesce(stage, 'unknown') AS stage, count(*) FILTER (event_type = 'stage_started') AS started, count(*) FILTER (event_type = 'stage_completed') AS completed, count(*) FILTER (event_type = 'stage_failed') AS failed FROM ({LOGGED}) WHERE event_type LIKE 'stage%' GROUP BY ALL""")
def a25_run_stages(spark, d):
    return O.run_stages(log(spark, d))


@query(f"""WITH l AS ({LOGGED}), r AS (SELECT run_id, max(ts) FILTER (event_type = 'run_completed') AS ended, min(ts) FILTER (event_type = 'run_started') AS began, max({{'ts': ts, 'f': k % 3}}) FILTER (event_type = 'run_completed') AS told FROM l GROUP BY 1)
SELECT DISTINCT run_id, publication FROM l JOIN r USING (run_id) WHERE (ended IS NULL AND began IS NOT NULL) OR (ended IS NOT NULL AND told.f > 0)""")
def a26_restart_list(spark, d):
    events = log(spark, d)
    return O.restart_list(O.analysed_runs(events), events)


@query(f"SELECT 'e' || k % 5 AS error_type, publication, count(*) AS errors, max(ts) AS last_seen FROM ({LOGGED}) WHERE level = 'ERROR' GROUP BY ALL")
def a14_errors_by_source(spark, d):
    """Errors by type and source, a row each."""
    errors = log(spark, d).where("level = 'ERROR'")
    return errors.groupBy(F.col("details")["error"].alias("error_type"), "publication").agg(F.count("*").alias("errors"), F.max("timestamp").alias("last_seen"))


# --- sizes (A09, A36, K04) -------------------------------------------------------------------------------


@query("SELECT count(*) AS total_rows, 5 AS total_columns, true AS sized FROM customer")
def a09_sized_stats(spark, d):
    return E.dataset_stats(table(spark, d, "customer")).select("total_rows", "total_columns", ((F.col("size_mb") > 0) & (F.col("row_bytes") > 0)).alias("sized"))


SIZED = ("customer", "orders", "part", "lineitem", "supplier", "nation", "region")


@query("WITH t AS (" + " UNION ALL ".join(f"SELECT '{t}' AS code, count(*) AS n_rows FROM {t}" for t in SIZED) + ") SELECT code, n_rows, round(n_rows * 100 / sum(n_rows) OVER (), 2)::DOUBLE AS share_pct, true AS sized FROM t QUALIFY row_number() OVER (ORDER BY n_rows DESC, code) <= 5")
def k04_largest_with_size(spark, d):
    each = None
    for t in SIZED:
        one = E.sizes(table(spark, d, t)).withColumn("code", F.lit(t))
        each = one if each is None else each.unionByName(one)
    return E.largest(each).withColumn("sized", F.col("row_bytes") > 0).drop("row_bytes")


@query("SELECT (SELECT count(*) FROM customer) AS sources, (SELECT count(*) FROM lineitem) AS loads, (SELECT count(*) FROM orders) AS ledger_rows, 2 AS n_tables, (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) AS n_rows, true AS sized")
def a36_sized_overview(spark, d):
    tables = {t: table(spark, d, t) for t in ("part", "supplier")}
    out = E.overview(given(spark, d, SOURCES), given(spark, d, HISTORY), given(spark, d, LEDGER), tables)
    return out.select("sources", "loads", "ledger_rows", "n_tables", "n_rows", ((F.col("size_mb") > 0) & (F.col("n_files") >= 2)).alias("sized"))
