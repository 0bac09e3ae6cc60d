"""Queries of readers, the query API and streams."""

from __future__ import annotations

import datetime
import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ledgerline.operators import keywords as K
from ledgerline.operators import metadata as MD
from ledgerline.operators import sheets
from ledgerline.sources import files as S
from ledgerline.sources import workbooks as W
from ledgerline.streaming import monitor as M

from . import api
from .inputs import FILES, given, plain
from .loading import HISTORY_SQL, SOURCES, SOURCES_SQL, history
from .registry import query
from .reports import META_SQL, TOLD, meta
from .shared import folder

PARTS = "SELECT p_partkey, p_name, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM {part}"


def csv_folder(spark, d):
    path = folder(spark, "csv")
    given(spark, d, PARTS).toDF("Part Key", "Name", "Size", "Unit £ Price").write.option("header", True).csv(path)
    return path


@query("SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_name AS name_val, CAST(p_size AS VARCHAR) AS size, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price FROM part")
def s01_read_csv(spark, d):
    return S.read_csv(spark, csv_folder(spark, d))


@query("SELECT * FROM (VALUES ('part_key', 'INTEGER'), ('name_val', 'VARCHAR(255)'), ('size', 'INTEGER'), ('unit_price', 'NUMERIC(18,6)')) t(column_name, stored_type)")
def s02_inferred_types(spark, d):
    return S.inferred_types(S.read_csv(spark, csv_folder(spark, d)))


#: Parts of one file at most: files grow in number with the table, not in size.
A_FILE = 1000


def packed(spark, d, suffix, make):
    """Files (path, content) with the parts of a brand, A_FILE keys each, made on the executors."""
    path = folder(spark, suffix)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"path": [frame["p_brand"].iloc[0].replace("#", "") + f"-{frame['block'].iloc[0]}"], "content": [make(frame.sort_values("p_partkey"))]})

    parts = given(spark, d, f"SELECT p_brand, p_partkey, p_name, p_size, floor(p_partkey / {A_FILE}) AS block FROM {{part}}")
    parts.groupBy("p_brand", "block").applyInPandas(build, "path string, content binary").write.parquet(path)
    return spark.read.parquet(path)


def archive(frame):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("data.csv", frame[["p_brand", "p_partkey", "p_name", "p_size"]].to_csv(index=False))
        z.writestr("readme.txt", "no data")
    return out.getvalue()


@query(f"SELECT replace(p_brand, '#', '') AS name, count(DISTINCT p_partkey // {A_FILE}) AS members, count(*) AS n_parts FROM part GROUP BY 1")
def s03_zip_members(spark, d):
    """The data members of archives that hold each brand's parts, and the rows in them."""

    def rows(frames):
        for frame in frames:
            yield pd.DataFrame({"archive": frame["archive"], "n": [len(pd.read_csv(io.BytesIO(c))) for c in frame["content"]]})

    counted = S.archive_members(packed(spark, d, "zip", archive)).mapInPandas(rows, "archive string, n long")
    return counted.groupBy(F.split_part("archive", F.lit("-"), F.lit(1)).alias("name")).agg(F.count("*").alias("members"), F.sum("n").alias("n_parts"))


def workbook(frame):
    rows = [[int(k), n, int(z)] for k, n, z in frame[["p_partkey", "p_name", "p_size"]].itertuples(index=False)]
    return W.workbook_bytes({"Data": ([["Part", "Name", "Size"], *rows], [])})


def merged_workbook(frame):
    """Two sheets: parts below a heading merged over all columns, and a title merged over a whole sheet."""
    rows = [[int(k), n, int(z), datetime.date(2024, 1, 1) + datetime.timedelta(days=int(z))] for k, n, z in frame[["p_partkey", "p_name", "p_size"]].itertuples(index=False)]
    return W.workbook_bytes({"Data": ([[f"Parts of {frame['p_brand'].iloc[0]}"], ["Part", "Name", "Size", "Day"], *rows], ["A1:D1"]), "Notes": ([["All parts"]], ["A1:XFD1048576"])})


@query(f"SELECT replace(p_brand, '#', '') AS file, count(*) * 3 + 3 * count(DISTINCT p_partkey // {A_FILE}) AS cells, count(*) * 2 AS numbers, CAST(max(p_size) AS INT) AS largest FROM part GROUP BY 1")
def s04_workbook_cells(spark, d):
    cells = S.cells_of(packed(spark, d, "xlsx", workbook))
    return cells.groupBy(F.split_part("file", F.lit("-"), F.lit(1)).alias("file")).agg(F.count("*").alias("cells"), F.count_if(F.col("ctype") == "n").alias("numbers"), F.max(F.when((F.col("col") == 3) & (F.col("ctype") == "n"), F.col("value").cast("int"))).alias("largest"))


@query(f"""WITH p AS (SELECT replace(p_brand, '#', '') || '-' || (p_partkey // {A_FILE}) AS file, p_brand, p_partkey, p_name, p_size, CAST(row_number() OVER (PARTITION BY p_brand, p_partkey // {A_FILE} ORDER BY p_partkey) + 2 AS INT) AS row FROM part),
f AS (SELECT DISTINCT file, p_brand FROM p)
SELECT file, 'Data' AS sheet, 1 AS row, unnest([1, 2, 3, 4]) AS col, 'Parts of ' || p_brand AS value, 's' AS ctype, true AS is_merged FROM f
UNION ALL SELECT file, 'Data', 2, unnest([1, 2, 3, 4]), unnest(['Part', 'Name', 'Size', 'Day']), 's', false FROM f
UNION ALL SELECT file, 'Data', row, unnest([1, 2, 3, 4]), unnest([CAST(p_partkey AS VARCHAR), p_name, CAST(p_size AS VARCHAR), strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d')]), unnest(['n', 's', 'n', 'd']), false FROM p
UNION ALL SELECT file, 'Notes', 1, CAST(unnest(range(1, 65)) AS INT), 'All parts', 's', true FROM f""")
def c01_workbook_merges(spark, d):
    """Cells under the merged ranges that their workbooks have, one of them over a whole sheet."""
    path = folder(spark, "contents")
    W.contents_of(packed(spark, d, "xlsx", merged_workbook)).write.parquet(path)  # each file is read once
    contents = spark.read.parquet(path)
    return sheets.resolved(contents.where("ctype <> 'm'").drop("last_row", "last_col"), W.merges_of(contents))


@query("SELECT p_type, count(*) AS n FROM part GROUP BY 1")
def s05_sql_over_dataset(spark, d):
    return S.as_view(given(spark, d, "SELECT * FROM {part}"), "SELECT p_type, count(*) AS n FROM {data} GROUP BY p_type")


@query("SELECT s_suppkey, s_name FROM supplier")
def s06_registered_table(spark, d):
    registry = spark.createDataFrame([("suppliers", f"{d}/supplier.parquet")], "code string, path string")
    return api.dataset(spark, registry, "suppliers").select("s_suppkey", "s_name")


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total FROM events GROUP BY 1")
def s08_event_log(spark, d):
    path = folder(spark, "events")
    rows = given(spark, d, "SELECT event_type, ts AS timestamp, concat('r', user_id) AS run_id, map('k', get_json_object(props, '$.k')) AS details FROM {events}")
    rows.write.json(path)
    return S.read_events(spark, path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.col("details")["k"].cast("long")).alias("total"))


@query("""SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total, count(*) FILTER (user_id % 2 = 0) AS nested, 0 AS malformed FROM events GROUP BY 1
UNION ALL SELECT NULL, 0, NULL, 0, count(*) FROM events WHERE event_id % 10 = 0""")
def s08_event_variants(spark, d):
    """A log whose details nest, with a line in ten cut off; each line is parsed once."""
    path = folder(spark, "events-lines")
    nested = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.struct(F.when(F.col("user_id") % 2 == 0, F.array("user_id")).alias("users")).alias("more"))
    rows = given(spark, d, "SELECT event_id, user_id, event_type, ts, props FROM {events}").select("event_id", F.to_json(F.struct("event_type", F.col("ts").alias("timestamp"), F.concat(F.lit("r"), "user_id").alias("run_id"), nested.alias("details"))).alias("line"))
    cut = rows.where("event_id % 10 = 0").select(F.substring("line", 1, 30).alias("line"))
    rows.select("line").unionByName(cut).unionByName(spark.createDataFrame([("",), ("  ",)], "line string")).write.text(path)
    good, bad = S.event_lines(spark, path)
    k, users = F.expr("variant_get(details, '$.k', 'bigint')"), F.expr("try_variant_get(details, '$.more.users[0]', 'bigint')")
    counts = good.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"), F.count(users).alias("nested")).withColumn("malformed", F.lit(0).cast("long"))
    lost = bad.agg(F.lit(None).cast("string").alias("event_type"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("total"), F.lit(0).cast("long").alias("nested"), F.count("*").alias("malformed"))
    return counts.unionByName(lost)


@query("SELECT 'm' || (o_custkey % 40) AS manifest_name, 's' || o_custkey AS code, 'u' || o_orderkey AS url FROM orders")
def s09_manifest_files(spark, d):
    # a manifest holds the files of few customers
    files = given(spark, d, "SELECT concat('m', o_custkey % 40) AS m, floor(o_custkey / 1000) AS block, concat('s', o_custkey) AS code, concat('u', o_orderkey) AS url FROM {orders}").groupBy("m", "block", "code").agg(F.collect_list(F.struct("url")).alias("files"))
    whole = files.groupBy("m", "block").agg(F.collect_list(F.struct("code", "files")).alias("sources")).select(F.struct(F.col("m").alias("name")).alias("manifest"), "sources")
    path = folder(spark, "manifests")
    whole.write.json(path)
    return S.manifest_files(spark.read.schema(S.MANIFEST).json(path)).select("manifest_name", "code", "url")


@query("SELECT p_partkey, 'col_' || p_size AS \"column\", p_name AS description FROM part")
def s10_dictionary_columns(spark, d):
    text = F.concat(F.lit("# x\n## Purpose\nParts of a kind\n\n### Columns\n#### `col_"), F.col("p_size"), F.lit("`\n- **Description:** "), F.col("p_name"), F.lit("\n- **Type:** INTEGER\n- **Search terms:** a, b\n"))
    rows = given(spark, d, "SELECT p_partkey, p_name, p_size FROM {part}").select("p_partkey", text.alias("value"))
    return S.dictionary_columns(rows, keys=("p_partkey",)).select("p_partkey", "column", "description")


PAGES = "SELECT page_id, url, concat(html, '<a href=\"/files/a', page_id % 7, '.xlsx\">x</a><a HREF=\"b', page_id, '.csv\">y</a>') AS html FROM {pages} WHERE page_id % 2 = 0 UNION ALL SELECT page_id, url, html FROM {pages} WHERE page_id % 2 = 1"
SITE = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
HREFS = f"SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)href=[\"'']([^\"'']+)[\"'']', 1)) AS href FROM ({plain(PAGES)})"
ABSOLUTE = f"CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href WHEN href LIKE '//%' THEN regexp_extract(url, '^([a-z]+:)', 1) || href WHEN href LIKE '/%' THEN {SITE} || href ELSE {SITE} || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') || href END"


DOWNLOADS = f"SELECT DISTINCT page_id, {ABSOLUTE} AS link FROM ({HREFS}) WHERE regexp_matches(lower(href), '\\.(xlsx|xls|zip|csv|ods)$')"


@query(DOWNLOADS)
def s11_download_links(spark, d):
    return S.download_links(given(spark, d, PAGES))


def subpages_sql(hrefs):
    return f"SELECT DISTINCT page_id, {ABSOLUTE} AS link FROM (SELECT *, rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS path FROM {hrefs}) WHERE starts_with(href, path) AND length(href) > length(path) + 1 AND NOT regexp_matches(lower(href), '\\.(xlsx|xls|pdf|zip|csv|ods)$') AND NOT contains(href, '#')"


SHORTER = f"(SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || CASE WHEN page_id % 3 = 0 THEN '' ELSE regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) END AS url, href FROM ({HREFS}))"


@query(subpages_sql(SHORTER))
def s12_subpage_links(spark, d):
    site = F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0)
    path = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1))
    return S.subpage_links(given(spark, d, PAGES).withColumn("url", F.concat(site, path)))


@query(f"""WITH direct AS ({DOWNLOADS}), child AS ({subpages_sql(f"({HREFS})")})
SELECT page_id, link FROM direct UNION ALL
SELECT DISTINCT c.page_id, d.link FROM child c JOIN pages p ON p.url = c.link JOIN direct d ON d.page_id = p.page_id WHERE c.page_id NOT IN (SELECT page_id FROM direct)""")
def s13_crawl(spark, d):
    return S.crawl(given(spark, d, PAGES))


LISTED = {
    "customer": "c_custkey:bigint c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string",
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double o_orderdate:timestamp_ntz o_orderpriority:string",
    "part": "p_partkey:bigint p_name:string p_brand:string p_type:string p_size:int p_retailprice:double",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{n}', '{kind}', {k})" for t, names in LISTED.items() for k, (n, kind) in enumerate((x.split(":") for x in names.split()), 1)) + ") t(\"table\", \"column\", type, position)")
def s14_listed_columns(spark, d):
    return S.listed_columns({t: given(spark, d, f"SELECT * FROM {{{t}}}") for t in ("part", "orders", "customer")})


@query("SELECT 'r' || c_custkey AS code, 'c' || c_nationkey AS \"column\", c_mktsegment AS description FROM customer")
def s15_registry_columns(spark, d):
    columns = F.create_map(F.concat(F.lit("c"), "c_nationkey"), F.col("c_mktsegment"))
    rows = given(spark, d, "SELECT c_custkey, c_nationkey, c_mktsegment FROM {customer}").select(F.concat(F.lit("r"), "c_custkey").alias("code"), F.to_json(columns).alias("columns"))
    return S.registry_columns(rows)


SHORT_MONTH = "substr('janfebmaraprmayjunjulaugsepoctnovdec', {0} % 12 * 3 + 1, 3)"


@query(f"""WITH p AS (SELECT page_id, url, {SITE} AS site, rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS path FROM pages),
l AS (SELECT page_id, page_id % 4 < 3 AS by_file, true AS file, CAST((page_id + k) % 12 + 1 AS INT) AS m, 2021 AS y, site || '/files/data-' || {SHORT_MONTH.format('(page_id + k)')} || '-2021.csv' AS link FROM p, (VALUES (0), (1)) v(k)
UNION ALL SELECT page_id, page_id % 4 < 3, false, CAST((page_id + k) % 12 + 1 AS INT), 2019, site || path || '/' || {SHORT_MONTH.format('(page_id + k)')} || '-2019' FROM p, (VALUES (1), (2), (3)) v(k) WHERE k <= page_id % 4)
SELECT page_id, format('{{:04d}}-{{:02d}}', y, m) AS code, CAST(y * 100 + m AS INT) AS sort_key, link FROM l WHERE file = by_file""")
def p12_landing_page_periods(spark, d):
    """Two files a page and up to three sub-pages, each named for a month."""
    path = "regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')"
    files = ", ".join(f"concat('<a href=\"/files/data-', {SHORT_MONTH.format(f'(page_id + {k})')}, '-2021.csv\">')" for k in (0, 1))
    pages = ", ".join(f"CASE WHEN {k} <= page_id % 4 THEN concat('<a href=\"', {path}, '/', {SHORT_MONTH.format(f'(page_id + {k})')}, '-2019\">') ELSE '' END" for k in (1, 2, 3))
    return S.landing_periods(given(spark, d, f"SELECT page_id, url, concat({files}, {pages}) AS html FROM {{pages}}"))


# --- the query API ---------------------------------------------------------------------------------------


@query(f"""SELECT s.code, s.domain, h.total_rows, h.loads, h.date_range FROM ({SOURCES_SQL}) s JOIN (SELECT source, CAST(sum(rows_loaded) AS BIGINT) AS total_rows, count(*) AS loads, strftime(min(loaded_at), '%Y-%m-%d') || ' to ' || strftime(max(loaded_at), '%Y-%m-%d') AS date_range FROM ({HISTORY_SQL}) GROUP BY 1) h ON h.source = s.code
WHERE s.domain = 'BUILDING' AND contains(s.code, 's1') AND total_rows >= 1000 ORDER BY s.code LIMIT 50""")
def q01_list_datasets(spark, d):
    return api.list_datasets(given(spark, d, SOURCES), history(spark, d), domain="BUILDING", keyword="s1", min_rows=1000)


@query("SELECT 'part' AS code, count(*) AS n_rows, 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' AS columns, '0,1,10' AS sample FROM part")
def q02_metadata(spark, d):
    return api.metadata(given(spark, d, "SELECT * FROM {part}"), "part")


@query("""SELECT column_name, kind, n_rows FROM (VALUES ('o_orderkey', 'numeric'), ('o_custkey', 'numeric'), ('o_totalprice', 'numeric'), ('o_orderdate', 'date'), ('o_orderstatus', 'text'), ('o_orderpriority', 'text'), ('SELECT count(*) FROM data', 'suggestion'), ('SELECT sum(o_orderkey) FROM data', 'suggestion'), ('SELECT o_orderstatus, count(*) FROM data GROUP BY o_orderstatus', 'suggestion')) t(column_name, kind), (SELECT count(*) AS n_rows FROM orders)""")
def q03_schema(spark, d):
    rows = given(spark, d, "SELECT * FROM {orders}")
    return api.schema(rows).crossJoin(rows.agg(F.count("*").alias("n_rows")))


@query("SELECT p_type, count(*) AS n FROM part GROUP BY 1")
def q04_ask_sql(spark, d):
    return api.ask(given(spark, d, "SELECT * FROM {part}"), "SELECT p_type, count(*) AS n FROM data GROUP BY p_type")


@query("SELECT CAST(sum(p_size) AS BIGINT) AS total_p_size FROM part")
def q04_ask_total(spark, d):
    return api.ask(given(spark, d, "SELECT p_size, p_type FROM {part}"), "What is the total size?")


@query(f"SELECT col AS \"column\", unit, aggregation, metric_type FROM ({TOLD}) WHERE tbl = 't_3' AND is_measure")
def q06_kpis(spark, d):
    return api.kpis(MD.rolled_up(meta(spark, d)), "t_3")


@query("SELECT p_type, p_size FROM part WHERE p_brand = 'Brand#7' ORDER BY p_type, p_size LIMIT 100")
def q07_query_metric(spark, d):
    return api.metric(given(spark, d, "SELECT p_type, p_brand, p_size FROM {part}"), "p_size", {"p_brand": "Brand#7", "absent": 1})


@query(f"SELECT tbl AS \"table\", col AS \"column\" FROM ({META_SQL}) WHERE contains(lower(concat_ws(' ', col, description)), 'region') ORDER BY 1, 2 LIMIT 100")
def q08_search_columns(spark, d):
    return api.search_columns(MD.described(meta(spark, d)).withColumn("keywords", F.lit("")), "region")


@query("SELECT 'l_quantity' AS metric, 'Quantity of a line' AS label, 'items' AS unit, count(*) AS total_rows, count(*) FILTER (l_returnflag = 'R') AS rows_found, 'absent' AS invalid_filters, count(*) FILTER (l_returnflag = 'R') > 100 AS truncated, CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN max(CAST(l_shipdate AS VARCHAR)) END AS latest_period FROM lineitem")
def q07_metric_context(spark, d):
    kpis = spark.createDataFrame([("l_quantity", "Quantity of a line", "items")], "`column` string, label string, unit string")
    return api.metric_context(given(spark, d, "SELECT l_shipdate, l_returnflag, l_quantity FROM {lineitem}"), "l_quantity", {"l_returnflag": "R", "absent": 1}, kpis)


@query("SELECT 'l_tax' AS metric, 'l_tax' AS label, 'unknown' AS unit, count(*) AS total_rows, CAST(0 AS BIGINT) AS rows_found, '' AS invalid_filters, false AS truncated, strftime(max(l_shipdate), '%Y-%m-%d') AS latest_period FROM lineitem")
def q07_metric_missed(spark, d):
    """A filter that leaves nothing: the answer names the latest period."""
    kpis = spark.createDataFrame([("l_quantity", "Quantity of a line", "items")], "`column` string, label string, unit string")
    return api.metric_context(given(spark, d, "SELECT CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag, l_tax FROM {lineitem}"), "l_tax", {"l_returnflag": "none"}, kpis)


# --- the keyword index -----------------------------------------------------------------------------------


def keyword_index(spark, d):
    """The stored postings of all columns, tagged by the domain of their table."""
    columns = meta(spark, d).withColumn("keywords", F.array(F.col("data_type")))
    tags = columns.select("table").distinct().withColumn("tags", F.array(F.concat(F.lit("area-"), F.substring("table", 3, 1)), F.lit("All")))
    path = folder(spark, "keywords")
    K.postings(columns, tags).write.parquet(path)
    return spark.read.parquet(path)


WORDS = "regexp_split_to_array(lower(concat_ws(' ', col, description, data_type)), '[^a-z0-9]+')"


def found_sql(words):
    return f"SELECT tbl, col FROM ({META_SQL}) GROUP BY tbl, col HAVING " + " AND ".join(f"bool_or(len(list_filter({WORDS}, lambda w: contains(w, '{w}'))) > 0)" for w in words)


def answer_sql(words):
    return f"""WITH f AS (SELECT tbl, count(*) AS hits FROM ({found_sql(words)}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50), r AS (SELECT *, row_number() OVER (ORDER BY hits DESC, tbl) AS rank, count(*) OVER () AS found FROM f), n AS (SELECT tbl, count(DISTINCT col) AS n_columns FROM ({META_SQL}) GROUP BY 1)
SELECT CASE WHEN found > 20 THEN 'narrow' ELSE 'datasets' END AS answer, CAST(found AS INT) AS found, CAST(rank AS INT) AS rank, tbl AS "table", hits, CASE WHEN found <= 20 THEN n_columns END AS n_columns FROM r JOIN n USING (tbl) WHERE found <= 20 OR rank <= 10"""


def answered(spark, d, keywords):
    details = meta(spark, d).groupBy("table").agg(F.count_distinct("column").alias("n_columns"))
    return K.discovered(keyword_index(spark, d), keywords, details)


@query(answer_sql(["build", "rate"]))
def q05_datasets_found(spark, d):
    """Datasets with a column that is told of in both words."""
    return answered(spark, d, ["build rate"])


@query(answer_sql(["region"]))
def q05_narrow_down(spark, d):
    return answered(spark, d, ["region"])


@query(f"SELECT DISTINCT tbl AS \"table\", col AS \"column\" FROM ({found_sql(['target'])}) ORDER BY 1, 2 LIMIT 50")
def q08_columns_by_index(spark, d):
    columns = MD.described(meta(spark, d)).withColumn("role", F.when(F.col("is_measure"), "measure").when(F.col("is_dimension"), "dimension"))
    one = columns.groupBy("table", "column").agg(F.min("description").alias("description"), F.min("data_type").alias("data_type"), F.min("role").alias("role"))
    return K.searched(keyword_index(spark, d), "Target", one).select("table", "column")


REGISTERED = "SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS domain, array(concat('n', c_nationkey), lower(c_mktsegment), 'all') AS tags FROM {customer}"


@query("SELECT CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment ELSE 'other' END AS domain, count(*) AS datasets FROM customer GROUP BY 1")
def q08_domains(spark, d):
    return K.domains(given(spark, d, REGISTERED))


@query("SELECT tag, count(*) AS datasets FROM (SELECT unnest(['n' || c_nationkey, lower(c_mktsegment), 'all']) AS tag FROM customer) GROUP BY 1")
def q08_all_tags(spark, d):
    return K.all_tags(given(spark, d, REGISTERED))


# --- streams ---------------------------------------------------------------------------------------------

LOG = "SELECT CAST(ts AS TIMESTAMP) AS ts, event_type, CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END AS level FROM {events}"


@query("SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1")
def w13_event_sink(spark, d):
    path = folder(spark, "w13")
    M.emitted(given(spark, d, LOG), path)
    stored = spark.read.schema("event_type string, date string").json(path)
    return stored.groupBy("date").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query("SELECT date_trunc('day', ts) AS starts, event_type, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors, round(count(*) FILTER (event_type = 'error') / count(*), 4) AS error_rate FROM events GROUP BY ALL")
def t02_event_windows(spark, d):
    path = folder(spark, "log")
    rows = given(spark, d, LOG)
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    out = folder(spark, "windows")

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    M.windowed(stream).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", folder(spark, "windows-state")).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(out)
    return last.join(F.broadcast(last.agg(F.max("batch").alias("batch"))), "batch").drop("batch").withColumn("starts", F.col("starts").cast("timestamp_ntz"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY 1")
def t01_landing_ingest(spark, d):
    landing, store, ledger = (folder(spark, f"t01-{n}") for n in ("in", "store", "ledger"))
    rows = given(spark, d, "SELECT o_orderkey, o_custkey, concat(year(o_orderdate), '-', substr(concat('0', month(o_orderdate)), -2, 2)) AS period FROM {orders}")
    rows.repartition(3).write.parquet(landing)  # files that share their periods
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    M.ingested(stream, store, ledger, folder(spark, "t01-state"))
    return spark.read.parquet(store).groupBy("period").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT 'r' || (event_id % 97) AS run_id, count(*) FILTER (event_type = 'signup') AS started, count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'error') AS failed, max(ts) AS seen FROM events GROUP BY 1)
SELECT run_id, CASE WHEN failed > 0 THEN 'FAILED' WHEN started > 0 AND completed + failed >= started THEN 'SUCCESS' ELSE 'INCOMPLETE' END AS status, started, completed, failed FROM r WHERE (started > 0 AND completed + failed >= started) OR seen + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)""")
def t03_run_states(spark, d):
    path, out = folder(spark, "t03"), folder(spark, "t03-out")
    rows = given(spark, d, "SELECT concat('r', event_id % 97) AS run_id, CAST(ts AS TIMESTAMP) AS ts, CASE event_type WHEN 'signup' THEN 'started' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'other' END AS kind FROM {events}")
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    M.run_states(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(spark, "t03-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


RUNS = "SELECT concat('r', event_id % 97) AS run_id, CAST(ts AS TIMESTAMP) AS ts, CASE event_type WHEN 'signup' THEN 'started' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'other' END AS kind FROM {events}"


@query("""WITH e AS (SELECT 'r' || (event_id % 97) AS run_id, ts, event_type FROM events),
b AS (SELECT *, coalesce(ts >= lag(ts) OVER (PARTITION BY run_id ORDER BY ts) + INTERVAL 8 HOUR, true) AS breaks FROM e),
s AS (SELECT *, sum(CASE WHEN breaks THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM b),
r AS (SELECT run_id, min(ts) AS began, max(ts) AS seen, count(*) FILTER (event_type = 'signup') AS started, count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'error') AS failed FROM s GROUP BY run_id, n)
SELECT run_id, began, CASE WHEN failed > 0 THEN 'FAILED' WHEN started > 0 AND completed >= started THEN 'SUCCESS' ELSE 'INCOMPLETE' END AS status, started, completed, failed FROM r WHERE seen + INTERVAL 8 HOUR <= (SELECT max(ts) FROM events)""")
def t03_run_sessions(spark, d):
    """Sessions of runs in Spark's state; those that the watermark, here the newest event, hasn't passed are still open."""
    path, out = folder(spark, "t03s"), folder(spark, "t03s-out")
    rows = given(spark, d, RUNS)
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    M.run_sessions(stream, "8 hours").writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(spark, "t03s-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).withColumn("began", F.col("began").cast("timestamp_ntz"))


@query("SELECT date_trunc('day', ts) AS starts, event_type, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors, round(count(*) FILTER (event_type = 'error') / count(*), 4) AS error_rate FROM events GROUP BY ALL")
def t02_closed_windows(spark, d):
    """The windows of a month's log that comes in thirds: those closed and, at its end, those still open."""
    path, out, late, state = (folder(spark, f"t02-{n}") for n in ("log", "out", "late", "state"))
    rows = given(spark, d, LOG)
    for days in ("day(ts) < 11", "day(ts) between 11 and 20", "day(ts) > 20"):  # files are taken by age
        rows.where(days).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    M.closed_windows(stream, out, late, state, folder(spark, "t02-checkpoint"), late="12 days")
    both = spark.read.parquet(out).drop("batch").unionByName(M.open_windows(spark, state))
    return both.withColumn("starts", F.col("starts").cast("timestamp_ntz"))
