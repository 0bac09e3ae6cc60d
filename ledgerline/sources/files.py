"""Readers of publications: CSV, ZIP archives, workbooks, manifests, event logs, dictionaries and links in pages."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.names import sheet_name
from ledgerline.functions.periods import period_of
from ledgerline.sources.workbooks import MEMBERS, cells_of, members, read_cells

__all__ = ["cells_of", "read_cells"]
EXTENSIONS = (".xlsx", ".xls", ".zip", ".csv", ".ods")
EVENT = "event_type string, timestamp timestamp, run_id string, level string, publication string, period string, stage string, message string, details map<string,string>"
MANIFEST = "manifest struct<name:string,description:string,created_at:string>, sources array<struct<code:string,name:string,`table`:string,enabled:boolean,files:array<struct<url:string,period:string,mode:string,sheet:string,extract:string>>,columns:array<struct<name:string,original_name:string,description:string,data_type:string>>>>"


def unique_names(spark: SparkSession, headers: list[str]) -> list[str]:
    """The column names of a header row: normalised, repeated ones numbered. Headers are few and named in one small job."""
    rows = spark.createDataFrame(list(enumerate(headers)), "i int, h string").select("i", sheet_name(F.col("h")).alias("n"))
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("n").orderBy("i"))).orderBy("i").collect()
    return [r["n"] if r["k"] == 1 else f"{r['n']}_{r['k']}" for r in rows]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header row, all text, under normalised names."""
    df = spark.read.csv(path, header=True)
    return df.toDF(*unique_names(spark, df.columns))


def inferred_types(df: DataFrame) -> DataFrame:
    """(column_name, stored_type) of text columns, from all values: whole numbers, numbers, else text."""
    tests = []
    for n in df.columns:
        c = F.trim(F.col(f"`{n}`").cast("string"))
        given = F.when(c != "", c)
        number = F.regexp_replace(given, "[,%]", "").try_cast("double")
        whole = F.regexp_replace(given, ",", "").rlike(r"^[+-]?[0-9]+$")
        tests.append(F.struct(F.lit(n).alias("column_name"), F.when(F.count(given) == 0, "VARCHAR(255)").when(F.coalesce(F.bool_and(whole), F.lit(False)), "INTEGER").when(F.count(given) == F.count(number), "NUMERIC(18,6)").otherwise("VARCHAR(255)").alias("stored_type")))
    return df.agg(F.array(*tests).alias("t")).select(F.explode("t").alias("t")).select("t.*")


def archive_members(files: DataFrame) -> DataFrame:
    """(archive, member, size, content) of the data members of archives (path, content); one member at a time is held."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, content in zip(part["path"].to_pylist(), part["content"], strict=True):
                yield from members(path, pa.BufferReader(content.as_buffer()))

    return files.select("path", "content").mapInArrow(run, MEMBERS)


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """The data members of every archive in a folder."""
    return archive_members(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content"))


def zip_member(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The members of that name; without one the error lists up to five that there are."""
    found = zip_members(spark, path)
    out = found.where(F.col("member") == name)
    if out.isEmpty():
        raise ValueError(f"no member {name}; there are {', '.join(r['member'] for r in found.select('member').limit(5).collect())}")
    return out


def as_view(df: DataFrame, sql: str) -> DataFrame:
    """The rows of `sql` over `df`, which it names {data}."""
    return df.sparkSession.sql(sql, data=df)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).json(path).where("event_type is not null")


#: Fields of an event that are columns; all else of it stays in `details`.
EVENT_FIELDS = ("event_type", "run_id", "level", "publication", "period", "stage", "message")


def event_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The events of a log, one JSON object a line, with nested details as VARIANT; and apart (line) what is no such object. Blank lines are neither.

    A line is parsed once, into a variant from which the columns are taken.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("line"), F.try_parse_json("value").alias("v"))
    is_event = F.col("v").isNotNull() & F.coalesce(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), F.lit(False))
    fields = [F.try_variant_get("v", f"$.{name}", "string").alias(name) for name in EVENT_FIELDS]
    at = F.try_variant_get("v", "$.timestamp", "string").try_cast("timestamp").alias("timestamp")
    good = lines.where(is_event).select(*fields, at, F.try_variant_get("v", "$.details", "variant").alias("details")).where("event_type is not null")
    return good, lines.where(~is_event).select("line")


def manifest_files(manifests: DataFrame) -> DataFrame:
    """One row for each source and file of parsed manifests; a manifest without its sections is an error."""
    checked = manifests.withColumn("sources", F.when(F.col("manifest").isNull() | F.col("sources").isNull(), F.raise_error(F.lit("a manifest needs the sections manifest and sources"))).otherwise(F.col("sources")))
    each = checked.select(F.col("manifest.name").alias("manifest_name"), F.explode_outer("sources").alias("s"))
    return each.select("manifest_name", "s.code", "s.enabled", F.explode_outer("s.files").alias("f")).select("manifest_name", "code", "enabled", "f.*")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return manifest_files(spark.read.schema(MANIFEST).json(path, multiLine=True))


def dictionary_columns(texts: DataFrame, text: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """The `keys` of the text, purpose, column, description, data_type and search terms of each column block of dictionary texts."""
    purpose = F.substring(F.regexp_replace(F.regexp_extract(text, r"(?s)## Purpose\s*\n(.*?)(?:\n#|\z)", 1), r"^\s+|\s+$", ""), 1, 500)
    blocks = F.regexp_extract_all(text, F.lit(r"(?s)(#### `[^`]+`.*?)(?=\n#### |\n### |\z)"), 1)
    out = texts.select(*keys, purpose.alias("purpose"), F.explode(blocks).alias("b"))

    def line(label: str) -> Column:
        return F.trim(F.regexp_extract("b", rf"(?i){label}:\**\s*([^\n]*)", 1))

    terms = F.transform(F.split(line("search terms"), ","), lambda t: F.trim(t))
    return out.select(*keys, "purpose", F.regexp_extract("b", "#### `([^`]+)`", 1).alias("column"), line("description").alias("description"), line("type").alias("data_type"), F.filter(terms, lambda t: t != "").alias("search_terms"), F.nullif(F.lower(line("role")), F.lit("")).alias("role"))


def hrefs(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit("(?i)href=[\"']([^\"']+)[\"']"), 1)).alias("href"))


def absolute(base: Column, href: Column) -> Column:
    """`href` as seen from the page `base`."""
    scheme, site = F.regexp_extract(base, "^([a-z]+:)", 1), F.regexp_extract(base, "^([a-z]+://[^/?#]*)", 1)
    folder = F.concat(site, F.regexp_replace(F.regexp_extract(base, "^[a-z]+://[^/?#]*([^?#]*)", 1), "[^/]*$", ""))
    return F.when(href.rlike("^[a-z]+:"), href).when(F.startswith(href, F.lit("//")), F.concat(scheme, href)).when(F.startswith(href, F.lit("/")), F.concat(site, href)).when(F.startswith(href, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), href)).otherwise(F.concat(F.when(folder == site, F.concat(site, F.lit("/"))).otherwise(folder), href))


def download_links(pages: DataFrame, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """Distinct absolute URLs of the files that each page links to."""
    wanted = "(" + "|".join(re.escape(e) for e in extensions) + ")$"
    return hrefs(pages).where(F.lower("href").rlike(wanted)).select("page_id", absolute(F.col("url"), F.col("href")).alias("link")).distinct()


def subpage_links(pages: DataFrame) -> DataFrame:
    """Distinct absolute URLs below each page's own path: longer by two characters, no file and no anchor."""
    path = F.regexp_replace(F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    rows = hrefs(pages).withColumn("path", path)
    keep = F.startswith("href", F.col("path")) & (F.length("href") > F.length("path") + 1) & ~F.lower("href").rlike(r"\.(xlsx|xls|pdf|zip|csv|ods)$") & ~F.contains("href", F.lit("#"))
    return rows.where(keep).select("page_id", absolute(F.col("url"), F.col("href")).alias("link")).distinct()


def landing_periods(pages: DataFrame) -> DataFrame:
    """(page_id, code, sort_key, link): the periods that each page's links name, one link for each.

    Files count where at least as many of them as of the sub-pages name a period, else the sub-pages do.
    """
    both = download_links(pages).withColumn("file", F.lit(True)).unionByName(subpage_links(pages).withColumn("file", F.lit(False)))
    # through explode the long expression is worked out once, not once for each field
    read = both.select("page_id", "link", "file", F.explode(F.array(period_of(F.regexp_extract("link", "([^/]*)/*$", 1)))).alias("p")).select("page_id", "link", "file", "p.*").where("code is not null")
    sides = read.groupBy("page_id").agg((F.count_if("file") >= F.count_if(~F.col("file"))).alias("by_file"))
    used = read.join(sides, "page_id").where("file = by_file")
    return used.groupBy("page_id", "code").agg(F.max("sort_key").alias("sort_key"), F.min("link").alias("link")).orderBy("page_id", "sort_key", "code")


def crawl(pages: DataFrame) -> DataFrame:
    """Each page's file links, or, where it has none, those of the pages that it leads to."""
    direct = download_links(pages)
    bare = pages.select("page_id").join(direct.select("page_id"), "page_id", "left_anti")
    children = subpage_links(pages).join(bare, "page_id", "left_semi").withColumnRenamed("page_id", "parent")
    below = children.join(pages.select("page_id", F.col("url").alias("link")), "link").select("parent", "page_id")
    return direct.unionByName(below.join(direct, "page_id").select(F.col("parent").alias("page_id"), "link").distinct())


def registry_columns(datasets: DataFrame, code: str | None = None) -> DataFrame:
    """(code, column, description) of registered datasets, whose `columns` are JSON by name; an unknown `code` is refused."""
    rows = datasets if code is None else datasets.where(F.col("code") == code)
    if code is not None and rows.isEmpty():
        raise ValueError(f"no dataset {code}")
    return rows.select("code", F.explode(F.from_json("columns", "map<string,string>")).alias("column", "description"))


def listed_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, type, position) of all tables, as a table."""
    rows = [(t, n, kind, k) for t, df in sorted(tables.items()) for k, (n, kind) in enumerate(df.dtypes, 1)]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "`table` string, `column` string, type string, position int")
