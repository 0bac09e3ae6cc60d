"""Exports: sorted files, catalogs, dictionaries, and checks that an export equals its table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.files import dictionary_columns


RESULT = "code string, success boolean, n_rows long, n_columns int, n_files long, size_bytes long, path string, error string"


def sizes(files: DataFrame) -> DataFrame:
    """One row on a table that was read from files: n_rows, n_files (with rows) and size_bytes, as the reader itself reports them."""
    each = files.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"), F.max("_metadata.file_size").alias("size"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes"))


def sort_key(df: DataFrame) -> list[Column]:
    """The first column and, so that a frequent value of it doesn't meet in one task, the others that have an order."""
    return [F.col(f"`{n}`") for n, k in df.dtypes if not k.startswith("map") and k != "variant"]


def exported(df: DataFrame, path: str) -> DataFrame:
    """Writes `df` ordered by its first column, equal ones by the others; one row on what was written."""
    df.orderBy(*sort_key(df)).write.mode("overwrite").option("compression", "snappy").parquet(path)
    back = df.sparkSession.read.parquet(path)
    return sizes(back).withColumns({"n_columns": F.lit(len(back.columns)), "path": F.lit(path)})


def exported_all(spark: SparkSession, codes: Iterable[str], read: Callable[[str], DataFrame], prefix: str, folder: str) -> DataFrame:
    """The exports of all sources whose code begins with `prefix`, one row each; a source that can't be read or written is a failed row."""
    rows = []
    for code in sorted(c for c in codes if c.startswith(prefix)):  # each export is a job of its own
        try:
            done = exported(read(code), f"{folder}/{code}").first()
            rows.append((code, True, done["n_rows"], done["n_columns"], done["n_files"], done["size_bytes"], done["path"], None))
        except Exception as e:  # noqa: BLE001  whatever a source fails with is its result
            rows.append((code, False, 0, 0, 0, 0, None, str(e).strip().split("\n")[0][:300]))
    return spark.createDataFrame(rows, RESULT)


def export_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("exports"), F.count_if("success").alias("succeeded"), F.sum("n_rows").alias("n_rows"), F.sum("size_bytes").alias("size_bytes"))


def json_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each row as JSON with not-a-numbers as nulls."""
    safe = [F.when(~F.isnan(F.col(n)), F.col(n)).alias(n) if k in ("double", "float") else F.col(n).cast("double").alias(n) if k.startswith("decimal") else F.col(n) for n, k in df.dtypes]
    return df.select(*(keep or []), F.to_json(F.struct(*safe)).alias("json"))


def catalog_row(df: DataFrame, code: str) -> DataFrame:
    """code, n_rows, n_columns, and the least and greatest of the first column that is named for a date or period."""
    dated = next((c for c in df.columns if "date" in c.lower() or "period" in c.lower()), None)
    day = F.to_date(F.expr(f"try_cast(`{dated}` as timestamp)")) if dated else F.lit(None).cast("date")
    return df.agg(F.count("*").alias("n_rows"), F.min(day).alias("min_date"), F.max(day).alias("max_date")).select(F.lit(code).alias("code"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "min_date", "max_date")


def catalog(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [catalog_row(df, code) for code, df in sorted(tables.items()) if code != "catalog"])


def sized_catalog(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """`catalog` of exported folders by code, with their size in KB."""

    def row(code: str, path: str) -> DataFrame:
        files = spark.read.parquet(path)
        kb = sizes(files).select(F.round(F.col("size_bytes") / 1024, 1).alias("size_kb"))
        return catalog_row(files, code).crossJoin(kb)  # of one row each

    return reduce(DataFrame.unionByName, [row(code, path) for code, path in sorted(paths.items()) if code != "catalog"])


def dataset_stats(files: DataFrame) -> DataFrame:
    """One row on a table that was read from files: total_rows, total_columns, size_mb and row_bytes (what a row takes on average)."""
    mb = F.round(F.col("size_bytes") / 1_048_576, 4)
    return sizes(files).select(F.col("n_rows").alias("total_rows"), F.lit(len(files.columns)).alias("total_columns"), mb.alias("size_mb"), F.round(F.try_divide("size_bytes", "n_rows"), 2).alias("row_bytes"))


def largest(datasets: DataFrame, most: int = 5) -> DataFrame:
    """The largest of datasets (code, n_rows, size_bytes) by rows, with the bytes of a row and the share of all rows."""
    whole = datasets.agg(F.sum("n_rows").alias("_all"))
    top = datasets.orderBy(F.desc("n_rows"), "code").limit(most).crossJoin(F.broadcast(whole))  # one row
    return top.select("code", "n_rows", F.round(F.try_divide("size_bytes", "n_rows"), 2).alias("row_bytes"), F.round(F.try_divide(F.col("n_rows") * 100, "_all"), 2).alias("share_pct"))


def overview(sources: DataFrame, history: DataFrame, ledger: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row on a store: sources, loads, ledger rows, tables with their rows, files and MB (of tables that were read from files)."""
    each = reduce(DataFrame.unionByName, [sizes(t) for t in tables.values()])
    total = each.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_files").alias("n_files"), F.round(F.sum("size_bytes") / 1_048_576, 4).alias("size_mb")).withColumn("n_tables", F.lit(len(tables)))
    counts = [df.agg(F.count("*").alias(n)) for n, df in (("sources", sources), ("loads", history), ("ledger_rows", ledger))]
    return reduce(DataFrame.crossJoin, [*counts, total])  # of one row each


TITLES = ("Dimensions", "Measures", "Other", "System")


def column_group() -> Column:
    """The place in TITLES of a column, by name and role."""
    return F.when(F.startswith("column", F.lit("_")), 3).when(F.col("is_dimension"), 0).when(F.col("is_measure"), 1).otherwise(2)


def quality_mark() -> Column:
    return F.when(F.col("confidence") >= 0.9, "✓").otherwise("~")


def sectioned(rows: DataFrame, by: str, line: Column, between: str) -> DataFrame:
    """`by`, sections (markdown of all groups that have columns) and n_columns; a table's columns are gathered."""
    packed = rows.select(by, F.struct(column_group().alias("g"), F.col("column"), line.alias("line")).alias("r")).groupBy(by).agg(F.array_sort(F.collect_list("r")).alias("rows"))

    def section(k: int, title: str) -> Column:
        own = F.filter("rows", lambda r: r["g"] == k)
        return F.when(F.size(own) > 0, F.concat(F.lit(f"### {title}\n"), F.array_join(F.transform(own, lambda r: r["line"]), between)))

    return packed.select(by, F.concat_ws(between, *[section(k, t) for k, t in enumerate(TITLES)]).alias("sections"), F.size("rows").alias("n_columns"))


def dictionaries(metadata: DataFrame, by: str) -> DataFrame:
    """One short markdown text for each table, grouped into dimensions, measures, other and system columns."""
    line = F.concat(F.lit("#### `"), "column", F.lit("` "), quality_mark(), F.lit("\n- "), F.coalesce("description", F.lit("")), F.lit("\n- type: "), F.coalesce("data_type", F.lit("?")))
    return sectioned(metadata, by, line, "\n").select(by, F.concat_ws("\n", F.concat(F.lit("# "), by), F.nullif("sections", F.lit(""))).alias("markdown"))


def full_dictionaries(metadata: DataFrame, by: str, purposes: DataFrame) -> DataFrame:
    """One whole markdown text for each table, which `files.dictionary_columns` reads back.

    `metadata` has `by`, column, original_name, data_type, description, least, most, null_rate, distinct_values, search_terms (array), is_dimension,
    is_measure, confidence and metadata_source; what is null is left out. `purposes` has `by`, purpose and n_rows.
    """

    def told(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"**{label}:** "), value)

    renamed = F.when(F.col("original_name") != F.col("column"), F.col("original_name"))
    lines = [
        F.concat(F.lit("#### `"), "column", F.lit("`\n")),
        told("Original Name", renamed),
        told("Type", F.coalesce("data_type", F.lit("?"))),
        told("Description", F.nullif("description", F.lit(""))),
        told("Range", F.concat("least", F.lit(" to "), "most")),
        told("Null Rate", F.concat(F.format_string("%.1f", F.col("null_rate").cast("double")), F.lit("%"))).alias("rate"),
        told("Distinct Values", F.col("distinct_values").cast("string")),
        told("Search Terms", F.nullif(F.array_join("search_terms", ", "), F.lit(""))),
        told("Metadata Quality", F.concat(quality_mark(), F.lit(" "), "metadata_source", F.lit(" (confidence: "), F.format_string("%.2f", F.col("confidence").cast("double")), F.lit(")"))),
    ]
    lines[5] = F.when(F.col("null_rate").isNotNull(), lines[5])
    texts = sectioned(metadata, by, F.concat(F.concat_ws("  \n", *lines), F.lit("\n")), "\n").join(purposes, by, "left")
    head = F.concat(F.lit("# "), by, F.lit("\n\n**Rows:** "), F.coalesce(F.col("n_rows").cast("string"), F.lit("?")), F.lit("\n**Columns:** "), F.col("n_columns").cast("string"))
    purpose = F.concat(F.lit("## Purpose\n\n"), F.coalesce("purpose", F.lit("No description available.")))
    return texts.select(by, F.concat_ws("\n\n", head, purpose, F.concat(F.lit("## Columns\n\n"), "sections")).alias("markdown"))


#: Buckets that both sides' rows are summed up in.
BUCKETS = 4096


def bucketed(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df`'s rows with their bucket and two halves of a hash; nulls count by their place."""
    marked = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    h = F.xxhash64(F.lit(1), *marked)
    return df.select(*[F.col(f"`{c}`") for c in columns], F.pmod(F.xxhash64(F.lit(2), *marked), F.lit(BUCKETS)).alias("_bucket"), F.shiftrightunsigned(h, 32).alias("_high"), h.bitwiseAND(0xFFFFFFFF).alias("_low"))


def differences(table: DataFrame, export: DataFrame) -> DataFrame:
    """Rows that only one side has, with the side; none for a true export, copies counted.

    Each side's rows are added up as hashes by bucket, whatever their order: one aggregate over both, of a row a bucket and task. Rows are
    compared as such only in buckets whose sums differ. Two sums of 32 bits and a count agree by accident once in 2^64 buckets.
    """
    shared = [c for c in table.columns if c in export.columns]
    a, b = bucketed(table, shared), bucketed(export, shared)
    signed = a.select("_bucket", "_high", "_low", F.lit(1).alias("_n")).unionByName(b.select("_bucket", (-F.col("_high")).alias("_high"), (-F.col("_low")).alias("_low"), F.lit(-1).alias("_n")))
    sums = signed.groupBy("_bucket").agg(F.sum("_high").alias("high"), F.sum("_low").alias("low"), F.sum("_n").alias("n"))
    differing = F.broadcast(sums.where("high <> 0 or low <> 0 or n <> 0").select("_bucket"))  # at most BUCKETS rows
    a, b = (x.join(differing, "_bucket", "left_semi").select(*[F.col(f"`{c}`") for c in shared]) for x in (a, b))
    return a.exceptAll(b).withColumn("side", F.lit("table")).unionByName(b.exceptAll(a).withColumn("side", F.lit("export")))


def verification(table: DataFrame, export: DataFrame) -> DataFrame:
    """One row: counts of both sides, columns that one lacks, and rows that one lacks."""
    lacking = sorted(set(table.columns) ^ set(export.columns))
    n = table.agg(F.count("*").alias("table_rows")).crossJoin(export.agg(F.count("*").alias("export_rows")))
    wrong = differences(table, export).agg(F.count("*").alias("different_rows"))
    return n.crossJoin(wrong).withColumn("different_columns", F.lit(",".join(lacking)))


#: What a dictionary must have. Fixed values.
SECTIONS = ("## Columns", "Description:", "Type:", "Search Terms:")


def dictionary_findings(dictionaries: DataFrame, columns: DataFrame) -> DataFrame:
    """(code, level, finding, detail): sections that a dictionary (code, markdown) lacks, columns that it documents and the export hasn't, which
    break queries, and columns of the export (code, column) that it leaves out, system columns aside. A dictionary without findings has no row."""
    texts = dictionaries.select("code", F.col("markdown").alias("value"))
    missing = texts.select("code", F.explode(F.filter(F.array(*[F.when(~F.contains("value", F.lit(x)), x) for x in SECTIONS]), lambda x: x.isNotNull())).alias("detail"))
    told = dictionary_columns(texts, keys=("code",)).select("code", "column").distinct()
    real = columns.select("code", "column").distinct()
    unknown = told.join(real, ["code", "column"], "left_anti").withColumnRenamed("column", "detail")
    known = real.join(texts.select("code").distinct(), "code", "left_semi").where(~F.startswith("column", F.lit("_")))
    untold = known.join(told, ["code", "column"], "left_anti").withColumnRenamed("column", "detail")
    absent = columns.select("code").distinct().join(texts.select("code").distinct(), "code", "left_anti").withColumn("detail", F.lit(""))
    kinds = ((absent, "error", "no dictionary"), (missing, "error", "section missing"), (unknown, "error", "documented column absent"), (untold, "warning", "undocumented column"))
    return reduce(DataFrame.unionByName, [rows.select("code", F.lit(level).alias("level"), F.lit(finding).alias("finding"), "detail") for rows, level, finding in kinds])
