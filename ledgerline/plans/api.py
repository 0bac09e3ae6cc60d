"""The query API: lists, schemas, questions and metrics over registered datasets."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.reshape import where_equal

REFUSED = re.compile(r"\b(drop|delete|insert|update|alter|create|truncate|grant|revoke)\b", re.IGNORECASE)
NUMBERS = ("int", "bigint", "double", "float", "smallint")


def kinds(df: DataFrame) -> dict[str, list[str]]:
    """Columns by kind: numeric, date and text; provenance left out."""
    out: dict[str, list[str]] = {"numeric": [], "date": [], "text": []}
    for name, kind in df.dtypes:
        if not name.startswith("_"):
            out["numeric" if kind in NUMBERS or kind.startswith("decimal") else "date" if kind.startswith(("date", "timestamp")) else "text"].append(name)
    return out


def schema(df: DataFrame) -> DataFrame:
    """(column_name, kind) and at most three suggested queries, as rows."""
    by = kinds(df)
    rows = [(n, k) for k, ns in by.items() for n in ns]
    suggestions = ["SELECT count(*) FROM data", *[f"SELECT sum({n}) FROM data" for n in by["numeric"][:1]], *[f"SELECT {n}, count(*) FROM data GROUP BY {n}" for n in by["text"][:1]]]
    return df.sparkSession.createDataFrame(rows + [(s, "suggestion") for s in suggestions], "column_name string, kind string")


def ask(df: DataFrame, question: str, most: int = 10_000) -> DataFrame:
    """SQL over the view `data`, or the template that a question's words choose; all rows are seen, `most` are returned."""
    if REFUSED.search(question):
        raise ValueError("only questions that read are answered")
    text = question.strip().lower()
    if text.startswith("select ") or "from data" in text:
        return df.sparkSession.sql(re.sub(r"\bdata\b", "{data}", question, count=1, flags=re.IGNORECASE), data=df).limit(most)
    by = kinds(df)
    number = next(iter(by["numeric"]), None)
    group = next((c for c in by["text"] if re.search("age|band|group", c)), next(iter(by["text"]), None))
    if "how many" in text or "count" in text:
        return df.agg(F.count("*").alias("row_count"))
    if number and ("total" in text or "sum" in text):
        return df.agg(F.sum(number).alias(f"total_{number}"))
    if number and ("average" in text or "mean" in text):
        return df.agg(F.avg(number).alias(f"average_{number}"))
    if number and group and (" by " in text or "group" in text):
        return df.groupBy(group).agg(F.sum(number).alias(f"total_{number}")).limit(most)
    if group and ("distinct" in text or "unique" in text):
        return df.select(group).distinct().limit(most)
    return df.orderBy(*df.columns[:1]).limit(min(most, 1000))


def metadata(df: DataFrame, code: str) -> DataFrame:
    """One row: columns, rows and a sample."""
    value = F.col(df.columns[0]).cast("string")
    few = df.select(value.alias("v")).where("v is not null").distinct().orderBy("v").limit(3)  # a top three, no list of all values
    sample = few.agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias("sample"))
    return df.agg(F.count("*").alias("n_rows")).crossJoin(sample).select(F.lit(code).alias("code"), "n_rows", F.lit(",".join(df.columns)).alias("columns"), "sample")


def discover(columns: DataFrame, keywords: list[str], most: int = 50) -> DataFrame:
    """(table, hits) of the tables whose columns hold a keyword, most hits first."""
    hit = F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(F.lower(F.col("column")), k))
    return columns.where(hit).groupBy("table").agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "table").limit(most)


def metric(df: DataFrame, name: str, filters: dict[str, object], most: int = 100) -> DataFrame:
    """A metric with the columns that say when, where and who; unknown filters are skipped, an unknown metric is refused."""
    if name not in df.columns:
        raise ValueError(unknown_metric(df, name))
    rows, _ = where_equal(df, filters)
    context = [c for c in df.columns if c != name and re.search("date|period|age|geography|icb|provider|segment|type", c)]
    return rows.select(*context, name).orderBy(*context, name).limit(most)


def unknown_metric(df: DataFrame, name: str) -> str:
    alike = [c for c in df.columns if name.lower() in c.lower() or c.lower() in name.lower()]
    return f"no metric {name}; {'like it are ' + ', '.join(alike[:5]) if alike else 'there are ' + ', '.join(kinds(df)['numeric'][:20])}"


def metric_context(df: DataFrame, name: str, filters: dict[str, object], kpis: DataFrame, most: int = 100) -> DataFrame:
    """One row on a metric: its label and unit as the measures (column, label, unit) tell them, rows before and after the filters, filters that
    fit no column, whether `most` rows leave some out, and, if no row is left, the latest period that there is."""
    if name not in df.columns:
        raise ValueError(unknown_metric(df, name))
    rows, skipped = where_equal(df, filters)
    dated = next((c for c in df.columns if re.search("period|date", c.lower())), None)
    before = df.agg(F.count("*").alias("total_rows"), (F.max(dated).cast("string") if dated else F.lit("unknown")).alias("_latest"))
    after = rows.agg(F.count("*").alias("rows_found"))
    told = kpis.where(F.col("column") == name).agg(F.min("label").alias("label"), F.min("unit").alias("unit"))
    one = before.crossJoin(after).crossJoin(told)  # one row each
    return one.select(
        F.lit(name).alias("metric"),
        F.coalesce("label", F.lit(name)).alias("label"),
        F.coalesce("unit", F.lit("unknown")).alias("unit"),
        "total_rows",
        "rows_found",
        F.lit(",".join(sorted(skipped))).alias("invalid_filters"),
        (F.col("rows_found") > most).alias("truncated"),
        F.when(F.col("rows_found") == 0, F.coalesce("_latest", F.lit("unknown"))).alias("latest_period"),
    )


def search_columns(columns: DataFrame, keyword: str, role: str | None = None, most: int = 100) -> DataFrame:
    text = F.lower(F.concat_ws(" ", "column", "description", "keywords"))
    rows = columns.where(F.contains(text, F.lit(keyword.lower())))
    return (rows.where(F.col(role)) if role else rows).select("table", "column").orderBy("table", "column").limit(most)


def kpis(rolled: DataFrame, table: str) -> DataFrame:
    """The measures of a table, from its metadata."""
    fields = "array<struct<column:string,unit:string,aggregation:string,metric_type:string>>"
    return rolled.where(F.col("table") == table).select(F.explode(F.from_json("kpis", fields)).alias("k")).select("k.*")


def list_datasets(sources: DataFrame, history: DataFrame, domain: str | None = None, keyword: str | None = None, min_rows: int = 0, most: int = 50) -> DataFrame:
    """Registered datasets that fit, by code, with their rows, loads and range of loads."""
    stats = history.groupBy(F.col("source").alias("code")).agg(F.sum("rows_loaded").alias("total_rows"), F.count("*").alias("loads"), F.min("loaded_at").alias("a"), F.max("loaded_at").alias("b"))
    span = F.concat(F.date_format("a", "yyyy-MM-dd"), F.lit(" to "), F.date_format("b", "yyyy-MM-dd"))
    rows = sources.where(F.col("domain") == domain) if domain else sources
    rows = rows.where(F.contains(F.lower("code"), F.lit(keyword.lower()))) if keyword else rows
    out = rows.select("code", "domain").join(stats, "code", "left").withColumn("total_rows", F.coalesce("total_rows", F.lit(0)))
    return out.where(F.col("total_rows") >= min_rows).select("code", "domain", "total_rows", "loads", span.alias("date_range")).orderBy("code").limit(most)


def dataset(spark: SparkSession, registry: DataFrame, code: str) -> DataFrame:
    """The table of a registered code (code, path); unknown codes are refused."""
    row = registry.where(F.col("code") == code).select("path").first()
    if row is None:
        raise ValueError(f"no dataset {code}")
    return spark.read.parquet(row["path"])
