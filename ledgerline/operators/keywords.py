"""An index of what columns are called and said to be: words of names, descriptions and tags, and where they stand.

It is built once and stored. A question looks up the few distinct words that hold its keyword, and only their postings are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: What parts words from one another.
BETWEEN = "[^\\p{L}\\p{N}]+"
#: Tables up to which an answer gives them all, and how many it names where there are more.
FEW, SAMPLE = 20, 10


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def postings(columns: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """(term, table, column, field) of columns (table, column, description, keywords array) and of tables' tags (table, tags array).

    A tag is one term as it is; its column is null.
    """
    fields = {"name": words(F.col("column")), "description": words(F.col("description")), "keyword": F.flatten(F.transform(F.coalesce("keywords", F.array().cast("array<string>")), lambda k: words(k)))}
    each = [columns.select(F.explode(F.array_distinct(terms)).alias("term"), "table", "column", F.lit(name).alias("field")) for name, terms in fields.items()]
    out = each[0].unionByName(each[1]).unionByName(each[2]).distinct()
    if tags is not None:
        own = tags.select(F.explode(F.array_distinct(F.transform("tags", F.lower))).alias("term"), "table", F.lit(None).cast("string").alias("column"), F.lit("tag").alias("field"))
        out = out.unionByName(own)
    return out


def hits(index: DataFrame, keywords: list[str], fields: tuple[str, ...] = ("name", "description", "keyword", "tag")) -> DataFrame:
    """(table, column, keyword) of the postings whose word holds a keyword; of a keyword of several words all must be met."""
    asked = [(k.lower(), w) for k in keywords for w in _parts(k)]
    spark = index.sparkSession
    parts = spark.createDataFrame(asked, "keyword string, part string")
    own = index.where(F.col("field").isin(*fields))
    terms = own.select("term").distinct()
    met = terms.join(F.broadcast(parts), F.contains("term", F.col("part")))  # a few words by the words that there are
    found = own.join(met, "term").select("table", "column", "keyword", "part").distinct()
    needed = parts.groupBy("keyword").agg(F.count_distinct("part").alias("_needed"))
    whole = found.groupBy("table", "column", "keyword").agg(F.count("*").alias("_n")).join(F.broadcast(needed), "keyword").where("_n = _needed")
    return whole.select("table", "column", "keyword")


def _parts(keyword: str) -> list[str]:
    return sorted({w for w in re.split(r"[\W_]+", keyword.lower()) if w})


def discovered(index: DataFrame, keywords: list[str], details: DataFrame, most: int = 50) -> DataFrame:
    """The answer to a search for datasets: their details (table, …) if they are few, else a request to narrow with ten samples.

    answer ('datasets' or 'narrow'), found (tables in all, at most `most`), rank, table, hits, and the details where they are given.
    """
    per_table = hits(index, keywords).groupBy("table").agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "table").limit(most)
    ranked = per_table.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("hits"), "table"))).withColumn("found", F.count("*").over(Window.partitionBy()))  # at most `most` rows
    narrow = F.col("found") > FEW
    shown = ranked.where(~narrow | (F.col("rank") <= SAMPLE)).withColumn("answer", F.when(narrow, "narrow").otherwise("datasets"))
    told = shown.join(details, "table", "left")
    extra = [F.when(F.col("answer") == "datasets", F.col(c)).alias(c) for c in details.columns if c != "table"]
    return told.select("answer", F.col("found").cast("int").alias("found"), "rank", "table", "hits", *extra)


def searched(index: DataFrame, keyword: str, columns: DataFrame, role: str | None = None, most: int = 50) -> DataFrame:
    """(table, column, description, data_type, role) of columns whose name, description or keywords hold `keyword`, by table and name."""
    found = hits(index, [keyword], ("name", "description", "keyword")).select("table", "column")
    rows = columns.where(F.col("role") == role) if role else columns
    return rows.join(found, ["table", "column"], "left_semi").select("table", "column", "description", "data_type", "role").orderBy("table", "column").limit(most)


def domains(registry: DataFrame) -> DataFrame:
    """The domains of registered datasets, with how many there are of each; without one it is other."""
    return registry.groupBy(F.coalesce("domain", F.lit("other")).alias("domain")).agg(F.count("*").alias("datasets"))


def all_tags(registry: DataFrame) -> DataFrame:
    """The tags (array) of registered datasets, with how many have each."""
    return registry.select(F.explode(F.array_distinct("tags")).alias("tag")).groupBy("tag").agg(F.count("*").alias("datasets"))
