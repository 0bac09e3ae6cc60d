"""The registry of sources and its metadata: sources and their loads, columns of sources, manifests after editing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import names
from ledgerline.operators.analytics import latest_per_key
from ledgerline.sources.files import dictionary_columns

#: What metadata of an enriched manifest is trusted with.
CONFIDENCE = 0.95


def column_metadata(columns: DataFrame, metadata_source: str = "enrichment") -> DataFrame:
    """Columns of enriched manifests as rows of the metadata store, one for each source and name, the last by position.

    `columns`: source, position, name, code, semantic_name, original_name, description, data_type, is_measure, is_dimension, query_keywords (array) and
    metadata struct<measure, dimension, tags>. The name is the first of name, code and semantic_name that is there; without one the column is left out.
    Where neither flag is set, the older form decides: a measure or dimension that the metadata names, and its tags where there are no keywords.
    """
    name = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("name", "code", "semantic_name")])
    flags = {f: F.coalesce(f, F.lit(False)) for f in ("is_measure", "is_dimension")}
    legacy = ~(flags["is_measure"] | flags["is_dimension"])
    words = F.coalesce("query_keywords", F.array().cast("array<string>"))
    out = columns.withColumn("column_name", name).where("column_name is not null")
    out = latest_per_key(out, ["source", "column_name"], F.desc("position"))
    return out.select(
        "source",
        "column_name",
        F.coalesce("original_name", "column_name").alias("original_name"),
        "description",
        F.coalesce("data_type", F.lit("VARCHAR")).alias("data_type"),
        F.when(legacy, F.col("metadata.measure").isNotNull()).otherwise(flags["is_measure"]).alias("is_measure"),
        F.when(legacy, F.col("metadata.dimension").isNotNull()).otherwise(flags["is_dimension"]).alias("is_dimension"),
        F.when(legacy & (F.size(words) == 0), F.coalesce("metadata.tags", words)).otherwise(words).alias("query_keywords"),
        F.lit(metadata_source).alias("metadata_source"),
        F.lit(CONFIDENCE).alias("confidence"),
    )


def stored_metadata(old: DataFrame, columns: DataFrame, metadata_source: str = "enrichment") -> DataFrame:
    """The metadata store with the sources of `columns` replaced as a whole, also those none of whose columns has a name."""
    new = column_metadata(columns, metadata_source)
    gone = columns.select("source").distinct()
    return old.join(gone, "source", "left_anti").unionByName(new)


def registered(sources: DataFrame, new: DataFrame) -> DataFrame:
    """`sources` with those of `new` whose code isn't taken yet; of equal new codes the first by name."""
    fresh = latest_per_key(new, ["code"], F.asc("name"))
    return sources.unionByName(fresh.join(sources.select("code"), "code", "left_anti"), allowMissingColumns=True)


def listed(sources: DataFrame, history: DataFrame) -> DataFrame:
    """Sources, the newest first, with their last load."""
    last = history.groupBy(F.col("source").alias("code")).agg(F.max("loaded_at").alias("last_load_at"))
    return sources.join(last, "code", "left").orderBy(F.desc_nulls_last("created_at"), "code")


def one_source(sources: DataFrame, code: str) -> DataFrame:
    found = sources.where(F.col("code") == code)
    if found.isEmpty():
        raise ValueError(f"no source {code}")
    return found


def logged(history: DataFrame, loads: DataFrame) -> DataFrame:
    """`history` with new loads appended, stamped where they have no time of their own."""
    return history.unionByName(loads.withColumn("loaded_at", F.coalesce("loaded_at", F.current_timestamp().cast(dict(history.dtypes)["loaded_at"]))), allowMissingColumns=True)


def registry_of(catalog: DataFrame, dictionaries: DataFrame, rules: list[tuple[str, str]], folder: str = "output") -> DataFrame:
    """One row for each dataset of a catalog (code, file_path, row_count, column_count, description): path, domain, tags, purpose and columns.

    The purpose is the dictionary's (code, markdown), else the description. Columns are those of the dictionary, as an array in its order of names;
    they are gathered by dataset, as many as a table has columns.
    """
    told = dictionary_columns(dictionaries.select("code", F.col("markdown").alias("value")), keys=("code",))
    entry = F.struct("column", "description", "data_type", "search_terms", "role")
    parsed = told.groupBy("code").agg(F.max("purpose").alias("told"), F.array_sort(F.collect_list(entry)).alias("columns"))
    path = F.coalesce("file_path", F.concat(F.col("code"), F.lit(".parquet")))
    placed = F.when(F.startswith(path, F.lit(f"{folder}/")), path).otherwise(F.concat(F.lit(f"{folder}/"), path))
    empty = F.array().cast(parsed.schema["columns"].dataType)
    return catalog.join(parsed, "code", "left").select(
        "code",
        placed.alias("path"),
        names.domain(F.col("code"), rules).alias("domain"),
        names.tags(F.col("code")).alias("tags"),
        F.coalesce(F.nullif("told", F.lit("")), "description", F.concat(F.lit("Source: "), F.col("code"))).alias("purpose"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("column_count", F.lit(0)).alias("column_count"),
        F.coalesce("columns", empty).alias("columns"),
    )


def filtered_catalog(registry: DataFrame, domain: str | None = None, keyword: str | None = None, min_rows: int = 0, tags: tuple[str, ...] = (), most: int = 50) -> DataFrame:
    """Datasets (code, description, domain, tags, row_count) of a domain, with a keyword in code or description, with all of the tags; by code."""
    rows = registry.where(F.coalesce("row_count", F.lit(0)) >= min_rows)
    if domain:
        rows = rows.where(F.lower("domain") == domain.lower())
    if keyword:
        rows = rows.where(F.contains(F.lower("code"), F.lit(keyword.lower())) | F.coalesce(F.contains(F.lower("description"), F.lit(keyword.lower())), F.lit(False)))
    for tag in tags:
        rows = rows.where(F.array_contains("tags", tag))
    return rows.orderBy("code").limit(most)


#: Fields of a file that an editor must not lose. Fixed values.
TECHNICAL = ("sheet", "extract", "period", "mode", "attributes")


def restored(original: DataFrame, edited: DataFrame, fields: tuple[str, ...] = TECHNICAL) -> DataFrame:
    """Files of an edited manifest (url, …) with the technical fields that they lost, as the original's last file of that URL had them; `restored` counts them."""
    own = [f for f in fields if f in original.columns]
    kept = latest_per_key(original, ["url"], F.desc("position")).select("url", *[F.col(f).alias(f"_{f}") for f in own])
    both = edited.join(kept, "url", "left")

    def lost(f: str) -> Column:
        return (F.col(f).isNull() if f in edited.columns else F.lit(True)) & F.col(f"_{f}").isNotNull()

    count = sum((lost(f).cast("int") for f in own), F.lit(0))
    values = {f: F.coalesce(F.col(f), F.col(f"_{f}")) if f in edited.columns else F.col(f"_{f}") for f in own}
    return both.withColumn("restored", count).withColumns(values).drop(*[f"_{f}" for f in own])


def url_findings(original: DataFrame, edited: DataFrame) -> DataFrame:
    """(url, finding) of URLs that an edited manifest lost (missing) or made up (extra)."""
    a, b = original.select("url").distinct(), edited.select("url").distinct()
    return a.join(b, "url", "left_anti").withColumn("finding", F.lit("missing")).unionByName(b.join(a, "url", "left_anti").withColumn("finding", F.lit("extra")))


def require_same_urls(original: DataFrame, edited: DataFrame) -> None:
    """An error that names up to five URLs if the two manifests' differ."""
    wrong = url_findings(original, edited).orderBy(F.desc("finding"), "url").limit(5).collect()
    if wrong:
        raise ValueError("URLs differ: " + ", ".join(f"{r['finding']} {r['url']}" for r in wrong))


def edited_sources(sources: DataFrame, edits: DataFrame) -> DataFrame:
    """Sources (code, name, table, description) with the edits (code, new_code, name, description) of their code, and the code they had."""
    e = latest_per_key(edits, ["code"], F.desc("position")).select(F.col("code").alias("_code"), "new_code", F.col("name").alias("_name"), F.col("description").alias("_description"))
    hit = F.col("_code").isNotNull()
    code = F.when(hit, F.coalesce("new_code", "code")).otherwise(F.col("code"))
    out = sources.join(e, F.col("code") == F.col("_code"), "left").withColumn("original_code", F.when(hit, F.col("code")))
    return out.withColumns({"code": code, "table": F.when(hit, F.concat(F.lit("tbl_"), code)).otherwise(F.col("table")), "name": F.when(hit, F.coalesce("_name", "name")).otherwise(F.col("name")), "description": F.when(hit, F.coalesce("_description", F.lit(""))).otherwise(F.col("description"))}).drop("_code", "new_code", "_name", "_description")


def edit_report(sources: DataFrame, edits: DataFrame) -> DataFrame:
    """(code, outcome, new_code) of every source and edit: changed or kept by an edit, source without edit, edit without source."""
    e = latest_per_key(edits, ["code"], F.desc("position")).select(F.col("code").alias("_code"), F.coalesce("new_code", "code").alias("new_code"))
    both = sources.select("code").distinct().join(e, F.col("code") == F.col("_code"), "full")
    outcome = F.when(F.col("code").isNull(), "edit without source").when(F.col("_code").isNull(), "source without edit").when(F.col("new_code") != F.col("code"), "changed").otherwise("kept")
    return both.select(F.coalesce("code", "_code").alias("code"), outcome.alias("outcome"), "new_code")
