"""Checks of configurations, manifests and loaded tables by fixed rules: one row for each rule that is broken."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.names import deduplicated_words
from ledgerline.functions.periods import is_period

AUDIT = ("_load_id", "_loaded_at", "_period", "_manifest_file_id")
# Parts of codes that say nothing of their source, and what a source must have.
GENERIC = ("table_", "summary_", "breakdown_", "sheet_")
REQUIRED = ("code", "name", "table", "enabled", "files")
#: Rows from which on a table is called very large.
VERY_LARGE = 10_000_000


def broken(df: DataFrame, keep: list[str], rules: list[tuple[str, Column | str, Column]]) -> DataFrame:
    """keep…, level and message of every (level, message, condition) that holds; conditions that are null don't."""
    found = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(level).alias("level"), (F.lit(text) if isinstance(text, str) else text).alias("message"))) for level, text, when in rules]))
    return df.select(*keep, F.explode(found).alias("f")).select(*keep, "f.*")


def _blank(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def config_findings(publications: DataFrame) -> DataFrame:
    """(publication, level, message) of publications: code, name, urls array<struct<period,url>>, url_template, discovery_mode, landing_page, periods array."""
    p = publications.withColumnRenamed("code", "publication")
    own = broken(p, ["publication"], [("warning", "Missing 'name' field", _blank("name"))])
    entries = p.where("urls is not null").select("publication", F.posexplode("urls").alias("i", "e")).select("publication", (F.col("i") + 1).alias("i"), "e.period", "e.url")
    named, period = ~_blank("period"), F.col("period")
    said = F.concat(F.lit("Period "), period)
    rules = [
        ("error", F.concat(F.lit("Entry "), F.col("i").cast("string"), F.lit(" missing 'period' field")), ~named),
        ("error", F.concat(said, F.lit(" has no URL (None)")), named & F.col("url").isNull()),
        ("error", F.concat(said, F.lit(" has empty URL")), named & (F.col("url") == "")),
        ("error", F.concat(said, F.lit(" has invalid URL: "), F.substring("url", 1, 50)), named & (F.col("url") != "") & ~F.col("url").rlike("^https?://")),
        ("warning", F.concat(F.lit("Period '"), period, F.lit("' has unusual format")), named & ~is_period(period)),
    ]
    listed = broken(entries, ["publication"], rules)
    by_template = p.where(F.col("urls").isNull() & (~_blank("url_template") | (F.col("discovery_mode") == "template")))
    templated = broken(by_template, ["publication"], [("error", "Template mode requires 'landing_page'", _blank("landing_page")), ("warning", "No periods defined", F.coalesce(F.size("periods"), F.lit(0)) <= 0)])
    none = publications.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("publication"), F.lit("error").alias("level"), F.lit("No publications defined in config").alias("message"))
    return reduce(DataFrame.unionByName, [own, listed, templated, none])


def manifest_findings(sources: DataFrame, manifest: str = "manifest", strict: bool = False, enriched: bool = False) -> DataFrame:
    """(manifest, source, level, message) of manifests' sources: `manifest`, position, code, name, table, enabled, files array<struct<url>>, columns array.

    A field that is null is missing. `strict` adds generic codes, `enriched` enabled sources without columns, a row for each manifest.
    """
    source = F.coalesce("code", F.concat(F.lit("source_"), F.col("position").cast("string")))
    s = sources.withColumn("source", source)
    keep = [manifest, "source"]
    rules = [("error", f"Missing required field '{field}'", F.col(field).isNull()) for field in REQUIRED]
    rules.append(("error", "'files' must be non-empty array", F.size("files") == 0))
    if strict:
        code = F.lower("code")
        rules.append(("warning", "Generic code pattern", reduce(Column.__or__, [F.contains(code, F.lit(g)) for g in GENERIC])))
    own = broken(s, keep, rules)
    files = s.select(*keep, F.posexplode("files").alias("i", "f"))
    unlinked = broken(files, keep, [("error", F.concat(F.lit("file "), F.col("i").cast("string"), F.lit(": Missing 'url'")), F.col("f.url").isNull())])
    repeated = s.where("code is not null").groupBy(manifest, "code").agg(F.count("*").alias("n")).where("n > 1")
    twice = repeated.select(manifest, F.col("code").alias("source"), F.lit("error").alias("level"), F.concat(F.lit("Duplicate source code: "), F.col("n").cast("string"), F.lit(" sources")).alias("message"))
    parts = [own, unlinked, twice]
    if enriched:
        bare = s.where(F.coalesce("enabled", F.lit(True)) & F.col("columns").isNull()).groupBy(manifest).agg(F.count("*").alias("n"))
        parts.append(bare.select(manifest, F.lit(None).cast("string").alias("source"), F.lit("warning").alias("level"), F.concat(F.col("n").cast("string"), F.lit(" enabled sources missing 'columns' metadata")).alias("message")))
    return reduce(DataFrame.unionByName, parts)


def table_checks(df: DataFrame | None, table: str, session_of: DataFrame, tracked: int | None = None, strict: bool = False) -> DataFrame:
    """(table, level, message) of a loaded table, from one aggregate over it; `tracked` is how many of its columns have metadata.

    Rules: it exists, has rows, has columns, has its audit columns; none of its own columns is all null (strict: none mostly null); metadata covers
    them; strict: more than one period; not very large. A missing (None), empty or bare table has no further findings. `session_of` gives the session.
    """
    spark = session_of.sparkSession
    schema = "table string, level string, message string"
    if df is None:
        return spark.createDataFrame([(table, "error", "Table does not exist")], schema)
    if not df.columns:
        return spark.createDataFrame([(table, "error", "Table has no columns")], schema)
    own = [c for c in df.columns if not c.startswith("_")]
    period = [F.min("_period").alias("_p0"), F.max("_period").alias("_p1")] if "_period" in df.columns else []
    one = df.agg(F.count("*").alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"n_{k}") for k, c in enumerate(own)], *period).withColumn("table", F.lit(table))
    n = F.col("_n")
    filled = n > 0
    rules: list[tuple[str, Column | str, Column]] = [("error", "Table is empty (0 rows)", ~filled)]
    if missing := [c for c in AUDIT if c not in df.columns]:
        rules.append(("warning", f"Missing audit columns: {', '.join(missing)}", filled))
    for k, c in enumerate(own):
        nulls = n - F.col(f"n_{k}")
        rules.append(("warning", F.concat(F.lit(f"Column '{c}' is 100% NULL ("), n.cast("string"), F.lit(" rows)")), filled & (nulls == n)))
        if strict:
            share = nulls * 100 / n
            rules.append(("warning", F.concat(F.lit(f"Column '{c}' has high NULL rate: "), F.format_string("%.1f", share.cast("double")), F.lit("%")), filled & (nulls < n) & (nulls * 2 > n)))
    if tracked is not None:
        told = "No column metadata found" if tracked == 0 else f"Partial metadata coverage: {tracked}/{len(own)} columns"
        rules.append(("warning", told, filled & F.lit(tracked < len(own))))
    if strict and period:
        rules.append(("warning", F.concat(F.lit("Only 1 period loaded: "), F.col("_p0").cast("string")), filled & (F.col("_p0") == F.col("_p1"))))
    rules.append(("warning", F.concat(F.lit("Very large table: "), n.cast("string"), F.lit(" rows")), n > VERY_LARGE))
    return broken(one, ["table"], rules)


# Types that a column may have.
TYPES = ("varchar", "integer", "numeric", "double precision", "date")


def fixed_columns(columns: DataFrame) -> DataFrame:
    """Columns as a model gave them (original_name, semantic_name, data_type, is_dimension and is_measure as text), put right: words of the name once,
    flags as booleans, a known type or varchar, and a name of letters, digits and underscores that begins with no digit, of 63 characters."""
    flags = {f: F.coalesce(F.lower(f).isin("true", "yes", "1"), F.lit(False)) for f in ("is_dimension", "is_measure")}
    kind = F.lower(F.trim(F.col("data_type")))
    name = F.substring(F.regexp_replace(F.regexp_replace(F.lower("semantic_name"), "[^a-z0-9_]", "_"), "^[0-9]+", ""), 1, 63)
    return columns.withColumns({"original_name": deduplicated_words(F.col("original_name")), "data_type": F.when(kind.isin(*TYPES), kind).otherwise("varchar"), "pg_name": name, **flags}).drop("semantic_name")
