"""Matching columns, sources, URLs and periods from one period to the next."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions import names, periods
from ledgerline.operators.analytics import latest_per_key
from ledgerline.sources.tables import kept


def fingerprints(columns: DataFrame, by: str, column: str) -> DataFrame:
    """Structure of each table: its distinct lower-case names, sorted and joined, as md5; short and with the count in front."""
    kept = F.array_sort(F.collect_set(F.lower(column)))
    out = columns.groupBy(by).agg(kept.alias("names"))
    joined = F.array_join("names", "|")
    return out.select(by, F.size("names").alias("n_columns"), F.md5(joined).alias("fingerprint"), F.substring(F.md5(F.concat(F.size("names").cast("string"), F.lit("|"), joined)), 1, 12).alias("sheet_fingerprint"))


def header_fingerprints(headers: DataFrame, by: str, header: str, position: str) -> DataFrame:
    """The two shorter marks of a sheet's headers, blank ones left out: short_fingerprint, 8 characters, whatever their order, with repeats, and
    ordered_fingerprint, 16 characters, by their order."""
    named = headers.withColumn("_name", names.schema_name(F.col(header))).where(F.coalesce(F.col(header), F.lit("")) != "").where("_name <> ''")
    kept = named.groupBy(by).agg(F.array_sort(F.collect_list("_name")).alias("sorted"), F.array_sort(F.collect_list(F.struct(position, "_name"))).alias("ordered"))
    in_order = F.transform("ordered", lambda x: x["_name"])
    return kept.select(by, F.substring(F.md5(F.array_join("sorted", "|")), 1, 8).alias("short_fingerprint"), F.substring(F.sha2(F.array_join(in_order, "|"), 256), 1, 16).alias("ordered_fingerprint"))


def overlaps(draft: DataFrame, reference: DataFrame, least: float) -> DataFrame:
    """(draft, reference, shared, n_draft, n_reference) of tables that share columns; both have table and column.

    Whole are the rows of references that have a part `least` of the draft's columns. Such a reference has one of the draft's rarest
    columns, more than a part of 1 - `least` of them: through those tables meet, so that a name that all tables have
    forms no pairs unless a draft has hardly any other.
    """
    d, r = (t.select("table", F.lower("column").alias("column")).distinct() for t in (draft, reference))
    sizes = [t.groupBy("table").agg(F.count("*").alias("n")) for t in (d, r)]
    held = r.groupBy("column").agg(F.count("*").alias("held"))
    order = Window.partitionBy("table").orderBy("held", "column")  # one table's columns
    ranked = d.join(held, "column", "left").na.fill(0, ["held"]).withColumn("k", F.row_number().over(order)).join(sizes[0], "table")
    # a part of a thousandth is taken off, against rounding
    rare = ranked.where(F.col("k") <= F.col("n") - F.ceil(F.col("n") * (least - 0.001)) + 1).select(F.col("table").alias("draft"), "column")
    r = r.withColumnRenamed("table", "reference")
    pairs = rare.join(r, "column").select("draft", "reference").distinct()
    shared = pairs.join(d.withColumnRenamed("table", "draft"), "draft").join(r, ["reference", "column"]).groupBy("draft", "reference").agg(F.count("*").alias("shared"))
    return shared.join(sizes[0].toDF("draft", "n_draft"), "draft").join(sizes[1].toDF("reference", "n_reference"), "reference")


def best_overlap(draft: DataFrame, reference: DataFrame, least: float = 0.7) -> DataFrame:
    """For each draft table the reference with the greatest part of its columns, if that is enough; the first by name of equals."""
    scored = overlaps(draft, reference, least).withColumn("score", F.col("shared") / F.col("n_draft"))
    return latest_per_key(scored.where(F.col("score") >= least), ["draft"], F.desc("score"), F.col("reference")).select("draft", "reference", "score")


def best_jaccard(draft: DataFrame, reference: DataFrame, least: float = 0.8) -> DataFrame:
    scored = overlaps(draft, reference, least).withColumn("score", F.col("shared") / (F.col("n_draft") + F.col("n_reference") - F.col("shared")))
    return latest_per_key(scored.where(F.col("score") >= least), ["draft"], F.desc("score"), F.col("reference")).select("draft", "reference", "score")


def forgiving(columns: DataFrame, metadata: DataFrame) -> DataFrame:
    """Each column with the metadata whose name fits best: exact, without _val, plus a suffix, without affixes on both sides."""
    c = F.lower("column")
    bare = r"^(col_|n_)|(_val|_total|_count|_pct)$"
    tries = F.array(*[F.struct(F.lit(k).alias("priority"), x.alias("key")) for k, x in enumerate([c, F.regexp_replace(c, "_val$", ""), F.concat(c, F.lit("_val")), F.concat(F.lit("~"), F.regexp_replace(c, bare, ""))])])
    n = F.lower("name")
    keys = F.array(n, F.concat(F.lit("~"), F.regexp_replace(n, bare, "")))
    known = metadata.select("name", "description", F.explode(F.array_distinct(keys)).alias("key"))
    asked = columns.select("column", F.explode(tries).alias("t")).select("column", "t.*")
    hit = latest_per_key(asked.join(known, "key"), ["column"], F.col("priority"), F.col("name"))
    return columns.select("column").distinct().join(hit.select("column", "name", "description", "priority"), "column", "left")


def matched_columns(draft: DataFrame, reference: DataFrame, by: str = "source", least: float = 0.8) -> DataFrame:
    """(source, column, reference, score): equal names first, then the most similar unused reference, in draft order.

    Equal names meet by a join, similar ones through letters that they share.
    """
    d = draft.select(by, "position", "column", names.matching_name(F.col("column")).alias("key"))
    r = reference.select(by, F.col("column").alias("reference"), names.matching_name(F.col("column")).alias("key"))
    once = latest_per_key(r, [by, "key"], F.col("reference"))
    exact = latest_per_key(d.join(once, [by, "key"]), [by, "key"], F.col("position")).select(by, "position", "column", "reference", F.lit(1.0).alias("score"))
    left = d.join(exact.select(by, "position"), [by, "position"], "left_anti").select(by, "position", "column", "key")
    free = r.join(exact.select(by, "reference"), [by, "reference"], "left_anti").select(by, "reference", F.col("key").alias("other"))
    return exact.withColumn("position", F.col("position").cast("long")).unionByName(assigned(similar_names(left, free, by, least), by))


def assigned(pairs: DataFrame, by: str) -> DataFrame:
    """Of pairs (by, position, column, reference, score) those that are taken if each column in its turn takes its best unused reference.

    By deferred acceptance, in rounds over all sources at once: every column proposes to the best reference it has left, and a reference keeps
    the first column that proposed. No later one can have it any more, so that those pairs go. As all references prefer columns in the same order,
    what remains when no pair goes is what the columns would take one after the other. Rounds are at most the columns of one source that vie.
    """
    own = [by, "position", "column"]
    left = kept(pairs)
    while True:
        proposed = latest_per_key(left, own, F.desc("score"), F.col("reference"))
        holds = latest_per_key(proposed, [by, "reference"], F.col("position"), F.col("column"))
        holder = holds.select(by, "reference", F.struct("position", "column").alias("_holder"))
        judged = kept(left.join(holder, [by, "reference"], "left").withColumn("_gone", F.coalesce(F.struct("position", "column") > F.col("_holder"), F.lit(False))))
        if judged.where("_gone").isEmpty():
            return holds
        left = judged.where("not _gone").drop("_holder", "_gone")


def similar_names(left: DataFrame, free: DataFrame, by: str, least: float) -> DataFrame:
    """Pairs of `left` (key) and `free` (other) of one source whose names are at least `least` similar, with the score.

    Names meet if they share two letters in a row, or one where they are short, and their lengths allow the score: similar ones do. Two names
    are compared once, however many sources have both.
    """

    def parts(key: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(key) - 1, F.lit(1))), lambda i: F.substring(key, i, 2))
        return F.array_distinct(F.when(F.length(key) <= 4, F.concat(pairs, F.split(key, ""))).otherwise(pairs))

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        matchers = (SequenceMatcher(None, x, y) for x, y in zip(a, b, strict=True))
        return pd.Series([m.ratio() if m.quick_ratio() >= least else 0.0 for m in matchers], dtype="float64")

    # few bytes and much work: as many tasks as a shuffle has, however small
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine, theirs = (t.select(by, c).distinct().withColumn("part", F.explode(parts(F.col(c)))).repartition(tasks, by, "part") for t, c in ((left, "key"), (free, "other")))
    met = kept(mine.join(theirs, [by, "part"]).where(2 * F.least(F.length("key"), F.length("other")) >= least * (F.length("key") + F.length("other"))).drop("part").distinct())
    asked = met.select("key", "other").distinct().repartition(tasks, "key", "other")
    similar = met.join(asked.withColumn("score", ratio("key", "other")).where(F.col("score") >= least), ["key", "other"])
    return left.join(similar, [by, "key"]).join(free, [by, "other"]).select(by, F.col("position").cast("long").alias("position"), "column", "reference", "score")


def matched_sources(draft: DataFrame, reference: DataFrame) -> DataFrame:
    """Each draft file (url, sheet, member) with the reference source found by the first of: file, pattern and sheet, pattern and member, pattern."""

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"file": F.regexp_extract("url", "([^/]*)$", 1), "pattern": names.stable_url(F.col("url"))})

    # computed once: every way reads both, and a join would test each name for null wherever it was made
    d, r = kept(keyed(draft)), kept(keyed(reference).select("code", "file", "pattern", "sheet", "member"))
    ways = [["file"], ["pattern", "sheet"], ["pattern", "member"], ["pattern"]]
    tries = [d.select("url", *way).distinct().join(r.groupBy(*way).agg(F.min("code").alias("code")), way).select("url", "code", F.lit(k).alias("priority")) for k, way in enumerate(ways)]
    hits = tries[0]
    for t in tries[1:]:
        hits = hits.unionByName(t)
    return latest_per_key(hits, ["url"], F.col("priority"), F.col("code"))


def reference_before(work: DataFrame, references: DataFrame, key: str, period: str) -> DataFrame:
    """Each row's latest reference period strictly before its own; none for April, which opens the year.

    One window over both sides in order of periods: neither side is multiplied.
    """
    both = work.select(key, period, F.lit(1).alias("asks")).distinct().unionByName(references.select(key, period, F.lit(0).alias("asks")).distinct())
    known = F.when(F.col("asks") == 0, F.col(period))
    before = Window.partitionBy(key).orderBy(F.col(period)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # of equal periods the asking row must not see itself: it takes the latest among strictly earlier ones
    ranked = both.groupBy(key, period).agg(F.max("asks").alias("asks"), F.max(known).alias("known"))
    found = ranked.withColumn("reference", F.last("known", ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, -1)))
    return found.where("asks = 1").select(key, period, F.when(~periods.opens_fiscal_year(F.col(period)), F.col("reference")).alias("reference"))


def urls_by_period(urls: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each ISO month of `wanted` (code) the URL that names it: final before provisional, then the shortest, then the first.

    A spelling is searched where URLs can hold one: each URL's month-like parts are extracted and joined by equality.
    """
    months = "|".join(names.MONTHS_LONG + names.MONTHS_SHORT)
    pattern = rf"(?i)((?:{months})[-_ ]?(?:\d{{4}}|\d{{2}})|\d{{4}}[-_]?\d{{2}}|\d{{2}}-\d{{4}})"
    parts = urls.select("url", F.explode(F.regexp_extract_all("url", F.lit(pattern), 1)).alias("part")).select("url", F.lower("part").alias("part"))
    spellings = wanted.select("code", F.explode(F.transform(periods.month_spellings(F.col("code")), F.lower)).alias("part")).distinct()
    hits = parts.join(spellings, "part").select("code", "url").distinct()
    return latest_per_key(hits, ["code"], F.contains(F.lower("url"), F.lit("prov")), F.length("url"), F.col("url"))


def coverage(actual: DataFrame, tracked: DataFrame, by: str) -> DataFrame:
    """For each table how many of its columns have metadata, and which are missing or orphaned."""
    a, t = actual.select(by, F.lower("column").alias("column")).distinct(), tracked.select(by, F.lower("column").alias("column")).distinct()
    both = a.withColumn("real", F.lit(True)).join(t.withColumn("told", F.lit(True)), [by, "column"], "full")
    return both.groupBy(by).agg(
        F.count(F.when(F.col("real") & F.col("told"), 1)).alias("covered"),
        F.count("real").alias("actual"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("told").isNull(), F.col("column")))), ",").alias("missing"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("real").isNull(), F.col("column")))), ",").alias("orphaned"),
    ).withColumn("coverage_pct", F.round(F.try_divide(F.col("covered") * 100, F.col("actual")), 2))


def compared_manifests(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row on two manifests (code, files): common, removed and added codes, consistency and verdict."""
    both = a.select("code", F.col("files").alias("fa")).join(b.select("code", F.col("files").alias("fb")), "code", "full")
    n = both.agg(F.count(F.when(F.col("fa").isNotNull() & F.col("fb").isNotNull(), 1)).alias("common"), F.count(F.when(F.col("fb").isNull(), 1)).alias("removed"), F.count(F.when(F.col("fa").isNull(), 1)).alias("added"), F.count(F.when(F.col("fa") != F.col("fb"), 1)).alias("files_changed"))
    consistency = F.round(F.try_divide(F.col("common") * 100, F.col("common") + F.col("removed")), 2)
    verdict = F.when((F.col("removed") == 0) & (F.col("added") == 0), "STABLE").when(F.col("removed") == 0, "GROWTH").when(F.col("added") == 0, "REDUCTION").otherwise("RESTRUCTURE")
    return n.withColumns({"consistency_pct": consistency, "verdict": verdict}).withColumn("band", F.when(F.col("consistency_pct") > 95, "high").when(F.col("consistency_pct") > 80, "medium").otherwise("low"))
