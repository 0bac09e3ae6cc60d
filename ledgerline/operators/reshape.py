"""Wide and long tables, column samples and groups, filters that tolerate unknown columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.names import is_date_header
from ledgerline.functions.periods import header_date

WIDE = 3


def require(df: DataFrame, columns: list[str]) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no such columns: {', '.join(missing)}")


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a in df.columns})


def date_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """The columns whose names are dates, and the others; names are few and are classified in one small job."""
    rows = literal_rows(df.sparkSession, df.columns).select("h", is_date_header(F.col("h")).alias("d")).collect()
    dates = {r["h"] for r in rows if r["d"]}
    return [c for c in df.columns if c in dates], [c for c in df.columns if c not in dates]


def unpivoted(df: DataFrame, static: list[str], dates: list[str], value: str = "value", period: str = "period") -> DataFrame:
    """One row for each row and date column: the static columns, the header's day, the header, the value. Nulls stay."""
    require(df, [*static, *dates])
    days = header_days(df.sparkSession, dates)
    # the day travels in the column's name, so that no row works it out again
    tagged = df.withColumnsRenamed({c: f"{days[c] or ''}|{c}" for c in dates})
    long = tagged.unpivot([F.col(f"`{c}`") for c in static], [F.col(f"`{days[c] or ''}|{c}`") for c in dates], "_tagged", value)
    bar = F.instr("_tagged", F.lit("|"))
    day, raw = F.nullif(F.substring_index("_tagged", "|", 1), F.lit("")), F.substring(F.col("_tagged"), bar + 1, F.length("_tagged"))
    return long.select(*static, day.alias(period), raw.alias("_raw_period"), value)


def header_days(spark: SparkSession, headers: list[str]) -> dict[str, str | None]:
    """The day that each header stands for; headers are few and are read in one small job."""
    rows = literal_rows(spark, headers).select("h", header_date(F.col("h")).alias("d")).collect()
    return {r["h"]: r["d"] for r in rows}


def literal_rows(spark: SparkSession, texts: list[str]) -> DataFrame:
    """A row (h) for each text, without a Python worker."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(t) for t in texts]).cast("array<string>")).alias("h"))


def unpivoted_if_wide(df: DataFrame, value: str = "value", period: str = "period") -> tuple[DataFrame, bool]:
    """The long form where at least three columns are dates, else the table itself."""
    dates, static = date_columns(df)
    return (unpivoted(df, static, dates, value, period), True) if len(dates) >= WIDE else (df, False)


def melted(df: DataFrame, keys: list[str], bands: list[str], band: str = "band", value: str = "value") -> DataFrame:
    require(df, [*keys, *bands])
    return df.unpivot(keys, bands, band, value)


def pivoted(df: DataFrame, keys: list[str], measure: str, measures: list[str], value: str) -> DataFrame:
    """A column for each of the measures, with the greatest value."""
    return df.groupBy(*keys).pivot(measure, measures).agg(F.max(value))


def harmonised(tables: dict[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """(measure, unit, dimension, value, source) of several tables: {source: (table, dimension, value, unit)}."""
    parts = [df.select(F.lit(v).alias("measure"), F.lit(unit).alias("unit"), F.col(dim).cast("string").alias("dimension"), F.col(v).cast("double").alias("value"), F.lit(source).alias("source")) for source, (df, dim, v, unit) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def where_equal(df: DataFrame, filters: dict[str, object]) -> tuple[DataFrame, list[str]]:
    """Rows that equal the filters on known columns, and the names of the unknown ones."""
    known = {c: v for c, v in filters.items() if c in df.columns}
    return reduce(lambda x, item: x.where(F.col(item[0]) == item[1]), known.items(), df), sorted(set(filters) - set(known))


#: Groups of columns that a preview shows whole, without and with a look for a sequence; a larger preview's size.
WHOLE, WHOLE_UNPATTERNED, PREVIEW = 50, 75, 30


def sampled_columns(columns: DataFrame, by: list[str], name: str, position: str) -> DataFrame:
    """A preview of each group's columns, with their `kind` and the group's `strategy`.

    full: all, of up to 50 columns, or up to 75 without a sequence. sequence: of the sequence that begins first, its first,
    middle and last column, and all others. strata: ids, then the first, middle and last of each other kind, 30 at most.
    """
    low = F.lower(name)
    kinds = {
        "ids": low.rlike("_id|_code") & ~low.rlike("diagnosis"),
        "dates": low.rlike("_date|_time"),
        "names": low.rlike("_name|_description"),
        "measures": low.rlike("_count|_total|_percentage|_score|_number"),
        "codes": low.rlike("diagnosis_|procedure_|medication_"),
    }
    kind, rank = F.lit("other"), F.lit(len(kinds))
    for number, (label, fits) in reversed(list(enumerate(kinds.items()))):
        kind, rank = F.when(fits, label).otherwise(kind), F.when(fits, number).otherwise(rank)
    sequences = sequential_groups(columns, by, name).select(*by, "prefix", F.lit(True).alias("_found"))
    group = Window.partitionBy(*by)  # the columns of one table
    rows = columns.withColumns({"kind": kind, "_rank": rank, "prefix": numbered_prefix(name)}).join(sequences, [*by, "prefix"], "left")
    first = F.min(F.when(F.col("_found"), F.struct(F.col(position).alias("at"), "prefix"))).over(group)["prefix"]
    rows = rows.withColumns({"_first": first, "_all": F.count("*").over(group)})
    rows = rows.withColumns({
        "_part": F.when(F.col("_first").isNull(), F.col("kind")).otherwise((F.col("prefix") == F.col("_first")).cast("string")),
        "strategy": F.when((F.col("_all") <= WHOLE) | ((F.col("_all") <= WHOLE_UNPATTERNED) & F.col("_first").isNull()), "full").when(F.col("_first").isNotNull(), "sequence").otherwise("strata"),
    })
    part = Window.partitionBy(*by, "_part")
    rows = rows.withColumns({"_n": F.count("*").over(part), "_k": F.row_number().over(part.orderBy(position))})
    spread = (F.col("_n") <= 2) | F.col("_k").isin(1, F.col("_n")) | (F.col("_k") == F.floor(F.col("_n") / 2) + 1)
    whole = (F.col("strategy") == "full") | ((F.col("strategy") == "sequence") & (F.col("_part") == "false")) | ((F.col("strategy") == "strata") & (F.col("kind") == "ids"))
    kept = rows.where(whole | spread).withColumn("_place", F.row_number().over(group.orderBy("_rank", position)))
    return kept.where((F.col("strategy") != "strata") | (F.col("_place") <= PREVIEW)).select(*columns.columns, "kind", "strategy")


def numbered_prefix(name: str) -> Column:
    return F.regexp_extract(name, "(?i)^([a-z_]+?)_*([0-9]+)", 1)


def sequential_groups(columns: DataFrame, by: list[str], name: str) -> DataFrame:
    """Prefixes that at least ten numbered columns of a group share, with over 70 % of steps of at most two, in numeric order."""
    prefix = numbered_prefix(name)
    number = F.regexp_extract(name, "(?i)^([a-z_]+?)_*([0-9]+)", 2).try_cast("long")
    rows = columns.select(*by, name, prefix.alias("prefix"), number.alias("number")).where("prefix <> ''")
    step = F.lead("number").over(Window.partitionBy(*by, "prefix").orderBy("number", name)) - F.col("number")
    sizes = rows.withColumn("step", step).groupBy(*by, "prefix").agg(F.count("*").alias("members"), F.count("step").alias("steps"), F.count(F.when(F.col("step") <= 2, 1)).alias("small"))
    return sizes.where((F.col("members") >= 10) & (F.col("small") > 0.7 * F.col("steps"))).select(*by, "prefix", "members")
