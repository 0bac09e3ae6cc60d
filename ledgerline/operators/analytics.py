"""Questions on tables by period: growth, shares, seasons, spread, ranks and profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.sources.tables import at_end_removed, shared_folder


def exact_sum(value: str | Column) -> Column:
    """A sum that does not depend on the order of rows, for values of two decimals."""
    column = F.col(value) if isinstance(value, str) else value
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def growth(df: DataFrame, order: str, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """`previous` and `growth_pct` against the row before, null where that is null or zero."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("previous", before).withColumn("growth_pct", F.round(F.try_divide((F.col(value) - F.col("previous")) * 100, F.col("previous")), 2))


def cumulative_share(df: DataFrame, order: str, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Each band's share of its group and the share up to it, in per cent."""
    whole = F.sum(value).over(Window.partitionBy(*by))
    up_to = F.sum(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"share_pct": F.round(F.try_divide(F.col(value) * 100, whole), 1), "cumulative_pct": F.round(F.try_divide(up_to * 100, whole), 1)})


def latest(df: DataFrame, order: str) -> DataFrame:
    """The rows of the greatest value of `order`, by a join to one aggregated row."""
    top = df.agg(F.max(order).alias("_top"))
    return df.join(F.broadcast(top), df[order] == top["_top"], "left_semi")


def latest_per_key(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first in `order`."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def moving(df: DataFrame, order: str, value: str, rows: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Moving average and spread over `rows` rows, the next value, and the rank within the group."""
    each = Window.partitionBy(*by).orderBy(order)
    last = each.rowsBetween(1 - rows, 0)
    return df.withColumns({"moving_avg": F.round(F.avg(value).over(last), 4), "volatility": F.round(F.stddev_samp(value).over(last), 4), "following": F.lead(value).over(each), "place": F.rank().over(Window.partitionBy(*by).orderBy(F.desc(value)))})


def year_to_date(df: DataFrame, day: str, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Three-period average, sum since April, and change against twelve rows before."""
    from ledgerline.functions.periods import fiscal_start_year

    each = Window.partitionBy(*by).orderBy(day)
    df = df.withColumn("fiscal", fiscal_start_year(F.col(day)))
    year = Window.partitionBy(*by, "fiscal").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag(value, 12).over(each)
    return df.withColumns({"quarter_avg": F.round(F.avg(value).over(each.rowsBetween(-2, 0)), 4), "to_date": F.sum(value).over(year), "year_on_year_pct": F.round(F.try_divide((F.col(value) - before) * 100, before), 2)})


def seasonality(df: DataFrame, day: str, value: str) -> DataFrame:
    return df.groupBy(F.month(day).alias("month")).agg(F.count("*").alias("periods"), F.round(F.avg(value), 2).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"), F.round(F.stddev_samp(value), 2).alias("spread"))


def band_totals(df: DataFrame, band: str, value: str) -> DataFrame:
    """Total, mean, least and most of each band."""
    return df.groupBy(band).agg(F.sum(value).alias("total"), F.round(F.avg(value), 4).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"))


def variation(df: DataFrame, band: str, value: str) -> DataFrame:
    """Each band's coefficient of variation, null where the mean is zero."""
    return df.groupBy(band).agg(F.round(F.try_divide(F.stddev_samp(value), F.avg(value)), 6).alias("variation"))


def share_of(df: DataFrame, keep: list[str], parts: dict[str, list[str]]) -> DataFrame:
    """For each name the share, in per cent, of its columns in the sum of all columns named; null where that is zero."""
    every = list(dict.fromkeys(c for columns in parts.values() for c in columns))
    whole = sum((F.col(c) for c in every), F.lit(0))
    return df.select(*keep, *[F.round(F.try_divide(sum((F.col(c) for c in columns), F.lit(0)) * 100, whole), 2).alias(name) for name, columns in parts.items()])


def snapshot_comparison(df: DataFrame, snapshot: str, band: str, value: str, now: object, then: object) -> DataFrame:
    """For each band two snapshots' values, change, growth, and shares with their change in points."""
    both = df.where(F.col(snapshot).isin(now, then)).groupBy(band).agg(F.sum(F.when(F.col(snapshot) == now, F.col(value))).alias("now"), F.sum(F.when(F.col(snapshot) == then, F.col(value))).alias("then"))
    everything = Window.partitionBy()  # one row for each band
    share = {n: F.try_divide(F.col(n) * 100, F.sum(n).over(everything)) for n in ("now", "then")}
    return both.withColumns({"change": F.col("now") - F.col("then"), "growth_pct": F.round(F.try_divide((F.col("now") - F.col("then")) * 100, F.col("then")), 1), "share_now": F.round(share["now"], 1), "share_change": F.round(share["now"] - share["then"], 1)})


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` worked out once and read from a table that goes when the driver ends."""
    path = at_end_removed(df.sparkSession, f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted_ranks(df: DataFrame, by: str, value: str, ranges: int = 256) -> DataFrame:
    """by, value, n (rows), smaller (rows of the group below the value, nulls first) and total (rows of the group), for each distinct value.

    A group's values are counted by range, so that no task sorts a whole group: the ranges lie between approximate
    quantiles, which decide where the work is done and not what is found. Those differ each time that they are worked
    out, by the order in which parts arrive; so the ranges of values are stored, and both uses see the same.
    """
    counted = df.groupBy(by, value).agg(F.count("*").alias("n"))
    marks = [k / ranges for k in range(1, ranges)]
    groups = counted.groupBy(by).agg(F.percentile_approx(value, marks, 4 * ranges).alias("_marks"), F.sum("n").alias("total")).withColumnRenamed(by, "_by")
    placed = counted.join(groups, F.col(by).eqNullSafe(F.col("_by")))
    below = F.filter(F.coalesce("_marks", F.array()), lambda m: m < F.col(value))
    placed = stored(placed.withColumn("_range", F.size(below)).drop("_by", "_marks"), "ranges")
    ordered = Window.partitionBy(by).orderBy("_range")  # a row for each range
    sizes = placed.groupBy(by, "_range").agg(F.sum("n").alias("_in"))
    sizes = sizes.select(F.col(by).alias("_by"), F.col("_range").alias("_r"), (F.sum("_in").over(ordered) - F.col("_in")).alias("_before"))
    up_to = F.sum("n").over(Window.partitionBy(by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    within = placed.withColumn("smaller", up_to - F.col("n"))
    joined = within.join(sizes, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_r")))
    return joined.select(by, value, "n", (F.col("smaller") + F.col("_before")).alias("smaller"), "total")


def benchmark(df: DataFrame, region: str, value: str) -> DataFrame:
    """Each row's value against its region and all: averages, percentile and rank."""
    averages = df.groupBy(region).agg(F.avg(value).alias("region_avg")).withColumnRenamed(region, "_region")
    percentile = F.coalesce(F.try_divide(F.col("smaller"), F.col("total") - 1), F.lit(0.0))
    ranks = counted_ranks(df, region, value).select(F.col(region).alias("_r"), F.col(value).alias("_v"), percentile.alias("percentile"), (F.col("total") - F.col("smaller") - F.col("n") + 1).alias("place"))
    placed = df.join(ranks, F.col(region).eqNullSafe(F.col("_r")) & F.col(value).eqNullSafe(F.col("_v")))
    placed = placed.join(averages, F.col(region).eqNullSafe(F.col("_region"))).drop("_r", "_v", "_region")
    return placed.crossJoin(F.broadcast(df.agg(F.avg(value).alias("overall_avg"))))


def quantiles(df: DataFrame, by: str, value: str, wanted: dict[str, float]) -> DataFrame:
    """by and for each name its exact quantile, between the two nearest values in proportion; nulls don't count."""
    ranks = counted_ranks(df.where(F.col(value).isNotNull()), by, value)

    def at(position: Column) -> Column:
        return F.max(F.when(F.col("smaller") <= position, F.col(value)))

    found = {}
    for name, q in wanted.items():
        place = (F.col("total") - 1) * q
        low, high = at(F.floor(place)), at(F.ceil(place))
        found[name] = low + (high - low) * F.max(place - F.floor(place))
    return ranks.groupBy(by).agg(*[c.alias(n) for n, c in found.items()])


def exact_mean(value: str) -> Column:
    """The mean of numbers that are taken to six decimals, rounded half away from zero to four: whole numbers throughout, so that no order of adding
    up and no mean in the middle between two results makes a difference.
    """
    total, n = F.sum(F.round(F.col(value) * 1000000).cast("decimal(20,0)")), F.count(value)
    rounded = F.call_function("div", 2 * F.abs(total) + 100 * n, 200 * n)
    return F.when(n > 0, F.signum(total.cast("double")) * rounded.cast("double") / 10000)


def profile(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """total, non_null, nulls, distinct, least and most of every column, from one pass."""
    names = columns or df.columns
    values = df.select(*[F.col(f"`{n}`").alias(f"v{k}") for k, n in enumerate(names)])
    own = [f"v{k}" for k in range(len(names))]
    if approximate:
        counts = {c: (F.count(c), F.approx_count_distinct(c)) for c in own}
        total = F.count("*")
    else:
        # each value with its number, in a row of its own column: what repeats in a task's rows goes there, all else by a shuffle
        dealt = values.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *own)
        kinds = dict(values.dtypes)
        alone = [F.struct(F.lit(k).alias("k"), *[(F.col(c) if c == one else F.lit(None).cast(kinds[c])).alias(c) for c in own]) for k, one in enumerate(own)]
        values = dealt.select(F.explode(F.array(*alone)).alias("r")).select("r.*").groupBy("k", *own).agg(F.count("*").alias("n"))
        counts = {c: (F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col("n"))), F.lit(0)), F.count(c)) for c in own}
        total = F.coalesce(F.sum(F.when(F.col("k") == 0, F.col("n"))), F.lit(0))
    measures = []
    for k, c in enumerate(own):
        number, distinct = counts[c]
        measures += [number.alias(f"c{k}"), distinct.alias(f"d{k}"), F.min(c).cast("string").alias(f"l{k}"), F.max(c).cast("string").alias(f"m{k}")]
    one = values.agg(total.alias("total"), *measures)
    rows = [F.struct(F.lit(n).alias("column_name"), F.col("total"), F.col(f"c{k}").alias("non_null"), (F.col("total") - F.col(f"c{k}")).alias("nulls"), F.col(f"d{k}").alias("distinct_values"), F.col(f"l{k}").alias("least"), F.col(f"m{k}").alias("most")) for k, n in enumerate(names)]
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("null_rate", F.round(F.try_divide(F.col("nulls") * 100, F.col("total")), 2))


def top_share(df: DataFrame, value: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows with their part of all rows' value."""
    whole = df.agg(F.sum(value).alias("_all"))
    return df.orderBy(*order).limit(k).crossJoin(F.broadcast(whole)).withColumn("share_pct", F.round(F.try_divide(F.col(value) * 100, F.col("_all")), 2)).drop("_all")


def modal(df: DataFrame, value: str) -> DataFrame:
    """The most frequent value, the smallest of equally frequent ones."""
    return df.groupBy(value).count().orderBy(F.desc("count"), value).limit(1)
