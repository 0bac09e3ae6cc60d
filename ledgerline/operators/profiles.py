"""Column profiles that merge: one row of counts and sketches for each period, to which a new period adds its own.

Counts, least and greatest are exact. Distinct values come from HyperLogLog sketches (2^12 registers, some 1.6 % standard error)
and quantiles from KLL sketches (k = 200, some 1.3 % of ranks), so that a profile of any number of periods reads only their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types that a sketch of distinct values takes as they are; others go as text.
COUNTED = ("int", "bigint", "string", "binary")
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profiled_columns(df: DataFrame, period: str) -> list[tuple[str, str]]:
    return [(n, k) for n, k in df.dtypes if n != period and not n.startswith("_")]


def is_number(kind: str) -> bool:
    return kind in NUMBERS or kind.startswith("decimal")


def sketched(df: DataFrame, period: str) -> DataFrame:
    """period, total, and for every column its count, least, greatest, sketch of distinct values and, of numbers, of quantiles."""
    measures = [F.count("*").alias("total")]
    for name, kind in profiled_columns(df, period):
        c = F.col(f"`{name}`")
        measures += [F.count(c).alias(f"{name}|n"), F.min(c).alias(f"{name}|least"), F.max(c).alias(f"{name}|most"), F.hll_sketch_agg(c if kind in COUNTED else c.cast("string")).alias(f"{name}|distinct")]
        if is_number(kind):
            measures.append(F.kll_sketch_agg_double(c.cast("double")).alias(f"{name}|ranks"))
    return df.groupBy(period).agg(*measures)


def merged(sketches: DataFrame) -> DataFrame:
    """One row for all periods of `sketched` rows, of the same columns."""
    union = {"total": F.sum, "n": F.sum, "least": F.min, "most": F.max, "distinct": F.hll_union_agg, "ranks": F.kll_merge_agg_double}
    names = [n for n in sketches.columns if n == "total" or "|" in n]
    return sketches.agg(*[union[n.rpartition("|")[2]](F.col(f"`{n}`")).alias(n) for n in names])


def profile_of(sketches: DataFrame, quantile: float = 0.5) -> DataFrame:
    """column_name, total, non_null, nulls, null_rate, distinct_values (estimated), least, most and the quantile of numbers (estimated)."""
    one = merged(sketches)
    total = F.coalesce("total", F.lit(0))

    def row(name: str) -> Column:
        at = {x: F.col(f"`{name}|{x}`") for x in ("n", "least", "most", "distinct")}
        ranks = F.kll_sketch_get_quantile_double(F.col(f"`{name}|ranks`"), F.lit(quantile)) if f"{name}|ranks" in one.columns else F.lit(None).cast("double")
        n = F.coalesce(at["n"], F.lit(0))
        value = F.when(n > 0, ranks)
        return F.struct(F.lit(name).alias("column_name"), total.alias("total"), n.alias("non_null"), (total - n).alias("nulls"), F.round(F.try_divide((total - n) * 100, total), 2).alias("null_rate"), F.coalesce(F.hll_sketch_estimate(at["distinct"]), F.lit(0)).alias("distinct_values"), at["least"].cast("string").alias("least"), at["most"].cast("string").alias("most"), value.alias("quantile"))

    names = [n.removesuffix("|n") for n in one.columns if n.endswith("|n")]
    return one.select(F.explode(F.array(*[row(n) for n in names])).alias("r")).select("r.*")
