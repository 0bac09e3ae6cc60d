"""Schedules of publications: which periods should be out by a day, under which URLs, and how often a source appears."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.periods import filled, monthly, period_start

#: Fiscal quarters that a schedule goes on for at most. Fixed value.
QUARTERS = 51


def scheduled(configs: DataFrame, as_of: Column) -> DataFrame:
    """(publication, period) of schedules: publication, type (monthly or fiscal_quarter), start and end ('current' or a month), months (array<int>, null: all),
    lag_weeks (null: 6), offset_months (null: 0), start_fy (null: 2025).

    A monthly schedule runs from start to end, 'current' being the day less the lag; with an offset a month counts once the month of its publication has begun.
    Fiscal quarters run from the first quarter of start_fy (named for the year in which it ends) while their end and the lag are past.
    """
    lag = F.coalesce("lag_weeks", F.lit(6)) * 7
    start = F.coalesce(period_start(F.col("start")), F.lit("2024-01-01").cast("date"))
    end = F.when(F.coalesce("end", F.lit("current")) == "current", F.date_sub(as_of, lag)).otherwise(F.last_day(period_start(F.col("end"))))
    by_month = configs.where("coalesce(type, 'monthly') <> 'fiscal_quarter'").withColumn("m", F.explode(monthly(start, end)))
    wanted = F.col("months").isNull() | F.array_contains("months", F.month("m"))
    offset = F.coalesce("offset_months", F.lit(0))
    out = (offset == 0) | (F.trunc(F.add_months("m", offset), "month") <= as_of)
    months = by_month.where(wanted & out).select("publication", F.date_format("m", "yyyy-MM").alias("period"))
    year = F.coalesce("start_fy", F.lit(2025))
    quarters = configs.where("type = 'fiscal_quarter'").select("publication", year.alias("fy"), lag.alias("lag"), F.explode(F.sequence(F.lit(0), F.lit(QUARTERS - 1))).alias("n"))
    last = F.last_day(F.add_months(F.make_date(F.col("fy") - 1, F.lit(6), F.lit(1)), F.col("n") * 3))
    code = F.concat(F.lit("FY"), F.lpad(((F.col("fy") + F.floor(F.col("n") / 4)) % 100).cast("string"), 2, "0"), F.lit("-Q"), (F.col("n") % 4 + 1).cast("string"))
    return months.unionByName(quarters.where(F.date_add(last, F.col("lag")) <= as_of).select("publication", code.alias("period")))


def resolved_urls(periods: DataFrame, publications: DataFrame, only: str | None = None) -> DataFrame:
    """(publication, period, url): the explicit URL of a period where a publication lists its URLs, else its template, or the exception for that period.

    `publications`: publication, landing_page, template, exceptions (map by period), urls (map by period, null: none listed), offset_months.
    Periods that are none, or that a list leaves out, have no row. `only` keeps one period.
    """
    rows = periods.where(F.col("period") == only) if only else periods
    dated = rows.join(publications, "publication").withColumn("_day", period_start(F.col("period")))
    offset = F.coalesce("offset_months", F.lit(0))
    published = F.when(offset != 0, F.add_months("_day", offset))  # the month of publication stands only where there is an offset
    template = F.coalesce(F.col("exceptions")[F.col("period")], F.col("template"))
    by_template = F.when(F.col("_day").isNotNull(), filled(template, F.col("period"), F.col("_day"), F.coalesce("landing_page", F.lit("")), published))
    url = F.when(F.col("urls").isNotNull(), F.col("urls")[F.col("period")]).otherwise(by_template)
    return dated.withColumn("url", url).where("url is not null").select("publication", "period", "url")


def frequencies(periods: DataFrame, by: str, period: str = "period") -> DataFrame:
    """How often each source appears: n_periods, earliest, latest, and quarterly for three periods or more in four months of the year at most, else monthly."""
    quarterly = (F.count_distinct(period) >= 3) & (F.count_distinct(F.substring(period, 6, 2)) <= 4)
    return periods.groupBy(by).agg(F.count_distinct(period).alias("n_periods"), F.min(period).alias("earliest"), F.max(period).alias("latest"), F.when(quarterly, "quarterly").otherwise("monthly").alias("frequency"))


def _fiscal(year: Column) -> Column:
    return F.concat(F.lpad((year % 100).cast("string"), 2, "0"), F.lit("/"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))


def fiscal_years(periods: DataFrame, by: str, sort_key: str = "sort_key") -> DataFrame:
    """(by, fiscal_year) of the April-to-March years from a source's first period to its last; sort keys are year and month as one number."""
    ends = periods.groupBy(by).agg(F.min(sort_key).alias("a"), F.max(sort_key).alias("b"))
    first, last = (F.floor(F.col(c) / 100) - F.when(F.col(c) % 100 >= 4, 0).otherwise(1) for c in "ab")
    return ends.select(by, F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("y")).select(by, _fiscal(F.col("y")).alias("fiscal_year"))


def sort_range(years: DataFrame, by: str, fiscal_year: str = "fiscal_year") -> DataFrame:
    """(by, from_key, to_key): April of the first of a source's fiscal years (24/25) to March of the last."""
    first, last = F.substring(fiscal_year, 1, 2).cast("int"), F.substring(fiscal_year, 4, 2).cast("int")
    return years.groupBy(by).agg(F.min((first + 2000) * 100 + 4).alias("from_key"), F.max((last + 2000) * 100 + 3).alias("to_key"))
