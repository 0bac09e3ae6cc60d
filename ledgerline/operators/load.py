"""Loading periods of a source: lineage, idempotent replacement, evolving schemas, ledgers and checks of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.functions import clean, periods
from ledgerline.functions.names import is_date_header
from ledgerline.operators.analytics import latest_per_key

PROVENANCE = ["_load_id", "_loaded_at", "_period", "_period_start", "_period_end", "_manifest_file_id"]
WIDER = ["int", "bigint", "decimal(38,6)", "double", "string"]


def stamped(df: DataFrame, load_id: int, loaded_at: Column, period: Column, manifest_file_id: int | None = None) -> DataFrame:
    """`df` without suppression markers and with its provenance."""
    return clean.suppress(df).withColumns({"_load_id": F.lit(load_id), "_loaded_at": loaded_at, "_period": period, "_period_start": periods.period_start(period), "_period_end": periods.period_end(period), "_manifest_file_id": F.lit(manifest_file_id).cast("int")})


def append(df: DataFrame, path: str) -> None:
    df.write.partitionBy("_period").mode("append").parquet(path)


def replace_periods(df: DataFrame, path: str) -> None:
    """Writes the periods that `df` has in place of the same periods at `path`; other periods stay."""
    if "_period" not in df.columns:
        raise ValueError("replacing needs a period")
    df.write.partitionBy("_period").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def staging_schema(columns: list[tuple[str, str]]) -> T.StructType:
    """The schema of a staging table for (name, stored type), provenance included."""
    kinds = {"INTEGER": "int", "BIGINT": "bigint", "BOOLEAN": "boolean", "DATE": "date", "REAL": "float", "DOUBLE PRECISION": "double"}
    own = [f"`{n}` {kinds.get(t, 'decimal' + t[7:] if t.startswith('NUMERIC(') else 'string')}" for n, t in columns]
    return T.StructType.fromDDL(", ".join([*own, "_load_id int, _loaded_at timestamp, _period string, _period_start date, _period_end date, _manifest_file_id int"]))


def evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, with the columns of both; what a row lacks is null."""
    return old.unionByName(new, allowMissingColumns=True)


def widened(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with each shared column as the narrowest type that holds both sides' values.

    A text column against a whole-number one becomes decimal if all its values are numbers, else both are text.
    """
    kinds = dict(new.dtypes)
    for name, kind in old.dtypes:
        other = kinds.get(name, kind)
        if kind == other or kind not in WIDER or other not in WIDER:
            continue
        wide = max(kind, other, key=WIDER.index)
        if wide == "string":
            text = new if other == "string" else old
            numbers = text.agg(F.bool_and(F.col(name).isNull() | F.col(name).try_cast("decimal(38,6)").isNotNull()).alias("ok")).first()["ok"]
            wide = "decimal(38,6)" if numbers else "string"
        old, new = old.withColumn(name, F.col(name).cast(wide)), new.withColumn(name, F.col(name).cast(wide))
    return old, new


def upserted(rows: DataFrame, key: list[str], order: list[Column], first_seen: str | None = None, loaded_at: tuple[str, Column] | None = None) -> DataFrame:
    """The latest row of each key; `first_seen` is the key's earliest, `loaded_at` its latest where the status says loaded."""
    each = Window.partitionBy(*key)
    out = rows.withColumn("_n", F.row_number().over(each.orderBy(*order)))
    if first_seen:
        out = out.withColumn(first_seen, F.min(first_seen).over(each))
    if loaded_at:
        out = out.withColumn(loaded_at[0], F.max(F.when(loaded_at[1], F.col(loaded_at[0]))).over(each))
    return out.where("_n = 1").drop("_n")


def replaced_for(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """`old` without the keys that `new` has, and `new`."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


#: New date columns from which on a table has gone wide.
WIDE = 3


def drift(found: DataFrame, stored: DataFrame) -> DataFrame:
    """(table, event, columns) of what tables' columns gained, lost or changed in type; both have table, column, type.

    Where three new columns or more are named for dates, a further event says so and names them.
    """
    real = stored.where(~F.startswith("column", F.lit("_")))
    both = found.alias("f").join(real.alias("s"), (F.col("f.table") == F.col("s.table")) & (F.col("f.column") == F.col("s.column")), "full")
    event = F.when(F.col("s.column").isNull(), "new_columns").when(F.col("f.column").isNull(), "missing_columns").when(F.col("f.type") != F.col("s.type"), "type_change")
    rows = both.select(F.coalesce("f.table", "s.table").alias("table"), event.alias("event"), F.coalesce("f.column", "s.column").alias("column")).where("event is not null")
    names = F.array_join(F.array_sort(F.collect_set("column")), ",").alias("columns")
    dated = rows.where((F.col("event") == "new_columns") & is_date_header(F.col("column")))
    wide = dated.groupBy("table").agg(F.count_distinct("column").alias("n"), names).where(F.col("n") >= WIDE)
    return rows.groupBy("table", "event").agg(names).unionByName(wide.select("table", F.lit("wide_date_detected").alias("event"), "columns"))


def tracking_id(url: Column, sheet: Column | None = None, member: Column | None = None) -> Column:
    """What a load is known by: its URL, with the archive's member or the workbook's sheet behind it."""
    part = F.coalesce(*[F.nullif(c, F.lit("")) for c in (member, sheet) if c is not None], F.lit(None).cast("string"))
    return F.when(part.isNotNull(), F.concat(url, F.lit("#"), part)).otherwise(url)


def loaded_state(work: DataFrame, history: DataFrame) -> DataFrame:
    """`work` (source, url) with the newest load of each: loaded, load_id, rows, loaded_at, mode; `history` has source, url, id, rows_loaded, loaded_at, mode."""
    newest = latest_per_key(history, ["source", "url"], F.desc("loaded_at"), F.desc("id"))
    last = newest.select("source", "url", F.col("id").alias("load_id"), F.col("rows_loaded").alias("rows"), "loaded_at", "mode")
    return work.join(last, ["source", "url"], "left").withColumn("loaded", F.col("load_id").isNotNull())


def pending(work: DataFrame, history: DataFrame) -> DataFrame:
    """Work whose (source, url) has not been loaded."""
    return work.join(history.select("source", "url").distinct(), ["source", "url"], "left_anti")


def checked(loads: DataFrame, least: int = 100) -> DataFrame:
    """`loads` with the verdict on each: failed, error without rows, warning under `least` rows, ok."""
    return loads.withColumn("verdict", F.when(~F.col("success"), "failed").when(F.col("rows_loaded") == 0, "error").when(F.col("rows_loaded") < least, "warning").otherwise("ok"))


# Fixed values.
LONG_MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
DATED = rf"({LONG_MONTHS})_\d{{4}}|\d{{4}}_({LONG_MONTHS})|(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)_\d{{2,4}}|q[1-4]_\d{{4}}|\d{{4}}_q[1-4]|fy_\d{{4}}_\d{{4}}"
YEAR_TO_DATE = "year_to_date|ytd|cumulative|total_since|running_total|accumulated"
SNAPSHOT = "as_of|snapshot|end_of_period|closing|at_date|position_as_at"
INCREMENTAL = "new_|during_period|in_period|this_month|current_period|period_only"


#: Confidence from which on an external verdict counts before what columns say.
TRUSTED = 0.75


def load_modes(columns: DataFrame, descriptions: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """table, pattern, confidence and mode, from the columns (table, column) or else the descriptions (table, description).

    An external verdict (table, verdict, sure; null: 0.80) of 0.75 or more comes first; a weaker one only where it is surer than all else.
    """
    low = F.lower("column")
    count = {n: F.count(F.when(low.rlike(p), 1)).alias(n) for n, p in (("dated", DATED), ("ytd", YEAR_TO_DATE), ("snap", SNAPSHOT), ("incr", INCREMENTAL))}
    tallied = columns.groupBy("table").agg(*count.values()).join(descriptions, "table", "left")
    text = F.lower(F.concat_ws(" ", "description", "table"))
    by_column = [(F.col("dated") >= 6, "time_series_wide", 0.95), (F.col("ytd") > 0, "cumulative_ytd", 0.85), (F.col("snap") > 0, "point_in_time_snapshot", 0.80), (F.col("incr") > 0, "incremental_transactional", 0.75)]
    by_text = [(text.rlike("historical|time series|trend|over time"), "time_series_wide", 0.70), (text.rlike(YEAR_TO_DATE), "cumulative_ytd", 0.75), (text.rlike(SNAPSHOT), "point_in_time_snapshot", 0.70), (text.rlike("transaction|event|log|individual|record"), "incremental_transactional", 0.65)]
    pattern, confidence = F.lit("unknown"), F.lit(0.5)
    for when, name, sure in reversed(by_column + by_text):
        pattern, confidence = F.when(when, name).otherwise(pattern), F.when(when, sure).otherwise(confidence)
    out = tallied.withColumns({"pattern": pattern, "confidence": confidence})
    if verdicts is not None:
        told = latest_per_key(verdicts, ["table"], F.desc("sure")).select("table", "verdict", F.when(F.col("verdict").isNotNull(), F.coalesce("sure", F.lit(0.80))).alias("sure"))
        out = out.join(told, "table", "left")
        first = (F.col("sure") >= TRUSTED) | ((F.col("confidence") < 0.65) & (F.col("sure") > F.col("confidence")))
        out = out.withColumns({"pattern": F.when(first, F.col("verdict")).otherwise(F.col("pattern")), "confidence": F.when(first, F.col("sure")).otherwise(F.col("confidence"))})
    append_it = (F.col("confidence") >= 0.8) & F.col("pattern").isin("incremental_transactional", "point_in_time_snapshot")
    return out.select("table", "pattern", "confidence", F.when(append_it, "append").otherwise("replace").alias("mode"))


def anomalies(loads: DataFrame, source: str, order: list[str], rows: str, added: Column, error: Column) -> DataFrame:
    """Each load's grade against the median of the five before it: critical, warning or normal."""
    before = Window.partitionBy(source).orderBy(*order).rowsBetween(-5, -1)
    last = F.sort_array(F.collect_list(rows).over(before))  # five values at most
    middle = F.when(F.size("_last") > 0, (F.get("_last", F.floor((F.size("_last") - 1) / 2).cast("int")) + F.get("_last", F.floor(F.size("_last") / 2).cast("int"))) / 2)
    out = loads.withColumn("_last", last).withColumn("typical", middle).drop("_last")
    ratio = F.try_divide(F.col(rows), F.col("typical"))
    grade = (
        F.when((F.col(rows) == 0) & error, "warning")
        .when((F.col(rows) == 0) & (F.col("typical") > 0), "critical")
        .when(ratio < 0.1, "critical")
        .when(error | (ratio < 0.5) | (ratio > 2) | (added >= 5), "warning")
        .otherwise("normal")
    )
    return out.withColumn("grade", grade)
