"""Streams: files that land, an event log by window, and runs that end or time out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerline.operators.load import stamped


LEDGER = "file string, rows_loaded long, periods array<string>, status string, loaded_at timestamp"


def ingested(stream: DataFrame, store: str, ledger: str, checkpoint: str, period: str = "period") -> None:
    """Loads every file that lands once, whatever batch it comes in; files of the same period lie beside each other in `store`.

    A file's rows are partitions of their own (_period, _file), so that loading it again after a failure writes those again and touches
    no other file's. Data comes first, then the file's row in `ledger`: files that have one are passed over, also from a new `checkpoint`.
    The ledger is one row for each file with rows; its counts are those of the stored rows.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)  # so that there is one to read

    def load(batch: DataFrame, number: int) -> None:
        loaded = spark.read.schema(LEDGER).parquet(ledger).select(F.col("file").alias("_known"))
        fresh = batch.join(loaded, F.col("_source") == F.col("_known"), "left_anti")
        rows = stamped(fresh.drop("_source"), number, F.current_timestamp(), F.col(period)).withColumn("_file", F.col("_file"))
        rows.write.partitionBy("_period", "_file").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(store)
        files = fresh.groupBy(F.col("_source").alias("file")).agg(F.count("*").alias("rows_loaded"), F.array_sort(F.collect_set(period)).alias("periods"))
        files.withColumns({"status": F.lit("loaded"), "loaded_at": F.current_timestamp()}).write.mode("append").parquet(ledger)

    tagged = stream.withColumn("_source", F.col("_metadata.file_path")).withColumn("_file", F.md5("_source"))
    tagged.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def emitted(events: DataFrame, path: str, at: str = "ts") -> None:
    """Appends events as JSON lines, in a folder for each date."""
    events.withColumn("date", F.date_format(at, "yyyy-MM-dd")).write.partitionBy("date").mode("append").json(path)


def windowed(events: DataFrame, at: str = "ts", width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events, errors and error share by window and type; the same expression serves a stream and a table."""
    counts = events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.count_if(F.col("level") == "error").alias("errors"))
    return counts.select(F.col("w.start").alias("starts"), "event_type", "events", "errors", F.round(F.col("errors") / F.col("events"), 4).alias("error_rate"))


OPEN = "starts timestamp, ends timestamp, event_type string, events long, errors long, newest timestamp"


def closed_windows(stream: DataFrame, out: str, late_rows: str, state: str, checkpoint: str, at: str = "ts", width: str = "1 day", late: str = "1 hour") -> None:
    """Writes the windows of `windowed` to `out` once the watermark has passed them, and rows that come after that to `late_rows`.

    Spark's own append mode drops late rows unseen. Here each batch adds its sums to those of the windows still open, a table of one row
    for each open window and type below `state`: what it holds is bounded by `late` and `width`, not by the stream's length. The watermark is the newest
    event of the batches before, less `late`. Everything of a batch goes to its own folder, so that a repeated batch changes nothing;
    states older than the last are removed. `open_windows` reads what is still open.
    """
    spark = stream.sparkSession
    delay = F.expr(f"INTERVAL {late}")

    def step(batch: DataFrame, number: int) -> None:
        before = spark.read.schema(OPEN).parquet(f"{state}/batch={number - 1}") if number else spark.createDataFrame([], OPEN)
        seen = before.agg(F.max("newest")).first()[0]
        rows = batch.withColumn("_window", F.window(at, width))
        too_late = F.coalesce(F.col("_window.end") <= F.lit(seen).cast("timestamp") - delay, F.lit(False))
        rows.where(too_late).drop("_window").write.mode("overwrite").parquet(f"{late_rows}/batch={number}")
        sums = rows.where(~too_late).groupBy(F.col("_window.start").alias("starts"), F.col("_window.end").alias("ends"), "event_type")
        new = sums.agg(F.count("*").alias("events"), F.count_if(F.col("level") == "error").alias("errors"), F.max(at).alias("newest"))
        both = before.unionByName(new).groupBy("starts", "ends", "event_type").agg(F.sum("events").alias("events"), F.sum("errors").alias("errors"), F.max("newest").alias("newest"))
        whole = both.where("starts is not null").crossJoin(both.agg(F.max("newest").alias("_newest")))  # one row
        is_over = F.col("ends") <= F.col("_newest") - delay
        share = F.round(F.col("errors") / F.col("events"), 4).alias("error_rate")
        whole.where(is_over).select("starts", "event_type", "events", "errors", share).write.mode("overwrite").parquet(f"{out}/batch={number}")
        mark = both.agg(F.lit(None).cast("timestamp").alias("starts"), F.lit(None).cast("timestamp").alias("ends"), F.lit(None).cast("string").alias("event_type"), F.lit(0).cast("long").alias("events"), F.lit(0).cast("long").alias("errors"), F.max("newest").alias("newest"))
        whole.where(~is_over).drop("_newest").unionByName(mark).write.mode("overwrite").parquet(f"{state}/batch={number}")
        removed(spark, f"{state}/batch={number - 2}")

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def open_windows(spark: SparkSession, state: str) -> DataFrame:
    """The windows that the watermark hasn't passed yet, as they stand after the last batch."""
    rows = spark.read.schema(f"{OPEN}, batch long").parquet(state)
    last = rows.agg(F.max("batch").alias("_last"))
    share = F.round(F.col("errors") / F.col("events"), 4).alias("error_rate")
    return rows.join(last, F.col("batch") == F.col("_last")).where("starts is not null").select("starts", "event_type", "events", "errors", share)


def removed(spark: SparkSession, path: str) -> None:
    """Takes a folder away, wherever it lies; one that isn't there is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run_sessions(events: DataFrame, timeout: str = "1 hour", late: str = "0 seconds") -> DataFrame:
    """Runs (run_id, ts, kind) from their first event to `timeout` after their last: SUCCESS, FAILED or INCOMPLETE. A run that goes on
    after its timeout is a run again.

    A session of Spark's own state: events may come out of order by up to `late`, and a session's state goes when the watermark passes it.
    The same expression serves a stream, in append mode, and a table.
    """
    counts = {kind: F.count_if(F.col("kind") == kind).alias(kind) for kind in ("started", "completed", "failed")}
    sessions = events.withWatermark("ts", late).groupBy("run_id", F.session_window("ts", timeout).alias("w")).agg(*counts.values())
    status = F.when(F.col("failed") > 0, "FAILED").when((F.col("started") > 0) & (F.col("completed") >= F.col("started")), "SUCCESS").otherwise("INCOMPLETE")
    return sessions.select("run_id", F.col("w.start").alias("began"), status.alias("status"), "started", "completed", "failed")


RUN_STATE = "started long, completed long, failed long, last_seen timestamp"
RUN_OUT = "run_id string, status string, started long, completed long, failed long"


def run_states(events: DataFrame, timeout_ms: int = 3_600_000) -> DataFrame:
    """One row for each run (run_id, ts, kind) when it is over: SUCCESS or FAILED, or INCOMPLETE once nothing has come for `timeout_ms`."""

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        started, completed, failed, last = state.get if state.exists else (0, 0, 0, None)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], "FAILED" if failed else "INCOMPLETE", started, completed, failed)], columns=["run_id", "status", "started", "completed", "failed"])
            return
        for frame in frames:
            kinds = frame["kind"].value_counts()
            started, completed, failed = started + int(kinds.get("started", 0)), completed + int(kinds.get("completed", 0)), failed + int(kinds.get("failed", 0))
            newest = frame["ts"].max()
            last = newest if last is None or newest > last else last
        if started and completed + failed >= started:
            if state.exists:
                state.remove()
            yield pd.DataFrame([(key[0], "FAILED" if failed else "SUCCESS", started, completed, failed)], columns=["run_id", "status", "started", "completed", "failed"])
            return
        state.update((started, completed, failed, last))
        # event time: the watermark must be behind the timeout
        state.setTimeoutTimestamp(max(int(last.timestamp() * 1000), state.getCurrentWatermarkMs()) + timeout_ms)

    return events.withWatermark("ts", "0 seconds").groupBy("run_id").applyInPandasWithState(follow, RUN_OUT, RUN_STATE, "append", GroupStateTimeout.EventTimeTimeout)
