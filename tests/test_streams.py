"""Streams over several batches: files of one period, replays, late rows, bounded state, runs that restart."""

import datetime
import uuid

import pytest
from ledgerline.streaming import monitor as M
from pyspark.sql import functions as F


@pytest.fixture()
def folders(tmp_path):
    return lambda name: f"{tmp_path}/{name}"


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


ROWS = "id long, period string"


def ingest(spark, folders, checkpoint="checkpoint"):
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(folders("in"))
    M.ingested(stream, folders("store"), folders("ledger"), folders(checkpoint))


def kept(spark, folders):
    stored = sorted((r["id"], r["_period"]) for r in spark.read.parquet(folders("store")).collect())
    ledger = spark.read.parquet(folders("ledger")).collect()
    assert sum(r["rows_loaded"] for r in ledger) == len(stored)
    assert len({r["file"] for r in ledger}) == len(ledger)
    return stored


def test_files_of_a_period_stay_over_batches_and_a_new_checkpoint(spark, folders):
    land(spark, [(1, "2024-01"), (2, "2024-01")], ROWS, folders("in"))
    land(spark, [(3, "2024-01"), (4, "2024-02")], ROWS, folders("in"))
    ingest(spark, folders)
    want = [(1, "2024-01"), (2, "2024-01"), (3, "2024-01"), (4, "2024-02")]
    assert kept(spark, folders) == want
    land(spark, [(5, "2024-01"), (5, "2024-01")], ROWS, folders("in"))
    ingest(spark, folders)
    want = sorted([*want, (5, "2024-01"), (5, "2024-01")])
    assert kept(spark, folders) == want
    ingest(spark, folders, "lost")  # every file comes again, under batch numbers that were used before
    assert kept(spark, folders) == want


def test_a_batch_that_dies_between_data_and_ledger_changes_nothing(spark, folders, monkeypatch):
    land(spark, [(1, "2024-01"), (2, "2024-02")], ROWS, folders("in"))
    ingest(spark, folders)
    land(spark, [(3, "2024-01"), (4, "2024-03")], ROWS, folders("in"))
    written = type(spark.range(1).write).parquet

    def dies(self, path, *args, **kwargs):
        if path == folders("ledger") and len(self._df.columns) == 5 and not self._df.isEmpty():
            raise RuntimeError("killed")
        return written(self, path, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", dies)
    with pytest.raises(Exception, match="killed"):
        ingest(spark, folders)
    monkeypatch.undo()
    assert spark.read.parquet(folders("store")).count() == 4  # its data is there
    ingest(spark, folders)
    assert kept(spark, folders) == [(1, "2024-01"), (2, "2024-02"), (3, "2024-01"), (4, "2024-03")]


LOG = "ts timestamp, event_type string, level string"
DAY = datetime.datetime(2024, 1, 1)


def at(day, hour):
    return DAY + datetime.timedelta(days=day, hours=hour)


def windows(spark, folders, files, again=False):
    for rows in files:
        land(spark, rows, LOG, folders("log"))
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folders("log"))
    M.closed_windows(stream, folders("out"), folders("late"), folders("state"), folders(f"windows-{uuid.uuid4()}" if again else "windows"))
    closed = spark.read.parquet(folders("out")).drop("batch")
    return closed, spark.read.schema(LOG).parquet(folders("late")), M.open_windows(spark, folders("state"))


def test_windows_close_late_rows_are_kept_and_state_is_bounded(spark, folders):
    files = [[(at(d, h), k, "error" if h == 3 else "info") for h in (1, 3, 23) for k in ("a", "b")] for d in range(12)]
    files[6].append((at(2, 5), "a", "info"))  # long after its window closed
    files[6].append((at(5, 22), "a", "info"))  # within the hour that is waited for
    closed, late, still_open = windows(spark, folders, files)
    assert [(r["ts"], r["event_type"]) for r in late.collect()] == [(at(2, 5), "a")]
    on_time = spark.createDataFrame([r for f in files for r in f if r[0] != at(2, 5)], LOG)
    want = sorted(map(tuple, M.windowed(on_time).collect()))
    assert sorted(map(tuple, closed.unionByName(still_open).collect())) == want
    assert closed.count() == 22
    for state in spark.read.schema(f"{M.OPEN}, batch long").parquet(folders("state")).groupBy("batch").count().collect():
        assert state["count"] <= 5  # two windows of two types, and the newest event
    before = sorted(map(tuple, closed.unionByName(still_open).collect()))
    closed, late, still_open = windows(spark, folders, [], again=True)  # every batch again
    assert sorted(map(tuple, closed.unionByName(still_open).collect())) == before
    assert late.count() == 1


def test_sessions_of_runs_out_of_order_and_restarted(spark, folders):
    rows = [("a", at(0, 1), "started"), ("a", at(0, 2), "completed"), ("a", at(0, 9), "started"), ("b", at(0, 3), "completed"), ("b", at(0, 2), "started"), ("c", at(0, 1), "started"), ("c", at(0, 1.5), "failed"), ("d", at(2, 0), "started")]
    schema = "run_id string, ts timestamp, kind string"
    for part in (rows[1::2], rows[::2]):
        land(spark, part, schema, folders("runs"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folders("runs"))
    M.run_sessions(stream, "2 hours", "3 days").writeStream.format("memory").queryName("sessions").outputMode("append").option("checkpointLocation", folders("c")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("sessions").count() == 0  # nothing is over while rows may still be three days late
    whole = sorted((r["run_id"], r["began"], r["status"]) for r in M.run_sessions(spark.createDataFrame(rows, schema), "2 hours").collect())
    want = [("a", at(0, 1), "SUCCESS"), ("a", at(0, 9), "INCOMPLETE"), ("b", at(0, 2), "SUCCESS"), ("c", at(0, 1), "FAILED"), ("d", at(2, 0), "INCOMPLETE")]
    assert whole == want
    land(spark, [("e", at(9, 0), "started")], schema, folders("runs"))
    land(spark, [("e", at(9, 0), "started")], schema, folders("runs"))
    M.run_sessions(stream, "2 hours", "3 days").writeStream.format("parquet").option("path", folders("over")).option("checkpointLocation", folders("c2")).trigger(availableNow=True).start().awaitTermination()
    over = spark.read.parquet(folders("over"))
    assert sorted((r["run_id"], r["began"], r["status"]) for r in over.select(F.col("run_id"), "began", "status").collect()) == want
