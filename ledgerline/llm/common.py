"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Word separators of the text contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's rows; where its files give fewer splits than there are cores, dealt to all cores.

    A file's row group goes to one task whole, so that otherwise few Python workers would see all texts.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which every executor can reach.

    Only where that setting is absent and all runs on one machine, as in tests, a folder of our own is used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared folder, so that a lost executor costs no more than its tasks."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """`df` written to a table in the shared folder and read from there: only the columns in use are read again,
    and the optimizer knows its size, so that it broadcasts the table only where that is small."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, object]], schema: str, rows: int | None = None) -> DataFrame:
    """Apply `fn` to each Arrow batch of `df`, or to `rows` of it at a time, given and returned as columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                part = batch.slice(start, rows)
                yield pa.RecordBatch.from_pydict(fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}))

    return df.mapInArrow(run, schema)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class Memo(dict):
    """Values by key, made when first asked for. Two generations of `size` entries bound what is remembered;
    keys of more than `longest` characters are made anew each time."""

    def __init__(self, make: Callable[[str], object], size: int = 400_000, longest: int = 40):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key: str) -> object:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
