"""Reading the tables of a folder, and keeping what is computed where every executor finds it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only where that is unset and all runs on one machine, as in tests, one of our own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def at_end_removed(spark: SparkSession, path: str) -> str:
    """`path`, which goes when the session's driver ends: what queries write there lives as long as what reads it may."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(where)
    system.deleteOnExit(where)  # only what is there can be marked
    system.delete(where, True)  # so that a writer may make it
    return path


def kept(df: DataFrame) -> DataFrame:
    """`df` computed once, as a checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
