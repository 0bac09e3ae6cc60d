"""Where queries that write keep their files: below the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ledgerline.sources.tables import at_end_removed, shared_folder


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which goes when the driver ends."""
    return at_end_removed(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
