"""Folders in which queries keep what they write."""

import subprocess
import sys
from pathlib import Path

PROGRAM = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
from ledgerline.plans.shared import folder
path = folder(spark, "part")
spark.range(3).write.parquet(path)
spark.range(3).write.parquet(sys.argv[1] + "/own")
print(spark.read.parquet(path).count())
"""


def test_folders_go_when_the_driver_ends(tmp_path):
    done = subprocess.run([sys.executable, "-c", PROGRAM, str(tmp_path)], capture_output=True, text=True, cwd=Path(__file__).resolve().parent.parent, timeout=120, check=True)
    assert done.stdout.strip().endswith("3")
    left = [p.name for p in tmp_path.iterdir()]
    assert "own" in left and not [n for n in left if n.startswith("part-")]
