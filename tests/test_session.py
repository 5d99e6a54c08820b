"""What the library writes to the shared folder goes when the program ends."""

import os
import subprocess
import sys

PROGRAM = """
import sys
from pyspark.sql import SparkSession
from tessera.session import cut_lineage, cut_table
conf = {"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1], "spark.sql.shuffle.partitions": "2"}
spark = SparkSession.builder.master("local[1]").config(map=conf).getOrCreate()
kept = cut_lineage(spark.range(10).selectExpr("id % 3 as k").groupBy("k").count())
print(kept.count(), cut_table(kept).count())
spark.stop()
"""


def test_checkpoints_go_without_the_callers_setting(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", PROGRAM, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=300)
    assert run.stdout.split() == ["3", "3"], run.stderr
    assert [f for _, _, files in os.walk(tmp_path) for f in files] == []
