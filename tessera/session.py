"""Session helpers.

The library never creates its own cluster settings for production use: a
caller hands in a ``SparkSession``.  ``local_session`` exists for tests and
the benchmark only.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session and only falls back to a fresh scratch folder when the setting is
absent (local runs); on a cluster that setting names shared storage.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="tessera-run-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for ``DataFrame.checkpoint``.

    Order: the directory already set on the context, then the session
    setting ``spark.checkpoint.dir``.  Only in local mode (tests, bench) is a
    scratch folder created when both are missing; on a cluster the missing
    setting is an error rather than a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive executor loss
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. an object-store or HDFS path)")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives
    executor loss) and return the truncated-lineage DataFrame.  What it wrote
    goes when the program ends, also where the caller's session does not clean
    its checkpoints."""
    checkpoint_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)
    written = kept._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if written.isDefined():
        _remove_at_exit(df.sparkSession, written.get())
    return kept


def ship_package(spark: SparkSession) -> None:
    """Python workers find this package where the driver does (needed where
    the package is on the driver's path only, as in local runs)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the program ends, be the session stopped by then or not."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def clean() -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone by then
            files.delete(target, True)

    atexit.register(clean)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in shared storage, removed when the program ends."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


def cut_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to shared storage and read back: cuts the
    lineage like a checkpoint, and later filters and column choices reach
    the scan."""
    path = scratch_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_table`` and the number of rows, counted while they are written."""
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    table = cut_table(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return table, int(seen.get.get("n", 0))
