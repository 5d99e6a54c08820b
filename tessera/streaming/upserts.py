"""Micro-batch sinks (``writeStream.foreachBatch``) for the keyed operators.

Both sinks are idempotent per epoch: a replayed micro-batch (after a driver
or executor failure) overwrites the partition of its own epoch instead of
adding a second copy, so the stream is exactly-once end to end together with
the source offsets in the query's checkpoint location.

* ``keyed_upsert_sink`` — replace-or-insert whole records by key (the raw
  store load): each batch is appended as change records of version
  ``epoch``; ``read_latest`` resolves the newest record per key.
* ``scd2_sink`` — apply each batch to a type-2 dimension; every epoch writes
  only the keys that its batch touches, with all their versions, and
  ``read_dimension`` takes each key from its newest epoch.  ``seq`` orders
  changes of one day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layers, star

EPOCH = "_epoch"


def keyed_upsert_sink(path: str, key: str, seq: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        cols = [c for c in batch.columns]
        # last by seq; equal seq -> the larger record, so a replay picks the same row
        latest = batch.groupBy(key).agg(F.max(F.struct(F.col(seq).alias("__seq"), *[F.col(c) for c in cols])).alias("__r")).select(
            *[F.col(f"__r.{c}").alias(c) for c in cols]
        )
        rec = latest.select(F.lit(int(epoch_id)).cast("long").alias(layers.VERSION), F.lit("WRITE").alias(layers.OP), *cols)
        (
            rec.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(layers.VERSION)
            .parquet(path)
        )

    return write


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    return layers.as_of_version(spark.read.parquet(path), [key])


def _write_epoch(dim: DataFrame, path: str, epoch: int) -> None:
    (
        dim.withColumn(EPOCH, F.lit(int(epoch)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EPOCH)
        .parquet(path)
    )


def scd2_sink(
    path: str, initial: DataFrame, key: str, tracked: list[str], effective: str = "effective_date", surrogate: str | None = None, seq: str | None = None
):
    """``initial`` is the dimension before the first batch; it is stored as
    epoch -1 (rewriting that one partition is idempotent on restart)."""
    _write_epoch(initial, path, -1)

    def write(batch: DataFrame, epoch_id: int) -> None:
        current = read_dimension(batch.sparkSession, path, key, before=int(epoch_id))
        touched = batch.select(key).distinct()
        nxt = star.scd2_apply(current, batch, key, tracked, effective=effective, surrogate=surrogate, seq=seq)
        _write_epoch(nxt.join(touched, key, "left_semi"), path, int(epoch_id))

    return write


def read_dimension(spark: SparkSession, path: str, key: str, before: int | None = None) -> DataFrame:
    """The dimension (optionally before epoch ``before``): the rows of each key
    from the newest epoch that holds it."""
    rows = spark.read.parquet(path)
    if before is not None:
        rows = rows.filter(F.col(EPOCH) < before)
    newest = rows.groupBy(F.col(key).alias("__key")).agg(F.max(EPOCH).alias("__newest"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(EPOCH) == F.col("__newest"))
    return rows.join(newest, same, "left_semi").drop(EPOCH)
