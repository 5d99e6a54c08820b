"""Layered (bronze / silver / gold) pipelines and versioned tables.

Storage is plain files in a shared folder: by default a ``lake`` folder
under the cluster's ``spark.checkpoint.dir`` (never a machine-local temp
folder), or any path the caller passes.  ``fmt`` is a parameter so a
table format with its own log (e.g. Delta) can be used where installed.

Versioned data is kept as a *change table*: every row change is a record
``(_version, _op, key..., columns...)`` with ``_op`` in WRITE/UPDATE/DELETE.
Stored in a folder per commit, an as-of read only scans the folders of versions
``<= v``, and the per-key reduction to the latest record is a
map-side-combined aggregate.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import cut_table, remove_folder, scratch_folder
from .changes import upsert_replace

VERSION, OP = "_version", "_op"


# --------------------------------------------------------------------------- paths and tables
def lake_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder in shared storage for one pipeline run: under
    ``spark.tessera.lake.dir`` where that is set (kept), else a scratch folder
    that goes when the program ends."""
    base = spark.conf.get("spark.tessera.lake.dir", None)
    return f"{base}/{name or 'run'}-{uuid.uuid4().hex[:12]}" if base else scratch_folder(spark, f"lake-{name or 'run'}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def publish_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Managed table dealt into ``buckets`` files by ``key`` and sorted in
    each: joins and aggregates on the key of tables with as many buckets plan
    no exchange, however often they run."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_clustered(df: DataFrame, path: str, by: str, keys: list[str], files: int) -> DataFrame:
    """``df`` written in ``files`` ranges of ``by``, sorted, with bloom filters on
    ``keys``: a lookup by range reads few files' row groups, one by any of
    the keys skips the groups that do not hold it."""
    w = df.repartitionByRange(files, by).sortWithinPartitions(by).write.mode("overwrite")
    for k in keys:
        w = w.option(f"parquet.bloom.filter.enabled#{k}", "true")
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


# --------------------------------------------------------------------------- keyed store
BUCKET = "_bucket"


class KeyedStore:
    """Rows by key in a folder, one partition per hash bucket of the key.

    A load replaces or inserts its rows (the largest ``seq`` of a key wins) and
    reads and writes only the buckets of its keys.  Their new rows are first
    written aside, then put in place bucket by bucket; a load that died in
    between is finished by the next one, and a load that is run again changes
    nothing.  One writer at a time.  A null key is a key."""

    def __init__(self, spark: SparkSession, path: str, key: str, seq: str, buckets: int = 64):
        self.spark, self.path, self.key, self.seq, self.buckets = spark, path.rstrip("/"), key, seq, buckets
        self.pending = self.path + "/_pending"

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _there(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _swap(self) -> None:
        rows = self._there(self.pending + "/rows")
        if rows is not None and self._there(self.pending + "/whole") is not None:
            rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        remove_folder(self.spark, self.pending)

    def load(self, batch: DataFrame) -> list[int]:
        """The buckets that were written, at most ``buckets`` numbers."""
        self._swap()
        batch = cut_table(self._dealt(batch))
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
        if not touched:
            return touched
        stored = self._there(self.path)
        stored = batch.limit(0) if stored is None else stored.where(F.col(BUCKET).isin(touched)).select(*batch.columns)
        upsert_replace(stored, batch, self.key, self.seq).write.parquet(self.pending + "/rows")
        self.spark.range(1).write.parquet(self.pending + "/whole")
        self._swap()
        return touched

    def read(self) -> DataFrame:
        self._swap()
        return self.spark.read.parquet(self.path).drop(BUCKET)


def publish(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Managed table by name (``saveAsTable``), read back with ``spark.table``.
    ``name`` may be qualified (``schema.table``); the schema is created if
    missing (``USE``-free: callers pass the qualified name)."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    df.write.format(fmt).mode(mode).saveAsTable(name)
    return spark.table(name)


# --------------------------------------------------------------------------- medallion steps
def to_silver(df: DataFrame, casts: dict[str, str], key: list[str], order: list[str] | None = None) -> DataFrame:
    """Typed, de-duplicated layer: apply ``casts`` then keep one row per
    ``key`` — the smallest by ``order`` (default: all remaining columns), so
    the survivor is deterministic even when duplicates differ.  The
    reduction is a partial aggregate: a hot key is combined map-side."""
    typed = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
    rest = [c for c in typed.columns if c not in key]
    order = order or rest
    fields = list(order) + [c for c in rest if c not in order]
    pick = F.min(F.struct(*[F.col(c).alias(f"__v_{c}") for c in fields])).alias("__m")
    return typed.groupBy(*key).agg(pick).select(*key, *[F.col(f"__m.__v_{c}").alias(c) for c in rest]).select(*typed.columns)


# --------------------------------------------------------------------------- change table
def initial_write(df: DataFrame, version: int = 0) -> DataFrame:
    """Version-0 change records for a table's first write."""
    return df.select(F.lit(version).cast("long").alias(VERSION), F.lit("WRITE").alias(OP), *df.columns)


def _next_version(changes: DataFrame) -> Column:
    return changes.select((F.max(VERSION) + 1).cast("long")).scalar()


def as_of_version(changes: DataFrame, key: list[str], version: int | None = None) -> DataFrame:
    """The table as of ``version`` (latest when None): per key the newest
    change record with ``_version <= version``; deleted keys disappear."""
    c = changes if version is None else changes.filter(F.col(VERSION) <= version)
    cols = [x for x in changes.columns if x not in (VERSION, OP) and x not in key]
    # newest version; within a version (a key written twice) the larger record, deterministically
    latest = c.groupBy(*key).agg(F.max(F.struct(VERSION, OP, *cols)).alias("__r"))
    return latest.filter(F.col("__r." + OP) != "DELETE").select(*key, *[F.col(f"__r.{x}").alias(x) for x in cols])


def _hit(cond) -> Column:
    return F.coalesce(F.expr(cond) if isinstance(cond, str) else cond, F.lit(False))


def _updated(current: DataFrame, cond, sets: dict, version: Column) -> DataFrame:
    upd = current.filter(_hit(cond)).withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in sets.items()})
    return upd.select(version.alias(VERSION), F.lit("UPDATE").alias(OP), *current.columns)


def _deleted(current: DataFrame, cond, version: Column) -> DataFrame:
    return current.filter(_hit(cond)).select(version.alias(VERSION), F.lit("DELETE").alias(OP), *current.columns)


def record_update(changes: DataFrame, key: list[str], cond, sets: dict, version: int | None = None) -> DataFrame:
    """``UPDATE t SET ... WHERE cond`` as new change records at ``version``
    (default ``max(_version) + 1``); only rows that match emit a record."""
    v = _next_version(changes) if version is None else F.lit(version).cast("long")
    return _updated(as_of_version(changes, key), cond, sets, v)


def record_delete(changes: DataFrame, key: list[str], cond, version: int | None = None) -> DataFrame:
    """``DELETE FROM t WHERE cond`` as tombstone records at ``version``."""
    v = _next_version(changes) if version is None else F.lit(version).cast("long")
    return _deleted(as_of_version(changes, key), cond, v)


def fold(changes: DataFrame, key: list[str], version: int) -> DataFrame:
    """The change records up to ``version`` folded into one per key that is
    there at that version.  Reads at this or a later version of the folded
    records and the later ones equal reads of all."""
    current = as_of_version(changes, key, version)
    return current.select(F.lit(version).cast("long").alias(VERSION), F.lit("WRITE").alias(OP), *current.columns)


def history(changes: DataFrame) -> DataFrame:
    """One row per version present in a change DataFrame: operation and
    number of affected rows (the table-history listing)."""
    return changes.groupBy(VERSION, OP).agg(F.count(F.lit(1)).alias("num_affected_rows")).select(
        F.col(VERSION).alias("version"), F.col(OP).alias("operation"), "num_affected_rows"
    )


class CommitConflict(RuntimeError):
    """Another writer took the version first; read again and retry."""


_LOG = "version long, folder string, operation string, num_affected_rows long, timestamp timestamp"


class VersionedTable:
    """A change table with one folder per commit and a log file per version.

    A commit writes its records to a folder of its own, then creates the log
    file named by the version, which names the folder.  Readers take only
    folders that the log names, so a commit that died before is invisible.
    The file is created only if it is not there, so of two writers of one
    version the later gets ``CommitConflict`` and nothing that was reported
    is lost.  (That creation is atomic on HDFS-like stores; where a store's is
    not, let one writer write.)  Nothing is cached: every handle reads the log.
    Every operation is a version, also one that changes no row.

    ``fold`` writes the table at a version as a snapshot, logged in the same
    way; reads and updates from then on take the last snapshot up to their
    version and the changes after it, instead of the whole history.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str]):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _logged(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).option("mode", "FAILFAST").json(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def _record(self, name: str, version: int, folder: str, operation: str, rows: int) -> None:
        """The log file of a version; an error where it is there already."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/{version:012d}.json")
        now = datetime.now(UTC).isoformat()
        entry = {"version": version, "folder": folder, "operation": operation, "num_affected_rows": rows, "timestamp": now}
        try:
            out = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(path, False)
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            raise CommitConflict(f"{self.path}: version {version} was taken") from None
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()

    def _write(self, name: str, version: int, records: DataFrame) -> tuple[str, int]:
        """Records to a folder of their own: its name and their number, which
        is observed while writing."""
        folder = f"{name}/{version:012d}-{uuid.uuid4().hex}"
        seen = Observation(folder)
        records.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{folder}")
        return folder, int(seen.get.get("n", 0))

    def log(self) -> DataFrame:
        """One row per committed version."""
        return self._logged("log")

    def last_version(self) -> int:
        v = self.log().agg(F.max("version")).first()[0]
        return -1 if v is None else int(v)

    def _folders(self, name: str, first: int, last: int | None) -> list[tuple[int, str]]:
        rows = self._logged(name).where(F.col("version") >= first)
        rows = rows if last is None else rows.where(F.col("version") <= last)
        return [(r.version, r.folder) for r in rows.select("version", "folder").orderBy("version").collect()]

    def changes(self, version: int | None = None) -> DataFrame:
        """Change records of the committed versions (up to ``version``)."""
        return self.spark.read.parquet(*[f"{self.path}/{f}" for _, f in self._folders("log", 0, version)])

    def commit(self, make_records, operation: str) -> int:
        version = self.last_version() + 1
        folder, rows = self._write("data", version, make_records(version))
        self._record("log", version, folder, operation, rows)
        return version

    def write(self, df: DataFrame) -> int:
        return self.commit(lambda v: initial_write(df, v), "WRITE")

    def update(self, cond, sets: dict) -> int:
        return self.commit(lambda v: _updated(self.read(v - 1), cond, sets, F.lit(v).cast("long")), "UPDATE")

    def delete(self, cond) -> int:
        return self.commit(lambda v: _deleted(self.read(v - 1), cond, F.lit(v).cast("long")), "DELETE")

    def fold(self, version: int | None = None) -> int:
        """Snapshot of ``version`` (default: the last)."""
        version = self.last_version() if version is None else version
        folder, rows = self._write("snapshots", version, fold(self._records(version), self.key, version))
        with contextlib.suppress(CommitConflict):  # it has one already: the same rows
            self._record("folds", version, folder, "FOLD", rows)
        return version

    def _records(self, version: int | None) -> DataFrame:
        """The last snapshot up to ``version`` and the changes after it."""
        snapshot = self._folders("folds", 0, version)[-1:]
        folders = snapshot + self._folders("log", snapshot[0][0] + 1 if snapshot else 0, version)
        return self.spark.read.parquet(*[f"{self.path}/{f}" for _, f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        return as_of_version(self._records(version), self.key)

    def history(self) -> DataFrame:
        return self.log().select("version", "timestamp", "operation", "num_affected_rows")
