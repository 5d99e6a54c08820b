"""Driver tables: one parquet file per table under an ``sf_dir``.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan,
so callers just select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Attribute access to the driver tables: ``t.lineitem``.

    Each table is opened once per instance (one file listing, one schema
    read): on object storage with many files, listing is the expensive part
    of opening a table, and queries read some tables more than once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(self.path(name))
        return self._open[name]

    def register_views(self, names=TABLES) -> None:
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
