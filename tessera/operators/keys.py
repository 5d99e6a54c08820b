"""Dense row numbering and surrogate keys without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` with no PARTITION BY pulls every row into
one task.  Instead the rows are range-partitioned on the order columns (many
tasks, each a contiguous key range), materialised once in the shared
checkpoint folder so both uses below see the same layout, then numbered as
``offset(partition) + position within partition``.  The per-partition counts
table has one row per partition, so its broadcast is bounded by the partition
count, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_PID = "__tessera_pid"
_POS = "__tessera_pos"


def number_rows(df: DataFrame, order_cols: list[str], name: str, base=None) -> DataFrame:
    """Add ``name`` = base + 1, 2, ... following ``order_cols`` (a total order).

    ``base`` is an int, a Column over a one-row DataFrame joined by the caller,
    or a one-row DataFrame with a single numeric column.
    """
    # no explicit partition count: AQE may coalesce adjacent range partitions
    # of a small input, and adjacent ranges stay contiguous and in order
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    ranged = cut_lineage(ranged)
    tagged = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(
        _POS, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    )
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: a window without PARTITION BY is bounded here.
    offsets = counts.select(
        _PID,
        (F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).fillna(0, subset=["__off"])
    out = tagged.join(F.broadcast(offsets), _PID).withColumn(
        name, (F.col("__off") + F.col(_POS) + F.lit(1)).cast("long")
    )
    if isinstance(base, DataFrame):
        bcol = base.columns[0]
        out = out.crossJoin(F.broadcast(base.select(F.coalesce(F.col(bcol).cast("long"), F.lit(0)).alias("__base"))))
        out = out.withColumn(name, F.col(name) + F.col("__base")).drop("__base")
    elif base is not None:
        out = out.withColumn(name, F.col(name) + F.lit(int(base)))
    return out.drop(_PID, _POS, "__off")


def assign_keys(members: DataFrame, natural_key: list[str], key_col: str, existing: DataFrame | None = None) -> DataFrame:
    """Surrogate keys for a dimension: (natural_key..., key_col) for every member.

    Existing members keep their key (stable across runs); new members get
    ``max(existing) + 1 ...`` in natural-key order, dense from 1 on a first load.
    ``existing`` is a previous mapping with the same columns, or None for a
    full reload (keys restart at 1).
    """
    distinct = members.select(*natural_key).distinct()
    if existing is None:
        return number_rows(distinct, natural_key, key_col)
    old = existing.select(*natural_key, key_col)
    new = distinct.join(old.select(*natural_key), natural_key, "left_anti")
    base = old.agg(F.max(key_col).alias("__max"))
    fresh = number_rows(new, natural_key, key_col, base=base)
    return old.unionByName(fresh.select(*natural_key, key_col))
