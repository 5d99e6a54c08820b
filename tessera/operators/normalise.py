"""Normalisation: split a wide table into entity/relation tables, rejoin
them, and find functional-dependency violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_entities(wide: DataFrame, entities: dict[str, list[str]]) -> dict[str, DataFrame]:
    """One DISTINCT projection per entity/relation (name -> columns)."""
    return {name: wide.select(*cols).distinct() for name, cols in entities.items()}


def rejoin(tables: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Join entity tables back on their shared keys, in the given order."""
    out = tables[0][0]
    for df, keys in tables[1:]:
        out = out.join(df, keys)
    return out


def fd_violations(df: DataFrame, lhs: list[str], rhs: str) -> DataFrame:
    """Determinant values of ``lhs -> rhs`` mapping to more than one ``rhs``
    (a BCNF/3NF violation).  Counted on (lhs, rhs) pairs first, so each
    determinant's partial counts are combined map-side."""
    pairs = df.select(*lhs, rhs).distinct()
    return pairs.groupBy(*lhs).agg(F.count(F.lit(1)).alias("num_values")).filter(F.col("num_values") > 1)


def is_lossless(original: DataFrame, rebuilt: DataFrame) -> bool:
    """Bag equality both ways (used in tests)."""
    cols = original.columns
    r = rebuilt.select(*cols)
    return original.exceptAll(r).isEmpty() and r.exceptAll(original).isEmpty()
