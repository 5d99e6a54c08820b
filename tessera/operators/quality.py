"""Declared constraints re-aimed as checks.

Each check returns a DataFrame of violations (empty = constraint holds);
``split`` separates good rows from a quarantine with a reason column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import is_blank
from .joins import without_match


class ConstraintViolation(ValueError):
    pass


def unique_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """PRIMARY KEY / UNIQUE: key values held by more than one row (NULL keys
    are ignored as in SQL UNIQUE)."""
    nonnull = df
    for k in key:
        nonnull = nonnull.filter(F.col(k).isNotNull())
    return nonnull.groupBy(*key).agg(F.count(F.lit(1)).alias("num_rows")).filter(F.col("num_rows") > 1)


def fk_violations(child: DataFrame, child_key: list[str], parent: DataFrame, parent_key: list[str]) -> DataFrame:
    """FOREIGN KEY: child rows whose (non-NULL) key has no parent row."""
    c = child
    for k in child_key:
        c = c.filter(F.col(k).isNotNull())  # NULL reference passes
    return without_match(c, parent, child_key, parent_key).select(*child_key, *[k for k in c.columns if k not in child_key])


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NOT NULL: (column_name, null_count) for each column, in one pass."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, null_count)")


def check_violations(df: DataFrame, predicate) -> DataFrame:
    """CHECK (predicate): rows where it is FALSE (NULL passes, as in SQL)."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~F.coalesce(p, F.lit(True)))


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column DEFAULTs: NULLs (or missing columns) take the default value."""
    out = df
    for c, v in defaults.items():
        lit = F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), lit) if c in df.columns else lit)
    return out


def required_text(c) -> Column:
    """A required document field: a non-blank string."""
    col = F.col(c) if isinstance(c, str) else c
    return ~is_blank(col)


def tag(df: DataFrame, rules: dict[str, Column], col: str = "reason") -> DataFrame:
    """Add ``col`` = the first failing rule's name (NULL for good rows) in
    one pass; ``rules`` maps a reason to a predicate good rows satisfy.
    Writing the tagged rows once, partitioned by ``col``, lands good and
    quarantined rows from a single scan."""
    reason = None
    for name, ok in rules.items():
        fail = ~F.coalesce(ok, F.lit(False))
        reason = F.when(fail, F.lit(name)) if reason is None else reason.when(fail, F.lit(name))
    return df.withColumn(col, reason)


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) views of ``tag``; quarantine rows carry the first
    failing reason."""
    tagged = tag(df, rules, "__reason")
    good = tagged.filter(F.col("__reason").isNull()).drop("__reason")
    bad = tagged.filter(F.col("__reason").isNotNull()).withColumnRenamed("__reason", "reason")
    return good, bad


def raise_if_any(violations: DataFrame, what: str) -> DataFrame:
    """Strict mode: fail the job when a violation exists (checked on one row
    only, never collecting the violations)."""
    if not violations.isEmpty():
        raise ConstraintViolation(f"{what}: constraint violated")
    return violations
