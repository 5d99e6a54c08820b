"""Row changes as pure functions ``current (+ change) -> next``.

Parquet tables take no UPDATE/DELETE/MERGE, so every DML statement of the
document store and the SQL scripts becomes a DataFrame transform.  "First
match" operations take an explicit total order; all reductions used here
(min of an order key, latest row per key) are partial aggregates, so a hot
key is combined map-side instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import number_rows


def _cond(cond) -> Column:
    c = F.expr(cond) if isinstance(cond, str) else cond
    return F.coalesce(c, F.lit(False))  # NULL condition = no match


def update_where(df: DataFrame, cond, sets: dict) -> DataFrame:
    """``UPDATE df SET col = expr, ... WHERE cond`` (NULL condition: no match).

    A dotted name (``"size.uom"``) updates a field of a struct column.
    """
    hit = _cond(cond)
    out = df
    plain = {}
    for name, expr in sets.items():
        expr = expr if isinstance(expr, Column) else F.lit(expr)
        if "." in name:
            top, field = name.split(".", 1)
            base = F.col(top)
            out = out.withColumn(top, F.when(hit, base.withField(field, expr)).otherwise(base))
        elif name in df.columns:
            plain[name] = F.when(hit, expr).otherwise(F.col(name))
        else:  # new field, present only on updated rows ($currentDate, $set of a new key)
            plain[name] = F.when(hit, expr)
    return out.withColumns(plain) if plain else out


def _first_match(df: DataFrame, cond, order_by: list[str]) -> DataFrame:
    """One-row frame with the smallest order key among matching rows."""
    key = F.struct(*[F.col(c) for c in order_by])
    return df.filter(_cond(cond)).agg(F.min(key).alias("__first"))


def update_first(df: DataFrame, cond, sets: dict, order_by: list[str]) -> DataFrame:
    """``updateOne``: update only the first match in ``order_by`` order."""
    first = _first_match(df, cond, order_by)
    key = F.struct(*[F.col(c) for c in order_by])
    tagged = df.crossJoin(F.broadcast(first))  # one row
    return update_where(tagged, _cond(cond) & (key == F.col("__first")), sets).drop("__first")


def delete_first(df: DataFrame, cond, order_by: list[str]) -> DataFrame:
    """``deleteOne``: remove only the first match in ``order_by`` order."""
    first = _first_match(df, cond, order_by)
    key = F.struct(*[F.col(c) for c in order_by])
    tagged = df.crossJoin(F.broadcast(first))
    hit = _cond(cond) & F.coalesce(key == F.col("__first"), F.lit(False))
    return tagged.filter(~hit).drop("__first")


def delete_where(df: DataFrame, cond) -> DataFrame:
    """``deleteMany(cond)``; ``cond=True`` empties the frame, keeping its schema."""
    return df.filter(~_cond(F.lit(cond) if isinstance(cond, bool) else cond))


def push(df: DataFrame, array_col: str, value, cond=True) -> DataFrame:
    """``$push``: append to an array field; a missing array becomes ``[value]``."""
    v = value if isinstance(value, Column) else F.lit(value)
    arr = F.coalesce(F.col(array_col), F.array().cast(df.schema[array_col].dataType))
    return update_where(df, F.lit(cond) if isinstance(cond, bool) else cond, {array_col: F.array_append(arr, v)})


def inc(df: DataFrame, col: str, by, cond=True) -> DataFrame:
    """``$inc``: add ``by``; a missing value counts as 0."""
    return update_where(df, F.lit(cond) if isinstance(cond, bool) else cond, {col: F.coalesce(F.col(col), F.lit(0)) + by})


def insert(df: DataFrame, rows: DataFrame) -> DataFrame:
    """``INSERT``/``insertMany`` with a column subset: missing columns NULL."""
    return df.unionByName(rows.select(*[c for c in rows.columns if c in df.columns]), allowMissingColumns=True).select(*df.columns)


def fill_from_lookup(df: DataFrame, lookup: DataFrame, on: tuple[str, str], value: str, new_col: str) -> DataFrame:
    """``ADD COLUMN`` + ``UPDATE SET new_col = (SELECT value FROM lookup WHERE
    lookup.k = df.k)``.  Several lookup rows per key: the smallest value is
    taken (deterministic stand-in for "first"); no match -> NULL."""
    left_key, right_key = on
    dedup = lookup.groupBy(F.col(right_key).alias("__lk")).agg(F.min(value).alias(new_col))
    return df.join(dedup, F.col(left_key) == F.col("__lk"), "left").drop("__lk")


def upsert_replace(target: DataFrame, batch: DataFrame, key: str, seq: str) -> DataFrame:
    """Keyed replace-or-insert of whole rows (``replace_one(upsert=True)``):
    per key the batch row with the largest ``seq`` wins over the stored row;
    keys absent from the batch keep their stored row.  Only the batch is
    reduced; the store meets its keys in an anti-join, which is a broadcast
    (no shuffle of the store) while the batch's keys are small.  A null key is
    a key."""
    cols = target.columns
    # by seq; equal seq -> the larger record (deterministic)
    win = batch.groupBy(key).agg(F.max(F.struct(F.col(seq).alias("__seq"), *[F.col(c) for c in cols])).alias("__r"))
    new = win.select(*[F.col(f"__r.{c}").alias(c) for c in cols])
    keys = batch.select(F.col(key).alias("__key")).distinct()
    kept = target.select(*cols).join(keys, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    return kept.unionByName(new)


def upsert_dimension(
    target: DataFrame | None,
    batch: DataFrame,
    natural_key: str,
    seq: str,
    surrogate: str,
    attrs: list[str],
) -> DataFrame:
    """``INSERT ... ON CONFLICT (natural_key) DO UPDATE SET attrs``.

    Batch rows are reduced to the last one per natural key (by ``seq``);
    existing members keep their surrogate key and take the new attributes;
    new members get ``max(key) + 1 ...`` in natural-key order.  ``target=None``
    is a full reload (keys restart at 1).
    """
    latest = batch.groupBy(natural_key).agg(
        F.max(F.struct(F.col(seq).alias("__seq"), *[F.col(a) for a in attrs])).alias("__v")
    ).select(natural_key, *[F.col(f"__v.{a}").alias(a) for a in attrs])
    if target is None:
        return number_rows(latest, [natural_key], surrogate).select(surrogate, natural_key, *attrs)
    old = target.select(surrogate, natural_key, *attrs)
    j = old.join(latest.select(natural_key, *[F.col(a).alias(f"__n_{a}") for a in attrs], F.lit(True).alias("__hit")), natural_key, "left")
    kept = j.select(
        surrogate, natural_key, *[F.when(F.col("__hit"), F.col(f"__n_{a}")).otherwise(F.col(a)).alias(a) for a in attrs]
    )
    new = latest.join(old.select(natural_key), natural_key, "left_anti")
    base = old.agg(F.max(surrogate).alias("m"))
    fresh = number_rows(new, [natural_key], surrogate, base=base).select(surrogate, natural_key, *attrs)
    return kept.unionByName(fresh)


def apply_movements(accounts: DataFrame, movements: DataFrame, key: str, balance: str, delta: str) -> DataFrame:
    """Balances after a set of signed movements (``balance = balance ± x``),
    each account's movements summed first (map-side combine)."""
    net = movements.groupBy(F.col(key).alias("__k")).agg(F.sum(delta).alias("__net"))
    j = accounts.join(net, F.col(key) == F.col("__k"), "left")
    return j.withColumn(balance, F.col(balance) + F.coalesce(F.col("__net"), F.lit(0))).drop("__k", "__net")


def append_aggregate(df: DataFrame, cond, group_value: dict, value_col: str) -> DataFrame:
    """``INSERT INTO t (cls, value) SELECT <const>, SUM(value) FROM t WHERE cond``:
    the total of the matching rows is appended as one new row."""
    total = df.filter(_cond(cond)).agg(F.sum(value_col).alias(value_col))
    row = total.select(*[F.lit(v).alias(k) for k, v in group_value.items()], F.col(value_col))
    return df.unionByName(row.select(*[F.col(c).cast(df.schema[c].dataType) for c in df.columns]))
