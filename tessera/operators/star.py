"""Dimensional modelling: date dimension, unknown members, fact build,
type-2 history (apply a batch, or build from a change feed), as-of lookup and
drill-across.  All functions are DataFrame -> DataFrame.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .keys import number_rows

OPEN_END = _dt.date(9999, 12, 31)


# --------------------------------------------------------------------------- date dimension
def date_attributes(d: Column) -> list[Column]:
    """The 12 columns of a Kimball date row for date column ``d``."""
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).cast("short").alias("day_num_in_week"),  # 1 = Sunday
        F.dayofmonth(d).cast("short").alias("day_num_in_month"),
        F.dayofyear(d).cast("short").alias("day_num_in_year"),
        F.weekofyear(d).cast("short").alias("calendar_week"),  # ISO week
        F.date_format(d, "MMMM").alias("calendar_month"),
        F.month(d).cast("short").alias("month_num"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("calendar_quarter"),
        F.year(d).cast("short").alias("calendar_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    ]


def date_dimension(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end] (dates or ISO strings)."""
    bounds = spark.range(1).select(F.to_date(F.lit(str(start))).alias("lo"), F.to_date(F.lit(str(end))).alias("hi"))
    return date_dimension_between(bounds)


def date_dimension_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Date dimension over the range held in a one-row DataFrame.

    Size is one row per calendar day of the span (a few thousand rows for
    decades), so it is safe to broadcast into fact joins.
    """
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*date_attributes(F.col("d")))


def span_of(df: DataFrame, col: str) -> DataFrame:
    """One-row (lo, hi) date bounds of a date/timestamp column."""
    return df.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))


# --------------------------------------------------------------------------- members
def with_unknown_member(dim: DataFrame, key_col: str, defaults: dict) -> DataFrame:
    """Add the placeholder member (key 0) that unmatched facts point to."""
    row = [F.lit(0).cast(dim.schema[key_col].dataType).alias(key_col)]
    for f in dim.schema.fields:
        if f.name == key_col:
            continue
        row.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    unknown = dim.sparkSession.range(1).select(*row)
    return dim.unionByName(unknown)


def lookup_key(fact: DataFrame, dim: DataFrame, on: list[str], key_col: str, unknown: int = 0) -> DataFrame:
    """Resolve a fact's natural key to the dimension's surrogate key; facts
    with no member point to the placeholder ``unknown``."""
    m = dim.select(*on, key_col)
    return fact.join(m, on, "left").withColumn(key_col, F.coalesce(F.col(key_col), F.lit(unknown)))


def build_fact(src: DataFrame, lookups: list[tuple], measures: dict, keep: list) -> DataFrame:
    """Fact rows: every ``(dim, natural key, surrogate column[, unknown key])``
    lookup (unmatched -> the placeholder, default 0), then the derived
    measures (name -> Column), with the kept degenerate columns first."""
    out = src
    for dim, on, key_col, *unknown in lookups:
        out = lookup_key(out, dim, on, key_col, *(unknown or [0]))
    out = out.withColumns(measures)
    return out.select(*keep, *[lk[2] for lk in lookups], *measures.keys())


# --------------------------------------------------------------------------- type-2 history
def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def scd2_apply(
    dim: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: list[str],
    effective: str = "effective_date",
    surrogate: str | None = None,
    seq: str | None = None,
) -> DataFrame:
    """Apply a change batch to a type-2 dimension.

    ``dim`` carries ``effective_date``, ``expiry_date``, ``is_current``; ``batch``
    carries ``key``, the tracked columns and ``effective`` (the change date).
    Per key, the current row and the batch changes are put in date order
    (several changes on one day: the last by ``seq`` wins); a change equal to
    the version before it (NULL-safe) is a no-op and dropped, every other one
    becomes a version that expires the day before the next one starts.  So an
    unchanged key is left alone (re-applying a batch changes nothing), a
    changed key gets its current row expired at ``change - 1 day`` plus one new
    version per real change, and unknown keys are inserted.  Changes dated
    on or before the current version's start are ignored.  Untracked
    attributes of new versions come from the current row; new versions get
    surrogate keys after the current maximum.

    The batch is first reduced to one row per (key, day) with map-side
    combine; the per-key window then holds at most one row per day of the
    batch plus the current row, whatever the batch volume.
    """
    order = [F.col(effective)] + ([F.col(seq)] if seq else [])
    attrs = [c for c in dim.columns if c not in {key, "effective_date", "expiry_date", "is_current"}]
    other = [c for c in attrs if c not in tracked and c != surrogate]
    daily = batch.groupBy(key, F.to_date(effective).alias("effective_date")).agg(
        # last by effective/seq; ties -> the larger value (deterministic)
        F.max(F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(c) for c in tracked])).alias("__v")
    ).select(key, "effective_date", *[F.col(f"__v.{c}").alias(c) for c in tracked])

    cur = dim.filter(F.col("is_current"))
    hist = dim.filter(~F.col("is_current"))
    touched = daily.select(key).distinct()
    cur_touched = cur.join(touched, key, "left_semi")
    untouched = cur.join(touched, key, "left_anti")

    seqd = cur_touched.select(key, "effective_date", *tracked, F.lit(0).alias("__src")).unionByName(
        daily.select(key, "effective_date", *tracked, F.lit(1).alias("__src"))
    )
    # changes dated on or before the current version's start are already
    # history: they are ignored (history is not rewritten)
    cur_start = F.max(F.when(F.col("__src") == 0, F.col("effective_date"))).over(Window.partitionBy(key))
    seqd = seqd.withColumn("__cur_start", cur_start).filter(
        (F.col("__src") == 0) | F.col("__cur_start").isNull() | (F.col("effective_date") > F.col("__cur_start"))
    ).drop("__cur_start")
    w = Window.partitionBy(key).orderBy("effective_date", "__src")
    same_prev = F.lit(True)
    for c in tracked:
        same_prev = same_prev & _same(F.col(c), F.lag(c).over(w))
    first = F.lag("effective_date").over(w).isNull()
    kept = seqd.withColumn("__keep", (F.col("__src") == 0) | first | ~same_prev).filter("__keep").drop("__keep")
    nxt = F.lead("effective_date").over(w)
    kept = kept.withColumn("__next", nxt)

    # the current rows of changed keys: same row, possibly expired now
    old = cur_touched.join(kept.filter("__src = 0").select(key, "__next"), key).select(
        key,
        *attrs,
        "effective_date",
        F.coalesce(F.date_sub("__next", 1), F.col("expiry_date")).alias("expiry_date"),
        F.col("__next").isNull().alias("is_current"),
    )
    carry = cur_touched.select(key, *other)
    new = kept.filter("__src = 1").join(carry, key, "left").select(
        key,
        *tracked,
        *other,
        "effective_date",
        F.coalesce(F.date_sub("__next", 1), F.lit(OPEN_END)).alias("expiry_date"),
        F.col("__next").isNull().alias("is_current"),
    )
    if surrogate:
        base = dim.agg(F.max(surrogate).alias("m"))
        new = number_rows(new, [key, "effective_date"], surrogate, base=base)
    keep_cols = [key, *attrs, "effective_date", "expiry_date", "is_current"]
    return hist.select(*keep_cols).unionByName(untouched.select(*keep_cols)).unionByName(old.select(*keep_cols)).unionByName(new.select(*keep_cols))


def scd2_from_changes(df: DataFrame, key: str, tracked: list[str], ts: str, order: str | None = None) -> DataFrame:
    """Type-2 history from a change feed (many changes per key at once).

    1. one row per (key, day): the last change of the day (by ``ts`` then
       ``order``) — a map-side-combined reduction, so after it a key holds at
       most one row per calendar day;
    2. drop no-op versions (same tracked values as the previous day, NULL-safe);
    3. expiry = next version's effective date - 1 day, open end 9999-12-31.
    Steps 2-3 are windows per key over the reduced rows, whose size per key is
    bounded by the number of days in the feed, not by the feed volume.
    """
    tie = [F.col(ts)] + ([F.col(order)] if order else [])
    daily = df.groupBy(key, F.to_date(ts).alias("effective_date")).agg(
        F.max(F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(tie)], *[F.col(c) for c in tracked])).alias("__v")
    ).select(key, "effective_date", *[F.col(f"__v.{c}").alias(c) for c in tracked])
    w = Window.partitionBy(key).orderBy("effective_date")
    same_as_prev = F.lit(True)
    for c in tracked:
        same_as_prev = same_as_prev & _same(F.col(c), F.lag(c).over(w))
    first = F.lag("effective_date").over(w).isNull()
    versions = daily.withColumn("__keep", first | ~same_as_prev).filter("__keep").drop("__keep")
    nxt = F.lead("effective_date").over(w)
    return versions.select(
        key,
        *tracked,
        "effective_date",
        F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN_END)).alias("expiry_date"),
        nxt.isNull().alias("is_current"),
    )


def as_of(history: DataFrame, when) -> DataFrame:
    """Versions valid on date ``when`` (inclusive on both ends)."""
    d = F.to_date(F.lit(str(when))) if not isinstance(when, Column) else when
    return history.filter(d.between(F.col("effective_date"), F.col("expiry_date")))


def join_as_of(fact: DataFrame, history: DataFrame, key: str, fact_date: str, how: str = "inner") -> DataFrame:
    """Point-in-time lookup: each fact row meets the version of its key valid
    on the fact's date.  The join is an equality on the key and the year: a
    version stands once for each year it covers within the facts' years, so
    a hot key's rows meet the versions of one year, not its whole history."""
    if how != "inner":
        raise ValueError(how)
    year = F.year(F.to_date(F.col(fact_date)))
    span = cut_lineage(fact.agg(F.min(year).alias("__from"), F.max(year).alias("__to")))
    h = history.withColumnRenamed(key, "__hkey").crossJoin(F.broadcast(span))  # one row
    first, last = F.greatest(F.year("effective_date"), F.col("__from")), F.least(F.year("expiry_date"), F.col("__to"))
    h = h.filter(first <= last).withColumn("__year", F.explode(F.sequence(first, last))).drop("__from", "__to")
    day = F.to_date(F.col(fact_date))
    cond = (F.col(key) == F.col("__hkey")) & (year == F.col("__year")) & day.between(F.col("effective_date"), F.col("expiry_date"))
    return fact.join(h, cond).drop("__hkey", "__year")


# --------------------------------------------------------------------------- drill-across
def drill_across(facts: list[tuple[DataFrame, dict]], by: list[str]) -> DataFrame:
    """Aggregate each fact on the conformed attributes ``by`` separately,
    then full-join the small aggregates (never fact to fact)."""
    out = None
    for df, aggs in facts:
        a = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
        out = a if out is None else out.join(a, by, "full")
    return out
