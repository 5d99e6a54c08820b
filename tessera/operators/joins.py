"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_match(side: DataFrame, other: DataFrame, side_on: list[str], other_on: list[str]) -> DataFrame:
    """Rows of ``side`` whose key has no equal in ``other`` (a NULL key has
    none), found against the *distinct* keys of ``other``.

    Keys alone shrink to a few bytes a row in a shuffle, but the last step of
    the distinct and the two sorts take about a hundred in memory.  Adaptive
    execution merges partitions up to a number of shuffled bytes, so a task
    of this join would get many millions of rows.  ``side`` is therefore dealt
    by number, which keeps ``spark.sql.shuffle.partitions`` tasks; the join is
    then an outer one, as the optimizer moves an anti-join below the dealing.
    A join whose keys are small enough to be broadcast is not dealt."""
    keys = other.select(*[F.col(f"`{o}`").alias(f"__k{i}") for i, o in enumerate(other_on)]).distinct()
    conf = side.sparkSession._jsparkSession.sessionState().conf()
    stored = int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    same_types = [side.select(f"`{c}`").schema[0].dataType for c in side_on] == [f.dataType for f in keys.schema]
    dealt = stored > conf.autoBroadcastJoinThreshold() and same_types
    s_al = (side.repartition(conf.numShufflePartitions(), *[F.col(f"`{c}`") for c in side_on]) if dealt else side).alias("__s")
    cond = None
    for i, col in enumerate(side_on):
        c = F.col(f"__s.`{col}`") == F.col(f"__o.__k{i}")
        cond = c if cond is None else cond & c
    if dealt:
        kept = s_al.join(keys.alias("__o"), cond, "left").filter(F.col("__o.__k0").isNull())
    else:
        kept = s_al.join(keys.alias("__o"), cond, "left_anti")
    return kept.select(*[F.col(f"__s.`{c}`").alias(c) for c in side.columns])


def outer_join(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str], how: str = "left") -> DataFrame:
    """LEFT or FULL outer equi-join written so that a hot key on either side
    is split: matches come from an inner join (AQE skew handling splits
    both sides of an inner join, but not the non-preserved side of an outer
    join nor any side of a full join), and the unmatched rows of a side come
    from an anti-join against the *distinct* keys of the other side (the
    distinct is a partial aggregate, so a hot key is one row per map task;
    ``without_match``).  Unmatched rows are padded with NULLs; columns are
    those of both inputs (a name on both sides is taken from the left).
    Inputs may share lineage (both sides are aliased)."""
    if how not in ("left", "full"):
        raise ValueError(how)
    lf, rt = left.alias("__l"), right.alias("__r")
    cond = None
    for a, b in zip(left_on, right_on):
        c = F.col(f"__l.`{a}`") == F.col(f"__r.`{b}`")
        cond = c if cond is None else cond & c
    cols = left.columns + [c for c in right.columns if c not in left.columns]
    pick = [F.col(f"__l.`{c}`").alias(c) if c in left.columns else F.col(f"__r.`{c}`").alias(c) for c in cols]
    matched = lf.join(rt, cond, "inner").select(*pick)

    out = matched.unionByName(without_match(left, right, left_on, right_on), allowMissingColumns=True)
    if how == "full":
        r_only = without_match(right, left, right_on, left_on)
        # a column named on both sides holds the left value: NULL for right-only rows
        r_only = r_only.select(*[F.col(c) if c not in left.columns else F.lit(None).cast(r_only.schema[c].dataType).alias(c) for c in right.columns])
        out = out.unionByName(r_only, allowMissingColumns=True)
    return out.select(*cols)
