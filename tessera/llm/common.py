"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A word: a run of characters that are not ASCII white space (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: What separates words (fixed value).
GAP = r"[\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, _UPPER, _LOWER)


def word_count(text: Column) -> Column:
    """Words in ``text`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: Column) -> Column:
    """Array of the words of ``text`` (null: empty)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def shuffled_index(i: Column, n: Column, *key: Column, rounds: int = 12) -> Column:
    """Pseudorandom permutation of [0, n) applied to ``i``: a swap-or-not
    shuffle, whose every round pairs x with (k - x) mod n and swaps the pair on
    a hash bit of its larger member.  ``key`` picks the permutation.  It is a
    bijection for every n, so no rank or sort over the indexes is needed."""

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        bit = F.xxhash64(*key, r, F.greatest(x, other)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(x)

    turns = F.array(*[F.lit(r) for r in range(rounds)])
    return F.aggregate(turns, i.cast("long"), swap)


def kth_largest(counts: DataFrame, k: int) -> tuple[int, float]:
    """The k-th largest n of ``counts`` (.., n), and the share of the rows of
    just that n which are among the k.  They are read off the histogram of n
    (a row for each different count), so no task orders rows of all others."""
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("rows"))
    so_far = F.sum("rows").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1))
    upto = histogram.withColumn("so_far", F.coalesce(so_far, F.lit(0))).where(F.col("so_far") < k)
    last = upto.agg(F.min(F.struct("n", "rows", "so_far")).alias("m")).first().m
    return (0, 1.0) if last is None else (last.n, min(1.0, (k - last.so_far) / last.rows))


#: Edges for one task of a component round.
EDGES_PER_TASK = 50_000


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the smallest node
    reachable.

    Each round hangs every node's larger neighbours below its smallest one
    (large star), then its smaller neighbours and itself (small star); both
    are a partial ``min`` per node and an equi-join, so a hub is pre-aggregated
    and its join partition can be split.  Rounds end when no edge changes;
    each is checkpointed to the shared folder, in as many tasks as the edges
    need.  ``max_rounds`` guards against a defect only: the rounds needed grow
    with the logarithm of the longest chain, and running out raises an error
    instead of returning part."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e = cut_lineage(e)
    before, tasks = None, 1 + e.count() // EDGES_PER_TASK
    for _ in range(max_rounds):
        e = e.coalesce(tasks)
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").coalesce(tasks).distinct().coalesce(tasks)
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.union(down.select("u", F.col("m").alias("v"))).where("u <> v").coalesce(tasks).distinct()
        e = cut_lineage(e.coalesce(tasks))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
