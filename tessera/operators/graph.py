"""Property-graph queries on two DataFrames.

``nodes(id, label, ...properties)`` and ``edges(eid, src, dst, rel,
...properties)``.  Pattern matches are joins; variable-length patterns are
frontier loops: a level joins the current frontier with the edge table, the
new paths are written to the shared checkpoint folder (lineage stays one level
deep, a lost executor recomputes one level only), and the loop stops when the
frontier is empty or the bound is reached.  The driver loop runs once per
level, never per row.

Semantics (results are bags, one row per match):
* ``unique="edge"`` — Cypher: a path never reuses an edge, nodes may repeat;
* ``unique="node"`` — the recursive-SQL form: a path never revisits a node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_counted, cut_table
from .keys import number_rows


# --------------------------------------------------------------------------- building
def from_tables(nodes: DataFrame, edges: DataFrame, node_id: str = "id", label: str = "label",
                src: str = "src", dst: str = "dst", rel: str = "rel", eid: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Standardise column names.  ``eid`` names a column that is unique per
    edge; without one, a traversal numbers the edges when it stores them, so
    parallel edges stay apart."""
    n = nodes.withColumnRenamed(node_id, "id").withColumnRenamed(label, "label")
    e = edges.withColumnRenamed(src, "src").withColumnRenamed(dst, "dst").withColumnRenamed(rel, "rel")
    return n, e if eid is None else e.withColumnRenamed(eid, "eid")


def link(pairs: DataFrame, nodes: DataFrame, src: tuple[str, str, str], dst: tuple[str, str, str], rel: str) -> DataFrame:
    """``MATCH (a:L1 {p: x}), (b:L2 {q: y}) CREATE (a)-[:rel]->(b)`` for every
    (x, y) in ``pairs``.  ``src``/``dst`` are (label, node property, pair
    column).  Both lookups are equi-joins on the property value."""
    (sl, sp, sc), (dl, dp, dc) = src, dst
    a = nodes.filter(F.col("label") == sl).select(F.col("id").alias("src"), F.col(sp).alias(sc))
    b = nodes.filter(F.col("label") == dl).select(F.col("id").alias("dst"), F.col(dp).alias(dc))
    return pairs.join(a, sc).join(b, dc).select("src", "dst", F.lit(rel).alias("rel"))


def label_inventory(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Which vertex labels and edge types exist, with counts."""
    v = nodes.groupBy(F.col("label").alias("name")).agg(F.count(F.lit(1)).alias("num")).withColumn("kind", F.lit("vertex"))
    e = edges.groupBy(F.col("rel").alias("name")).agg(F.count(F.lit(1)).alias("num")).withColumn("kind", F.lit("edge"))
    return v.unionByName(e).select("name", "kind", "num")


def typed(edges: DataFrame, rel=None) -> DataFrame:
    """(eid, src, dst) of the edges of type ``rel`` (a name, a list, or all);
    without an edge id (src, dst)."""
    e = edges
    if rel is not None:
        rels = [rel] if isinstance(rel, str) else list(rel)
        e = e.filter(F.col("rel").isin(*rels))
    return e.select(F.col("eid").cast("long").alias("eid"), "src", "dst") if "eid" in e.columns else e.select("src", "dst")


def stored(edges: DataFrame, rel=None) -> DataFrame:
    """The edges of a traversal as a table (read at every level; filters reach
    its scan), with an id per edge."""
    e = typed(edges, rel)
    return cut_table(e if "eid" in e.columns else e.withColumn("eid", F.monotonically_increasing_id()).select("eid", "src", "dst"))


def _materialised(edges: DataFrame, rel, direction: str) -> DataFrame:
    return oriented(stored(edges, rel), None, direction)


def oriented(edges: DataFrame, rel=None, direction: str = "out") -> DataFrame:
    """Edges as (eid, src, dst) for traversal: typed (``rel`` a name or list),
    reversed for ``in``, both ways for ``both`` (each copy keeps its eid so
    edge-uniqueness still holds)."""
    fwd = typed(edges, rel)
    rev = fwd.select(*[c for c in fwd.columns if c == "eid"], F.col("dst").alias("src"), F.col("src").alias("dst"))
    if direction == "out":
        return fwd
    if direction == "in":
        return rev
    if direction == "both":
        return fwd.unionByName(rev)
    raise ValueError(direction)


# --------------------------------------------------------------------------- fixed patterns
def hop(frontier: DataFrame, edges: DataFrame, at: str = "id", rel=None, direction: str = "out", to: str = "nbr") -> DataFrame:
    """One typed hop from the ``at`` column of ``frontier``: adds ``to``."""
    e = oriented(edges, rel, direction).select(F.col("src").alias(at), F.col("dst").alias(to))
    return frontier.join(e, at)


def converge_counts(edges: DataFrame, rel_a: str, rel_b: str) -> DataFrame:
    """Count matches of ``(a)-[:rel_a]->(m)<-[:rel_b]-(b)`` per ``b``.

    The pattern's matches are all (a, b) pairs around each middle node; the
    count per ``b`` is the sum over its middle nodes of the number of ``a``s,
    so it is computed from per-middle-node counts without emitting the
    pairs (a hub middle node costs one row, not a product)."""
    a_per_m = edges.filter(F.col("rel") == rel_a).groupBy(F.col("dst").alias("m")).agg(F.count(F.lit(1)).alias("na"))
    b_m = edges.filter(F.col("rel") == rel_b).select(F.col("src").alias("b"), F.col("dst").alias("m"))
    return b_m.join(a_per_m, "m").groupBy("b").agg(F.sum("na").alias("num_matches"))


# --------------------------------------------------------------------------- variable length
def _grow(frontier: DataFrame, e: DataFrame, unique: str) -> DataFrame:
    """Paths one edge longer; ``e`` has (eid, end, dst)."""
    j = frontier.join(e, "end")
    fresh = ~F.array_contains("nodes", F.col("dst")) if unique == "node" else ~F.array_contains("eids", F.col("eid"))
    return j.filter(fresh).select(
        "start",
        F.col("dst").alias("end"),
        F.array_append("nodes", F.col("dst")).alias("nodes"),
        F.array_append("eids", F.col("eid")).alias("eids"),
        (F.col("hops") + 1).alias("hops"),
    )


def _seeds(ids: DataFrame) -> DataFrame:
    """Paths of no edge."""
    none = F.array().cast("array<long>").alias("eids")
    return ids.select(F.col("id").alias("start"), F.col("id").alias("end"), F.array("id").alias("nodes"), none, F.lit(0).alias("hops"))


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def expand(edges: DataFrame, starts: DataFrame, lo: int = 1, hi: int | None = None, rel=None, direction: str = "out",
           unique: str = "edge", targets: DataFrame | None = None) -> DataFrame:
    """Variable-length pattern ``(s)-[*lo..hi]->(x)`` from the ``id``s in
    ``starts``: one row per path with ``start``, ``end``, ``nodes`` (node ids
    in path order), ``eids`` and ``hops``.

    ``hi=None`` is the unbounded pattern: it ends when no path can grow, which
    the uniqueness rule guarantees, also on cycles.  With ``targets`` (ids)
    only paths that end there are given, found by ``paths_between``."""
    if unique not in ("edge", "node"):
        raise ValueError(unique)
    e = _materialised(edges, rel, direction)
    if targets is not None:
        return paths_between(e, starts, targets, lo, hi, unique)
    e = e.withColumnRenamed("src", "end")
    frontier, out, h = _seeds(starts), [], 0
    while hi is None or h < hi:
        h += 1
        frontier = _grow(frontier, e, unique)
        if h == hi:  # the last level is read once
            out.append(frontier)
            break
        frontier, count = cut_counted(frontier)
        if not count:
            break
        out.append(frontier)
    return _all(out).filter(F.col("hops") >= lo) if out else frontier.limit(0)


def paths_between(e: DataFrame, starts: DataFrame, targets: DataFrame, lo: int, hi: int | None, unique: str) -> DataFrame:
    """All paths from ``starts`` to ``targets`` along ``e`` (eid, src, dst; a
    table that is read at every level), met in the middle.

    Half paths grow forward from the starts and backward from the targets,
    each time on the side whose last level has fewer; the halves of a path are
    joined on the node where they meet, if together they still use no edge (no
    node) twice.  A path no longer than the forward levels is found whole
    there, a longer one by the last forward level and the rest backward, so
    each is found once.  A side that cannot grow ends the search: it holds
    halves as long as any path."""
    sides = [e.select("eid", F.col("src").alias("end"), "dst"), e.select("eid", F.col("dst").alias("end"), F.col("src").alias("dst"))]
    seeds = [cut_counted(_seeds(side)) for side in (starts, targets.distinct())]
    levels, counts = [[table] for table, _ in seeds], [count for _, count in seeds]
    while min(counts) and (hi is None or len(levels[0]) + len(levels[1]) - 2 < hi):
        side = int(counts[1] < counts[0])
        grown, counts[side] = cut_counted(_grow(levels[side][-1], sides[side], unique))
        if counts[side]:
            levels[side].append(grown)
    whole, back = _all(levels[0]), _all(levels[1])
    back = back.select("end", F.col("start").alias("goal"), F.col("nodes").alias("b_nodes"), F.col("eids").alias("b_eids"), F.col("hops").alias("b_hops"))
    both = whole.join(back, "end").filter((F.col("b_hops") == 0) | (F.col("hops") == len(levels[0]) - 1))
    if unique == "node":
        both = both.filter(F.size(F.array_intersect("nodes", "b_nodes")) == 1)
    else:
        both = both.filter(~F.arrays_overlap("eids", "b_eids"))
    nodes = F.concat("nodes", F.slice(F.reverse("b_nodes"), F.lit(2), F.col("b_hops")))
    both = both.select("start", F.col("goal").alias("end"), nodes.alias("nodes"), F.concat("eids", F.reverse("b_eids")).alias("eids"), (F.col("hops") + F.col("b_hops")).alias("hops"))
    return both.filter(F.col("hops") >= max(lo, 1))


def descendants(edges: DataFrame, roots: DataFrame, rel=None, direction: str = "out") -> DataFrame:
    """``(root)-[*]->(x)``: all nodes below ``roots`` (column ``id``) with their
    depth, one row per path.  No depth limit.

    Where every node has one parent at most and no circle is met, depths come
    from pointer doubling (log2(depth) joins); else from the walk along the
    edges, in which a path uses an edge once, so cycles end."""
    parents = oriented(edges, rel, direction).select(F.col("dst").alias("id"), F.col("src").alias("at"))
    found = _tree_depths(parents, roots.select("id").distinct())
    if found is not None:
        return found
    p = expand(edges, roots, 1, None, rel=rel, direction=direction, unique="edge")
    return p.select(F.col("end").alias("id"), F.col("hops").alias("depth"))


def _tree_depths(parents: DataFrame, roots: DataFrame) -> DataFrame | None:
    """(id, depth) below ``roots`` from (id, at = a parent).  A round replaces each
    node's pointer by its target's own, until it stands on a root or runs off
    the top.  None where a node has several parents or there is a circle."""
    parents = parents.groupBy("id").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("parents"))
    at_root = roots.select(F.col("id").alias("at"), F.lit(True).alias("hit"))
    up, count = cut_counted(parents.join(at_root, "at", "left").select("id", "at", F.lit(1).cast("long").alias("depth"), F.coalesce("hit", F.lit(False)).alias("hit"), "parents"))
    if not up.where("parents > 1").isEmpty():
        return None
    up = up.drop("parents")
    left = count.bit_length() + 1  # rounds after which a pointer has left any chain
    while not up.where("not hit").isEmpty():
        if not left:
            return None
        onward = up.select(F.col("id").alias("at"), F.col("at").alias("to"), F.col("depth").alias("more"), F.col("hit").alias("there"))
        moved = up.where("not hit").join(onward, "at").select("id", F.col("to").alias("at"), (F.col("depth") + F.col("more")).alias("depth"), F.col("there").alias("hit"))
        up, left = cut_table(up.where("hit").unionByName(moved)), left - 1
    # a root below another root: what is below it is below both
    over, left = cut_counted(up.join(roots, "id", "left_semi").select(F.col("id").alias("at"), F.col("at").alias("to"), F.col("depth").alias("more")))
    found, further = [up], up
    if not left:
        return up.select("id", F.col("depth").cast("int").alias("depth"))
    while left >= 0:
        further, count = cut_counted(further.join(over, "at").select("id", F.col("to").alias("at"), (F.col("depth") + F.col("more")).alias("depth"), "hit"))
        if not count:
            return _all(found).select("id", F.col("depth").cast("int").alias("depth"))
        found.append(further)
        left -= 1
    return None


def reached(edges: DataFrame, starts: DataFrame, lo: int, hi: int, rel=None, direction: str = "out") -> DataFrame:
    """Distinct (start, end) of ``(s)-[*lo..hi]-(x)``.  For ``lo`` up to 1 a level
    keeps one row per (start, node, last edge) instead of every path, so a
    hub does not multiply the work; a longer walk that comes back over an
    edge ends where a shorter one did."""
    if lo > 1:
        return expand(edges, starts, lo, hi, rel, direction).select("start", "end").distinct()
    e = oriented(edges, None, direction).withColumnRenamed("src", "end")
    frontier = starts.select(F.col("id").alias("start"), F.col("id").alias("end"), F.lit(None).cast("long").alias("last"))
    out = None
    for _ in range(hi):
        step = frontier.join(e, "end").filter(~F.col("eid").eqNullSafe(F.col("last")))
        frontier = step.select("start", F.col("dst").alias("end"), F.col("eid").alias("last")).distinct()
        out = frontier.select("start", "end") if out is None else out.unionByName(frontier.select("start", "end"))
    return out.distinct()


def suggest_links(edges: DataFrame, anchors: DataFrame, rel=None) -> DataFrame:
    """Friends-of-friends: nodes within 1..2 hops of each anchor, not the
    anchor itself, not already linked to it; distinct (anchor, candidate)."""
    e = stored(edges, rel)
    direct = e.join(anchors.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("src").alias("start"), F.col("dst").alias("end")).distinct()
    cand = reached(e, anchors, 1, 2).filter(F.col("end") != F.col("start"))
    return cand.join(direct, ["start", "end"], "left_anti")


def suggest_top(first: DataFrame, second: DataFrame, k: int, linked: DataFrame | None = None) -> DataFrame:
    """For every start of ``first`` (src, dst) its ``k`` best ends two hops away
    over ``second`` (src, dst): (start, end, degree, rank).  The best ends are
    those that most different edges of ``second`` lead to, then the smallest; the
    start itself and pairs of ``linked`` (start, end) are left out.

    A middle node's ends stand in one order for all who come by, so each edge
    into it needs only the first few of them: they are handed out in blocks of
    ``k``, and an edge gets a further block only while its start has rejected
    some.  A hub of d edges thus gives d * k rows and not d * d, and no node's
    ends are gathered in one task: their places come from a numbering of all."""
    first, second = first.select("src", "dst").distinct(), cut_table(second.select("src", "dst").distinct())
    degree = second.groupBy("dst").agg(F.count(F.lit(1)).alias("degree"))
    ends = second.join(degree, "dst").select(F.col("src").alias("mid"), (-F.col("degree")).alias("less"), F.col("dst").alias("end"))
    ends = cut_table(number_rows(ends, ["mid", "less", "end"], "no"))
    base = ends.groupBy("mid").agg(F.min("no").alias("base"), F.count(F.lit(1)).alias("size"))
    ends = ends.join(base, "mid").withColumn("block", F.expr(f"(no - base) div {k}"))
    blocks = ends.groupBy("mid", "block").agg(F.collect_list(F.struct("less", "end")).alias("ends"))
    blocks = cut_table(blocks.join(base.select("mid", "size"), "mid"))
    zero = F.lit(0).cast("long")
    asking, found = first.select(F.col("src").alias("start"), F.col("dst").alias("mid"), zero.alias("block"), zero.alias("held")), []
    while True:
        given = asking.join(blocks, ["mid", "block"])
        each = given.select("start", "mid", "block", "held", "size", F.explode("ends").alias("e")).select("start", "mid", "block", "held", "size", "e.less", "e.end")
        if linked is not None:
            each = each.join(linked.select("start", "end", F.lit(True).alias("known")).distinct(), ["start", "end"], "left")
        known = F.coalesce("known", F.lit(False)) if linked is not None else F.lit(False)
        taken, count = cut_counted(each.withColumn("good", ~known & (F.col("end") != F.col("start"))))
        if not count:
            break
        found.append(taken.where("good").select("start", "end", "less"))
        more = taken.groupBy("start", "mid", "block").agg(F.max("held").alias("held"), F.max("size").alias("size"), F.sum(F.col("good").cast("long")).alias("got"))
        more = more.withColumn("held", F.col("held") + F.col("got")).where((F.col("held") < k) & ((F.col("block") + 1) * k < F.col("size")))
        asking = cut_table(more.select("start", "mid", (F.col("block") + 1).alias("block"), "held"))
    none = asking.select("start", F.col("mid").alias("end"), F.lit(0).cast("long").alias("less")).limit(0)
    order = Window.partitionBy("start").orderBy("less", "end")
    ranked = _all([none, *found]).distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("start", "end", (-F.col("less")).alias("degree"), "rank")


def shortest_path(edges: DataFrame, a, b, max_hops: int, rel=None, direction: str = "both") -> DataFrame:
    """One shortest path from ``a`` to ``b`` of at most ``max_hops`` edges.

    Breadth-first from both ends, each time on the side whose last level has
    fewer nodes, until the last levels share a node; so a hub near one end
    is not expanded when the other end is nearer.  A level is one join of the
    last one with the edges, reduced to a row per node with its smallest
    predecessor, and an anti-join with the side's earlier levels; nothing
    enumerates paths.  Of several shortest paths the one is given whose nodes,
    read from ``b``, are the smallest possible predecessors.  No path within the
    bound: no row.
    """
    e = _materialised(edges, rel, direction)
    kind = e.schema["src"].dataType
    sides = [e.select(F.col("src").alias("parent"), F.col("dst").alias("id")), e.select(F.col("dst").alias("parent"), F.col("src").alias("id"))]
    row = edges.sparkSession.range(1)
    levels = [[row.select(F.lit(x).cast(kind).alias("id"), F.lit(None).cast(kind).alias("parent"))] for x in (a, b)]
    counts, met = [1, 1], levels[0][0].select("id").where(F.col("id") == F.lit(b).cast(kind))
    found = a == b
    while not found and min(counts) and len(levels[0]) + len(levels[1]) - 2 < max_hops:
        side = int(counts[1] < counts[0])
        mine, other = levels[side], levels[1 - side]
        near = mine[-1].select(F.col("id").alias("parent")).join(sides[side], "parent").groupBy("id").agg(F.min("parent").alias("parent"))
        # a level's neighbours lie on the level before, on itself or beyond, if edges go both ways
        grown, counts[side] = cut_counted(near.join(_all([lv.select("id") for lv in mine]), "id", "left_anti"))
        mine.append(grown)
        met = grown.select("id").join(other[-1].select("id"), "id")
        found = not met.isEmpty()
    if not found:
        return row.select(F.array(F.lit(b).cast(kind)).alias("nodes"), F.lit(0).alias("hops")).limit(0)
    # from where the sides meet on to b, over the nodes of b's levels that lie on a shortest path
    chain, on = [], cut_table(met)
    for level in reversed(levels[1][:-1]):
        step = on.select(F.col("id").alias("parent")).join(sides[0], "parent").join(level.select("id"), "id", "left_semi")
        on = cut_table(step.groupBy("id").agg(F.min("parent").alias("parent")))
        chain.insert(0, on)
    path = row.select(F.array(F.lit(b).cast(kind)).alias("nodes"))
    for lv in [*chain, *reversed(levels[0][1:])]:
        path = path.withColumn("id", F.get("nodes", F.lit(0))).join(lv, "id").select(F.array_prepend("nodes", F.col("parent")).alias("nodes"))
    return path.select("nodes", F.lit(len(levels[0]) + len(levels[1]) - 2).alias("hops"))


def neighbourhood(nodes: DataFrame, edges: DataFrame, start, lo: int = 1, hi: int = 2, rel=None) -> DataFrame:
    """``(s)-[*lo..hi]-(ctx) RETURN DISTINCT label(ctx), ctx``: undirected,
    edge-unique, anchored at node ``start``."""
    spark = edges.sparkSession
    id_type = nodes.schema["id"].dataType
    s = spark.range(1).select(F.lit(start).cast(id_type).alias("id"))
    ends = reached(stored(edges, rel), s, lo, hi, direction="both").select(F.col("end").alias("id"))
    return nodes.join(ends, "id", "left_semi")


def path_text(c: Column, sep: str = ",") -> Column:
    """Node-id array as text (for display and oracle comparison)."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)
