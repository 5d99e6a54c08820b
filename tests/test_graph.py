"""Graph operators on the fixture graphs (friendships, org chart, social and
books graphs)."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph

FRIENDS = [("Alice", "Bob"), ("Bob", "Charlie"), ("Charlie", "David"), ("Alice", "Eve"), ("Eve", "Frank"), ("Frank", "David")]


def _knows(spark, pairs=FRIENDS):
    e = spark.createDataFrame(pairs, "src string, dst string").withColumn("rel", F.lit("KNOWS"))
    names = sorted({x for p in pairs for x in p})
    n = spark.createDataFrame([(x, "Person") for x in names], "id string, label string")
    return graph.from_tables(n, e)


def _start(spark, name):
    return spark.createDataFrame([(name,)], "id string")


def test_all_simple_paths_alice_to_david(spark):
    _, e = _knows(spark)
    p = graph.expand(e, _start(spark, "Alice"), 1, 10, rel="KNOWS", unique="node").filter("end = 'David'")
    got = sorted((r.hops, ",".join(r.nodes)) for r in p.collect())
    assert got == [(3, "Alice,Bob,Charlie,David"), (3, "Alice,Eve,Frank,David")]


def test_exact_two_hops_and_suggestions(spark):
    _, e = _knows(spark)
    two = graph.expand(e, _start(spark, "Alice"), 2, 2, rel="KNOWS")
    assert sorted(r.end for r in two.collect()) == ["Charlie", "Frank"]
    sug = graph.suggest_links(e, _start(spark, "Alice"), rel="KNOWS")
    assert sorted(r.end for r in sug.collect()) == ["Charlie", "Frank"]


def test_org_chart_descendants(spark):
    tree = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (2, 5), (3, 6)], "src long, dst long").withColumn("rel", F.lit("MANAGES")).withColumn("eid", F.col("dst"))
    d = graph.descendants(tree, spark.createDataFrame([(1,)], "id long"), rel="MANAGES")
    assert sorted((r.id, r.depth) for r in d.collect()) == [(2, 1), (3, 1), (4, 2), (5, 2), (6, 2)]
    b = graph.expand(tree, spark.createDataFrame([(1,)], "id long"), 1, 1, rel="MANAGES")
    assert sorted(r.end for r in b.collect()) == [2, 3]


def test_descendants_end_on_a_cycle_and_have_no_depth_limit(spark):
    start = spark.createDataFrame([(1,)], "id long")
    cyc = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long").withColumn("rel", F.lit("R"))
    assert sorted((r.id, r.depth) for r in graph.descendants(cyc, start).collect()) == [(1, 3), (2, 1), (3, 2)]
    chain = spark.range(1, 301).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit("R").alias("rel"))
    deep = graph.descendants(chain, start)
    assert sorted((r.id, r.depth) for r in deep.collect()) == [(i + 1, i) for i in range(1, 301)]


def test_parallel_edges_stay_apart(spark):
    e = spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "src long, dst long").withColumn("rel", F.lit("R"))
    nodes = spark.createDataFrame([(1, "N"), (2, "N")], "id long, label string")
    _, e = graph.from_tables(nodes, e)
    p = graph.expand(e, spark.createDataFrame([(1,)], "id long"), 3, 3)
    assert [(r.end, len(set(r.eids))) for r in p.collect()] == [(2, 3), (2, 3)]


def test_paths_to_targets_are_the_filtered_paths(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(9), rng.randrange(9)) for _ in range(22)]
    e = spark.createDataFrame(pairs, "src long, dst long").withColumn("rel", F.lit("R"))
    start, target = spark.createDataFrame([(0,)], "id long"), spark.createDataFrame([(5,), (5,)], "id long")
    for unique in ("node", "edge"):
        every = graph.expand(e, start, 1, 5, unique=unique).filter("end = 5")
        pruned = graph.expand(e, start, 1, 5, unique=unique, targets=target)
        assert sorted(r.nodes for r in every.collect()) == sorted(r.nodes for r in pruned.collect())


def test_edge_unique_allows_revisits_node_unique_does_not(spark):
    # 3-cycle plus a tail; edge-unique paths may come back to the start
    _, e = _knows(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d")])
    s = _start(spark, "a")
    edge = {tuple(r.nodes) for r in graph.expand(e, s, 1, 6, unique="edge").collect()}
    node = {tuple(r.nodes) for r in graph.expand(e, s, 1, 6, unique="node").collect()}
    assert node <= edge
    assert ("a", "b", "c", "a", "d") in edge and ("a", "b", "c", "a", "d") not in node
    assert max(len(p) for p in edge) == 5  # every edge used at most once


def test_parallel_edges_and_self_loop(spark):
    e = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("b", "b", 3)], "src string, dst string, eid long").withColumn("rel", F.lit("R"))
    p = graph.expand(e, _start(spark, "a"), 1, 3, unique="edge")
    # two parallel first hops, each may take the self-loop once
    assert sorted((r.hops, len(r.eids)) for r in p.collect()) == [(1, 1), (1, 1), (2, 2), (2, 2)]


BOOKS_NODES = [
    ("asimov", "Author", "Isaac Asimov"), ("gibson", "Author", "William Gibson"), ("clarke", "Author", "Arthur C. Clarke"),
    ("foundation", "Book", "Foundation"), ("irobot", "Book", "I, Robot"), ("neuro", "Book", "Neuromancer"),
    ("rama", "Book", "Rendezvous with Rama"), ("russia", "Country", "Russia"), ("uk", "Country", "United Kingdom"),
    ("scifi", "Genre", "Science Fiction"), ("robots", "Topic", "Robots"), ("cyber", "Topic", "Cyberspace"),
]
BOOKS_EDGES = [
    ("asimov", "foundation", "WROTE"), ("asimov", "irobot", "WROTE"), ("gibson", "neuro", "WROTE"), ("asimov", "russia", "BORN_IN"),
    ("foundation", "scifi", "IN_GENRE"), ("irobot", "scifi", "IN_GENRE"), ("neuro", "scifi", "IN_GENRE"),
    ("asimov", "gibson", "INFLUENCED"), ("neuro", "irobot", "CITES"), ("clarke", "uk", "BORN_IN"), ("clarke", "rama", "WROTE"),
    ("rama", "scifi", "IN_GENRE"), ("irobot", "robots", "HAS_TOPIC"), ("neuro", "cyber", "HAS_TOPIC"),
]


def _books(spark):
    n = spark.createDataFrame(BOOKS_NODES, "id string, label string, name string")
    e = spark.createDataFrame(BOOKS_EDGES, "src string, dst string, rel string")
    return graph.from_tables(n, e)


def test_shortest_connection_asimov_gibson(spark):
    _, e = _books(spark)
    p = graph.shortest_path(e, "asimov", "gibson", 4).collect()
    assert [(list(r.nodes), r.hops) for r in p] == [(["asimov", "gibson"], 1)]
    none = graph.shortest_path(e, "asimov", "nowhere", 4).collect()
    assert none == []


def test_shortest_path_tie_break_is_deterministic(spark):
    _, e = _knows(spark)
    p = graph.shortest_path(e, "Alice", "David", 4).first()
    assert p.hops == 3 and list(p.nodes) in (["Alice", "Bob", "Charlie", "David"], ["Alice", "Eve", "Frank", "David"])
    assert list(p.nodes) == ["Alice", "Bob", "Charlie", "David"]  # smallest predecessors


def test_neighbourhood_of_neuromancer(spark):
    n, e = _books(spark)
    ctx = graph.neighbourhood(n, e, "neuro", 1, 2)
    names = sorted(r.name for r in ctx.collect())
    assert names == sorted(["William Gibson", "Science Fiction", "I, Robot", "Cyberspace", "Isaac Asimov", "Foundation", "Rendezvous with Rama", "Robots"])


def test_typed_chain_and_collect(spark):
    n, e = _books(spark)
    russia = n.filter("name = 'Russia'").select("id")
    authors = graph.hop(russia, e, rel="BORN_IN", direction="in").select(F.col("nbr").alias("id"))
    books = graph.hop(authors, e, rel="WROTE").select(F.col("nbr").alias("id"))
    sf = graph.hop(books, e, rel="IN_GENRE").filter("nbr = 'scifi'").select("id")
    titles = sorted(r.name for r in sf.join(n, "id").collect())
    assert titles == ["Foundation", "I, Robot"]
    bundle = graph.hop(n.filter("name = 'Isaac Asimov'").select("id"), e, rel="WROTE").groupBy("id").agg(F.count(F.lit(1)).alias("c")).first()
    assert bundle.c == 2


def test_label_inventory_and_link(spark):
    n, e = _books(spark)
    inv = {(r.kind, r.name): r.num for r in graph.label_inventory(n, e).collect()}
    assert inv[("vertex", "Book")] == 4 and inv[("edge", "WROTE")] == 4
    pairs = spark.createDataFrame([("Isaac Asimov", "Russia")], "author string, country string")
    made = graph.link(pairs, n, ("Author", "name", "author"), ("Country", "name", "country"), "BORN_IN").collect()
    assert [(r.src, r.dst, r.rel) for r in made] == [("asimov", "russia", "BORN_IN")]


def test_converge_counts_without_pairs(spark):
    e = spark.createDataFrame(
        [("hanks", "m1", "ACTED_IN"), ("ryan", "m1", "ACTED_IN"), ("ephron", "m1", "DIRECTED"), ("ephron", "m2", "DIRECTED")],
        "src string, dst string, rel string",
    )
    got = {r.b: r.num_matches for r in graph.converge_counts(e, "ACTED_IN", "DIRECTED").collect()}
    assert got == {"ephron": 2}


def test_recursive_sql_equals_frontier_loop(spark):
    """Spark SQL's WITH RECURSIVE and the checkpointed frontier loop give the
    same descendants on the place tree of the smallest driver tables."""
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    from tessera.plans.graph_queries import tree_edges
    from tessera.sources.tables import Tables

    t = Tables(spark, sf)
    tree_edges(t).createOrReplaceTempView("place_tree")
    rec = spark.sql(
        """
        WITH RECURSIVE sub(id, depth) AS (
          SELECT dst, 1 FROM place_tree WHERE src = 13
          UNION ALL SELECT t.dst, s.depth + 1 FROM place_tree t JOIN sub s ON t.src = s.id
        )
        SELECT id, depth FROM sub
        """
    )
    loop = graph.descendants(tree_edges(t), spark.createDataFrame([(13,)], "id long"), rel="HAS")
    assert sorted(map(tuple, rec.collect())) == sorted(map(tuple, loop.collect()))


def _random_edges(spark, rng, nodes, count):
    pairs = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(count)]
    return pairs, spark.createDataFrame(pairs, "src long, dst long").withColumn("rel", F.lit("R"))


@pytest.mark.parametrize("seed", range(4))
def test_routes_meet_in_the_middle(spark, seed):
    """Several starts and targets, also equal ones, on graphs with cycles and
    parallel edges, with and without a bound, against plain enumeration."""
    rng = random.Random(seed)
    pairs, e = _random_edges(spark, rng, 7, 12)
    unique, hi = ("edge", "node")[seed % 2], (None, 6)[seed // 2]
    starts, targets = {0, 1}, {5, 0}
    want = []

    def walk(start, at, nodes, used):
        if used and at in targets:
            want.append(tuple(nodes))
        if hi is None or len(used) < hi:
            for i, (s, d) in enumerate(pairs):
                if s == at and i not in used and (unique == "edge" or d not in nodes):
                    walk(start, d, [*nodes, d], used | {i})

    for s in starts:
        walk(s, s, [s], frozenset())
    ids = [spark.createDataFrame([(x,) for x in sorted(side)], "id long") for side in (starts, targets)]
    got = graph.expand(e, ids[0], 1, hi, unique=unique, targets=ids[1]).collect()
    assert sorted(tuple(r.nodes) for r in got) == sorted(want) and all(len(r.nodes) == r.hops + 1 == len(r.eids) + 1 for r in got)


def test_shortest_path_from_both_ends(spark):
    """Length and tie rule against a one-sided search, both directions."""
    rng = random.Random(7)
    for direction, nodes, count in (("out", 14, 24), ("both", 16, 20), ("in", 10, 16)):
        pairs, e = _random_edges(spark, rng, nodes, count)
        along = {"out": pairs, "in": [(d, s) for s, d in pairs], "both": pairs + [(d, s) for s, d in pairs]}[direction]
        for goal, bound in ((nodes - 1, 6), (nodes - 2, 3), (0, 3)):
            parent, level, frontier = {}, {0: 0}, [0]
            while frontier:
                step = {}
                for s, d in along:
                    if s in frontier and d not in level:
                        step[d] = min(step.get(d, s), s)
                parent |= step
                level |= dict.fromkeys(step, level[frontier[0]] + 1)
                frontier = sorted(step)
            want = [goal]
            while goal in level and want[0] != 0:
                want.insert(0, parent[want[0]])
            found = graph.shortest_path(e, 0, goal, bound, direction=direction).collect()
            assert [(r.nodes, r.hops) for r in found] == ([(want, level[goal])] if level.get(goal, 99) <= bound else [])


def _walk_depths(pairs, roots):
    out = []

    def walk(at, depth, used):
        for i, (s, d) in enumerate(pairs):
            if s == at and i not in used:
                out.append((d, depth + 1))
                walk(d, depth + 1, used | {i})

    for r in roots:
        walk(r, 0, frozenset())
    return sorted(out)


def test_descendants_of_forests_by_doubling(spark, monkeypatch):
    rng = random.Random(3)
    forest = [(rng.randrange(max(0, i - 9), i), i) for i in range(1, 60) if i % 13]
    e = spark.createDataFrame(forest, "src long, dst long").withColumn("rel", F.lit("R"))
    monkeypatch.setattr(graph, "expand", None)  # no walk
    for roots in ({0}, {0, 3, 13, 14, 999}, {59}):
        got = graph.descendants(e, spark.createDataFrame([(r,) for r in roots] * 2, "id long"))
        assert sorted(map(tuple, got.collect())) == _walk_depths(forest, roots)


def test_descendants_below_a_circle(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (2, 4), (4, 5)]
    e = spark.createDataFrame(pairs, "src long, dst long").withColumn("rel", F.lit("R"))
    for roots in ({1}, {1, 2}, {4}):
        got = graph.descendants(e, spark.createDataFrame([(r,) for r in roots], "id long"))
        assert sorted(map(tuple, got.collect())) == _walk_depths(pairs, roots)


def test_suggestions_for_all_nodes(spark):
    """Against all pairs, with a hub that a third of all edges meet at, and links
    that use up the first blocks."""
    rng = random.Random(5)
    first = {(rng.randrange(60), rng.randrange(100, 130)) for _ in range(150)} | {(a, 100) for a in range(60)}
    second = {(rng.randrange(100, 130), rng.randrange(60)) for _ in range(150)} | {(100, c) for c in range(0, 60, 2)}
    degree = {}
    for _, c in second:
        degree[c] = degree.get(c, 0) + 1
    popular = sorted(degree, key=lambda c: (-degree[c], c))
    linked = {(a, c) for a in range(0, 60, 3) for c in popular[:12]} | {(7, c) for c in range(60)}
    frames = [spark.createDataFrame(sorted(x) * 2, names) for x, names in ((first, "src long, dst long"), (second, "src long, dst long"), (linked, "start long, end long"))]
    for k, known in ((3, linked), (5, set())):
        want = set()
        for a in {a for a, _ in first}:
            ends = {c for x, m in first if x == a for n, c in second if n == m} - {a} - {c for x, c in known if x == a}
            want |= {(a, c, degree[c], i + 1) for i, c in enumerate(sorted(ends, key=lambda c: (-degree[c], c))[:k])}
        got = graph.suggest_top(frames[0], frames[1], k, frames[2] if known else None)
        assert {tuple(r) for r in got.collect()} == want
    assert graph.suggest_top(frames[0].limit(0), frames[1], 3).count() == 0
