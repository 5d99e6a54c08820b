"""Property tests: operators against brute force on random small inputs."""

import datetime as dt
from collections import deque

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import changes, graph, layers, star
from tessera.operators.keys import number_rows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.sets(st.integers(-1000, 1000), min_size=0, max_size=60))
def test_number_rows_is_rank(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = sorted((r.k, r.n) for r in number_rows(df, ["k"], "n").collect())
    assert got == [(k, i + 1) for i, k in enumerate(sorted(keys))]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 50), st.integers(0, 9)), max_size=30))
def test_upsert_replace_last_wins(spark, rows):
    batch = spark.createDataFrame(rows, "_id string, seq int, v int") if rows else spark.createDataFrame([], "_id string, seq int, v int")
    store = spark.createDataFrame([("a", 100, -1), ("z", 0, -2)], "_id string, seq int, v int")
    got = {r._id: (r.seq, r.v) for r in changes.upsert_replace(store, batch, "_id", "seq").collect()}
    want = {"a": (100, -1), "z": (0, -2)}
    best = {}
    for k, s, v in rows:
        if k not in best or (s, v) > best[k]:
            best[k] = (s, v)
    want.update(best)
    assert got == want


DAY = dt.date(2024, 1, 1)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(0, 20), st.sampled_from(["x", "y", None])), max_size=12))
def test_scd2_apply_invariants(spark, changes_):
    dim = spark.createDataFrame(
        [("k1", "x", DAY - dt.timedelta(days=100), star.OPEN_END, True), ("k2", None, DAY - dt.timedelta(days=100), star.OPEN_END, True)],
        "k string, v string, effective_date date, expiry_date date, is_current boolean",
    )
    rows = [(k, v, DAY + dt.timedelta(days=d)) for k, d, v in changes_]
    batch = spark.createDataFrame(rows, "k string, v string, effective_date date") if rows else spark.createDataFrame([], "k string, v string, effective_date date")
    res = star.scd2_apply(dim, batch, "k", ["v"])
    out = sorted((r.k, r.effective_date, r.expiry_date, r.v, r.is_current) for r in res.collect())
    by_key = {}
    for k, eff, exp, v, cur in out:
        by_key.setdefault(k, []).append((eff, exp, v, cur))
    for k, versions in by_key.items():
        assert sum(1 for x in versions if x[3]) == 1  # one current version
        assert versions[-1][3] and versions[-1][1] == star.OPEN_END
        for a, b in zip(versions, versions[1:]):
            assert (b[0] - a[1]).days == 1  # gapless, non-overlapping
            assert a[2] != b[2]  # consecutive versions differ (no-ops dropped)
    again = star.scd2_apply(res, batch, "k", ["v"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, res.collect()), key=str)


def _paths(edges, start, hi, unique):
    out, stack = [], [((start,), ())]
    while stack:
        nodes, used = stack.pop()
        if len(used) == hi:
            continue
        for eid, (s, d) in enumerate(edges):
            if s != nodes[-1]:
                continue
            if unique == "edge" and eid in used:
                continue
            if unique == "node" and d in nodes:
                continue
            p = (nodes + (d,), used + (eid,))
            out.append(p[0])
            stack.append(p)
    return sorted(out)


EDGES = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=8)


@SETTINGS
@given(EDGES, st.sampled_from(["edge", "node"]))
def test_expand_matches_enumeration(spark, edges, unique):
    e = spark.createDataFrame([(i, s, d, "R") for i, (s, d) in enumerate(edges)], "eid long, src long, dst long, rel string")
    start = spark.createDataFrame([(0,)], "id long")
    got = sorted(tuple(r.nodes) for r in graph.expand(e, start, 1, 4, unique=unique).collect())
    assert got == _paths(edges, 0, 4, unique)


@SETTINGS
@given(EDGES, st.integers(0, 4))
def test_shortest_path_matches_bfs(spark, edges, target):
    e = spark.createDataFrame([(i, s, d, "R") for i, (s, d) in enumerate(edges)], "eid long, src long, dst long, rel string")
    adj = {}
    for s, d in edges:
        adj.setdefault(s, set()).add(d)
        adj.setdefault(d, set()).add(s)
    dist, q = {0: 0}, deque([0])
    while q:
        u = q.popleft()
        for v in adj.get(u, ()):
            if v not in dist:
                dist[v] = dist[u] + 1
                q.append(v)
    got = graph.shortest_path(e, 0, target, 4).collect()
    if target in dist and dist[target] <= 4:
        assert len(got) == 1 and got[0].hops == dist[target] and got[0].nodes[0] == 0 and got[0].nodes[-1] == target
        p = list(got[0].nodes)
        assert all(p[i + 1] in adj[p[i]] for i in range(len(p) - 1))
    else:
        assert got == []


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 100)), min_size=1, max_size=15, unique_by=lambda x: x[0]),
       st.integers(0, 100), st.integers(0, 100))
def test_versions_replay(spark, rows, upd_below, del_below):
    vt = layers.VersionedTable(spark, layers.lake_dir(spark, "prop"), ["k"])
    vt.write(spark.createDataFrame(rows, "k int, v int"))
    vt.update(F.col("v") < upd_below, {"v": F.col("v") + 1000})
    vt.delete(F.col("v") < del_below)
    state = dict(rows)
    v0 = dict(state)
    state = {k: (v + 1000 if v < upd_below else v) for k, v in state.items()}
    v1 = dict(state)
    state = {k: v for k, v in state.items() if not v < del_below}
    assert {r.k: r.v for r in vt.read(0).collect()} == v0
    assert {r.k: r.v for r in vt.read(1).collect()} == v1
    assert {r.k: r.v for r in vt.read().collect()} == state


KEYS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 99)), max_size=12)


@SETTINGS
@given(KEYS, KEYS, st.sampled_from(["left", "full"]))
def test_outer_join_equals_native(spark, left_rows, right_rows, how):
    from tessera.operators.joins import outer_join

    left = spark.createDataFrame(left_rows, "a int, x int") if left_rows else spark.createDataFrame([], "a int, x int")
    right = spark.createDataFrame(right_rows, "b int, y int") if right_rows else spark.createDataFrame([], "b int, y int")
    native = left.join(right, left.a == right.b, how).select("a", "x", "b", "y")
    mine = outer_join(left, right, ["a"], ["b"], how).select("a", "x", "b", "y")
    assert sorted(map(tuple, mine.collect()), key=str) == sorted(map(tuple, native.collect()), key=str)
