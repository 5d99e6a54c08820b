"""Approximate nearest neighbours: a forest of random-projection trees.

Fit.  ``TREES`` trees are grown on a bounded sample of the distinct vectors
(``SAMPLE`` rows with the smallest hash).  A node splits at the median of the
projection on the difference of two centres, drawn at random and refined by a
few rounds of 2-means.  Depth is ``DEPTH`` for every input, so the model is
bounded: TREES x 2^DEPTH planes.

Index.  Every vector goes to one leaf of each tree.  Leaves grow with the
input; a leaf is dealt out in chunks of about ``CHUNK_ROWS`` vectors, so a leaf
that holds a third of all vectors is many groups.

Search.  A query keeps one priority queue over the nodes of all trees, ordered by
the squared distances to the planes on the wrong side of which they lie.
It pops leaves until they hold ``SHARE`` of the fitted sample and at least k of
it (all of it, if there are fewer), each vector counted once over all trees and
the query left out.  A dense group can make up most of such a share, so a query
goes on until they also hold its k nearest of the sample.  A table of up to
``SAMPLE`` vectors is its own sample.  Queries meet vectors by an
equi-join on (tree, leaf, chunk); a group compares its queries with its
vectors in blocks and passes on the best k of each query.  The final ranking is
exact: Euclidean distances in double precision on the original vectors, ties
to the smaller id.

With vectors spread evenly over 64 dimensions there is no shortcut: neighbours
are hardly nearer than the rest, and 0.9 of them are found
in about 0.4 of all rows.  ``SHARE`` is a parameter.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part.  Rows with a null id take no part; of rows
that share an id the smallest vector counts.  An empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

TREES = 16
DEPTH = 8
SAMPLE = 16_384
SHARE = 0.5
CHUNK_ROWS = 4_096
K = 10
SEED = 7


@dataclass
class Forest:
    """Complete binary trees: planes[t, node] and offsets[t, node] for the
    2^DEPTH - 1 inner nodes, children of node i at 2i + 1 and 2i + 2."""

    planes: np.ndarray
    offsets: np.ndarray

    @property
    def depth(self) -> int:
        return int(self.planes.shape[1] + 1).bit_length() - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row of ``x`` in every tree."""
        out = np.zeros((len(x), len(self.planes)), dtype=np.int32)
        rows = np.arange(len(x))
        for t, (planes, offsets) in enumerate(zip(self.planes, self.offsets)):
            side = x @ planes.T >= offsets
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + side[rows, node]
            out[:, t] = node - len(planes)
        return out

    def visits(self, q: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) of the leaves with vectors in the order of the shared
        queue."""
        margins = np.einsum("tnd,d->tn", self.planes, q) - self.offsets
        inner = self.planes.shape[1]
        queue = [(0.0, t, 0) for t in range(len(self.planes))]
        while queue:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                m = margins[t, node]
                near = 2 * node + 1 + (m >= 0)
                heapq.heappush(queue, (far + m * m, t, 4 * node + 3 - near))
                node = near
            leaf = node - inner
            if sizes[t, leaf]:
                yield t, leaf


class Sample:
    """The fitted rows by (tree, leaf): what a query's leaves hold is counted on
    them, a row once."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaves: np.ndarray, n_leaves: int):
        self.ids, self.x = ids, x
        self.order = np.argsort(leaves, axis=0, kind="stable")
        self.starts = [np.searchsorted(np.sort(own), np.arange(n_leaves + 1)) for own in leaves.T]

    def enough(self, query_id: int, q: np.ndarray, visits: Iterator[tuple[int, int]], share: float, k: int) -> list[tuple[int, int]]:
        """The first of ``visits``, until they hold ``share`` of the rows other
        than the query ``q`` and its ``k`` nearest of them, or all."""
        open_ = self.ids != query_id
        total = int(open_.sum())
        wanted, out = share * total, []
        d = np.where(open_, ((self.x - q) ** 2).sum(1), np.inf)
        near = np.zeros(len(d), dtype=bool)
        near[np.argsort(d, kind="stable")[: min(k, total)]] = True
        seen, missing = 0, min(k, total)
        while (seen < wanted or missing) and (to := next(visits, None)):
            t, leaf = to
            own = self.order[self.starts[t][leaf] : self.starts[t][leaf + 1], t]
            own = own[open_[own]]
            seen += len(own)
            missing -= int(near[own].sum())
            open_[own] = False
            out.append(to)
        return out


def grow(sample: np.ndarray, trees: int, depth: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    inner, dims = 2**depth - 1, sample.shape[1]
    planes, offsets = np.zeros((trees, inner, dims)), np.zeros((trees, inner))
    for t in range(trees):
        rows: dict[int, np.ndarray] = {0: np.arange(len(sample))}
        for node in range(inner):
            own = rows.pop(node)
            x = sample[own]
            plane = rng.standard_normal(dims)
            if len(own) > 1:
                part = x[rng.permutation(len(own))[:256]]
                a, b = part[0], part[1]
                for _ in range(5):
                    left = ((part - a) ** 2).sum(1) <= ((part - b) ** 2).sum(1)
                    if left.all() or not left.any():
                        break
                    a, b = part[left].mean(0), part[~left].mean(0)
                if np.any(a != b):
                    plane = a - b
            plane = plane / np.linalg.norm(plane)
            side = x @ plane
            planes[t, node], offsets[t, node] = plane, np.median(side) if len(own) else 0.0
            right = side >= offsets[t, node]
            rows[2 * node + 1], rows[2 * node + 2] = own[~right], own[right]
    return Forest(planes, offsets)


def valid_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec array<double>) of the rows that take part."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("vec", lambda x: x != 0)).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    rows = cut_lineage(rows)
    dims = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (dims.d if dims else 0))


def _leaf_rows(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(1).flatten()).reshape(batch.num_rows, -1)
            leaves = forest.leaves(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(leaves))], ["vec_id", "vec", "leaves"])

    return run


def _visit_rows(forest: Forest, sizes: np.ndarray, fitted: Sample, share: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q = np.array(batch.column(1)[i].as_py())
                to = fitted.enough(batch.column(0)[i].as_py(), q, forest.visits(q, sizes), share, k)
                n = len(to)
                same = pa.array([i] * n, pa.int64())
                cols = [pa.array([t for t, _ in to], pa.int32()), pa.array([x for _, x in to], pa.int32())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(same), batch.column(1).take(same), *cols], ["query_id", "q", "tree", "leaf"])

    return run


def _best(k: int, block: int = 256):
    def run(key, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if points.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, ids = np.stack(points["vec"]), points["vec_id"].to_numpy()
        order = np.argsort(ids)
        x, ids = x[order], ids[order]
        out = []
        for at in range(0, len(queries), block):
            part = queries.iloc[at : at + block]
            for qid, q in zip(part["query_id"].to_numpy(), part["q"]):
                d = np.sqrt(((x - q) ** 2).sum(1))
                d[ids == qid] = np.inf
                pick = np.argsort(d, kind="stable")[:k] if len(d) <= 4 * k else None
                if pick is None:
                    edge = np.partition(d, k - 1)[k - 1]
                    pick = np.flatnonzero(d <= edge)
                    pick = pick[np.argsort(d[pick], kind="stable")][:k]
                pick = pick[np.isfinite(d[pick])]
                out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[pick], "score": d[pick]}))
        return pd.concat(out)

    return run


def _first_by_hash(rows: DataFrame, count: int, sample: int, seed: int) -> DataFrame:
    """``sample`` of the ``count`` rows: those of the smallest hash.  Only rows
    below a bound that leaves more than enough are ordered."""
    key = F.xxhash64("vec_id", F.lit(seed))
    share = 1.25 * sample / max(1, count)
    near = rows if share >= 1 else rows.where(key < F.lit(int((share - 0.5) * 2**64)))
    return near.orderBy(key, "vec_id").limit(sample)


def search(table: DataFrame, is_query: Column, *, k: int = K, trees: int = TREES, depth: int = DEPTH, share: float = SHARE, sample: int = SAMPLE, chunk_rows: int = CHUNK_ROWS, seed: int = SEED, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for
    which ``is_query`` (a condition on vec_id) holds."""
    vectors = valid_vectors(table, id_col, vec_col)
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    count = vectors.count()
    fit = _first_by_hash(vectors, count, sample, seed).select("vec").collect()
    if not fit:
        return spark.createDataFrame([], schema)
    points = np.unique(np.array([r.vec for r in fit]), axis=0)
    forest = grow(points, trees, depth, seed)

    placed = cut_lineage(vectors.mapInArrow(_leaf_rows(forest), "vec_id long, vec array<double>, leaves array<int>"))
    per_leaf = placed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    sizes = np.zeros((trees, 2**depth), dtype=np.int64)
    for r in per_leaf:
        sizes[r.tree, r.leaf] = r["count"]

    again = _first_by_hash(placed, count, sample, seed).select("vec_id", "vec", "leaves").toArrow()  # the fitted rows
    fitted = Sample(np.array(again.column("vec_id")), np.array(again.column("vec").to_pylist()), np.array(again.column("leaves").to_pylist(), dtype=np.int32), 2**depth)

    # chunks of a leaf: as many as its size asks for
    large = spark.createDataFrame([(int(t), int(x), int(-(-sizes[t, x] // chunk_rows))) for t, x in np.argwhere(sizes > 0)], "tree int, leaf int, chunks int")
    spread = placed.select("vec_id", "vec", F.posexplode("leaves").alias("tree", "leaf")).join(F.broadcast(large), ["tree", "leaf"])
    spread = spread.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")).drop("chunks")
    queries = vectors.where(is_query).mapInArrow(_visit_rows(forest, sizes, fitted, share, k), "query_id long, q array<double>, tree int, leaf int")
    queries = queries.join(F.broadcast(large), ["tree", "leaf"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    key = ["tree", "leaf", "chunk"]
    near = spread.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(_best(k), "query_id long, vec_id long, score double")
    ranked = near.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
