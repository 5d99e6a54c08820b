"""Hard negatives of anchor vectors, by rotated one-bit codes.

Scores are inner products of integer vectors.  A vector is rotated (padded to a
multiple of 64 dimensions) and coded by its signs, one bit a dimension; with
the code is stored its alignment, the vector's length along the code vector.
What the code leaves of the vector is coded again by signs, ``LEVELS`` codes in
all, for in few dimensions one leaves six tenths of the length.  An anchor is
rotated too and cut to ``PLANES`` bits a dimension.  The inner product of codes
and anchor is then a sum of popcounts; by Cauchy-Schwarz it is off by at most
|what the codes leave| |anchor| + |codes| |what the anchor's cut leaves|.
So every candidate has an interval that holds its score for certain.  Those
whose interval cannot come among the wanted ones are left out, all others are
scored in integers: results are exact.

Two passes: the best positives of each anchor, which set the windows of scores,
and the best negatives in each window.  Rows are packed, evenly, into blocks of
``BLOCK`` with their codes, anchors into blocks of ``ANCHORS``; a task meets
some blocks of rows with one block of anchors, keeps the best so far as its
bound, and passes on the best few of every anchor, which Spark merges.

Rows with a null id, label or vector or with a null or non-finite component take
no part, nor do those whose squared length is 2^56 or more, as 95
times their scores do not fit a long.  Vectors of another length than the anchor's do not meet it.
Rows of the anchor's id are never its positives or negatives; other repeated
rows count each time; equal anchor rows are one anchor.  Only the named columns
are read.  Without anchors or rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_table

LEVELS, PLANES = 4, 5
BLOCK, BLOCKS_A_TASK, ANCHORS = 1 << 13, 4, 1 << 11
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
_TILE, _ANCHOR_TILE = 2048, 128
_NONE = np.iinfo(np.int64).min


# --------------------------------------------------------------------------- codes
@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """Orthogonal matrix that takes a vector to ``dim`` padded to 64s."""
    full = -(-dim // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(full, full)))
    return (q * np.sign(np.diag(r)))[:dim]


def _bits(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags, axis=-1).view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, alignments, rest) of integer vectors (row, dimension): bits as
    words (level, row, word), alignments (level, row), and for each row the
    lengths of what the codes leave and of what they hold."""
    left = vectors.astype(np.float64) @ rotation(vectors.shape[1])
    whole, width = left.copy(), max(1, left.shape[1])
    codes = np.zeros((LEVELS, len(left), left.shape[1] // 64), np.uint64)
    along = np.zeros((LEVELS, len(left)))
    for k in range(LEVELS):
        up = left >= 0
        codes[k], along[k] = _bits(up), np.abs(left).sum(1) / np.sqrt(width)
        left -= np.where(up, 1, -1) * (along[k] / np.sqrt(width))[:, None]
    return codes, along, np.stack([np.linalg.norm(left, axis=1), np.linalg.norm(whole - left, axis=1)])


class Anchors:
    """Anchors cut to bit planes, ready for estimates against codes."""

    def __init__(self, vectors: np.ndarray):
        turned = vectors.astype(np.float64) @ rotation(vectors.shape[1])
        self.width = turned.shape[1]
        self.length = np.linalg.norm(turned, axis=1)
        self.low = turned.min(1) if self.width else np.zeros(len(turned))
        span = (turned.max(1) if self.width else self.low) - self.low
        self.unit = np.where(span > 0, span / ((1 << PLANES) - 1), 1.0)
        cut = np.rint((turned - self.low[:, None]) / self.unit[:, None]).astype(np.int64)
        self.off = np.linalg.norm(turned - self.low[:, None] - cut * self.unit[:, None], axis=1)
        self.total = cut.sum(1)
        self.planes = [_bits((cut >> j & 1).astype(bool)) for j in range(PLANES)]

    def bounds(self, a: slice, codes: np.ndarray, along: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score possible (anchor, row)."""
        low, unit, total = self.low[a, None], self.unit[a, None], self.total[a, None]
        about = np.zeros((len(low), codes.shape[1]))
        for code, length in zip(codes, along):
            hits = np.zeros(about.shape, np.int64)
            for j, plane in enumerate(self.planes):
                for w in range(code.shape[1]):
                    hits += np.bitwise_count(code[:, w] & plane[a, w, None]).astype(np.int64) << j
            ones = np.bitwise_count(code).sum(1, dtype=np.int64)
            about += length / np.sqrt(max(1, self.width)) * (low * (2 * ones - self.width) + unit * (2 * hits - total))
        off = rest[0] * self.length[a, None] + rest[1] * self.off[a, None]
        off += 0.01 + 1e-9 * rest.sum(0) * self.length[a, None]  # more than floating point loses
        return about - off, about + off


# --------------------------------------------------------------------------- blocks
_ROW = "dim int, part int, ids binary, labels binary, vectors binary, extra binary, codes binary, along binary, rest binary"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _packer(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        part = TaskContext.get().partitionId()

        def out(dim: int) -> pa.RecordBatch:
            ids, labels, vectors, extra = (np.concatenate(x) for x in zip(*held.pop(dim)))
            row = [dim, part, ids, labels, vectors, extra, *encode(vectors)]
            types = [pa.int32(), pa.int32()] + [pa.binary()] * 7
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes() if i > 1 else x], t) for i, (x, t) in enumerate(zip(row, types))], _NAMES)

        for batch in batches:
            lists = batch.column(2)
            dims = pc.list_value_length(lists).to_numpy()
            flat, ends = lists.flatten().to_numpy(), np.cumsum(dims)
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            extra = batch.column(3).flatten().to_numpy().reshape(batch.num_rows, -1)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for a in range(0, len(at), size):
                    rows = at[a : a + size]
                    vectors = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
                    held.setdefault(int(dim), []).append((ids[rows], labels[rows], vectors, extra[rows]))
                    if sum(len(x[0]) for x in held[int(dim)]) >= size:
                        yield out(int(dim))
            while sum(len(x[0]) for h in held.values() for x in h) > 4 * size:  # many lengths of vectors
                yield out(next(iter(held)))
        for dim in list(held):
            yield out(dim)

    return pack


def _packed(rows: DataFrame, count: int, size: int) -> DataFrame:
    """``rows`` (vec_id, label, v, extra) dealt evenly into blocks with codes."""
    return cut_table(rows.repartition(1 + count // size).mapInArrow(_packer(size), _ROW))


def _arrays(table: pa.Table, i: int) -> dict[str, np.ndarray]:
    raw = {c: np.frombuffer(table.column(c)[i].as_py(), t) for c, t in zip(_NAMES[2:], [np.int64] * 4 + [np.uint64, np.float64, np.float64])}
    n, dim = len(raw["ids"]), table.column("dim")[i].as_py()
    shapes = {"vectors": (n, dim), "extra": (n, -1) if n and len(raw["extra"]) else (n, 0), "codes": (LEVELS, n, -(-dim // 64)), "along": (LEVELS, n), "rest": (2, n)}
    return {c: x.reshape(shapes.get(c, n)) for c, x in raw.items()}


def _best(best: tuple[np.ndarray, np.ndarray], group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
    """Merges scored rows into each group's best (group, place): the highest
    score first, then the smallest id."""
    places = best[0].shape[1]
    touched = np.unique(group)
    g = np.concatenate([np.repeat(touched, places), group])
    s, i = np.concatenate([best[0][touched].ravel(), score]), np.concatenate([best[1][touched].ravel(), ids])
    order = np.lexsort((i, -s, s == _NONE, g))  # a place that is free comes last
    g, s, i = g[order], s[order], i[order]
    place = np.arange(len(g)) - np.searchsorted(g, g)
    keep = place < places
    best[0][g[keep], place[keep]], best[1][g[keep], place[keep]] = s[keep], i[keep]


def _meet(rows: pa.Table, given: dict[str, np.ndarray], wanted, scored) -> None:
    """Every row of the blocks against all anchors, tile by tile:
    ``wanted(anchors, ids, labels, low, high)`` says from intervals which pairs
    may matter, ``scored(anchor, score, id)`` takes those pairs' scores."""
    ask = Anchors(given["vectors"])
    for i in range(rows.num_rows):
        block = _arrays(rows, i)
        for r in range(0, len(block["ids"]), _TILE):
            t = slice(r, r + _TILE)
            ids, labels, vectors = block["ids"][t], block["labels"][t], block["vectors"][t]
            for a in range(0, len(given["ids"]), _ANCHOR_TILE):
                low, high = ask.bounds(slice(a, a + _ANCHOR_TILE), block["codes"][:, t], block["along"][:, t], block["rest"][:, t])
                q, n = np.nonzero(wanted(slice(a, a + _ANCHOR_TILE), ids, labels, low, high))
                for c in range(0, len(q), 1 << 16):  # integer products, so many at a time
                    qc, nc = q[c : c + (1 << 16)] + a, n[c : c + (1 << 16)]
                    scored(qc, np.einsum("ij,ij->i", given["vectors"][qc], vectors[nc]), ids[nc])


_POSITIVE = "anchor_id long, anchor_row long, positive_id long, positive_score long"
_NEGATIVE = "anchor_id long, anchor_row long, no int, positive_id long, positive_score long, negative_id long, negative_score long"


def _table(schema: str, columns: list) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], [f[0] for f in fields])


def _positives(count: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [_table(_POSITIVE, [[]] * 4)]
        for i in range(anchors.num_rows):
            given = _arrays(anchors, i)
            n = len(given["ids"])
            best = np.full((n, count), _NONE), np.zeros((n, count), np.int64)

            def wanted(a, ids, labels, low, high):
                alike = (given["labels"][a, None] == labels) & (given["ids"][a, None] != ids)
                return alike & (high >= best[0][a, -1:])

            _meet(rows, given, wanted, lambda q, score, ids: _best(best, q, score, ids))
            q, place = np.nonzero(best[0] != _NONE)
            out.append(_table(_POSITIVE, [given["ids"][q], given["extra"][q, 0], best[1][q, place], best[0][q, place]]))
        return pa.concat_tables(out)

    return find


def _negatives(count: int, low_cent: int, high_cent: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [_table(_NEGATIVE, [[]] * 7)]
        for i in range(anchors.num_rows):
            given = _arrays(anchors, i)
            there, pid, pscore = given["extra"][:, 1::3] > 0, given["extra"][:, 2::3], given["extra"][:, 3::3]
            first = -(-low_cent * pscore // 100)  # the window of scores, in integers
            last = high_cent * pscore // 100
            there = there & (first <= last)
            n, per = there.shape
            best = np.full((n * per, count), _NONE), np.zeros((n * per, count), np.int64)
            cap = np.where(there, last, _NONE).max(1, initial=_NONE)

            def wanted(a, ids, labels, low, high):
                need = np.maximum(first, best[0][:, -1].reshape(n, per))[a]
                need = np.where(there[a], need, np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
                other = (given["labels"][a, None] != labels) & (given["ids"][a, None] != ids)
                return other & (high >= need[:, None]) & (low <= cap[a, None])

            def scored(q, score, ids):
                at, no = np.nonzero(there[q] & (first[q] <= score[:, None]) & (score[:, None] <= last[q]))
                _best(best, q[at] * per + no, score[at], ids[at])

            _meet(rows, given, wanted, scored)
            g, place = np.nonzero(best[0] != _NONE)
            q, no = np.divmod(g, max(1, per))
            out.append(_table(_NEGATIVE, [given["ids"][q], given["extra"][q, 0], no, pid[q, no], pscore[q, no], best[1][g, place], best[0][g, place]]))
        return pa.concat_tables(out)

    return find


# --------------------------------------------------------------------------- Spark
def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(``scale`` * x) of every component."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def taking_part(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """(vec_id, label, v): the rows that take part, in whole numbers."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    fits = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.pow(F.floor(F.lit(scale) * c.cast("double")).cast("double"), 2)) < 2.0**56
    kept = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(fits, F.lit(False)))
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), whole_numbers(x, scale).alias("v"))


def _pairs(rows: DataFrame, anchors: DataFrame, find, schema: str) -> DataFrame:
    """Blocks of rows against blocks of anchors, each pair of groups in a task."""
    groups = rows.agg(F.max("part")).first()[0]
    parts = anchors.agg(F.max("part")).first()[0]
    if groups is None or parts is None:
        return rows.sparkSession.createDataFrame([], schema)
    groups = groups // BLOCKS_A_TASK + 1
    left = rows.withColumn("g", F.floor(F.col("part") / BLOCKS_A_TASK).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(parts))))
    right = anchors.withColumn("b", F.col("part")).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return left.groupBy("dim", "g", "b").cogroup(right.groupBy("dim", "g", "b")).applyInArrow(find, schema)


def _first(rows: DataFrame, by: list[str], score: str, vec_id: str, count: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), vec_id)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= count)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """For every anchor of ``rows`` (vec_id, label, v; see ``taking_part``) and
    each of its best positives, the first negatives whose score is ``low`` to
    ``high`` per cent of the positive's."""
    rows = cut_table(rows)
    count = rows.count()
    chosen = cut_table(rows.where(is_anchor).distinct().withColumn("anchor_row", F.xxhash64("vec_id", "label", "v")))
    anchors = chosen.count()
    blocks = _packed(rows.withColumn("extra", F.array(F.lit(0).cast("long"))), count, BLOCK)
    asking = _packed(chosen.select("vec_id", "label", "v", F.array("anchor_row").alias("extra")), anchors, ANCHORS)
    found = _pairs(blocks, asking, _positives(positives), _POSITIVE)
    found = _first(found, ["anchor_id", "anchor_row"], "positive_score", "positive_id", positives)
    # a flag, the id and the score of each positive, in order
    none, key = F.lit(0).cast("long"), [F.col("anchor_id").alias("vec_id"), "anchor_row"]
    each = found.groupBy(*key).agg(*[F.max(F.when(F.col("rank") == k + 1, F.array(F.lit(1).cast("long"), "positive_id", "positive_score"))).alias(f"p{k}") for k in range(positives)])
    extra = F.flatten(F.array(F.array("anchor_row"), *[F.coalesce(f"p{k}", F.array(none, none, none)) for k in range(positives)]))
    asking = _packed(chosen.join(each, ["vec_id", "anchor_row"]).select("vec_id", "label", "v", extra.alias("extra")), anchors, ANCHORS)
    found = _pairs(blocks, asking, _negatives(negatives, low, high), _NEGATIVE)
    found = _first(found, ["anchor_id", "anchor_row", "no"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
