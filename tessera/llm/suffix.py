"""Removal of repeated byte strings by sorting the suffixes of a cover sample.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
anywhere else.  Sorting every suffix of the corpus would move many times the
input; a cover sample decides the same with a fraction of the suffixes:

1. Cover sample.  Of every window of LENGTH bytes the ``PREFIX``-byte prefix
   with the smallest hash (the leftmost on ties) is its sample suffix.  The choice
   depends on the window's content alone, so equal windows have their sample
   suffix at the same offset: the property for which a difference cover is
   used, at 1.5 % of the positions (residues need 9 %; see README).
   Neighbouring windows share a sample suffix; together they are its *run*,
   the bytes from the first window's start to the last one's end.
2. Ranks.  Sample suffixes get a name by their prefix; names found once are
   settled (nothing repeats there).  Runs equal as a whole get one name of
   their own: long ties, such as copies of texts, end here without comparing
   them further, and all windows of a run found twice are repeated.
3. Blockwise sort.  What is left is one representative for each different
   run, in buckets of equal prefix.  A task sorts the windows of one bucket
   after another; equal neighbours are repeated.  The memory is that of a
   bucket; a bucket with more than ``BUCKET_RUNS`` runs is not sorted in a task
   but its windows' fingerprints are counted by a partial aggregate.
4. Per document the repeated windows are merged into maximal runs and cut out.

Null texts are empty, ids may be null, repeated rows are occurrences of their
own, texts shorter than LENGTH bytes are never changed; an empty table gives an
empty result.  Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_table
from .shingles import mixed

LENGTH = 200
PREFIX = 64
BUCKET_RUNS = 20_000
CHUNK_BYTES = 1 << 18  # bytes of text worked on at a time
_SORT_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class Rolling:
    """Hashes of all strings of a fixed length in a buffer, from one prefix sum
    of the bytes times powers of an odd base, modulo 2^64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            ones = np.ones(n, dtype=np.uint64)
            self.up, self.down = (np.cumprod(np.concatenate([ones[:1], ones[1:] * b])) for b in (_BASE, inverse))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * self.up[: len(data)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((sums[starts + length] - sums[starts]) * self.down[starts])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, in two passes over blocks."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    square = padded.reshape(blocks, width)
    left = np.minimum.accumulate(square, axis=1).ravel()
    right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def cover_runs(texts: list[bytes], rolling: Rolling, length: int, prefix: int):
    """(text, start, windows, name, body hash) arrays of the runs of ``texts``."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    data = b"".join(texts)
    if size.max(initial=0) < length:
        return (np.zeros(0, dtype=np.int64),) * 5
    raw = np.frombuffer(data, dtype=np.uint8)
    sums = rolling.sums(raw)
    heads = rolling.at(sums, np.arange(len(raw) - prefix + 1), prefix)
    bits = np.uint64(int(len(raw)).bit_length())
    packed = ((heads >> bits) << bits) | np.arange(len(heads), dtype=np.uint64)
    least = sliding_min(packed, length - prefix + 1)
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    end = np.cumsum(size)
    of = np.repeat(np.arange(len(texts)), size)[: len(anchor)]
    windows = np.flatnonzero(np.arange(len(anchor)) + length <= end[of])
    anchor, of = anchor[windows], of[windows]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])]))
    count = np.diff(np.concatenate([first, [len(windows)]]))
    start, view = windows[first], memoryview(data)
    body = np.fromiter((xxhash.xxh3_64_intdigest(view[a : a + n + length - 1]) for a, n in zip(start.tolist(), count.tolist())), dtype=np.uint64, count=len(first))
    text = of[first]
    return text, start - (end - size)[text], count, heads[anchor[first]].view(np.int64), body.view(np.int64)


def _intervals(lo: np.ndarray, hi: np.ndarray) -> list[dict]:
    """Sorted starts lo..hi joined where they touch."""
    new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1] + 1]))
    return [{"lo": int(x), "hi": int(y)} for x, y in zip(lo[new], hi[np.concatenate([new[1:] - 1, [len(hi) - 1]])])]


def _by_bytes(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of a column, a row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right")))
        yield batch.slice(a, b - a)
        a = b


def _pieces(texts: list[bytes], length: int, limit: int = CHUNK_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text, offset, bytes) of about ``limit`` bytes.  A longer text is
    cut so that each of its windows lies in one piece; a run that a cut
    divides is two runs."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), limit):
            held.append((i, at, text[at : at + limit + length - 1]))
            size += len(held[-1][2])
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _runs(length: int, prefix: int):
    """A row for each different run of a text (of a piece, where it is long):
    its first start, how often it is there, and, if more than once, all of
    its windows' starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for part in (part for batch in batches for part in _by_bytes(batch, 2)):
            for pieces in _pieces(part.column(2).to_pylist(), length):
                piece, start, count, name, body = cover_runs([p[2] for p in pieces], rolling, length, prefix)
                text, start = np.array([p[0] for p in pieces])[piece], start + np.array([p[1] for p in pieces])[piece]
                order = np.lexsort((start, body, name, text))
                text, start, count, name, body = (x[order] for x in (text, start, count, name, body))
                same = (text[1:] == text[:-1]) & (name[1:] == name[:-1]) & (body[1:] == body[:-1]) & (count[1:] == count[:-1])
                first = np.flatnonzero(np.concatenate([[True], ~same])) if len(text) else np.zeros(0, dtype=np.int64)
                times = np.diff(np.concatenate([first, [len(text)]]))
                own = [None if n == 1 else _intervals(start[i : i + n], start[i : i + n] + count[i : i + n] - 1) for i, n in zip(first.tolist(), times.tolist())]
                take = pa.array(text[first])
                span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
                cols = [pa.array(start[first].astype(np.int32)), pa.array(count[first].astype(np.int32)), pa.array(name[first]), pa.array(body[first]), pa.array(times.astype(np.int32)), pa.array(own, span)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *cols], ["id", "thash", "start", "windows", "name", "body", "times", "own"])

    return run


def _bodies(length: int):
    """Rows (text, runs) -> the bytes of each run, or its windows'
    fingerprints if its bucket is large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            for i in range(batch.num_rows):
                data, runs = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                cols: list[list] = [[], [], [], [], []]
                for r in runs:
                    own = data[r["start"] : r["start"] + r["windows"] + length - 1]
                    prints = None
                    if r["large"]:
                        sums = rolling.sums(np.frombuffer(own, dtype=np.uint8))
                        prints = rolling.at(sums, np.arange(r["windows"]), length).view(np.int64)
                    for c, v in zip(cols, (r["start"], r["name"], r["once"], None if r["large"] else own, prints)):
                        c.append(v)
                n = len(runs)
                arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64())))]
                both = [batch.column(c).take(pa.array([i] * n)) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays([*both, *arrays], ["id", "thash", "start", "name", "once", "own", "prints"])

    return run


def _sorted_buckets(length: int):
    """Rows in order of bucket -> repeated windows of the runs found once."""

    def repeated(rows: list[pa.RecordBatch], rolling: Rolling) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        own = table.column("own").to_pylist()
        size = np.array([len(x) for x in own], dtype=np.int64)
        sums = rolling.sums(np.frombuffer(b"".join(own), dtype=np.uint8))
        windows, begin = size - length + 1, np.cumsum(size) - size
        of = np.repeat(np.arange(len(own)), windows)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        prints = rolling.at(sums, begin[of] + inside, length)
        order = np.argsort(prints, kind="stable")
        equal = prints[order][1:] == prints[order][:-1]
        twice = np.zeros(len(of), dtype=bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        twice &= np.array(table.column("once").to_pylist(), dtype=bool)[of]
        at = np.flatnonzero(twice)
        edge = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of[at]) != 0)]) if len(at) else np.zeros(0, dtype=bool)
        lo = at[edge]
        hi = np.concatenate([at[np.flatnonzero(edge)[1:] - 1], at[-1:]]) if len(at) else lo
        rows_of = pa.array(of[lo])
        start = np.array(table.column("start").to_pylist(), dtype=np.int64)[of[lo]]
        cols = [table.column("id").combine_chunks().take(rows_of), table.column("thash").combine_chunks().take(rows_of), pa.array(start + inside[lo]), pa.array(start + inside[hi])]
        return pa.RecordBatch.from_arrays(cols, ["id", "thash", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, held, size = Rolling(), [], 0
        for batch in batches:
            name = np.array(batch.column(3))
            for part in np.split(np.arange(len(name)), np.flatnonzero(np.diff(name)) + 1):
                if not len(part):
                    continue
                if held and size >= _SORT_BYTES and held[-1].column(3)[-1].as_py() != name[part[0]]:
                    yield repeated(held, rolling)
                    held, size = [], 0
                held.append(batch.slice(int(part[0]), len(part)))
                size += sum(len(x) for x in held[-1].column(5).to_pylist())
        if held:
            yield repeated(held, rolling)

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row struct of the other columns, id, thash, bytes)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(F.struct(*rest).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("thash"), F.to_binary(text, F.lit("utf-8")).alias("bytes"))


def _same_text(a: str, b: str):
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.thash") == F.col(f"{b}.thash"))


def repeated_windows(rows: DataFrame, *, length: int = LENGTH, prefix: int = PREFIX, bucket_runs: int = BUCKET_RUNS) -> DataFrame:
    """(id, thash, lo, hi): starts lo..hi of windows that also start elsewhere.
    ``rows`` as ``_rows`` gives them."""
    kind = rows.schema["id"].dataType.simpleString()
    span = "array<struct<lo:bigint,hi:bigint>>"
    texts = rows.where(F.octet_length("bytes") >= length).select("id", "thash", "bytes")
    runs = texts.mapInArrow(_runs(length, prefix), f"id {kind}, thash long, start int, windows int, name long, body long, times int, own {span}")
    # counted before the runs are dealt out: one map over the texts at a time
    again = cut_table(runs.groupBy("name").agg(F.sum("times").alias("c")).where("c > 1").select("name"))
    runs = cut_table(runs.join(again, "name", "left_semi"))

    # "windows" is the length of the body, which the body's hash covers
    different = runs.groupBy("name", "body", "windows").agg(F.sum("times").alias("c"), F.min(F.struct("id", "thash", "start")).alias("m"))
    different = cut_table(different)
    copies = runs.join(different.where("c > 1").select("name", "body", "windows"), ["name", "body", "windows"], "left_semi")
    only = F.array(F.struct(F.col("start").cast("long").alias("lo"), (F.col("start") + F.col("windows") - 1).cast("long").alias("hi")))
    whole = copies.select("id", "thash", F.inline(F.coalesce("own", only)))

    buckets = different.groupBy("name").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    has_large = not buckets.where(F.col("k") > bucket_runs).isEmpty()
    open_ = different.join(buckets, "name").select("m.*", F.struct("m.start", "windows", "name", (F.col("c") == 1).alias("once"), (F.col("k") > bucket_runs).alias("large")).alias("run"))
    wanted = open_.groupBy("id", "thash").agg(F.collect_list("run").alias("runs"))
    read = rows.alias("r").join(wanted.alias("w"), _same_text("r", "w")).select("r.row", "r.id", "r.thash", "r.bytes", "w.runs")
    bodies = read.mapInArrow(_bodies(length), f"id {kind}, thash long, start long, name long, once boolean, own binary, prints array<long>")
    if has_large:  # then read twice
        bodies = cut_table(bodies)
    small = bodies.where("own is not null").drop("prints").repartition("name").sortWithinPartitions("name")
    found = small.mapInArrow(_sorted_buckets(length), f"id {kind}, thash long, lo long, hi long")

    if not has_large:
        return whole.unionByName(found)
    prints = bodies.where("prints is not null").select("id", "thash", "start", "once", F.posexplode("prints").alias("w", "print"))
    twice = prints.groupBy("print").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("print")
    start = F.col("start") + F.col("w")
    large = prints.where("once").join(twice, "print", "left_semi").select("id", "thash", start.alias("lo"), start.alias("hi"))
    return whole.unionByName(found).unionByName(large)


def _to_characters(data: bytes, a: np.ndarray, b: np.ndarray):
    """Spans shrunk to the characters that they cover as a whole."""
    raw = np.frombuffer(data + b"\0", dtype=np.uint8)
    for _ in range(3):
        a, b = a + ((raw[a] & 0xC0) == 0x80), b - ((raw[b] & 0xC0) == 0x80)
    return a, b


def _cut(length: int, whole_chars: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _by_bytes(whole, 1, 4 * CHUNK_BYTES)):
            removed, spans, kept = [], [], []
            for data, lo, hi in zip(batch.column(1), batch.column(2), batch.column(3)):
                data = data.as_py()
                if not lo.is_valid:
                    removed.append(0)
                    spans.append([])
                    kept.append(data)
                    continue
                a, b = np.array(lo.as_py()), np.array(hi.as_py()) + length
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.concatenate([[True], a[1:] > b[:-1]])
                a, b = a[new], b[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(b) - 1]])]
                if whole_chars:
                    a, b = _to_characters(data, a, b)
                removed.append(int((b - a).sum()))
                spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(a, b)])
                edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(data)]
                kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            cols = [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["row", "n_removed", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, whole_chars: bool = False, **how) -> DataFrame:
    """(row struct of the input's columns without the text, n_bytes, n_removed,
    spans array<struct<start, stop>>, kept binary) of every row.  With
    ``whole_chars`` a character of which only some bytes are covered stays."""
    rows = _rows(docs, id_col, text_col)
    per = repeated_windows(rows, length=length, **how).groupBy("id", "thash").agg(F.collect_list(F.struct("lo", "hi")).alias("w"))
    # the texts are dealt out once: the plan of the bodies reads the same exchange
    joined = rows.alias("r").join(per.alias("p"), _same_text("r", "p"), "left").select("r.row", "r.bytes", F.col("p.w.lo").alias("lo"), F.col("p.w.hi").alias("hi"))
    schema = f"row {joined.schema['row'].dataType.simpleString()}, n_removed long, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    out = joined.mapInArrow(_cut(length, whole_chars), schema)
    return out.withColumn("n_bytes", F.octet_length("kept") + F.col("n_removed"))


def cleaned_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts, by whole
    characters, so texts stay valid; ``n_chars`` follows where it is there.
    Every row stays; a null text becomes an empty one."""
    out = remove_repeats(docs, id_col=id_col, text_col=text_col, whole_chars=True, **how).select("row.*", F.decode("kept", "utf-8").alias(text_col))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(F.col(text_col)).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
