"""Near-duplicates by MinHash with tensored banding, confirmed on full sets.

A document is the set of its five-word shingles.  Sets equal as a whole are one
class.  Each class has ``GROUPS`` small collections of ``ROWS`` minhashes; a
table of the index is a pair of collections, its key the combination of
both.  So GROUPS x ROWS minhashes (32) give GROUPS (GROUPS - 1) / 2 tables (120)
of 2 x ROWS minhashes each, where plain banding would compute 480.  Two sets
meet in a table if two collections agree: at similarity 0.75 a pair is missed
with probability 4e-5, and less above.

1. A collection value that no other class has cannot be part of a shared key;
   such values are dropped first, so keys are formed only where they can meet.
2. In every bucket all classes are compared with its centre, the class that
   meets most others over all tables; sets whose sizes rule out the
   similarity are left out, the others are compared in full.  Confirmed links
   give components; buckets within one component are settled.
3. In the buckets left, classes of different components whose 32 minhashes
   agree in at least ``SCREEN`` places (a pair of similarity 0.75 fails that
   with probability 1e-7) may be linked; chains of them are clusters.  In a
   cluster all classes of different components are compared in full, and the
   links that join components are passed on.  Tasks pass on no more pairs than
   it takes to keep a group together.  In a bucket and in a cluster the classes
   outside the largest component ask, all classes answer, so a group that hangs
   together but for a few costs its size; groups of any size are compared in
   bounded blocks, and nothing is capped.

Keys, classes and links are joined on values with many distinct keys; joins on
a hot bucket are inner equi-joins that adaptive execution splits.  Members of a
large bucket or cluster meet what is known of it in several tasks.

Null or empty texts have empty sets and are linked with nothing.  Rows without
an id are in no link (component_id null, kept true).  Repeated rows are copies;
the row whose id is the component's smallest is kept, and so are its repeats.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage, cut_table
from .common import connected_components
from .shingles import WordHashes, chunks, mixed, shingle_hashes

WIDTH = 5
GROUPS = 16
ROWS = 2
SCREEN = 11
BUCKET_ROWS = 4_096  # rows of a bucket that a task compares at once
BLOCK_SHINGLES = 1 << 20  # shingles of a cluster that a task compares at once
SALTS = 64  # tasks over which the members of a cluster are dealt
SIMILAR = 75  # per cent


def _signatures(width: int, groups: int, rows: int):
    k = np.arange(1, groups * rows + 1, dtype=np.uint64)
    odd = mixed(k * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    add = mixed(odd)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for run_ in chunks(texts):
                own = [texts[i] for i in run_]
                flat, counts = shingle_hashes(own, hashes, width)
                n, h1, h2 = (np.zeros(len(own), dtype=np.int64) for _ in range(3))
                sig = np.zeros((len(own), groups * rows), dtype=np.uint64)
                some = np.flatnonzero(counts)
                if len(some):
                    at = (np.cumsum(counts) - counts)[some]
                    for j in range(groups * rows):
                        sig[some, j] = np.minimum.reduceat(flat * odd[j] + add[j], at)
                    for i, a in zip(some, at):
                        u = np.unique(flat[a : a + counts[i]])
                        n[i] = len(u)
                        h1[i], h2[i] = u.sum().astype(np.int64), mixed(u).sum().astype(np.int64)
                ids, th = (batch.column(c).slice(run_.start, len(run_)) for c in (0, 1))
                offsets = pa.array(np.arange(0, len(own) * groups * rows + 1, groups * rows, dtype=np.int32))
                low = pa.array((sig >> np.uint64(32)).astype(np.uint32).view(np.int32).ravel())
                cols = [ids, th, pa.array(n), pa.array(h1), pa.array(h2), pa.ListArray.from_arrays(offsets, low)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "thash", "n", "h1", "h2", "sig"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for run_ in chunks(texts):
                flat, counts = shingle_hashes([texts[i] for i in run_], hashes, width)
                at = np.cumsum(counts) - counts
                own = [np.unique(flat[a : a + c]) for a, c in zip(at, counts)]
                offsets = pa.array(np.cumsum([0, *(len(u) for u in own)]).astype(np.int32))
                values = pa.array(np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64))
                ids = batch.column(0).slice(run_.start, len(run_))
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, values)], ["rep", "set"])

    return run


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, thash, n, h1, h2, sig) of every row: set size, two hashes of the
    whole set, and the minhashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("thash"), F.to_binary(text, F.lit("utf-8")).alias("bytes"))
    return rows.mapInArrow(_signatures(width, GROUPS, ROWS), "doc_id long, thash long, n long, h1 long, h2 long, sig array<int>")


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, i, j, rep, n): the keys of the tables (i, j) in which a class can
    meet another."""
    value = [F.xxhash64(F.lit(g), *[F.get("sig", F.lit(g * ROWS + r)) for r in range(ROWS)]) for g in range(GROUPS)]
    one = classes.select("rep", "n", F.posexplode(F.array(*value)).alias("g", "value"))
    shared = one.groupBy("value").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("value")
    mine = one.join(shared, "value").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("g", "value"))).alias("v")).where(F.size("v") > 1)
    v = F.col("v")

    def entry(a, b):
        return F.struct(F.xxhash64(a["g"], b["g"], a["value"], b["value"]).alias("key"), a["g"].alias("i"), b["g"].alias("j"))

    pairs = F.flatten(F.transform(v, lambda a, i: F.transform(F.slice(v, i + 2, F.lit(GROUPS)), lambda b: entry(a, b))))
    return mine.select(F.explode(pairs).alias("e"), "rep", "n").select("e.*", "rep", "n")


def _sizes_fit(a, b):
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILAR


def full_sets(wanted: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, width: int) -> DataFrame:
    """(rep, set) of the classes ``wanted`` (rep, id, thash)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("thash"), F.to_binary(text, F.lit("utf-8")).alias("bytes"))
    rows = rows.join(wanted, ["id", "thash"]).select("rep", "bytes")
    sets = rows.mapInArrow(_sets(width), "rep long, set array<long>")
    return cut_table(sets.dropDuplicates(["rep"]))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("rep").alias("u"), F.col("set").alias("su")), "u").join(sets.select(F.col("rep").alias("v"), F.col("set").alias("sv")), "v")
    common = F.size(F.array_intersect("su", "sv"))
    return both.where(100 * common >= SIMILAR * (F.size("su") + F.size("sv") - common)).select("u", "v")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows equal in ``keys``; the rows come in order of them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([np.array(batch.column(k)) for k in keys], axis=1)
        edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if held and tuple(marks[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(marks[a])
    if held:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return np.array(table.column(name))


def _lists(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.array(x.values) for x in table.column(name)]


def _pairs_found(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["u", "v"])


def _spanning(rep: np.ndarray, label: np.ndarray, asks: np.ndarray, linked) -> Iterator[tuple[int, int]]:
    """Links that join the components of a group, one per join.  ``linked`` gives
    the members linked with member i; the members that ask take a turn each."""
    label = label.copy()
    for i in np.flatnonzero(asks):
        other = label != label[i]
        if not other.any():
            continue
        other &= linked(i)
        while other.any():
            k = int(np.argmax(other))
            yield int(max(rep[i], rep[k])), int(min(rep[i], rep[k]))
            label[label == label[k]] = label[i]
            other &= label != label[i]


def _screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets -> pairs of different components that agree well enough, as many
    as it takes to keep together what may be linked."""
    found: list[tuple[int, int]] = []
    for group in _groups(batches, ["key", "lo", "hi"]):
        rep, label, n, asks = (_column(group, c) for c in ("rep", "component", "n", "asks"))
        sig = np.stack(_lists(group, "sig"))

        def linked(i: int) -> np.ndarray:
            fits = np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * SIMILAR
            return fits & ((sig == sig[i]).sum(axis=1) >= SCREEN)

        found += _spanning(rep, label, asks, linked)
        if len(found) > 50_000:
            yield _pairs_found(found)
            found = []
    yield _pairs_found(found)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clusters -> links between different components, from the full sets."""
    found: list[tuple[int, int]] = []
    for group in _groups(batches, ["key", "lo", "hi"]):
        rep, label, asks = (_column(group, c) for c in ("rep", "component", "asks"))
        sets = _lists(group, "set")
        n = np.array([len(x) for x in sets])
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), n)[np.argsort(ids, kind="stable")]
        start = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(values)))])
        own = np.split(ids, np.cumsum(n)[:-1])

        def linked(i: int) -> np.ndarray:
            common = np.bincount(np.concatenate([owner[start[x] : start[x + 1]] for x in own[i]]), minlength=len(sets))
            return 100 * common >= SIMILAR * (n + n[i] - common)

        found += _spanning(rep, label, asks, linked)
        if len(found) > 50_000:
            yield _pairs_found(found)
            found = []
    yield _pairs_found(found)


def _apart(rows: DataFrame, group: str, weight, block: int) -> DataFrame:
    """(group, main, asking, whole) of the groups of several components: the
    heaviest component, and blocks for the rows outside it and for all rows."""
    per = rows.groupBy(group, "component").agg(F.sum(weight).alias("w"))
    per = per.groupBy(group).agg(F.max(F.struct("w", "component")).alias("top"), F.sum("w").alias("all"))
    blocks = lambda x: F.ceil(x / block).cast("int")
    out = per.select(group, F.col("top.component").alias("main"), blocks(F.col("all") - F.col("top.w")).alias("asking"), blocks(F.col("all")).alias("whole"))
    return out.where("asking > 0")


def _dealt(rows: DataFrame, groups: DataFrame, group: str, own, other) -> DataFrame:
    """``rows`` joined with ``groups`` (one row each), the rows of a group in as
    many tasks as ``own`` says; ``other`` is the same number, of ``groups``."""
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), (other - 1).cast("int"))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), own).cast("int"))
    return rows.join(groups, [group, "salt"]).drop("salt")


def _in_blocks(rows: DataFrame, group: str) -> DataFrame:
    """Rows with (main, asking, whole) of their group, dealt out over (key, lo,
    hi): the rows of block lo that ask, and all rows of block hi.  A group of any
    size is worked off in bounded tasks, one for a small group; its largest
    component is not compared with itself."""
    turn = F.col("component") != F.col("main")
    lo, hi = (F.pmod(F.xxhash64("rep", F.lit(k)), F.col(c)).cast("int") for k, c in enumerate(("asking", "whole")))
    rows = rows.withColumns({"turn": turn, "own_lo": lo, "own_hi": hi})
    place = lambda a, b, asks: F.struct(a.alias("lo"), b.alias("hi"), asks.alias("asks"))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    answers = F.transform(every("asking"), lambda x: place(x, F.col("own_hi"), F.col("turn") & (x == F.col("own_lo"))))
    asks = F.transform(F.filter(every("whole"), lambda x: F.col("turn") & (x != F.col("own_hi"))), lambda x: place(F.col("own_lo"), x, F.lit(True)))
    rows = rows.withColumn("place", F.explode(F.concat(answers, asks))).select("*", "place.*").withColumnRenamed(group, "key")
    rows = rows.drop("place", "turn", "own_lo", "own_hi", "main", "asking", "whole")
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def class_components(reps: DataFrame, docs: DataFrame, **how) -> DataFrame | None:
    """(node, component) of the classes that are linked (None: none is)."""
    keys = cut_lineage(table_keys(reps))
    size = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    keys = cut_lineage(keys.join(size, "key"))
    # the class that meets most others is a bucket's centre: a text that others
    # were copied from meets more of them than they each other
    rank = keys.groupBy("rep").agg(F.sum("c").alias("meets"))
    keys = cut_lineage(keys.join(rank, "rep").withColumn("who", F.struct("meets", "rep", "n")))
    sets = full_sets(reps.join(rank, "rep", "left_semi").select("rep", "id", "thash"), docs, **how)

    pairs = keys.join(keys.groupBy("key").agg(F.max("who").alias("centre")), "key")
    pairs = pairs.where((F.col("rep") != F.col("centre.rep")) & _sizes_fit(F.col("n"), F.col("centre.n")))
    pairs = pairs.select(F.greatest("rep", "centre.rep").alias("u"), F.least("rep", "centre.rep").alias("v")).distinct()
    links = cut_lineage(confirmed(pairs, sets))
    comp = cut_lineage(connected_components(links))
    tree = comp.select(F.col("node").alias("u"), F.col("component").alias("v"))  # as few edges as keep the components

    part = keys.select("key", "c", "rep", "n").join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
    part = cut_lineage(part.withColumn("component", F.coalesce("component", "rep")))
    open_ = cut_lineage(_apart(part, "key", F.lit(1), BUCKET_ROWS))
    rest = _dealt(part, open_, "key", F.ceil(F.col("c") / BUCKET_ROWS), F.col("whole"))
    rest = _in_blocks(rest.drop("c").join(reps.select("rep", "sig"), "rep"), "key")
    maybe = cut_lineage(rest.mapInArrow(_screened, "u long, v long").distinct())
    if maybe.isEmpty():
        return comp
    # what may be linked, chained over the old links and the new pairs: a pair
    # left out of a bucket because its ends hang together is in one cluster
    cluster = connected_components(tree.union(maybe)).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    member = cluster.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    many = F.lit(SALTS)
    mixed_ = _apart(member, "cluster", F.lit(1), BUCKET_ROWS).select("cluster")
    member = cut_lineage(_dealt(member, mixed_, "cluster", many, many).join(sets, "rep"))
    member = _dealt(member, _apart(member, "cluster", F.size("set"), BLOCK_SHINGLES), "cluster", many, many)
    member = _in_blocks(member, "cluster")
    further = cut_lineage(member.mapInArrow(_compared, "u long, v long").distinct())
    return comp if further.isEmpty() else connected_components(tree.union(further))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, thash, n_shingles, component_id, kept) of every row."""
    how = {"id_col": id_col, "text_col": text_col, "width": width}
    signed = cut_lineage(signatures(docs, **how))
    known = signed.where("n > 0 and doc_id is not null")
    classes = known.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "thash", "sig")).alias("m"))
    # a class has a number of its own: an id may stand on rows of different texts
    number = F.monotonically_increasing_id().alias("rep")
    classes = cut_lineage(classes.select("h1", "h2", "n", number, F.col("m.doc_id").alias("id"), F.col("m.thash").alias("thash"), F.col("m.sig").alias("sig")))
    comp = class_components(classes, docs, **how)

    whole = classes.select("h1", "h2", "n", "rep", "id")
    if comp is None:
        whole = whole.withColumnRenamed("id", "component")
    else:
        named = comp.withColumnRenamed("node", "rep").join(whole.select("rep", "id"), "rep")
        named = named.select("rep", "component").join(named.groupBy("component").agg(F.min("id").alias("name")), "component")
        whole = whole.join(named.select("rep", "name"), "rep", "left").select("h1", "h2", "n", F.coalesce("name", "id").alias("component"))
    out = signed.join(whole, ["h1", "h2", "n"], "left")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "thash", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with one row for each group of near-duplicates: of the rows
    that carry the component's id, one."""
    none = F.lit(-(2**63))
    keep = near_duplicates(docs, id_col=id_col, text_col=text_col, width=width).where("kept")
    keep = keep.select(F.coalesce("doc_id", none).alias("__id"), F.col("thash").alias("__th")).distinct()
    key = {"__id": F.coalesce(F.col(id_col).cast("long"), none), "__th": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    rows = docs.withColumns(key).join(keep, list(key))
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy("__th"))).where("__n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
