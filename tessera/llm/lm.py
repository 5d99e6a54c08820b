"""Language-model scores by Brown's class-based bigrams.

    P(word | word before) = P(class | class before) x P(word | class)

1. Counts of all training words (partial counts in the tasks, then a sum).
2. Exchange clustering.  The ``CORE`` most frequent words (a bounded model
   parameter) are clustered by moving one word after another to the class
   that raises the likelihood of the class bigrams most, until few move; the
   bigram counts of the core come from all training texts.
3. Every other word is exchanged once against the core's classes: the
   likelihood of its neighbours under each class is a sum over its occurrences
   beside a core word or an end, made in the tasks and added up by word.  A word
   without any is in class 1.
4. Tokens get class and count: the ``TABLE`` most frequent words from a broadcast
   table (bounded by that parameter), all others by a join on the word.
   Class transitions are counted over all training texts.

Smoothing: a word's count gives up ``DISCOUNT`` within its class, which is the
mass of words not seen; transitions are backed off to class frequencies.  The
end token is a class of its own, and also what a text starts after.  For any
word before, the probabilities of all known words, the end and "any unknown
word" add up to 1.

A null text is empty (its one token is the end).  Rows may repeat and ids may
be null; each row is scored.  Without training texts every token, the end
included, has probability 1.  Only id and text are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, cut_table
from .common import kth_largest
from .shingles import chunks

CLASSES = 16
CORE = 1_024
TABLE = 1 << 19
SWEEPS = 12
DISCOUNT = 0.5
BACKOFF = 2.0
_FLUSH = 400_000  # different words that a task holds
_ROWS_OUT = 50_000
_HELD = 1 << 22  # tokens that a task holds
_END = 0  # class of the end token; word classes are 1 .. CLASSES


def _words(texts: list[bytes]) -> list[list[bytes]]:
    """Words with A-Z in lower case, split at ASCII white space."""
    return [t.lower().split() for t in texts]


def _texts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, range, list[bytes]]]:
    for batch in batches:
        texts = batch.column(column).to_pylist()
        for part in chunks(texts):
            yield batch, part, [texts[i] for i in part]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's words and how often each is met; a bounded table of them at a time."""
    count: Counter[bytes] = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        while count:
            some = [count.popitem() for _ in range(min(len(count), _ROWS_OUT))]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    for _, _, texts in _texts(batches):
        for words in _words(texts):
            count.update(words)
        if len(count) > _FLUSH:
            yield from out()
    yield from out()


def _sequence(words: list[list[bytes]], index: dict, end: int, missing: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens, each text between two ends, and the place of the
    end before each text.  A word that ``index`` lacks is ``missing``."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    total, start = int(size.sum()), np.cumsum(size + 1) - size - 1
    flat = chain.from_iterable(words)
    numbers = map(index.__getitem__, flat) if missing is None else map(index.get, flat, repeat(missing))
    seq, inside = np.full(total + len(words) + 1, end, dtype=np.int32), np.ones(total + len(words) + 1, dtype=bool)
    inside[start] = inside[-1] = False
    seq[inside] = np.fromiter(numbers, dtype=np.int32, count=total)
    return seq, start


def _core_bigrams(core: list[bytes]):
    """Counts of neighbours among the core words; number len(core) is the end."""
    size = len(core) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = {w: i for i, w in enumerate(core)}, np.zeros(size * size, dtype=np.int64)
        for _, _, texts in _texts(batches):
            seq, _ = _sequence(_words(texts), index, len(core), -1)
            a, b = seq[:-1].astype(np.int64), seq[1:]
            both = (a >= 0) & (b >= 0)
            np.add.at(total, a[both] * size + b[both], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class (1 .. ``classes``) of each word by exchange clustering.  The last
    row and column of ``bigrams`` are the end token, whose class stays 0."""
    words = len(bigrams) - 1
    cls = np.empty(words + 1, dtype=np.int64)
    cls[:words] = 1 + np.arange(words) % classes
    cls[words] = _END
    n = classes + 1
    member = np.zeros((words + 1, n))
    member[np.arange(words + 1), cls] = 1
    grid = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            right, left, own = bigrams[w] @ member, bigrams[:, w] @ member, bigrams[w, w]
            a = cls[w]
            right[a] -= own
            left[a] -= own
            grid[a] -= right
            grid[:, a] -= left
            grid[a, a] -= own
            member[w, a] = 0
            rows, cols = grid.sum(1), grid.sum(0)
            base = _xlogx(grid)
            gain = (_xlogx(grid + right[None, :]) - base).sum(1) + (_xlogx(grid + left[:, None]) - base).sum(0)
            d = np.arange(n)
            diag = grid[d, d]
            gain += _xlogx(diag + right + left + own) - _xlogx(diag + right) - _xlogx(diag + left) + _xlogx(diag)
            gain -= _xlogx(rows + right.sum() + own) - _xlogx(rows) + _xlogx(cols + left.sum() + own) - _xlogx(cols)
            gain[_END] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            cls[w] = b
            grid[b] += right
            grid[:, b] += left
            grid[b, b] += own
            member[w, b] = 1
        if moved <= words // 200:
            break
    return cls


def _blocks(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column from one array and the byte offsets of its values."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])


def _bytes_of(column: pa.Array) -> np.ndarray:
    """The bytes of all values of a binary column, end to end."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]


def _neighbour_scores(core: list[bytes], cls: np.ndarray, after: np.ndarray, before: np.ndarray):
    """(word, n, s): a word's count and, for each class, the likelihood of its
    neighbours if the word were in it (little-endian 32-bit floats)."""
    states, classes = after.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: int(c) for w, c in zip(core, cls)}
        index, held, tokens = defaultdict(count(1).__next__), [], 0  # number 0 is the end

        def flush() -> pa.RecordBatch:
            seq = np.concatenate(held)
            names = list(index)
            size = len(names) + 1
            kind = np.full(size, states, dtype=np.int64)  # the last one: no core word
            kind[0] = _END
            for w, c in known.items():
                if w in index:
                    kind[index[w]] = c
            k, score = kind[seq], np.zeros((size, classes))
            for own, other, weight in ((seq[:-1], k[1:], after), (seq[1:], k[:-1], before)):
                times = np.bincount(own.astype(np.int64) * (states + 1) + other, minlength=size * (states + 1))
                score += times.reshape(size, states + 1)[:, :states] @ weight
            n = np.bincount(seq, minlength=size)
            s = _blocks(score[1:].astype("<f4"), np.arange(size) * 4 * classes)
            index.clear()
            index.default_factory = count(1).__next__
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(n[1:]), s], ["word", "n", "s"])

        for _, _, texts in _texts(batches):
            held.append(_sequence(_words(texts), index, 0)[0])
            tokens += len(held[-1])
            if len(index) > _FLUSH or tokens > _HELD:
                if index:
                    yield flush()
                held, tokens = [], 0
        if index:
            yield flush()

    return run


def _added(classes: int):
    """Rows in order of word -> one row per word with the best class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last word may go on in the next batch

        def out(words: pa.Array, n, s) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64()), pa.array(1 + np.argmax(s, axis=1), pa.int32())], ["word", "n", "cls"])

        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column(0).cast(pa.binary()), np.array(batch.column(1))
            s = _bytes_of(batch.column(2)).view("<f4").astype(np.float64).reshape(len(words), classes)
            if held:
                words, n, s = pa.concat_arrays([held[0], words]), np.concatenate([held[1], n]), np.concatenate([held[2], s])
            other = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], 1 + np.flatnonzero(other)])
            n, s = np.add.reduceat(n, first), np.add.reduceat(s, first, axis=0)
            words = words.take(pa.array(first))
            last = len(words) - 1
            held = (words.slice(last), n[last:], s[last:])
            if last:
                yield out(words.slice(0, last), n[:last], s[:last])
        if held:
            yield out(*held)

    return run


def cluster(train: DataFrame, *, classes: int = CLASSES, core: int = CORE) -> DataFrame:
    """(word, n, cls) of every word of ``train`` (one binary text column)."""
    counts = cut_table(train.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    top = [bytes(r.word) for r in counts.where(F.col("n") >= kth_largest(counts, core)[0]).orderBy(F.desc("n"), "word").limit(core).collect()]
    size = len(top) + 1
    pairs = train.mapInArrow(_core_bigrams(top), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    bigrams = np.zeros(size * size)
    bigrams[np.array(pairs.column("pair"), dtype=np.int64)] = np.array(pairs.column("n"))
    bigrams = bigrams.reshape(size, size)
    cls = exchange(bigrams, classes)
    member = np.zeros((size, classes + 1))
    member[np.arange(size), cls] = 1
    grid = member.T @ bigrams @ member + 0.1
    forward = np.log(grid / grid.sum(1, keepdims=True))  # of the class after
    backward = np.log(grid / grid.sum(0, keepdims=True))  # of the class before
    scores = train.mapInArrow(_neighbour_scores(top, cls[:-1], forward[1:].T.copy(), backward[:, 1:].copy()), "word binary, n long, s binary")
    best = scores.repartition("word").sortWithinPartitions("word").mapInArrow(_added(classes), "word binary, n long, cls int")
    spark = train.sparkSession
    moved = spark.createDataFrame([(bytearray(w), int(c)) for w, c in zip(top, cls)], "word binary, own int")
    return best.join(F.broadcast(moved), "word", "left").select("word", "n", F.coalesce("own", "cls").alias("cls"))


def _encode(table: dict, end_count: int, log_emit_end: float, n_classes: int):
    """Per row: tokens, known tokens, sums of log10(c + 1) and of emissions, class
    pairs (code, times), and the words that the table lacks with their place."""
    states = n_classes + 2  # end, classes, unknown

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cls, base, emit = table.value
        index = {w: i for i, w in enumerate(words.split(b"\n") if words else [])}
        end = len(cls)  # number of the end; -1, the last entry, is "not in the table"
        cls = np.concatenate([cls, [_END, -1]]).astype(np.int64)
        base = np.concatenate([base, [np.log10(end_count + 1), 0.0]])
        emit = np.concatenate([emit, [log_emit_end, 0.0]])
        row = TaskContext.get().partitionId() << 33
        for batch, part, texts in _texts(batches, 2):
            n = len(texts)
            split = _words(texts)
            seq, start = _sequence(split, index, end, -1)
            k = cls[seq]
            size = np.diff(np.concatenate([start, [len(seq) - 1]]))  # tokens, the end included
            doc = np.repeat(np.arange(n), size)  # of every token but the first end
            here, before = k[1:], k[:-1]
            both = (here >= 0) & (before >= 0)
            grid = np.bincount(doc[both] * states * states + before[both] * states + here[both], minlength=n * states * states).reshape(n, -1)
            own, code = np.nonzero(grid)
            ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))])
            token = seq[1:]
            known = np.add.reduceat(((token != end) & (here >= 0)).astype(np.int64), start) + (end_count > 0)
            rare = np.flatnonzero(here < 0)
            lists = np.concatenate([[0], np.cumsum(np.bincount(doc[rare], minlength=n))]).astype(np.int32)
            rare_at = rare - start[doc[rare]]
            rare_words = pa.array([split[d][i] for d, i in zip(doc[rare].tolist(), rare_at.tolist())], pa.binary())
            after = np.append(k, _END)[rare + 2]
            fields = [pa.array(rare_at.astype(np.int32)), pa.array(before[rare].astype(np.int8)), pa.array(after.astype(np.int8))]
            places = pa.StructArray.from_arrays(fields, ["at", "l", "r"])
            cols = [
                batch.column(0).slice(part.start, n),
                batch.column(1).slice(part.start, n),
                pa.array(np.arange(row, row + n)),
                pa.array(size),
                pa.array(known),
                pa.array(np.add.reduceat(base[token], start)),
                pa.array(np.add.reduceat(emit[token], start)),
                _blocks(code.astype("<u2"), ends * 2),
                _blocks(grid[own, code].astype("<u4"), ends * 4),
                pa.ListArray.from_arrays(pa.array(lists), rare_words),
                pa.ListArray.from_arrays(pa.array(lists), places),
            ]
            row += n
            yield pa.RecordBatch.from_arrays(cols, ["id", "held_out", "row", "n_tokens", "n_known", "base", "emit", "codes", "times", "rare", "places"])

    return run


def _resolved(n_classes: int):
    """Adds the class pairs of the words that were looked up by a join."""
    unknown, states = n_classes + 1, n_classes + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_codes, out_times = [], []
            for codes, times, found in zip(batch.column(7).to_pylist(), batch.column(8).to_pylist(), batch.column(9).to_pylist()):
                if found:
                    here = {f["at"]: unknown if f["cls"] is None else f["cls"] for f in found}
                    more = []
                    for f in found:
                        c = here[f["at"]]
                        more.append((f["l"] if f["l"] >= 0 else here[f["at"] - 1]) * states + c)
                        if f["r"] >= 0:  # else the next one adds the pair
                            more.append(c * states + f["r"])
                    a = np.concatenate([np.frombuffer(codes, "<u2"), np.array(more)]).astype(np.int64)
                    w = np.concatenate([np.frombuffer(times, "<u4"), np.ones(len(more))])
                    total = np.bincount(a, weights=w)
                    some = np.flatnonzero(total)
                    codes, times = some.astype("<u2").tobytes(), total[some].astype("<u4").tobytes()
                out_codes.append(codes)
                out_times.append(times)
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(out_codes, pa.binary()), pa.array(out_times, pa.binary())], batch.schema.names[:9])

    return run


def _pairs(states: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(states * states)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_bytes_of(batch.column(0)).view("<u2"), weights=_bytes_of(batch.column(1)).view("<u4"), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], ["pair", "n"])

    return run


def _score(log_step: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = [float((log_step[np.frombuffer(c, "<u2")] * np.frombuffer(t, "<u4")).sum()) for c, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(step, pa.float64())], [*batch.schema.names[2:], "step"])

    return run


def transitions(pairs: np.ndarray, size: np.ndarray, types: np.ndarray) -> np.ndarray:
    """log10 of the step from one state to the next.  States: end, classes,
    unknown.  ``size`` and ``types`` are the words and different words of a
    class (index 0: the end)."""
    states = len(size) + 1
    unknown = states - 1
    grid = pairs[:unknown, :unknown]
    total = max(size.sum(), 1.0)
    prior = size / total
    step = np.zeros((states, states))
    step[:unknown, :unknown] = (grid + BACKOFF * prior) / (grid.sum(1, keepdims=True) + BACKOFF)
    step[unknown, :unknown] = prior
    gives = np.where(size > 0, DISCOUNT * types / np.maximum(size, 1), 0.0)
    gives[_END] = 0.0
    step[:, unknown] = step[:, :unknown] @ gives
    if not size.sum():
        step[:] = 1.0
    return np.log10(np.maximum(step, 1e-300))


def score(docs: DataFrame, held_out: Column, *, classes: int = CLASSES, core: int = CORE, table: int = TABLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    row; the model is trained on the rows for which ``held_out`` is false."""
    spark = docs.sparkSession
    text = F.to_binary(F.coalesce(F.col(text_col), F.lit("")), F.lit("utf-8"))
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), text.alias("text"))
    train = rows.where("not held_out").select("text")
    vocab = cut_table(cluster(train, classes=classes, core=core))
    stats = vocab.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    n_train = train.count()
    size, types = np.zeros(classes + 1), np.zeros(classes + 1)
    size[_END], types[_END] = n_train, min(n_train, 1)
    for r in stats:
        size[r.cls], types[r.cls] = r.n, r.types
    tokens, distinct = int(size.sum()), int(types.sum())

    # about ``table`` words; of those equally frequent at its end a share by hash
    least, share = kth_largest(vocab, table)
    tied = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    top = vocab.where((F.col("n") > least) | ((F.col("n") == least) & tied)).toArrow()
    n_top, cls_top = np.array(top.column("n"), dtype=np.float64), np.array(top.column("cls"), dtype=np.int64)
    emit_top = np.log10((n_top - DISCOUNT) / size[cls_top]) if len(n_top) else n_top
    shared = spark.sparkContext.broadcast((b"\n".join(top.column("word").to_pylist()), cls_top, np.log10(n_top + 1), emit_top))

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, row long, n_tokens long, n_known long, base double, emit double, codes binary, times binary, rare array<binary>, places array<struct<at:int,l:tinyint,r:tinyint>>"
    coded = cut_table(rows.mapInArrow(_encode(shared, n_train, 0.0, classes), schema))
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "places")).alias("x")).select("row", F.col("x.rare").alias("word"), "x.places.*")
    looked = rare.join(vocab, "word", "left")
    share = F.element_at(F.array(*[F.lit(float(x)) for x in np.maximum(size, 1.0)]), F.col("cls") + 1)
    emitted = F.when(F.col("n").isNotNull(), F.log10((F.col("n") - DISCOUNT) / share)).otherwise(F.lit(0.0))
    per = looked.groupBy("row").agg(
        F.collect_list(F.struct("at", "l", "r", "cls")).alias("found"),
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more_base"),
        F.sum(emitted).alias("more_emit"),
        F.count("n").alias("more_known"),
    )
    zero = F.lit(0.0)
    joined = coded.drop("rare", "places").join(per, "row", "left").select(
        "id", "held_out", "row", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base"),
        (F.col("emit") + F.coalesce("more_emit", zero)).alias("emit"),
        "codes", "times", "found",
    )
    done = schema.partition(", rare")[0]
    resolved = cut_lineage(joined.mapInArrow(_resolved(classes), done))

    states = classes + 2
    grid = np.zeros(states * states)
    for r in resolved.where("not held_out").select("codes", "times").mapInArrow(_pairs(states), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        grid[r.pair] = r.n
    log_step = transitions(grid.reshape(states, states), size, types).ravel()
    scored = resolved.select("codes", "times", "id", "held_out", "n_tokens", "n_known", "base", "emit").mapInArrow(
        _score(log_step), f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, emit double, step double"
    )
    norm = float(np.log10(tokens + distinct + 1))
    return scored.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("emit") + F.col("step")).alias("score"),
    )
