"""Spelling variants: words of the corpus that one edit sets apart.

Words.  Runs of ``[A-Za-z\\u00C0-\\u00FF]`` of every whole text, A-Z in lower
case; ``damage`` (optional) may take one code point out of a document's run.
A task counts its words in a bounded table, Spark adds the counts up.

Search.  Two words at distance one share the first or the second half of either:
the edit lies in one of them.  So a word is searched twice: its first half is
matched exactly and the match extended to the right with one error, and its
second half exactly, extended to the left.  Both run on an FM-index of the
delimited vocabulary: the interval of suffix ranks is narrowed letter by letter
over the Burrows-Wheeler transform, from one delimiter to the other; the
extension to the right uses the index of the reversed words, that to the left
the index of the words.  An error is tried only where the interval holds
another word, with the letters that the transform holds in the interval.

Shards.  A word is filed under every half by which a word of its own length or
of one more or less may look for it (at most four), and looks under its own
two; halves are dealt to shards by hash, about ``SHARD`` filed words in each.
A half under which more than ``SHARD`` words are filed is split: its words are
dealt over several shards and each look-up goes to all of them.  So no shard
grows with the vocabulary, and no pairs are formed within a shard.

Forms.  A word's form is its near word of largest count (ties: the smallest in
code-point order) if that is at least ``factor`` times its own; the root is
reached by pointer doubling along the forms, whose counts at least double.

Null and empty texts have no words; a null id is written as an empty string;
rows of one id are damaged alike; repeated rows count each time.  A run may
have any length.  Only the named columns are read.  Without words: no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, cut_table

MIN_POINTS, MIN_COUNT, FACTOR = 5, 3, 2
SHARD = 1 << 14  # words filed in a shard
TABLE = 1 << 18  # words counted by a task before it passes them on
SLICE = 1 << 20  # characters of a long text split into runs at a time

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_GAP = re.compile("[^A-Za-zÀ-ÿ]")


# --------------------------------------------------------------------------- words
def drop_letter(doc_id: str, runs: list[str], every: int = 97) -> list[str]:
    """Damage of a document's distinct runs: where ``every`` divides h, the
    crc32 of ``<doc_id>:<run>``, the run loses its code point h % length."""
    base = zlib.crc32(f"{doc_id}:".encode())
    out = []
    for run in runs:
        h = zlib.crc32(run.encode(), base)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out.append(run)
    return out


def _runs(text: str) -> Counter:
    """Runs of a text and how often each stands there."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE:  # parts end between two runs
            gap = _GAP.search(text, at + SLICE)
            end = gap.start() if gap else end
        found.update(_RUNS.findall(text[at:end].encode().lower().decode()))  # bytes: A-Z only
        at = end
    return found


def count_words(docs: DataFrame, damage: Callable[[str, list[str]], list[str]] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n) of all words of ``MIN_POINTS`` code points that occur
    ``MIN_COUNT`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string()), pa.array(sums.values(), pa.int64())], ["word", "n"])
            sums.clear()
            return batch

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = _runs(body.as_py() or "")
                runs = list(found)
                for word, n in zip(damage(name or "", runs) if damage else runs, found.values()):
                    if len(word) >= MIN_POINTS:
                        sums[word] = sums.get(word, 0) + n
                if len(sums) > TABLE:
                    yield out()
        yield out()

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


# --------------------------------------------------------------------------- index
class FmIndex:
    """FM-index of delimited words that narrows an interval of suffix ranks by
    one letter at a time, in reading order of the words given."""

    def __init__(self, words: list[str]):
        # the text holds the words backwards, so that a step before the match reads a word's next letter
        points = np.frombuffer(("\0" + "\0".join(w[::-1] for w in words) + "\0").encode("utf-32-le"), np.uint32)
        self.letters, text = np.unique(points, return_inverse=True)
        self.n = n = len(text)
        ends = np.flatnonzero(text == 0)
        self.order = _suffix_order(text, ends, len(self.letters))
        self.before = text[self.order - 1]  # the transform: the letter before each suffix
        by = np.argsort(self.before, kind="stable")
        self.key = self.before[by].astype(np.int64) * (n + 1) + by
        self.word_at = np.full(n + 1, -1, np.int64)
        self.word_at[ends[:-1] + 1] = np.arange(len(words))

    def codes(self, words: list[str], width: int) -> np.ndarray:
        """The words as a matrix of letter numbers; 0 behind a word's end, and
        a number without rows for a letter that no indexed word has."""
        out = np.zeros((len(words), width), np.int64)
        lengths = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        out[np.arange(width) < lengths[:, None]] = np.where(self.letters[at] == points, at, len(self.letters))
        return out

    def everything(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """``count`` times the interval before which all words begin."""
        return np.zeros(count, np.int64), np.full(count, np.searchsorted(self.key, self.n + 1), np.int64)

    def step(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals narrowed by a letter each."""
        base = letter * (self.n + 1)
        return np.searchsorted(self.key, base + lo), np.searchsorted(self.key, base + hi)

    def whole(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words that end in each interval: (interval, word)."""
        which, at = _spread(*self.step(lo, hi, np.zeros(len(lo), np.int64)))
        return which, self.word_at[self.order[self.key[at]]]

    def follow(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The letters that may come next: (interval, letter), each pair once."""
        base = len(self.letters)
        narrow = np.flatnonzero(hi - lo <= base)
        which, at = _spread(lo[narrow], hi[narrow])
        wide = np.flatnonzero(hi - lo > base)
        pairs = [np.unique(narrow[which] * base + self.before[at]), (wide[:, None] * base + np.arange(base)).ravel()]
        which, letter = np.divmod(np.concatenate(pairs), base)
        return which[letter > 0], letter[letter > 0]


def _suffix_order(text: np.ndarray, ends: np.ndarray, letters: int) -> np.ndarray:
    """Starts of all suffixes in order.  What is behind a suffix's delimiter
    does not count; equal ones are ordered by place.  A round doubles the
    letters that are compared."""
    n = len(text)
    place = np.arange(n)
    left = ends[np.searchsorted(ends, place)] - place  # letters before the delimiter
    bits = int(letters).bit_length()
    width = min(n, max(1, 60 // bits))
    rank = np.zeros(n, np.int64)
    for k in range(width):
        rank <<= bits
        rank[: n - k] |= np.where(k < left[: n - k], text[k:], 0)
    while True:
        order = np.lexsort((np.where(left < width, place, 0), rank))
        same = (rank[order][1:] == rank[order][:-1]) & (left[order][1:] >= width)
        if not same.any():
            return order
        level = np.empty(n, np.int64)
        level[order] = np.append(0, np.cumsum(~same))
        rank = level * n
        rank[: n - width] += np.where(left[: n - width] >= width, level[width:], 0)
        width *= 2


def _spread(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals [a, b): (interval, place)."""
    size = b - a
    which = np.repeat(np.arange(len(a)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)


def search(index: FmIndex, words: list[str], exact: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, indexed word) at one edit: each of ``words`` matches its first
    ``exact`` letters, and one error lies behind them.  ``held``: the word is
    itself in the index.  A pair may come twice."""
    size = np.array([len(w) for w in words])
    by = np.argsort(size, kind="stable")
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    a = 0
    for b in range(1, len(by) + 1):  # parts of like length, of about a million letters
        if b == len(by) or (b + 1 - a) * size[by[b]] > 1 << 20:
            part = by[a:b]
            found += [(part[q], w) for q, w in _search(index, [words[i] for i in part], exact[part], size[part], held[part])]
            a = b
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _search(index: FmIndex, words: list[str], exact: np.ndarray, size: np.ndarray, held: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    code = index.codes(words, int(size.max()) + 1)
    q, p = np.arange(len(words)), 0
    lo, hi = index.everything(len(words))
    erred = np.zeros((4, 0), np.int64)  # query, its next letter, interval: after the error
    while len(q) or erred.shape[1]:
        if len(q):  # without an error so far: the interval of the first p letters
            at = exact[q] <= p
            erred = np.concatenate([erred, *_err(index, code, size, q[at], lo[at], hi[at], p)], axis=1)
            go = size[q] > p
            q, lo, hi = q[go], lo[go], hi[go]
            lo, hi = index.step(lo, hi, code[q, p])
            go = hi - lo > held[q]  # more than the word itself
            q, lo, hi = q[go], lo[go], hi[go]
            p += 1
        done = size[erred[0]] <= erred[1]
        if done.any():
            which, w = index.whole(*erred[2:, done])
            yield erred[0, done][which], w
        eq, at, a, b = erred[:, ~done]
        a, b = index.step(a, b, code[eq, at])
        erred = np.stack([eq, at + 1, a, b])[:, b > a]


def _err(index: FmIndex, code: np.ndarray, size: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, p: int) -> list[np.ndarray]:
    """States behind one error at letter ``p``: left out, put in, replaced."""
    inside = size[q] > p
    which, letter = index.follow(lo, hi)
    a, b = index.step(lo[which], hi[which], letter)
    other = inside[which] & (letter != code[q[which], p])
    return [
        np.stack([q[inside], np.full(inside.sum(), p + 1), lo[inside], hi[inside]]),
        np.stack([q[which], np.full(len(which), p), a, b])[:, b > a],
        np.stack([q[which], np.full(len(which), p + 1), a, b])[:, other & (b > a)],
    ]


# --------------------------------------------------------------------------- Spark
def _filed(words: DataFrame) -> DataFrame:
    """(left, half, word, n, asks): every word under the halves by which it may
    be looked for; ``asks`` where the half is its own.  ``left``: the half is
    the second one, and the match is extended to the left."""
    size = F.char_length("word")

    def lengths(of) -> Column:  # for a word that looks, of this length or of one less or more
        return F.array_distinct(F.array(*[of(F.greatest(size + d, F.lit(MIN_POINTS))) for d in (0, -1, 1)]))

    first, second = (lambda m: F.floor(m / 2).cast("int")), (lambda m: F.ceil(m / 2).cast("int"))
    right = F.transform(lengths(first), lambda k: F.struct(F.lit(False).alias("left"), F.col("word").substr(F.lit(1), k).alias("half"), (k == first(size)).alias("asks")))
    left = F.transform(lengths(second), lambda k: F.struct(F.lit(True).alias("left"), F.col("word").substr(size - k + 1, k).alias("half"), (k == second(size)).alias("asks")))
    return words.select("word", "n", F.explode(F.concat(right, left)).alias("f")).select("f.left", "f.half", "word", "n", "f.asks")


_PAIR = "word string, near string, near_n long"


def _near(table: pa.Table) -> pa.Table:
    """Pairs of a shard."""
    found: list[list] = [[], [], []]
    words, counts = table.column("word").to_pylist(), table.column("n").to_pylist()
    lefts, asks, target = (table.column(c).to_pylist() for c in ("left", "asks", "target"))
    for left in (False, True):
        held = {w: n for w, n, side, t in zip(words, counts, lefts, target) if side == left and t}
        asking = list(dict.fromkeys(w for w, side, a in zip(words, lefts, asks) if side == left and a))
        if not held or not asking:
            continue
        turn = (lambda w: w[::-1]) if left else (lambda w: w)
        exact = np.array([(len(w) + left) // 2 for w in asking])
        known = list(held)
        q, w = search(FmIndex([turn(x) for x in known]), [turn(x) for x in asking], exact, np.array([x in held for x in asking]))
        found[0] += [asking[i] for i in q]
        found[1] += [known[i] for i in w]
        found[2] += [held[known[i]] for i in w]
    return pa.table([pa.array(found[0], pa.string()), pa.array(found[1], pa.string()), pa.array(found[2], pa.int64())], ["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for all pairs of ``words`` (word, n; words distinct
    and of ``MIN_POINTS`` letters or more) at one edit, in both directions."""
    filed = _filed(words)
    shards = 1 + filed.count() // SHARD
    hot = filed.groupBy("left", "half").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("parts")).where("parts > 1")
    rows = filed.join(hot, ["left", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    rows = rows.withColumn("part", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own"))))
    dealt = F.pmod(F.xxhash64("left", "half"), F.lit(shards))
    shard = F.when(F.col("parts") == 1, dealt).otherwise(F.xxhash64("left", "half", "part"))
    rows = rows.select(shard.alias("shard"), "left", "word", "n", "asks", (F.col("part") == F.col("own")).alias("target"))
    return rows.groupBy("shard").applyInArrow(_near, _PAIR).distinct()


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that the forms lead to.
    Pointer doubling: a round halves the way that is left."""
    ways = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = cut_lineage(ways.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if ways.where("moved").isEmpty():
            return ways.drop("moved")
        ways = ways.drop("moved")


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n."""
    words = cut_table(words.select("word", "n"))
    near = near_words(words)
    # the largest count; of equal ones the smallest word
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = words.join(found, "word", "left")
    taken = -F.col("best.less") >= factor * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.form")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")
    )
    rows = cut_table(rows)
    roots = follow_forms(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
