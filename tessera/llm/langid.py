"""Language identification of documents that may mix languages.

A document's words are drawn from a mixture of languages.  A word's likelihood
in a language is the product of its letter trigrams' (a space stands before and
after the word); trigrams are hashed into ``BUCKETS`` buckets, whose smoothed
counts are learned from labelled documents.  Expectation-maximisation estimates
the document's proportions over all languages; then sets of the 1, 2, 3, ...
languages of largest proportion are fitted in turn, and a set grows as long as
its log-likelihood gains more than ``PENALTY`` * log(words + 1).

Learning counts every training text: a task sums its own counts, Spark adds them
up by (language, bucket).  The model has ``BUCKETS`` numbers a language, whatever
the size of the corpus; it grows with the number of languages only.

A word is a run of letters in lower case, in pieces of at most ``PIECE``; a
letter is what Unicode calls one.  Null texts and texts without a letter are
``und`` with score 0, as is every text where nothing was learned.  Training
rows without text or language are left out.  Equal proportions go to the smaller
code; repeated rows are judged one by one, each by its text alone.  Only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 1 << 17
PIECE = 16
ALPHA = 0.1  # added to every bucket's count
PENALTY = 2.0
FULL_ROUNDS, SET_ROUNDS = 12, 8
CHUNK = 1 << 19  # characters judged together
SLICE = 1 << 18  # characters of a long text split into words at a time
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]{1,%d}" % PIECE)
_BREAK = re.compile(r"[\W\d_]")
_TABLE = 1 << 18  # words remembered by a worker
_M = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint64)


@dataclass(frozen=True)
class Model:
    """Languages in code order and log-probabilities (bucket, language)."""

    languages: tuple[str, ...]
    log_p: np.ndarray


class Words(dict):
    """Word -> number, and the words met for the first time; -1 for a run of
    numerals that holds no letter."""

    def __init__(self) -> None:
        self.fresh: list[str] = []
        self.n = 0

    def __missing__(self, word: str) -> int:
        if not any(map(str.isalpha, word)):
            self[word] = -1
            return -1
        self[word] = no = self.n
        self.n += 1
        self.fresh.append(word)
        return no


def _slices(text: str) -> Iterator[str]:
    """``text`` in parts that end between two words (or, in a run of letters
    longer than a quarter of ``SLICE``, inside it)."""
    at = 0
    while len(text) - at > SLICE:
        found = _BREAK.search(text, at + SLICE, at + SLICE + SLICE // 4)
        end = found.start() if found else min(len(text), at + SLICE + SLICE // 4)
        yield text[at:end]
        at = end
    yield text[at:]


def _numbers(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a text and how often each stands there."""
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in _slices(text.lower()):
        some = _WORDS.findall(part)
        no = np.fromiter(map(words.__getitem__, some), np.int64, len(some))
        no, c = np.unique(no[no >= 0], return_counts=True)
        if len(found):
            no, at = np.unique(np.concatenate([found, no]), return_inverse=True)
            c = np.bincount(at, np.concatenate([counts, c])).astype(np.int64)
        found, counts = no, c
    return found, counts


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of ``words`` end to end, and where each word's
    start (a word has as many as letters)."""
    points = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    mixed = points[:-2] * _M[0] + points[1:-1] * _M[1] + points[2:] * _M[2]
    mixed = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths + 2) - lengths - 2
    own = np.ones(len(mixed), bool)
    own[(starts[1:] - 1)[:, None] - np.arange(2)] = False  # the two that span the gap before a word
    return (mixed[own] % np.uint64(BUCKETS)).astype(np.int64), np.cumsum(lengths) - lengths


# --------------------------------------------------------------------------- learning
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])], ["lang", "bucket", "n"])
        sums.clear()

    for batch in batches:
        words, per = Words(), {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found, counts = _numbers(text.as_py(), words)
            per.setdefault(lang, []).append((found, counts))
        if not words.n:
            continue
        grams, starts = _grams(words.fresh)
        lengths = np.diff(np.append(starts, len(grams)))
        for lang, parts in per.items():
            n = np.bincount(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), words.n)
            if lang not in sums and len(sums) >= 64:  # a task holds the counts of so many languages
                yield from out()
            sums[lang] = sums.get(lang, 0) + np.bincount(grams, np.repeat(n, lengths), BUCKETS).astype(np.int64)
    yield from out()


def learn(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang") -> Model:
    """The trigram model of the rows where ``train`` holds."""
    rows = docs.where(train).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    parts = rows.mapInArrow(_count, "lang string, bucket int, n long")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(sums["lang"].unique()))
    counts = np.full((BUCKETS, len(languages)), ALPHA)
    counts[sums["bucket"], sums["lang"].map({name: i for i, name in enumerate(languages)}).astype(int)] += sums["n"]
    return Model(languages, np.log(counts / counts.sum(0)).astype(np.float32))


# --------------------------------------------------------------------------- inference
def _em(p: np.ndarray, c: np.ndarray, doc: np.ndarray, start: np.ndarray, total: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (document, language) and log-likelihoods, from word
    likelihoods ``p``, counts ``c`` and each word's document."""
    share = np.full((len(start), p.shape[1]), 1.0 / p.shape[1])
    for _ in range(rounds if p.shape[1] > 1 else 0):
        r = p * share[doc]
        r *= (c / np.maximum(r.sum(1), 1e-300))[:, None]
        share = np.add.reduceat(r, start) / total[:, None]
    return share, np.add.reduceat(c * np.log(np.maximum((p * share[doc]).sum(1), 1e-300)), start)


def mixture(p: np.ndarray, c: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each document its languages, largest proportion first, and their
    proportions.  ``p``: likelihoods (word, language), scaled by any factor
    a word; ``sizes``: distinct words of each document, all positive."""
    start = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    total = np.add.reduceat(c, start)
    first, _ = _em(p, c, doc, start, total, FULL_ROUNDS)
    order = np.argsort(-first, axis=1, kind="stable")
    out: list = [None] * len(sizes)
    best = np.full(len(sizes), -np.inf)
    live = np.arange(len(sizes))  # documents whose set still grows
    for k in range(1, p.shape[1] + 1):
        rows = np.isin(doc, live) if len(live) < len(sizes) else slice(None)
        at = np.searchsorted(live, doc[rows])
        chosen = order[live, :k]
        size = sizes[live]
        share, score = _em(np.take_along_axis(p[rows], chosen[at], 1), c[rows], at, np.cumsum(size) - size, total[live], SET_ROUNDS)
        score -= PENALTY * (k - 1) * np.log(total[live] + 1)
        better = score > best[live]
        for j in np.flatnonzero(better):
            by = np.lexsort((chosen[j], -share[j]))
            out[live[j]] = chosen[j][by], share[j][by]
        best[live] = np.maximum(best[live], score)
        live = live[better]
        if not len(live):
            break
    return out


class Judge:
    """Languages of texts under a model; remembers the likelihoods of words."""

    def __init__(self, model: Model):
        self.model, self.words, self.known = model, Words(), np.zeros((0, len(model.languages)))

    def _likelihoods(self, no: np.ndarray) -> np.ndarray:
        if self.words.fresh:
            grams, starts = _grams(self.words.fresh)
            logs = np.empty((len(starts), len(self.model.languages)))
            for a in range(0, len(starts), 4096):  # so many words' trigrams at a time
                end = starts[a + 4096] if a + 4096 < len(starts) else len(grams)
                logs[a : a + 4096] = np.add.reduceat(self.model.log_p[grams[starts[a] : end]].astype(float), starts[a : a + 4096] - starts[a])
            self.known = np.concatenate([self.known, np.exp(logs - logs.max(1, keepdims=True))])
            self.words.fresh = []
        return self.known[no]

    def __call__(self, texts: list[str | None]) -> list[list[tuple[str, float]]]:
        """For each text (language, proportion), the largest first."""
        out: list = [[] for _ in texts]
        if not self.model.languages:
            return out
        if self.words.n > _TABLE:
            self.words, self.known = Words(), self.known[:0]
        found = [(i, *_numbers(t, self.words)) for i, t in enumerate(texts) if t]
        found = [f for f in found if len(f[1])]
        if found:
            p = self._likelihoods(np.concatenate([f[1] for f in found]))
            c = np.concatenate([f[2] for f in found]).astype(float)
            for (i, _, _), (langs, shares) in zip(found, mixture(p, c, np.array([len(f[1]) for f in found]))):
                out[i] = [(self.model.languages[k], float(min(1.0, s))) for k, s in zip(langs, shares)]
        return out


_LANGUAGES = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``lang_pred`` (the language of the largest
    proportion), ``score`` (that proportion), ``languages`` (all of the
    chosen set, with proportions)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p))
    chunk = CHUNK // max(1, len(model.languages) // 8)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = Judge(Model(*shared.value))
        for batch in batches:
            column = batch.column(0)
            ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + chunk, "right")))
                found = ask(column.slice(a, b - a).to_pylist())
                pred = pa.array([f[0][0] if f else UNKNOWN for f in found], pa.string())
                score = pa.array([f[0][1] if f else 0.0 for f in found], pa.float64())
                sets = pa.array([[{"lang": x, "share": s} for x, s in f] for f in found], _LANGUAGES)
                kept = [batch.column(i).slice(a, b - a) for i in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, pred, score, sets], [*keep, "lang_pred", "score", "languages"])
                a = b

    given = docs.select(F.col(text).alias("__text"), *keep)
    schema = StructType(given.select(*keep).schema.fields).add("lang_pred", "string").add("score", "double")
    made = docs.sparkSession.range(0).select(F.expr("cast(null as array<struct<lang: string, share: double>>)").alias("languages"))
    return given.mapInArrow(judge, StructType([*schema.fields, *made.schema.fields]))
