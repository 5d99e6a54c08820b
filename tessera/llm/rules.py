"""Quality rules as a learned decision list (DataFrame functions only).

Sequential covering on labelled statistics.  Every labelled document is a
vector of bins (a feature's bin counts the thresholds below its value; the
thresholds are quantiles over the labelled documents).  A rule is a conjunction
of threshold conditions, grown condition by condition for information gain on
the grow part, then cut back on the prune part (a hash of the id splits them).
A rule is accepted while it is right on the prune part; the documents it
covers are taken out, and the next rule is grown.  Each step reads one
histogram (feature, bin) -> counts, made by a partial aggregate over the
labelled documents and bounded by features x bins.  The list becomes one
ordered conditional expression over the features.

``MAX_CONDITIONS`` bounds the length of a rule (a model parameter).  The list
ends when no bad document is left or a rule is not accepted; every accepted one
takes out ``MIN_COVER`` documents or more.  All labelled documents are used.

Texts: null counts as without words.  Labels: a document with several labels is
bad if any says so; null labels are left out; without labels the list is
empty and only the base rule decides.  Ids may be null or repeat: a verdict
depends on the row's own text.  Only id and text are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WORD, words_of

MAX_CONDITIONS = 3
BINS = 24
MIN_PRECISION = 0.9
MIN_COVER = 3
PRUNE_PARTS = 3  # one part of so many prunes
SYMBOLS = r"[#*$%&|<>]"

#: Features of the list, as SQL over the columns of ``measure``.
FEATURES = {
    "words": "n_words",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
}


def _windows(words: Column) -> Column:
    """A hash for each 3-word window of the array column ``words``."""
    n = F.size(words)
    i = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(i, lambda k: F.xxhash64(F.get(words, k), F.get(words, k + 1), F.get(words, k + 2)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base counts (n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words) and those of the learned features."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    rows = rows.withColumn("w", words_of(F.col("t"))).withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)))
    rows = rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit(r"[!?;:|*$%&#@~^=+]")).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("w")).alias("h"),
    )
    # a window hash occurs again where a sorted neighbour is equal
    rows = rows.withColumn("twice", F.size("h") > F.size(F.array_distinct("h")))
    pairs = F.transform("h", lambda x, k: F.struct(x.alias("h"), k.alias("k")))
    rows = rows.withColumn("s", F.when(F.col("twice"), F.array_sort(pairs)).otherwise(F.array().cast("array<struct<h:bigint,k:int>>")))
    s = F.col("s")
    same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
    again = F.filter("s", lambda x, k: same(x, k - 1) | same(x, k + 1))
    inside = F.flatten(F.transform(again, lambda x: F.array(x["k"], x["k"] + 1, x["k"] + 2)))
    return rows.withColumn("n_repeat_words", F.size(F.array_distinct(inside)).cast("long")).drop("h", "s", "twice")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def on_bins(self) -> Column:
        b = F.element_at("bins", list(FEATURES).index(self.feature) + 1)
        return b > self.bin if self.above else b <= self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _below(feature: str):
    return lambda edge: F.col(feature) > edge


def _all(conditions, how) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & how(c)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(measured: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality") -> list[list[Condition]]:
    """Ordered rules that say "reject", from labels (1 good, 0 bad)."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg((F.min(label_col) == 0).cast("int").alias("bad"))
    known = measured.where(~base_failed()).join(marks, "doc_id")
    names = list(FEATURES)
    values = known.select("bad", F.pmod(F.xxhash64("doc_id"), F.lit(PRUNE_PARTS)).alias("part"), *[F.expr(FEATURES[f]).cast("double").alias(f) for f in names])
    at = [i / (BINS + 1) for i in range(1, BINS + 1)]
    cuts = values.agg(
        *[F.percentile_approx(f, at, 10_000).alias(f) for f in names], *[F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), at, 10_000).alias(f"{f}__bad") for f in names]
    ).first()
    if cuts is None or cuts[names[0]] is None:
        return []
    edges = {f: sorted({*(cuts[f] or []), *(cuts[f"{f}__bad"] or [])}) for f in names}
    bins = [F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges[f]]), _below(f))) for f in names]
    left = cut_lineage(values.select("bad", "part", F.array(*bins).alias("bins")))

    rules: list[list[Condition]] = []
    while True:
        grow, rule = left.where("part > 0"), []
        best_gain = 1.0
        while len(rule) < MAX_CONDITIONS:
            rows = grow.where(_all(rule, Condition.on_bins)).select("bad", F.posexplode("bins").alias("f", "b")).groupBy("f", "b").agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).collect()
            if not rows:
                break
            of = {(r.f, r.b): (r.p, r.n - r.p) for r in rows}
            p0, n0 = (sum(x[i] for (f, _), x in of.items() if f == 0) for i in (0, 1))
            if not p0 or not n0:
                break
            best = None
            for f, name in enumerate(names):
                p = n = 0
                for b, edge in enumerate(edges[name]):
                    p, n = p + of.get((f, b), (0, 0))[0], n + of.get((f, b), (0, 0))[1]
                    for above, (x, y) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        g = _gain(x, y, p0, n0)
                        if best is None or g > best[0] + 1e-9:
                            best = (g, Condition(name, above, float(edge), b))
            if best is None or best[0] < best_gain:
                break
            rule.append(best[1])
        if not rule:
            break
        upto = [_all(rule[: k + 1], Condition.on_bins) for k in range(len(rule))]
        counts = left.where("part = 0").agg(*[F.sum(F.when(c, F.col("bad"))).alias(f"p{k}") for k, c in enumerate(upto)], *[F.sum(F.when(c, 1 - F.col("bad"))).alias(f"n{k}") for k, c in enumerate(upto)]).first()
        score = [((counts[f"p{k}"] or 0), (counts[f"n{k}"] or 0)) for k in range(len(rule))]
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in score]
        k = max(range(len(rule)), key=lambda i: (worth[i], -i))
        p, n = score[k]
        if p < MIN_COVER or (p + 1) / (p + n + 2) < MIN_PRECISION * (p + 1) / (p + 2):
            break
        rules.append(rule[: k + 1])
        left = cut_lineage(left.where(~_all(rules[-1], Condition.on_bins)))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """True: keep.  One ordered conditional expression over measured columns."""
    out = F.when(base_failed(), False)
    for rule in rules:
        out = out.when(_all(rule, Condition.column), False)
    return out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` of every row of ``docs``."""
    measured = cut_lineage(measure(docs, id_col, text_col))
    rules = learn(measured, labels)
    return measured.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), verdict(rules).alias("kept")
    )


def kept_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the learned list keeps, with their columns.  The
    rows' counts are a checkpoint keyed by (id, text hash); rows equal in both
    have one verdict."""
    key = [F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__thash")]
    measured = cut_lineage(measure(docs.select(F.struct(*key).alias("key"), F.col(text_col)), "key", text_col))
    rules = learn(measured.withColumn("key", F.col("doc_id")).withColumn("doc_id", F.col("key.__id")), labels)
    keep = measured.where(verdict(rules)).select("doc_id.__id", "doc_id.__thash").distinct()
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("k.__id")) & (F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("k.__thash"))
    return docs.alias("d").join(keep.alias("k"), same, "left_semi")
