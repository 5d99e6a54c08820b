"""Mixing sources to target weights (DataFrame functions only).

The words of a source form one line: its documents one after another.  The
line is cut into blocks of ``block_words`` words (the last one shorter).  The
mix is a sequence of slots dealt out over output shards; a slot holds a block.

1. ``targets``: words that each source gives, by weights, with every source
   capped at ``max_repeats`` times its size and the excess reshared.
2. ``slots``: a source fills ``target`` words with passes over its blocks.
   Slot k of a source reads block ``perm(k)`` of a pseudorandom permutation of
   the block indexes, a new one on each pass; the last slot is cut so that the
   words add up.  Where the slot lands in the output is a permutation of all
   slots, so the counts of sources in a shard are a multinomial draw
   conditioned on the totals (plain draws would miss the target of a source of
   few blocks by a tenth and more).
3. ``mix``: slots join blocks on (source, block index).  Both sides have a key
   per block, so a source with a third of all words is spread like any other.

No step has a task per source over its documents: positions in the line come
from running sums in buckets of documents, over the buckets of a range, and over
the ranges; only the last, one row for four million documents, and the
per-source totals are ordered in one task.  Equal rows are counted first and
dealt out in lots of a bucket's size, so a row that makes up a third of the
table fills buckets like any others.

Nulls: a null text has no words; a null source is a source, ordered last; a
null id is an id.  Rows repeated in the input are documents of their own.
Empty input gives an empty result.  Only id, text and source are read, so
other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import GAP, WORD, shuffled_index, word_count

#: Weights in turn for the sources in order (fixed values).
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
SEED = 20_011
_CHUNK = 16_384
_BUCKET_ROWS = 2_048
_RANGE = 2_048  # buckets


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, skey, thash, size), one row for each input row."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        _source_key(F.col(source_col)).alias("skey"),
        F.xxhash64(F.col(text_col)).alias("thash"),
        word_count(F.col(text_col)).alias("size"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(skey, source_size, weight, target double, quota long) per source.

    Capped shares are solved in closed form: in order of cap / weight, a
    source is capped while its cap is at most its share of what the capped
    ones before it leave.  Ordered over one row per source."""
    per = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    turn = F.array(*[F.lit(int(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(turn, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * max_repeats)
    by = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = Window.partitionBy()
    per = per.withColumn("before", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = per.withColumn("left", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("level", (F.sum("source_size").over(every) - F.col("before")) / F.col("left"))
    per = per.withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    # the first source that is not capped has the largest level of those
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    per = per.withColumn("target", F.least(target, F.col("cap").cast("double")))
    return per.select("skey", "source_size", "weight", "target", F.round("target").cast("long").alias("quota"))


def place(sized: DataFrame, rows: int) -> DataFrame:
    """Add (bucket, rn) and ``start``, the document's first word in its
    source's line.  ``rows`` (the row count) sets the number of buckets."""
    buckets = rows // _BUCKET_ROWS + 16
    lots = sized.groupBy("doc_id", "source", "skey", "thash", "size").agg(F.count(F.lit(1)).alias("copies"))
    lots = lots.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_BUCKET_ROWS}"))))
    lots = lots.withColumn("copies", F.least(F.col("copies") - F.col("lot") * _BUCKET_ROWS, F.lit(_BUCKET_ROWS).cast("long")))
    lots = cut_lineage(lots.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "thash", "lot"), F.lit(buckets)).cast("int")))
    own = Window.partitionBy("skey", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "thash", "size")
    inside = lots.repartition("skey", "bucket").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    inside = inside.drop("copies", "lot", "copy")
    inside = inside.withColumn("rn", F.row_number().over(own)).withColumn("upto", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    totals = lots.groupBy("skey", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    # running sums over ranges of buckets, then over the buckets of a range
    totals = totals.withColumn("part", F.expr(f"bucket div {_RANGE}"))
    before = lambda by, key: F.coalesce(F.sum("words").over(Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.groupBy("skey", "part").agg(F.sum("words").alias("words"))
    parts = parts.select("skey", "part", before(["skey"], "part").alias("behind"))
    base = totals.withColumn("base", before(["skey", "part"], "bucket")).join(parts, ["skey", "part"])
    base = base.select("skey", "bucket", (F.col("base") + F.col("behind")).alias("base"))
    return inside.join(base, ["skey", "bucket"]).withColumn("start", F.col("base") + F.col("upto") - F.col("size")).drop("base", "upto")


def slots(per_source: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(skey, pass, block, take, slot, shard): a row for each slot of the mix.
    Sources are dealt out in chunks of slots, as many tasks as chunks."""
    words = per_source.agg(F.sum("quota")).first()[0] or 0
    tasks = 1 + words // (block_words * _CHUNK)
    b, size, quota = F.lit(block_words).cast("long"), F.col("source_size"), F.col("quota")
    plan = per_source.where("quota > 0").select(
        "skey",
        quota,
        size,
        F.expr(f"source_size div {block_words}").alias("full"),
        F.expr(f"(source_size + {block_words - 1}) div {block_words}").alias("items"),
        F.expr("quota div source_size").alias("passes"),
        F.expr("quota % source_size").alias("rest"),
    )
    plan = plan.withColumn("n_slots", F.col("passes") * F.col("items") + F.expr(f"(rest + {block_words - 1}) div {block_words}"))
    line = Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.withColumn("first_slot", F.coalesce(F.sum("n_slots").over(line), F.lit(0)))
    plan = plan.withColumn("all_slots", F.sum("n_slots").over(Window.partitionBy()))
    chunk = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_slots - 1) div {_CHUNK}"))))
    one = chunk.repartition(tasks, "skey", "chunk").withColumn(
        "k", F.explode(F.sequence(F.col("chunk") * _CHUNK, F.least(F.col("chunk") * _CHUNK + _CHUNK, F.col("n_slots")) - 1))
    )
    one = one.withColumn("pass", F.expr("k div items")).withColumn("j", F.expr("k % items"))
    block = F.when(
        F.col("j") < F.col("full"), shuffled_index(F.col("j"), F.greatest(F.col("full"), F.lit(1)), F.lit(seed), F.col("skey"), F.col("pass"))
    ).otherwise(F.col("full"))
    length = F.when(F.col("j") < F.col("full"), b).otherwise(size - F.col("full") * b)
    take = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, F.col("rest") - F.col("j") * b))
    slot = shuffled_index(F.col("first_slot") + F.col("k"), F.col("all_slots"), F.lit(seed + 1))
    out = one.select("skey", "pass", "passes", block.alias("block"), take.alias("take"), slot.alias("slot"))
    return out.withColumn("shard", F.expr(f"slot div {shard_slots}"))


def mix(docs: DataFrame, *, weights=WEIGHTS, max_repeats=MAX_REPEATS, block_words=BLOCK_WORDS, shard_slots=SHARD_SLOTS, seed=SEED, distinct=False, id_col="doc_id", text_col="text", source_col="source"):
    """The mix as two DataFrames: ``documents`` (doc_id, source, thash, size,
    skey, bucket, rn, start, source_size, target) and ``pieces`` (shard, slot,
    pass, passes, skey, bucket, rn, word_from, word_to): the words of a
    document that a slot holds, counted from the document's first.  With
    ``distinct`` rows equal in id, source and text count once."""
    sized = sizes(docs, id_col, text_col, source_col)
    sized = cut_lineage(sized.dropDuplicates(["doc_id", "skey", "thash"]) if distinct else sized)
    per_source = cut_lineage(targets(sized, weights, max_repeats))
    placed = place(sized, sized.count())
    span = placed.where("size > 0").select("skey", "bucket", "rn", "start", (F.col("start") + F.col("size")).alias("stop"))
    blocks = span.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(stop - 1) div {block_words}"))))
    held = slots(per_source, block_words, shard_slots, seed).hint("merge").join(blocks, ["skey", "block"])
    lo = F.greatest(F.col("start"), F.col("block") * block_words)
    hi = F.least(F.col("stop"), F.col("block") * block_words + F.col("take"))
    pieces = held.where(lo < hi).select(
        "shard", "slot", "pass", "passes", "skey", "bucket", "rn", (lo - F.col("start")).alias("word_from"), (hi - F.col("start")).alias("word_to")
    )
    return placed.join(per_source.select("skey", "source_size", "target"), "skey"), pieces


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per input row."""
    documents, pieces = mix(docs, **options)
    got = pieces.groupBy("skey", "bucket", "rn").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    out = documents.join(got, ["skey", "bucket", "rn"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document's whole
    text once for each full pass of its source, and the words that the last
    pass took of it, in order, as one more row.  Rows equal in id, source and
    text count once; documents without words are in no mix."""
    columns = docs.columns
    documents, pieces = mix(docs, distinct=True, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    last = F.when(F.col("pass") == F.col("passes"), F.struct("word_from", "word_to"))
    used = pieces.groupBy("skey", "bucket", "rn").agg(F.max("passes").alias("__passes"), F.array_sort(F.collect_list(last)).alias("__spans"))
    got = documents.join(used, ["skey", "bucket", "rn"]).select(
        F.xxhash64("doc_id", F.col("doc_id").isNull()).alias("__id"), F.col("skey").alias("__skey"), F.col("thash").alias("__thash"), "__passes", "__spans"
    )
    id_ = F.col(id_col)
    key = {"__id": F.xxhash64(id_, id_.isNull()), "__skey": _source_key(F.col(source_col)), "__thash": F.xxhash64(F.col(text_col))}
    rows = docs.withColumns(key).join(got, list(key))
    rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy("__thash"))).where("__n = 1")
    unit = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD}(?:{GAP})?)"), F.lit(1))
    words = F.transform("__spans", lambda s: F.array_join(F.slice(F.col("__units"), (s["word_from"] + 1).cast("int"), (s["word_to"] - s["word_from"]).cast("int")), ""))
    none = F.array().cast("array<string>")
    whole = F.when(F.col("__passes") > 0, F.array_repeat(F.col(text_col), F.col("__passes").cast("int"))).otherwise(none)
    rest = F.when(F.size("__spans") > 0, F.array(F.array_join(words, ""))).otherwise(none)
    rows = rows.withColumn("__units", F.when(F.size("__spans") > 0, unit))
    rows = rows.withColumn(text_col, F.explode(F.concat(whole, rest)))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.char_length(F.col(text_col)).cast("long"))
    return rows.select(*[F.col(f"`{c}`") for c in columns])
