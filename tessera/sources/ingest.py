"""JSON-array ingestion into a raw zone.

A source file holds one top-level JSON array of objects and is read in parallel,
however large.  Spark's text reader gives each input split as fragments that
end at a comma.  A first pass reports what each split does to the tokeniser's
state (``json_items.Effect``: depth, string and escape, for a start inside and
outside of a string), a few numbers per split.  Composed in file order they
give every split its start state, so that a second pass cuts all splits on
their own, holding one item in memory.  The pieces of items that span splits
are then joined.  Object items are parsed against a declared schema and keep
their raw JSON text (extra fields survive); everything else goes to a
quarantine with a reason.  ``strict=True`` restores fail-fast behaviour.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.quality import ConstraintViolation
from ..session import cut_table, ship_package
from .json_items import MALFORMED, ArrayItems, Effect, State, after

_SPLIT = ["source_file", "block"]
_STATE = "source_file string, block long, depth long, in_string boolean, escaped boolean, done boolean"
_PIECE = "source_file string, block long, seq long, text string, reason string, edge boolean, ends boolean"
_SPACE = " \t\r\n"  # white space of JSON
_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)], [f[0] for f in fields])


# --------------------------------------------------------------------------- effects and states
def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: the state behind a file's first split, the effects
    of any other."""
    split, reader, both = None, None, ()

    def report() -> pa.RecordBatch:
        said = vars(reader.state()) if reader else [vars(e) for e in both]
        return _table("source_file string, block long, effect string", [(*split, json.dumps(said))])

    for batch in batches:
        for file, block, text in zip(*(batch.column(c).to_pylist() for c in ("source_file", "block", "value"))):
            if (file, block) != split:
                if split:
                    yield report()
                split, first = (file, block), True
                reader, both = (ArrayItems(), ()) if block == 0 else (None, (Effect(False), Effect(True)))
            if reader:
                for _ in reader.feed(text if first else "," + text):
                    pass
                reader.held = [""]
            for effect in both:
                effect.feed(text if first else "," + text)
            first = False
    if split:
        yield report()


def _states(table: pa.Table) -> pa.Table:
    """Start state of every split of a file, from the splits' effects."""
    rows, state = [], State()
    for row in sorted(table.to_pylist(), key=lambda r: r["block"]):
        rows.append((row["source_file"], row["block"], *vars(state).values()))
        said = json.loads(row["effect"])
        state = State(**said) if isinstance(said, dict) else after(state, *(Effect(**e) for e in said))
    return pa.Table.from_batches([_table(_STATE, rows)])


# --------------------------------------------------------------------------- cutting
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of each split, numbered by ``seq``.  ``edge``: a piece of an item that
    a split before has begun (0) or a later one goes on with (1); ``ends``: its
    last piece."""
    split, reader, seq, fresh = None, None, 0, False
    rows: list[tuple] = []

    def keep(text: str, reason: str | None) -> None:
        nonlocal seq, fresh
        if fresh:
            rows.append((*split, 0, text, reason, True, True))
        elif reason or text.strip(_SPACE):
            rows.append((*split, seq, text.strip(_SPACE), reason, False, True))
            seq += not reason
        fresh = False

    def finish() -> None:
        left = reader.open_text() if split else None
        if left is not None:
            rows.append((*split, 0 if fresh else 1, left, None, True, False))

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("source_file", "block", "value", "depth", "in_string", "escaped", "done"))
        for file, block, text, depth, in_string, escaped, done in zip(*columns):
            first = (file, block) != split
            if first:
                finish()
                split, reader, seq, fresh = (file, block), ArrayItems(State(depth, in_string, escaped, done)), 0, depth > 0
            # the reader took away the comma before a fragment
            for item, reason in reader.feed(text if first and block == 0 else "," + text):
                keep(item, reason)
        if rows:
            yield _table(_PIECE, rows)
            rows.clear()
    finish()
    if rows:
        yield _table(_PIECE, rows)


@contextmanager
def _same_splits(spark: SparkSession):
    """Both passes see the same splits, also if executors come or go between
    them: the number of cores that the reader reckons with is held."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", ",").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no"), "value")
    with _same_splits(spark):
        effects = lines.select(*_SPLIT, "value").mapInArrow(_effects, "source_file string, block long, effect string")
        states = cut_table(effects.groupBy("source_file").applyInArrow(_states, _STATE))
        given = lines.join(states, _SPLIT, "left").withColumn("depth", F.coalesce("depth", F.raise_error(F.lit("a split without a start state"))))
        return cut_table(given.sortWithinPartitions("no").mapInArrow(_cut, _PIECE))


def _numbered(pieces: DataFrame) -> DataFrame:
    """(source_file, item_no, raw, reason) of all pieces.  Order and numbers come
    from windows over a few numbers per split; texts are joined per item."""
    earlier = Window.partitionBy("source_file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, -1)
    edges = pieces.where("edge").select(*_SPLIT, "seq", "text", "ends")
    # the pieces up to an end are one item
    item = F.coalesce(F.sum(F.col("ends").cast("long")).over(earlier), F.lit(0))
    item_of = edges.select(*_SPLIT, "seq", "ends").withColumn("item", item).drop("ends")
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("parts")
    joined = edges.join(item_of, [*_SPLIT, "seq"]).groupBy("source_file", "item").agg(parts, F.max("ends").alias("ended"), F.max("block").alias("block"))
    text = F.btrim(F.array_join(F.col("parts.text"), ""), F.lit(_SPACE))
    spanning = joined.select(*_SPLIT, text.alias("raw"), F.when(~F.col("ended"), F.lit(MALFORMED)).alias("reason"))
    spanning = cut_table(spanning.where("raw <> '' or reason is not null"))
    # numbers: an item that ends in a split comes before those that begin there
    led = spanning.where("reason is null").select(*_SPLIT, F.lit(1).cast("long").alias("lead"))
    whole = pieces.where("not edge").select(*_SPLIT, "seq", F.col("text").alias("raw"), "reason")
    counts = whole.where("reason is null").groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("n")).join(led, _SPLIT, "full")
    total = F.sum(F.coalesce("n", F.lit(0)) + F.coalesce("lead", F.lit(0)))
    before = F.coalesce(total.over(Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cut_table(counts.select(*_SPLIT, before.alias("before"), F.coalesce("lead", F.lit(0)).alias("lead")))
    whole = whole.join(starts, _SPLIT, "left").withColumn("no", F.col("before") + F.col("lead") + F.col("seq"))
    spanning = spanning.join(starts, _SPLIT, "left").withColumn("no", F.col("before"))
    rows = whole.select("source_file", "no", "raw", "reason").unionByName(spanning.select("source_file", "no", "raw", "reason"))
    return rows.select("source_file", F.when(F.col("reason").isNull(), F.col("no")).alias("item_no"), "raw", "reason")


def read_json_array(spark: SparkSession, path: str, schema, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(documents, quarantine)``.

    documents: ``source_file``, ``item_no``, the declared fields, ``raw`` (the
    item's JSON text).  quarantine: ``source_file``, ``item_no`` (NULL for a
    file-level problem), ``raw``, ``reason``: "not a JSON array", "malformed
    JSON" (a broken item, or what is left of a file whose array does not
    end), or "item is not an object".  Items before a file's broken end are
    documents.  An empty file yields no rows; anything after the array's
    closing bracket is ignored, as is a comma that is a file's last character.
    The items are cut once, into a scratch table
    in shared storage that both results read.
    """
    ship_package(spark)
    staged = _numbered(_pieces(spark, path))
    parsed = F.try_parse_json("raw")
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(parsed.isNull(), F.lit("malformed JSON"))
        .when(~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("item is not an object"))
    )
    tagged = staged.withColumn("reason", reason)
    docs = tagged.filter(F.col("reason").isNull()).select("source_file", "item_no", F.from_json("raw", schema).alias("__d"), "raw")
    docs = docs.select("source_file", "item_no", "__d.*", "raw")
    quarantine = tagged.filter(F.col("reason").isNotNull())
    if strict and not quarantine.isEmpty():
        raise ConstraintViolation(f"{path}: rejected JSON input")
    return docs, quarantine


def write_json_arrays(docs: DataFrame, path: str, files: int) -> None:
    """``docs`` as ``files`` JSON array files below ``path``, with stray commas
    between the items as the source files have them.  An array is written
    row by row (a bracket, the items, a bracket), never gathered in a cell."""
    spark = docs.sparkSession
    items = docs.select((F.monotonically_increasing_id() % files).alias("b"), F.lit(1).alias("part"), F.concat(F.to_json(F.struct(*docs.columns)), F.lit(",")).alias("value"))
    bracket = F.when(F.col("part") == 0, "[ ,").otherwise(",]").alias("value")
    ends = spark.range(files).select(F.col("id").alias("b"), F.explode(F.array(F.lit(0), F.lit(2))).alias("part")).select("b", "part", bracket)
    rows = items.unionByName(ends).repartition(files, "b").sortWithinPartitions("b", "part")
    rows.select("b", "value").write.mode("overwrite").partitionBy("b").text(path)

