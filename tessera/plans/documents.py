"""Document-store style queries: nested fields, arrays, projections and
``$group`` pipelines.

Collections on the driver tables: ``events`` rows are documents whose
``props`` JSON text is parsed with a declared schema (``from_json``), and
per (user, day) documents carry the sorted set of event types as ``tags``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import money, out, ratio
from ..sources.tables import Tables
from .registry import register

PROPS_SCHEMA = "k INT"


def events_docs(t):
    """``events`` with ``props`` parsed into a struct (malformed -> NULL)."""
    return t.events.withColumn("props", F.from_json("props", PROPS_SCHEMA))


def day_docs(t):
    """One document per (user, day): event types as a sorted array.  The
    array is bounded by the number of event types, whatever the volume."""
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sort_array(F.collect_set("event_type")).alias("tags"))


_DAY_DOCS_SQL = "SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list_distinct(list(event_type))) AS tags FROM events GROUP BY ALL"


@register(
    "q_doc_nested",
    "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) = 42",
)
def q_doc_nested(spark, sf_dir):
    """``find({"props.k": 42})`` — equality on an embedded field."""
    d = events_docs(Tables(spark, sf_dir))
    return d.filter(F.col("props.k") == 42).select("event_id", "user_id", F.col("props.k").alias("k"))


@register(
    "q_arr_contains",
    f"SELECT user_id, day, array_to_string(tags, ',') AS tags FROM ({_DAY_DOCS_SQL}) WHERE list_contains(tags, 'error')",
)
def q_arr_contains(spark, sf_dir):
    """``find({tags: "error"})`` — array holds the value."""
    d = day_docs(Tables(spark, sf_dir))
    return d.filter(F.array_contains("tags", "error")).select("user_id", "day", F.array_join("tags", ",").alias("tags"))


@register(
    "q_arr_all",
    f"SELECT user_id, day, array_to_string(tags, ',') AS tags FROM ({_DAY_DOCS_SQL}) WHERE list_has_all(tags, ['error', 'click'])",
)
def q_arr_all(spark, sf_dir):
    """``{$all: ["error", "click"]}`` — holds every value, any order, extras allowed."""
    d = day_docs(Tables(spark, sf_dir))
    want = F.array(F.lit("error"), F.lit("click"))
    return d.filter(F.size(F.array_except(want, F.col("tags"))) == 0).select(
        "user_id", "day", F.array_join("tags", ",").alias("tags")
    )


@register(
    "q_arr_elem_match",
    """
SELECT vec_id, label FROM embeddings
WHERE len(list_filter(embedding, lambda x: CAST(x AS DOUBLE) > 0.30 AND CAST(x AS DOUBLE) < 0.31)) > 0
""",
)
def q_arr_elem_match(spark, sf_dir):
    """``{$elemMatch: {$gt: 0.30, $lt: 0.31}}`` — one element meets both bounds."""
    t = Tables(spark, sf_dir)
    hit = F.exists("embedding", lambda x: (x.cast("double") > 0.30) & (x.cast("double") < 0.31))
    return t.embeddings.filter(hit).select("vec_id", "label")


@register(
    "q_doc_project",
    "SELECT user_id, event_type, value FROM events WHERE event_type = 'purchase'",
)
def q_doc_project(spark, sf_dir):
    """``find({event_type: "purchase"}, {user_id: 1, event_type: 1, value: 1, _id: 0})``."""
    t = Tables(spark, sf_dir)
    return t.events.filter(F.col("event_type") == "purchase").drop("event_id", "ts", "props")


@register(
    "q_doc_match_project",
    """
SELECT event_id AS item, event_type AS inventory_status, CAST(json_extract(props, '$.k') AS INTEGER) AS unit
FROM events WHERE value > 50
""",
)
def q_doc_match_project(spark, sf_dir):
    """``$match`` then ``$project`` that renames and lifts a nested field."""
    d = events_docs(Tables(spark, sf_dir))
    return d.filter(F.col("value") > 50).select(
        F.col("event_id").alias("item"), F.col("event_type").alias("inventory_status"), F.col("props.k").alias("unit")
    )


@register(
    "q_doc_group",
    """
SELECT event_type AS _id,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value,
       COUNT(*) AS num_items,
       CAST(ROUND(CAST(CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_value
FROM events GROUP BY event_type ORDER BY total_value DESC
""",
)
def q_doc_group(spark, sf_dir):
    """``$group`` with ``$sum``, ``$sum: 1`` and ``$avg``, then ``$sort`` desc."""
    t = Tables(spark, sf_dir)
    g = t.events.groupBy(F.col("event_type").alias("_id")).agg(F.sum(money("value")).alias("v"), F.count(F.lit(1)).alias("num_items"))
    return g.select("_id", out(F.col("v")).alias("total_value"), "num_items", ratio(F.col("v"), F.col("num_items")).alias("avg_value")).orderBy(
        F.desc("total_value"), "_id"
    )


@register(
    "q_doc_cond_group",
    """
SELECT event_type AS _id,
       CAST(SUM(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS high_value_docs,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM events GROUP BY event_type ORDER BY _id
""",
)
def q_doc_cond_group(spark, sf_dir):
    """``$sum: {$cond: [{$gt: ["$value", 50]}, 1, 0]}`` inside ``$group``."""
    t = Tables(spark, sf_dir)
    g = t.events.groupBy(F.col("event_type").alias("_id")).agg(
        F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).cast("long").alias("high_value_docs"),
        out(F.sum(money("value"))).alias("total_value"),
    )
    return g.orderBy("_id")


@register(
    "q_doc_pipeline_limit",
    """
SELECT event_id, event_type, value FROM events
WHERE event_type IN ('click', 'view', 'purchase')
ORDER BY event_id LIMIT 3
""",
)
def q_doc_pipeline_limit(spark, sf_dir):
    """``$match {$in}`` -> ``$project`` -> ``$limit: 3``; the store's natural
    order is replaced by the document key so the three are well defined."""
    t = Tables(spark, sf_dir)
    m = t.events.filter(F.col("event_type").isin("click", "view", "purchase")).select("event_id", "event_type", "value")
    return m.orderBy("event_id").limit(3)
