"""Layered pipeline, versioned reads and JSON-array ingestion on the driver
tables.  Every run writes to a fresh folder in shared storage (see
``layers.lake_dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.names import normalise_name
from ..operators import changes, layers, quality
from ..session import cut_table
from ..sources.ingest import read_json_array, write_json_arrays
from ..sources.tables import Tables
from .registry import register

_LI = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_KEY = ["l_orderkey", "l_linenumber"]
_REST = [c for c in _LI if c not in _KEY]


def _bronze(spark, t):
    path = layers.lake_dir(spark, "bronze")
    layers.write_table(t.lineitem.select(*_LI), path)
    return layers.read_table(spark, path)


def _silver(spark, t):
    bronze = _bronze(spark, t)
    silver = layers.to_silver(bronze, {"l_extendedprice": "decimal(12,2)"}, _KEY)
    path = layers.lake_dir(spark, "silver")
    layers.write_table(silver, path)
    return layers.read_table(spark, path)


@register("q_medallion_bronze", f"SELECT {', '.join(_LI)} FROM lineitem")
def q_medallion_bronze(spark, sf_dir):
    """Bronze: raw rows written as they come, read back."""
    return _bronze(spark, Tables(spark, sf_dir))


_SILVER_SQL = f"""
silver AS (
  SELECT {', '.join(_KEY)}, {', '.join(c if c != 'l_extendedprice' else 'CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice' for c in _REST)}
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(_KEY)} ORDER BY {', '.join(_REST)}) AS rn FROM lineitem)
  WHERE rn = 1
)"""


@register(
    "q_medallion_silver",
    f"WITH {_SILVER_SQL} SELECT {', '.join(c if c != 'l_extendedprice' else 'CAST(l_extendedprice AS DOUBLE) AS l_extendedprice' for c in _LI)} FROM silver",
)
def q_medallion_silver(spark, sf_dir):
    """Silver: money cast to decimal(12,2), one row per (order, line) — the
    smallest by the remaining columns when duplicates differ."""
    s = _silver(spark, Tables(spark, sf_dir))
    return s.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


@register(
    "q_medallion_gold",
    f"""
WITH {_SILVER_SQL}
SELECT o.o_custkey, CAST(SUM(s.l_extendedprice) AS DOUBLE) AS revenue
FROM silver s JOIN orders o ON s.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey
""",
)
def q_medallion_gold(spark, sf_dir):
    """Gold: revenue per customer from silver, in SQL over the layer
    DataFrames (parameterised ``spark.sql``, no session-global view names),
    written and read back."""
    t = Tables(spark, sf_dir)
    silver = _silver(spark, t)
    gold = spark.sql(
        """
        SELECT o.o_custkey, SUM(s.l_extendedprice) AS revenue
        FROM {silver} s JOIN {orders} o ON s.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey
        """,
        silver=silver,
        orders=t.orders,
    )
    path = layers.lake_dir(spark, "gold")
    layers.write_table(gold, path)
    return layers.read_table(spark, path).withColumn("revenue", F.col("revenue").cast("double"))


# --------------------------------------------------------------------------- versions

_O = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _versioned_orders(spark, t):
    """v0 write of orders; v1 pending orders' price + 1; v2 delete of
    finished orders under 5000."""
    vt = layers.VersionedTable(spark, layers.lake_dir(spark, "orders_versions"), ["o_orderkey"])
    vt.write(t.orders.select(*_O))
    vt.update(F.col("o_orderstatus") == "P", {"o_totalprice": F.col("o_totalprice") + 1})
    vt.delete((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 5000))
    return vt


@register(
    "q_version_history",
    """
SELECT 0 AS version, 'WRITE' AS operation, COUNT(*) AS num_affected_rows FROM orders
UNION ALL SELECT 1, 'UPDATE', COUNT(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 2, 'DELETE', COUNT(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 5000
""",
)
def q_version_history(spark, sf_dir):
    vt = _versioned_orders(spark, Tables(spark, sf_dir))
    h = vt.history()
    return h.select(F.col("version").cast("int").alias("version"), "operation", "num_affected_rows")


_V1_SQL = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
    "o_orderdate, o_orderpriority FROM orders"
)


@register("q_version_as_of", _V1_SQL)
def q_version_as_of(spark, sf_dir):
    """The table as of version 1 (after the update, before the delete)."""
    return _versioned_orders(spark, Tables(spark, sf_dir)).read(1).select(*_O)


@register(
    "q_version_current",
    f"SELECT * FROM ({_V1_SQL}) WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 5000)",
)
def q_version_current(spark, sf_dir):
    return _versioned_orders(spark, Tables(spark, sf_dir)).read().select(*_O)


@register(
    "q_version_folded",
    f"""
SELECT 2 AS version, * FROM ({_V1_SQL}) WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 5000)
UNION ALL
SELECT 3, o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 2 ELSE o_totalprice END, o_orderdate, o_orderpriority
FROM ({_V1_SQL}) WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 5000)
""",
)
def q_version_folded(spark, sf_dir):
    """A snapshot of version 2 is folded, an update follows that reads it and
    not the history before; the table as of the snapshot and now."""
    vt = _versioned_orders(spark, Tables(spark, sf_dir))
    vt.fold()
    vt.update(F.col("o_orderpriority") == "1-URGENT", {"o_totalprice": F.col("o_totalprice") + 2})
    return vt.read(2).select(F.lit(2).alias("version"), *_O).unionByName(vt.read().select(F.lit(3).alias("version"), *_O))


# --------------------------------------------------------------------------- stored layouts

BUCKETS = 16


@register(
    "q_keyed_store",
    """
SELECT o_orderkey, o_custkey, o_totalprice, 1 AS seq FROM orders WHERE o_custkey % 100 <> 7
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 10, 2 FROM orders WHERE o_custkey % 100 = 7
UNION ALL SELECT o_orderkey + 1000000000000, o_custkey, o_totalprice, 2 FROM orders WHERE o_custkey % 100 = 3
""",
)
def q_keyed_store(spark, sf_dir):
    """Orders loaded into a keyed store, then a second load that replaces some
    and inserts others; the store afterwards.  A load writes its keys'
    buckets only."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    store = layers.KeyedStore(spark, layers.lake_dir(spark, "keyed_orders"), "o_orderkey", "seq", BUCKETS)
    store.load(orders.withColumn("seq", F.lit(1)))
    changed = orders.filter(F.col("o_custkey") % 100 == 7).withColumn("o_totalprice", F.col("o_totalprice") + 10)
    new = orders.filter(F.col("o_custkey") % 100 == 3).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000_000)
    store.load(changed.unionByName(new).withColumn("seq", F.lit(2)))
    return store.read().select("o_orderkey", "o_custkey", "o_totalprice", "seq")


@register(
    "q_managed_join",
    """
SELECT o.o_orderkey, o.o_orderpriority, count(*) AS num_lines, CAST(sum(l.l_quantity) AS DOUBLE) AS quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderpriority
""",
)
def q_managed_join(spark, sf_dir):
    """Orders and their lines as managed tables in equal buckets of the order
    key: the join and the aggregate above it plan no exchange.  The tables
    are dropped once the result is written."""
    t = Tables(spark, sf_dir)
    names = [f"{name}_{uuid.uuid4().hex}" for name in ("orders", "lines")]
    try:
        orders = layers.publish_bucketed(t.orders.select("o_orderkey", "o_orderpriority"), names[0], "o_orderkey", BUCKETS)
        lines = layers.publish_bucketed(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"), names[1], "o_orderkey", BUCKETS)
        joined = orders.join(lines, "o_orderkey").groupBy("o_orderkey", "o_orderpriority")
        return cut_table(joined.agg(F.count(F.lit(1)).alias("num_lines"), F.sum("l_quantity").cast("double").alias("quantity")))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@register(
    "q_clustered_lookup",
    """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
WHERE o_custkey = 13 OR (o_orderdate = (SELECT max(o_orderdate) FROM orders) AND o_orderpriority = '1-URGENT')
""",
)
def q_clustered_lookup(spark, sf_dir):
    """Lookups on stored orders, in ranges of the date with bloom filters on
    the customer: the rows of one customer, and the urgent ones of one day."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    files = max(8, orders.count() // 1_000_000)
    stored = layers.write_clustered(orders, layers.lake_dir(spark, "clustered_orders"), "o_orderdate", ["o_custkey"], files)
    day = stored.agg(F.max("o_orderdate")).first()[0]
    urgent = (F.col("o_orderdate") == F.lit(day)) & (F.col("o_orderpriority") == "1-URGENT")
    mine = stored.filter(F.col("o_custkey") == 13)
    found = mine.unionByName(stored.filter(urgent & ~F.col("o_custkey").eqNullSafe(F.lit(13))))
    return found.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


# --------------------------------------------------------------------------- JSON arrays -> raw zone

ROWS_PER_FILE = 50_000  # each file is one array, read in parallel


DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def _loaded(spark, t):
    """The documents, exported as JSON array files and loaded back."""
    path = layers.lake_dir(spark, "json_arrays")
    docs = t.documents.select("doc_id", "text", "lang", "source", "n_chars")
    write_json_arrays(docs, path, max(1, -(-docs.count() // ROWS_PER_FILE)))
    return read_json_array(spark, path, DOCUMENT)


@register(
    "q_ingest_json",
    "SELECT doc_id, text, lang, NULLIF(source, '') AS source, n_chars FROM documents",
)
def q_ingest_json(spark, sf_dir):
    """Documents exported as JSON array files, then loaded back through the
    array reader (stray commas tolerated, schema declared, raw kept)."""
    docs, _bad = _loaded(spark, Tables(spark, sf_dir))
    return docs.select("doc_id", "text", "lang", F.nullif(F.col("source"), F.lit("")).alias("source"), "n_chars")


_LOAD_SQL = """
WITH named AS (
  SELECT doc_id, COALESCE(NULLIF(source, ''), 'osv') AS package_name, text, lang, n_chars FROM documents
), stored AS (
  SELECT *, regexp_replace(lower(regexp_replace(package_name, '[-_.]+', '-', 'g')), '^\\s+|\\s+$', '', 'g') AS normalized_package_name
  FROM named
), latest AS (
  SELECT normalized_package_name, arg_max(package_name, doc_id) AS package_name, arg_max(lang, doc_id) AS lang,
         arg_max(text, doc_id) AS text, arg_max(n_chars, doc_id) AS n_chars
  FROM stored GROUP BY normalized_package_name
)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY normalized_package_name) AS BIGINT) AS package_key, * FROM latest
"""


@register("q_load_job", _LOAD_SQL)
def q_load_job(spark, sf_dir):
    """The load as one job: array files to whole documents, an id and a
    package name for each, keyed replace into the raw store in two batches
    (short documents, then long ones), then the package dimension from the
    store: blank names to quarantine, the last document of a package wins,
    dense keys.  What is set aside is stored in the lake with its reason."""
    docs, bad = _loaded(spark, Tables(spark, sf_dir))
    docs = docs.withColumn("package_name", F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("osv")))
    docs = docs.withColumn("normalized_package_name", normalise_name("package_name"))
    rows = docs.select(
        F.concat(F.col("normalized_package_name"), F.lit(":"), F.col("doc_id").cast("string")).alias("_id"),
        "doc_id", "package_name", "normalized_package_name", "lang", "text", "n_chars",
    )
    store = changes.upsert_replace(rows.limit(0), rows.filter(F.coalesce(F.col("n_chars") < 5000, F.lit(True))), "_id", "doc_id")
    store = changes.upsert_replace(store, rows.filter(F.col("n_chars") >= 5000), "_id", "doc_id")
    good, blank = quality.split(store, {"missing package name": quality.required_text("package_name")})
    aside = bad.select("source_file", "raw", "reason").unionByName(blank.select(F.col("_id").alias("raw"), "reason"), allowMissingColumns=True)
    layers.write_table(aside, layers.lake_dir(spark, "quarantine"))
    attrs = ["package_name", "lang", "text", "n_chars"]
    dim = changes.upsert_dimension(None, good, "normalized_package_name", "doc_id", "package_key", attrs)
    return dim.select("package_key", "normalized_package_name", *attrs)
