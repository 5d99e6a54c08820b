"""Row changes, keyed upserts, quality checks and normalisation on the driver
tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import money, out, units
from ..functions.names import composite_id, first_present, normalise_name, to_text
from ..operators import changes, normalise, quality
from ..sources.tables import Tables
from .registry import register

RUN_TS = "2024-01-01 00:00:00"  # injected run timestamp ($currentDate), wall clock, no time zone

# --------------------------------------------------------------------------- I1, I3, I7, I8, I9

_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register(
    "q_update_where",
    f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice > 400000 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""",
)
def q_update_where(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select(*_ORDER_COLS.split(", "))
    return changes.update_where(o, F.col("o_totalprice") > 400000, {"o_orderpriority": F.lit("1-URGENT")})


@register(
    "q_update_first",
    f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'P') THEN '0-HOLD' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""",
)
def q_update_first(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select(*_ORDER_COLS.split(", "))
    return changes.update_first(o, F.col("o_orderstatus") == "P", {"o_orderpriority": F.lit("0-HOLD")}, ["o_orderkey"])


@register(
    "q_delete_first",
    f"SELECT {_ORDER_COLS} FROM orders WHERE o_orderkey <> (SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'F')",
)
def q_delete_first(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select(*_ORDER_COLS.split(", "))
    return changes.delete_first(o, F.col("o_orderstatus") == "F", ["o_orderkey"])


@register(
    "q_delete_where",
    f"SELECT {_ORDER_COLS} FROM orders WHERE NOT (o_orderstatus = 'O')",
)
def q_delete_where(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select(*_ORDER_COLS.split(", "))
    return changes.delete_where(o, F.col("o_orderstatus") == "O")


@register(
    "q_insert",
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s_suppkey + (SELECT max(c_custkey) FROM customer) + 1, s_name, NULL, NULL, NULL FROM supplier
""",
)
def q_insert(spark, sf_dir):
    """Suppliers enrolled as customers with a column-subset insert: the
    columns the insert does not name are NULL."""
    t = Tables(spark, sf_dir)
    c = t.customer
    top = c.select(F.max("c_custkey")).scalar()
    new = t.supplier.select((F.col("s_suppkey") + top + 1).alias("c_custkey"), F.col("s_name").alias("c_name"))
    return changes.insert(c, new)


# --------------------------------------------------------------------------- document-style updates


def _part_docs(t):
    """part as documents: qty and a nested size object."""
    return t.part.select(
        "p_partkey",
        F.col("p_size").alias("qty"),
        F.struct(F.col("p_size").cast("double").alias("h"), F.lit("cm").alias("uom")).alias("size"),
    )


@register(
    "q_update_many",
    """
SELECT p_partkey, p_size AS qty, CAST(p_size AS DOUBLE) AS size_h,
       CASE WHEN p_size < 10 THEN 'in' ELSE 'cm' END AS size_uom,
       CASE WHEN p_size < 10 THEN TIMESTAMP '2024-01-01 00:00:00' END AS lastModified
FROM part
""",
)
def q_update_many(spark, sf_dir):
    """``updateMany({qty: {$lt: 10}}, {$set: {"size.uom": "in"}, $currentDate: {lastModified}})``."""
    t = Tables(spark, sf_dir)
    d = changes.update_where(
        _part_docs(t),
        F.col("qty") < 10,
        {"size.uom": F.lit("in"), "lastModified": F.lit(RUN_TS).cast("timestamp_ntz")},
    )
    return d.select("p_partkey", "qty", F.col("size.h").alias("size_h"), F.col("size.uom").alias("size_uom"), "lastModified")


@register(
    "q_inc",
    "SELECT p_partkey, CASE WHEN p_size < 10 THEN COALESCE(p_size, 0) + 5 ELSE p_size END AS qty FROM part",
)
def q_inc(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return changes.inc(_part_docs(t), "qty", 5, F.col("qty") < 10).select("p_partkey", "qty")


@register(
    "q_push",
    """
SELECT user_id, day,
       array_to_string(CASE WHEN list_contains(tags, 'purchase') THEN list_append(tags, 'featured') ELSE tags END, ',') AS tags
FROM (SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list_distinct(list(event_type))) AS tags FROM events GROUP BY ALL)
""",
)
def q_push(spark, sf_dir):
    """Per (user, day) documents with their event-type tags; ``$push`` of
    "featured" onto every document that has a purchase."""
    t = Tables(spark, sf_dir)
    docs = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sort_array(F.collect_set("event_type")).alias("tags"))
    pushed = changes.push(docs, "tags", "featured", F.array_contains("tags", "purchase"))
    return pushed.select("user_id", "day", F.array_join("tags", ",").alias("tags"))


@register(
    "q_update_lookup",
    """
SELECT s.s_suppkey, s.s_name, s.s_nationkey, l.nation_name
FROM supplier s LEFT JOIN (SELECT n_nationkey, min(n_name) AS nation_name FROM nation GROUP BY n_nationkey) l
ON s.s_nationkey = l.n_nationkey
""",
)
def q_update_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return changes.fill_from_lookup(s, t.nation, ("s_nationkey", "n_nationkey"), "n_name", "nation_name")


# --------------------------------------------------------------------------- package records (X10-X13, I10, C5)

_SPELLED_SQL = (
    "CASE p_partkey % 3 WHEN 0 THEN replace(p_name, ' ', '_') "
    "WHEN 1 THEN upper(replace(p_name, ' ', '-.')) ELSE replace(p_name, ' ', '.') END"
)


def _norm_sql(x: str) -> str:
    return f"regexp_replace(lower(regexp_replace({x}, '[-_.]+', '-', 'g')), '^\\s+|\\s+$', '', 'g')"


def _spelled():
    """Part names spelled three ways (by key): ``_``, upper-case ``-.``, ``.``."""
    k = F.col("p_partkey") % 3
    return (
        F.when(k == 0, F.regexp_replace("p_name", " ", "_"))
        .when(k == 1, F.upper(F.regexp_replace("p_name", " ", "-.")))
        .otherwise(F.regexp_replace("p_name", " ", "."))
    )


@register(
    "q_normalise_names",
    f"SELECT p_partkey, {_SPELLED_SQL} AS package_name, {_norm_sql(_SPELLED_SQL)} AS normalized_package_name FROM part",
)
def q_normalise_names(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = t.part.select("p_partkey", _spelled().alias("package_name"))
    return p.select("p_partkey", "package_name", normalise_name("package_name").alias("normalized_package_name"))


def _package_docs(t):
    """Package documents from part: ``info.name`` is the spelled name but
    empty for PROMO parts (fallback ``package_name``), ``author_email`` is a
    number in the raw record."""
    return t.part.select(
        F.col("p_partkey").alias("seq"),
        F.struct(
            F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(_spelled()).alias("name"),
            F.col("p_size").alias("author_email"),
        ).alias("info"),
        F.col("p_name").alias("package_name"),
        F.col("p_size"),
    )


def _package_rows(docs):
    name = first_present("info.name", "package_name")
    return docs.select("seq", "p_size", name.alias("package_name"), to_text("info.author_email").alias("author_email")).withColumn(
        "normalized_package_name", normalise_name("package_name")
    )


_PKG_ROWS_SQL = f"""
docs AS (
  SELECT p_partkey AS seq, p_size, CASE WHEN p_type = 'PROMO' THEN '' ELSE {_SPELLED_SQL} END AS info_name,
         p_name AS raw_package_name, CAST(p_size AS VARCHAR) AS author_email
  FROM part
), pkg AS (
  SELECT seq, p_size, COALESCE(NULLIF(info_name, ''), raw_package_name) AS package_name, author_email FROM docs
), rows AS (
  SELECT *, {_norm_sql("package_name")} AS normalized_package_name FROM pkg
)"""


@register(
    "q_dim_package",
    f"""
WITH {_PKG_ROWS_SQL},
latest AS (
  SELECT normalized_package_name, arg_max(package_name, seq) AS package_name, arg_max(author_email, seq) AS author_email
  FROM rows GROUP BY normalized_package_name
)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY normalized_package_name) AS BIGINT) AS package_key,
       normalized_package_name, package_name, author_email
FROM latest
""",
)
def q_dim_package(spark, sf_dir):
    """Package dimension from package documents, full reload: name by
    first-present fallback, quarantine of blank names, upsert by normalised
    name (last document wins), dense keys."""
    t = Tables(spark, sf_dir)
    rows = _package_rows(_package_docs(t))
    good, _bad = quality.split(rows, {"missing package name": quality.required_text("package_name")})
    dim = changes.upsert_dimension(None, good, "normalized_package_name", "seq", "package_key", ["package_name", "author_email"])
    return dim.select("package_key", "normalized_package_name", "package_name", "author_email")


@register(
    "q_upsert_dim",
    f"""
WITH {_PKG_ROWS_SQL},
a AS (
  SELECT normalized_package_name, arg_max(package_name, seq) AS package_name, arg_max(author_email, seq) AS author_email
  FROM rows WHERE p_size <= 25 GROUP BY normalized_package_name
), b AS (
  SELECT normalized_package_name, arg_max(package_name, seq) AS package_name, arg_max(author_email, seq) AS author_email
  FROM rows WHERE p_size > 25 GROUP BY normalized_package_name
), ka AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY normalized_package_name) AS BIGINT) AS package_key, * FROM a
)
SELECT ka.package_key, ka.normalized_package_name,
       COALESCE(b.package_name, ka.package_name) AS package_name,
       CASE WHEN b.normalized_package_name IS NOT NULL THEN b.author_email ELSE ka.author_email END AS author_email
FROM ka LEFT JOIN b ON ka.normalized_package_name = b.normalized_package_name
UNION ALL
SELECT (SELECT max(package_key) FROM ka) + ROW_NUMBER() OVER (ORDER BY b.normalized_package_name),
       b.normalized_package_name, b.package_name, b.author_email
FROM b WHERE b.normalized_package_name NOT IN (SELECT normalized_package_name FROM ka)
""",
)
def q_upsert_dim(spark, sf_dir):
    """Two loads into the package dimension: first the small parts
    (``p_size <= 25``), then the rest.  Members seen in the first load keep
    their key and take the second load's attributes; new names get keys
    after the current maximum."""
    t = Tables(spark, sf_dir)
    rows = _package_rows(_package_docs(t))
    first = changes.upsert_dimension(
        None, rows.filter(F.col("p_size") <= 25), "normalized_package_name", "seq", "package_key", ["package_name", "author_email"]
    )
    second = changes.upsert_dimension(
        first, rows.filter(F.col("p_size") > 25), "normalized_package_name", "seq", "package_key", ["package_name", "author_email"]
    )
    return second.select("package_key", "normalized_package_name", "package_name", "author_email")


@register(
    "q_composite_id",
    f"""
SELECT doc_id,
       concat_ws(':', COALESCE(NULLIF(CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END, ''), 'osv'),
                 {_norm_sql("lang || '.' || source")}) AS _id
FROM documents
""",
)
def q_composite_id(spark, sf_dir):
    """Record ids ``source:normalised-name``; the source is blanked on every
    fifth record to exercise the ``osv`` default."""
    t = Tables(spark, sf_dir)
    d = t.documents
    src = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("source"))
    return d.select("doc_id", composite_id(src, F.concat(F.col("lang"), F.lit("."), F.col("source"))).alias("_id"))


@register(
    "q_raw_upsert",
    """
WITH d AS (
  SELECT concat(COALESCE(NULLIF(source, ''), 'osv'), ':', lang) AS _id, doc_id, text, lang, source, n_chars,
         CASE WHEN n_chars >= 5000 THEN 1 ELSE 0 END AS load_no
  FROM documents
)
SELECT _id, doc_id, text, lang, source, n_chars FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY _id ORDER BY load_no DESC, doc_id DESC) AS rn FROM d
) WHERE rn = 1
""",
)
def q_raw_upsert(spark, sf_dir):
    """Raw store keyed by ``source:lang``: first load = short documents, then
    the long ones replace whole stored records by key; within a load the
    last document (by id) wins."""
    t = Tables(spark, sf_dir)
    d = t.documents.select(
        F.concat(F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("osv")), F.lit(":"), F.col("lang")).alias("_id"),
        "doc_id",
        "text",
        "lang",
        "source",
        "n_chars",
    )
    empty = d.limit(0)
    store = changes.upsert_replace(empty, d.filter(F.col("n_chars") < 5000), "_id", "doc_id")
    return changes.upsert_replace(store, d.filter(F.col("n_chars") >= 5000), "_id", "doc_id")


@register(
    "q_limit_source",
    "SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 100",
)
def q_limit_source(spark, sf_dir):
    """``--limit``: cap on the documents read, in key order (the cap is the feature)."""
    t = Tables(spark, sf_dir)
    return t.documents.select("doc_id", "text", "lang", "source", "n_chars").orderBy("doc_id").limit(100)


# --------------------------------------------------------------------------- I12, I13


@register(
    "q_ledger_balances",
    """
SELECT c.c_custkey,
       CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) - COALESCE(m.net, 0) AS DOUBLE) AS balance
FROM customer c LEFT JOIN (
  SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS net FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey
) m ON c.c_custkey = m.o_custkey
""",
)
def q_ledger_balances(spark, sf_dir):
    """Balances after charging every pending order to its customer."""
    t = Tables(spark, sf_dir)
    acc = t.customer.select("c_custkey", money("c_acctbal").alias("balance"))
    mv = t.orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"), (-money("o_totalprice")).alias("delta"))
    res = changes.apply_movements(acc, mv, "c_custkey", "balance", "delta")
    return res.select("c_custkey", out(F.col("balance")).alias("balance"))


@register(
    "q_append_aggregate",
    """
WITH t AS (SELECT l_returnflag, CAST(l_quantity AS INTEGER) AS qty FROM lineitem),
t2 AS (SELECT * FROM t UNION ALL SELECT 'N', SUM(qty) FROM t WHERE l_returnflag = 'R')
SELECT l_returnflag, CAST(SUM(qty) AS BIGINT) AS total_qty FROM t2 GROUP BY l_returnflag
""",
)
def q_append_aggregate(spark, sf_dir):
    """Append the total of class R as a new class-N row, then sum per class."""
    t = Tables(spark, sf_dir)
    base = t.lineitem.select("l_returnflag", units("l_quantity").cast("long").alias("qty"))
    grown = changes.append_aggregate(base, F.col("l_returnflag") == "R", {"l_returnflag": "N"}, "qty")
    return grown.groupBy("l_returnflag").agg(F.sum("qty").alias("total_qty"))


# --------------------------------------------------------------------------- C1-C6


@register(
    "q_check_unique",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS num_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
)
def q_check_unique(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@register(
    "q_check_fk",
    "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)",
)
def q_check_fk(spark, sf_dir):
    """Orders must be referenced by at least one line (orders -> lineitem)."""
    t = Tables(spark, sf_dir)
    return quality.fk_violations(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], t.lineitem, ["l_orderkey"])


_ORDERS_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register(
    "q_check_not_null",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM orders" for c in _ORDERS_ALL),
)
def q_check_not_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.null_counts(t.orders, _ORDERS_ALL)


@register(
    "q_check_range",
    "SELECT c_custkey, c_acctbal FROM customer WHERE NOT COALESCE(c_acctbal >= 0, TRUE)",
)
def q_check_range(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.check_violations(t.customer.select("c_custkey", "c_acctbal"), F.col("c_acctbal") >= 0)


@register(
    "q_quarantine",
    """
WITH d AS (
  SELECT doc_id, text, lang, n_chars, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN '  ' ELSE source END AS package
  FROM documents
)
SELECT doc_id, text, lang, n_chars, package, CASE WHEN package IS NULL OR regexp_replace(package, '\\s+', '', 'g') = '' THEN 'missing package' ELSE 'ok' END AS status
FROM d
""",
)
def q_quarantine(spark, sf_dir):
    """Required-field check on package records: the name is blanked on every
    seventh record and whitespace-only on the next; those go to quarantine."""
    t = Tables(spark, sf_dir)
    k = F.col("doc_id") % 7
    d = t.documents.select("doc_id", "text", "lang", "n_chars", F.when(k == 0, F.lit("")).when(k == 1, F.lit("  ")).otherwise(F.col("source")).alias("package"))
    tagged = quality.tag(d, {"missing package": quality.required_text("package")}, "status")
    return tagged.withColumn("status", F.coalesce(F.col("status"), F.lit("ok")))


@register(
    "q_defaults",
    """
SELECT s_suppkey, s_name, COALESCE(s_acctbal, 0.0) AS s_acctbal, TRUE AS is_active, 'UNKNOWN' AS district
FROM supplier
""",
)
def q_defaults(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    return quality.with_defaults(s, {"s_acctbal": 0.0, "is_active": True, "district": "UNKNOWN"})


# --------------------------------------------------------------------------- N1-N4

_WIDE_SQL = """
wide AS (
  SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, o.o_totalprice, o.o_orderstatus
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def _wide(t):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").join(c, "o_custkey")


_ENTITIES = {
    "customer": ["o_custkey", "c_name", "c_mktsegment"],
    "order": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"],
}


@register("q_normalise_entities", f"WITH {_WIDE_SQL} SELECT DISTINCT o_custkey, c_name, c_mktsegment FROM wide")
def q_normalise_entities(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return normalise.split_entities(_wide(t), _ENTITIES)["customer"]


@register(
    "q_normalise_rejoin",
    f"""
WITH {_WIDE_SQL}, cust AS (SELECT DISTINCT o_custkey, c_name, c_mktsegment FROM wide),
ord AS (SELECT DISTINCT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM wide)
SELECT ord.o_orderkey, ord.o_custkey, cust.c_name, cust.c_mktsegment, ord.o_totalprice, ord.o_orderstatus
FROM ord JOIN cust ON ord.o_custkey = cust.o_custkey
""",
)
def q_normalise_rejoin(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parts = normalise.split_entities(_wide(t), _ENTITIES)
    j = normalise.rejoin([(parts["order"], []), (parts["customer"], ["o_custkey"])])
    return j.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment", "o_totalprice", "o_orderstatus")


@register(
    "q_normalise_3nf",
    """
SELECT DISTINCT c.c_nationkey, n.n_name, n.n_regionkey
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
)
def q_normalise_3nf(spark, sf_dir):
    """The transitive attribute (customer -> nation -> name, region) moved to
    its own table, taken from the wide customer rows."""
    t = Tables(spark, sf_dir)
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    wide = t.customer.select("c_custkey", "c_nationkey").join(n, "c_nationkey")
    return normalise.split_entities(wide, {"nation": ["c_nationkey", "n_name", "n_regionkey"]})["nation"]


@register(
    "q_fd_violations",
    """
SELECT l_orderkey, l_linenumber, COUNT(DISTINCT l_partkey) AS num_values
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(DISTINCT l_partkey) > 1
""",
)
def q_fd_violations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return normalise.fd_violations(t.lineitem, ["l_orderkey", "l_linenumber"], "l_partkey")
