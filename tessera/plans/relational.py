"""Relational queries: projections, filters, subqueries, joins, grouping,
top-k and unions on the driver tables.  Plain DataFrame expressions; no
library wrapper around ``filter``/``join``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import money, out, ratio, units
from ..session import cut_lineage
from ..operators.joins import outer_join, without_match
from ..sources.tables import Tables
from .registry import register

# --------------------------------------------------------------------------- F1-F7, F14-F17


@register(
    "q_project_const",
    "SELECT 'customer' AS note, c_custkey, c_name AS customer_name FROM customer",
)
def q_project_const(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.customer.select(F.lit("customer").alias("note"), "c_custkey", F.col("c_name").alias("customer_name"))


@register(
    "q_filter_eq",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def q_filter_eq(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@register(
    "q_filter_gt",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 400000",
)
def q_filter_gt(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.orders.filter(F.col("o_totalprice") > 400000).select("o_orderkey", "o_custkey", "o_totalprice")


@register(
    "q_filter_in",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'O')",
)
def q_filter_in(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.orders.filter(F.col("o_orderstatus").isin("P", "O")).select("o_orderkey", "o_orderstatus")


@register(
    "q_url_search",
    "SELECT page_id, url FROM pages WHERE url ILIKE '%BLOG%'",
)
def q_url_search(spark, sf_dir):
    """Case-insensitive substring search (SQLite LIKE ignores ASCII case)."""
    t = Tables(spark, sf_dir)
    return t.pages.filter(F.col("url").ilike("%BLOG%")).select("page_id", "url")


@register(
    "q_topk",
    "SELECT page_id, url FROM pages WHERE url ILIKE '%BLOG%' ORDER BY page_id DESC LIMIT 10",
)
def q_topk(spark, sf_dir):
    t = Tables(spark, sf_dir)
    hits = t.pages.filter(F.col("url").ilike("%BLOG%")).select("page_id", "url")
    return hits.orderBy(F.col("page_id").desc_nulls_last()).limit(10)


@register(
    "q_max_row",
    "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal = (SELECT max(s_acctbal) FROM supplier)",
)
def q_max_row(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = t.supplier
    top = s.select(F.max("s_acctbal")).scalar()
    return s.filter(F.col("s_acctbal") == top).select("s_suppkey", "s_name", "s_acctbal")


@register(
    "q_above_avg",
    """
SELECT p_partkey, p_name, p_retailprice FROM part
WHERE CAST(p_retailprice AS DECIMAL(12,2)) > (SELECT AVG(CAST(p_retailprice AS DECIMAL(12,2))) FROM part)
""",
)
def q_above_avg(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = t.part
    avg_price = p.select(F.avg(money("p_retailprice"))).scalar()
    return p.filter(money("p_retailprice") > avg_price).select("p_partkey", "p_name", "p_retailprice")


@register(
    "q_len_above_avg",
    "SELECT p_partkey, p_name, length(p_name) AS name_length FROM part WHERE length(p_name) > (SELECT AVG(length(p_name)) FROM part)",
)
def q_len_above_avg(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = t.part
    avg_len = p.select(F.avg(F.length("p_name"))).scalar()
    return p.filter(F.length("p_name") > avg_len).select("p_partkey", "p_name", F.length("p_name").alias("name_length"))


@register(
    "q_in_top_group",
    """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer GROUP BY c_mktsegment ORDER BY COUNT(*) DESC, c_mktsegment LIMIT 1)
""",
)
def q_in_top_group(spark, sf_dir):
    """Semi-join against a ranked, limited group query (ties -> smallest
    segment name).  The top group is one row: a bounded broadcast."""
    t = Tables(spark, sf_dir)
    c = t.customer
    top = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "c_mktsegment").limit(1)
    return c.join(F.broadcast(top.select("c_mktsegment")), "c_mktsegment", "left_semi").select("c_custkey", "c_name", "c_mktsegment")


@register(
    "q_filter_topk",
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 42
ORDER BY o_totalprice, o_orderkey LIMIT 5
""",
)
def q_filter_topk(spark, sf_dir):
    """Filter, sort by another column, limit: TakeOrderedAndProject over a
    pushed-down filter."""
    t = Tables(spark, sf_dir)
    return (
        t.orders.filter(F.col("o_custkey") == 42)
        .select("o_orderkey", "o_custkey", "o_totalprice")
        .orderBy(F.col("o_totalprice").asc_nulls_last(), "o_orderkey")
        .limit(5)
    )


# --------------------------------------------------------------------------- J1-J8


@register(
    "q_join_inner",
    "SELECT c.c_custkey, c.c_name, n.n_name FROM customer c INNER JOIN nation n ON c.c_nationkey = n.n_nationkey",
)
def q_join_inner(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(n, "c_nationkey").select("c_custkey", "c_name", "n_name")


@register(
    "q_join_left",
    "SELECT o.o_orderkey, l.l_linenumber, l.l_quantity FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey",
)
def q_join_left(spark, sf_dir):
    """Orders left-joined to their lines.  Written as matches + orders
    without lines, so a hot order key on the lineitem side is split (see
    ``joins.outer_join``)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    j = outer_join(t.orders.select("o_orderkey"), li, ["o_orderkey"], ["l_orderkey"], "left")
    return j.select("o_orderkey", "l_linenumber", "l_quantity")


_FULL_SQL = """
SELECT o.o_orderkey, l.l_orderkey, l.l_linenumber
FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') o
FULL OUTER JOIN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R') l
ON o.o_orderkey = l.l_orderkey
"""


def _full_sides(t):
    o = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    li = t.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber")
    return o, li


@register("q_join_full", _FULL_SQL)
def q_join_full(spark, sf_dir):
    """Full outer join, written so that a hot key is split (``joins.outer_join``)."""
    o, li = _full_sides(Tables(spark, sf_dir))
    return outer_join(o, li, ["o_orderkey"], ["l_orderkey"], "full").select("o_orderkey", "l_orderkey", "l_linenumber")


@register("q_full_outer_emulated", _FULL_SQL)
def q_full_outer_emulated(spark, sf_dir):
    """Full outer join as matches UNION ALL left-only UNION ALL right-only
    with NULL padding; must equal ``q_join_full``.  The one-sided branches
    anti-join against distinct keys, so every branch tolerates a hot key."""
    o, li = _full_sides(Tables(spark, sf_dir))
    left, right = o.alias("o"), li.alias("l")
    same = F.col("o.o_orderkey") == F.col("l.l_orderkey")
    matched = left.join(right, same).select("o.o_orderkey", "l.l_orderkey", "l.l_linenumber")
    left_only = without_match(o, li, ["o_orderkey"], ["l_orderkey"])
    right_only = without_match(li, o, ["l_orderkey"], ["o_orderkey"])
    return matched.unionByName(left_only, allowMissingColumns=True).unionByName(right_only, allowMissingColumns=True)


@register(
    "q_join_cross",
    "SELECT c.c_custkey, n.n_name FROM customer c CROSS JOIN nation n WHERE c.c_nationkey = n.n_nationkey",
)
def q_join_cross(spark, sf_dir):
    """Cross product + filter: Catalyst turns the filter into the join
    condition, so no product is ever materialised."""
    t = Tables(spark, sf_dir)
    c, n = t.customer, t.nation
    return c.crossJoin(n).filter(c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


@register(
    "q_anti_join",
    """
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""",
)
def q_anti_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # distinct keys first: a hot order key on the probed side becomes one row
    return without_match(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, ["o_orderkey"], ["l_orderkey"])


@register(
    "q_bridge_join",
    """
SELECT l.l_orderkey, l.l_linenumber, p.p_name, CAST(l.l_quantity AS INTEGER) AS quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""",
)
def q_bridge_join(spark, sf_dir):
    """Orders to parts through the lineitem bridge (many-to-many)."""
    t = Tables(spark, sf_dir)
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return t.lineitem.join(p, "l_partkey").select("l_orderkey", "l_linenumber", "p_name", units("l_quantity").alias("quantity"))


@register(
    "q_join_chain",
    """
SELECT n.n_name, COUNT(*) AS num_lines, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
""",
)
def q_join_chain(spark, sf_dir):
    """Four-way chain.  Lines are first reduced per order (map-side combine),
    so the order->customer->nation joins see one row per order."""
    t = Tables(spark, sf_dir)
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("rev")
    )
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nat = t.nation.select("n_nationkey", "n_name")
    j = per_order.join(o, "o_orderkey").join(c, "c_custkey").join(nat, "n_nationkey")
    return j.groupBy("n_name").agg(F.sum("n").alias("num_lines"), out(F.sum("rev")).alias("revenue"))


# --------------------------------------------------------------------------- A1, A2, A8, A9, A15


@register(
    "q_group_sum",
    """
SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount, COUNT(*) AS num_orders
FROM orders GROUP BY o_orderstatus
""",
)
def q_group_sum(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.orders.groupBy("o_orderstatus").agg(
        out(F.sum(money("o_totalprice"))).alias("total_amount"), F.count(F.lit(1)).alias("num_orders")
    )


@register(
    "q_count_zero",
    """
SELECT o.o_orderkey, COUNT(l.l_orderkey) AS line_count
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey
""",
)
def q_count_zero(spark, sf_dir):
    """COUNT of the nullable side of a left join: 0 for orders without
    lines.  Lines are counted per order first, then left-joined."""
    t = Tables(spark, sf_dir)
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_orderkey").alias("line_count"))
    return t.orders.select("o_orderkey").join(per_order, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce(F.col("line_count"), F.lit(0)).alias("line_count")
    )


@register(
    "q_global_agg",
    """
SELECT CAST(MAX(l_quantity) AS INTEGER) AS max_quantity,
       COUNT(*) AS returned_lines,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS returned_value,
       CAST(ROUND(CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_returned_value
FROM lineitem WHERE l_returnflag = 'R'
""",
)
def q_global_agg(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = t.lineitem.filter(F.col("l_returnflag") == "R")
    a = r.agg(
        F.max(units("l_quantity")).alias("max_quantity"),
        F.count(F.lit(1)).alias("returned_lines"),
        F.sum(money("l_extendedprice")).alias("v"),
    )
    return a.select("max_quantity", "returned_lines", out(F.col("v")).alias("returned_value"), ratio(F.col("v"), F.col("returned_lines")).alias("avg_returned_value"))


@register(
    "q_top_share",
    """
SELECT n_name, CAST(sales AS DOUBLE) AS total_sales FROM (
  SELECT n_name, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS sales, SUM(SUM(CAST(l_extendedprice AS DECIMAL(12,2)))) OVER () AS every
  FROM nation, customer, orders, lineitem
  WHERE n_nationkey = c_nationkey AND c_custkey = o_custkey AND o_orderkey = l_orderkey
  GROUP BY n_name
) WHERE 25 * sales > every
""",
)
def q_top_share(spark, sf_dir):
    """Groups above a share (1/25) of the grand total: aggregate, then compare
    with a scalar over the (small) aggregate."""
    t = Tables(spark, sf_dir)
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(money("l_extendedprice")).alias("rev"))
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nat = t.nation.select("n_nationkey", "n_name")
    sales = per_order.join(o, "o_orderkey").join(c, "c_custkey").join(nat, "n_nationkey").groupBy("n_name").agg(
        F.sum("rev").alias("total_sales")
    )
    sales = cut_lineage(sales)  # one row per nation, read twice (filter and total)
    cut = sales.select(F.sum("total_sales") / 25).scalar()
    return sales.filter(F.col("total_sales") > cut).select("n_name", out(F.col("total_sales")).alias("total_sales"))


_COUNTED = ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"]


@register(
    "q_row_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS num_rows FROM {n}" for n in _COUNTED),
)
def q_row_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out_df = None
    for n in _COUNTED:
        c = getattr(t, n).agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(n).alias("table_name"), "num_rows")
        out_df = c if out_df is None else out_df.unionByName(c)
    return out_df.orderBy("table_name")
