"""Graph queries on graphs derived from the driver tables.

* Typed graph: Supplier/Customer -IN-> Nation -IN-> Region,
  Customer -BOUGHT-> Part (orders x lineitem), Supplier -SUPPLIES-> Part.
  Nations, parts and suppliers are hubs.
* Supply graph: the same tables along the goods' way, Customer -BOUGHT-> Part
  -SOLD_BY-> Supplier -IN-> Nation -IN-> Region, without cycles, so unbounded
  patterns have finite answers.  Anchors: customer 1, region 1 and 2.
* Place tree: Region -HAS-> Nation -HAS-> Customer, from the tables' own keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from ..session import cut_table
from ..sources.tables import Tables
from .registry import register

START, FAR = 1, 13  # customers
MAX_PATH_HOPS = 10  # the path query's own bound

# --------------------------------------------------------------------------- graph builders


# Typed node ids are longs: key * 8 + kind code (fixed values below), so the
# id space of all kinds is shared without string keys in shuffles and joins.
KIND_CODE = {"supplier": 1, "customer": 2, "part": 3, "nation": 4, "region": 5}


def typed_id(kind: str, key: int) -> int:
    return key * 8 + KIND_CODE[kind]


def _tid(kind, c):
    return F.col(c).cast("long") * 8 + KIND_CODE[kind]


def typed_graph(t):
    nodes = (
        t.supplier.select(_tid("supplier", "s_suppkey").alias("id"), F.lit("Supplier").alias("label"), F.col("s_name").alias("name"))
        .unionByName(t.customer.select(_tid("customer", "c_custkey").alias("id"), F.lit("Customer").alias("label"), F.col("c_name").alias("name")))
        .unionByName(t.part.select(_tid("part", "p_partkey").alias("id"), F.lit("Part").alias("label"), F.col("p_name").alias("name")))
        .unionByName(t.nation.select(_tid("nation", "n_nationkey").alias("id"), F.lit("Nation").alias("label"), F.col("n_name").alias("name")))
        .unionByName(t.region.select(_tid("region", "r_regionkey").alias("id"), F.lit("Region").alias("label"), F.col("r_name").alias("name")))
    )
    li = t.lineitem
    bought = li.select("l_orderkey", "l_partkey").join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    edges = (
        t.supplier.select(_tid("supplier", "s_suppkey").alias("src"), _tid("nation", "s_nationkey").alias("dst"), F.lit("IN").alias("rel"))
        .unionByName(t.customer.select(_tid("customer", "c_custkey").alias("src"), _tid("nation", "c_nationkey").alias("dst"), F.lit("IN").alias("rel")))
        .unionByName(t.nation.select(_tid("nation", "n_nationkey").alias("src"), _tid("region", "n_regionkey").alias("dst"), F.lit("IN").alias("rel")))
        .unionByName(
            bought.select(_tid("customer", "o_custkey").alias("src"), _tid("part", "l_partkey").alias("dst"), F.lit("BOUGHT").alias("rel")).distinct()
        )
        .unionByName(
            li.select(_tid("supplier", "l_suppkey").alias("src"), _tid("part", "l_partkey").alias("dst"), F.lit("SUPPLIES").alias("rel")).distinct()
        )
    )
    return graph.from_tables(nodes, edges)


_TYPED_SQL = """
nodes AS (
  SELECT s_suppkey * 8 + 1 AS id, 'Supplier' AS label, s_name AS name FROM supplier
  UNION ALL SELECT c_custkey * 8 + 2, 'Customer', c_name FROM customer
  UNION ALL SELECT p_partkey * 8 + 3, 'Part', p_name FROM part
  UNION ALL SELECT n_nationkey * 8 + 4, 'Nation', n_name FROM nation
  UNION ALL SELECT r_regionkey * 8 + 5, 'Region', r_name FROM region
), edges AS (
  SELECT s_suppkey * 8 + 1 AS src, s_nationkey * 8 + 4 AS dst, 'IN' AS rel FROM supplier
  UNION ALL SELECT c_custkey * 8 + 2, c_nationkey * 8 + 4, 'IN' FROM customer
  UNION ALL SELECT n_nationkey * 8 + 4, n_regionkey * 8 + 5, 'IN' FROM nation
  UNION ALL SELECT DISTINCT o.o_custkey * 8 + 2, l.l_partkey * 8 + 3, 'BOUGHT'
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  UNION ALL SELECT DISTINCT l_suppkey * 8 + 1, l_partkey * 8 + 3, 'SUPPLIES' FROM lineitem
)"""


def _from(edges, kind):
    """Edges that leave nodes of one kind."""
    return edges.filter(F.col("src") % 8 == KIND_CODE[kind])


def supply_graph(t):
    """Edges of the supply graph, without nodes."""
    nodes, edges = typed_graph(t)
    sold = edges.filter(F.col("rel") == "SUPPLIES").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit("SOLD_BY").alias("rel"))
    places = edges.filter((F.col("rel") == "IN") & (F.col("src") % 8 != KIND_CODE["customer"]))
    return edges.filter(F.col("rel") == "BOUGHT").unionByName(sold).unionByName(places)


def tree_edges(t):
    """Region -HAS-> Nation -HAS-> Customer."""
    n = t.nation.select(_tid("region", "n_regionkey").alias("src"), _tid("nation", "n_nationkey").alias("dst"))
    c = t.customer.select(_tid("nation", "c_nationkey").alias("src"), _tid("customer", "c_custkey").alias("dst"))
    return n.unionByName(c).withColumn("rel", F.lit("HAS"))


_TREE_SQL = """
tree AS (
  SELECT n_nationkey * 8 + 4 AS id, n_regionkey * 8 + 5 AS parent FROM nation
  UNION ALL SELECT c_custkey * 8 + 2, c_nationkey * 8 + 4 FROM customer
)"""

# --------------------------------------------------------------------------- typed-graph patterns


@register("q_scan_nodes", f"WITH {_TYPED_SQL} SELECT id, label, name FROM nodes")
def q_scan_nodes(spark, sf_dir):
    """``MATCH (v) RETURN v``."""
    nodes, _ = typed_graph(Tables(spark, sf_dir))
    return nodes.select("id", "label", "name")


@register(
    "q_graph_labels",
    f"""
WITH {_TYPED_SQL}
SELECT label AS name, 'vertex' AS kind, COUNT(*) AS num FROM nodes GROUP BY label
UNION ALL SELECT rel, 'edge', COUNT(*) FROM edges GROUP BY rel
""",
)
def q_graph_labels(spark, sf_dir):
    nodes, edges = typed_graph(Tables(spark, sf_dir))
    return graph.label_inventory(nodes, edges)


@register(
    "q_graph_link",
    f"""
WITH {_TYPED_SQL}, pairs AS (SELECT c.c_name, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT a.id AS src, b.id AS dst, 'IN' AS rel
FROM pairs p JOIN nodes a ON a.label = 'Customer' AND a.name = p.c_name
JOIN nodes b ON b.label = 'Nation' AND b.name = p.n_name
""",
)
def q_graph_link(spark, sf_dir):
    """``MATCH (c:Customer {name: x}), (n:Nation {name: y}) CREATE (c)-[:IN]->(n)``
    for each (customer name, nation name) pair of the source rows."""
    t = Tables(spark, sf_dir)
    nodes, _ = typed_graph(t)
    pairs = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_name", "n_name")
    e = graph.link(pairs, nodes, ("Customer", "name", "c_name"), ("Nation", "name", "n_name"), "IN")
    return e.select("src", "dst", "rel")


@register(
    "q_graph_one_hop",
    f"""
WITH {_TYPED_SQL}
SELECT c.id, c.name FROM edges e JOIN nodes c ON e.src = c.id
WHERE e.rel = 'IN' AND e.dst = 7 * 8 + 4 AND c.label = 'Customer'
""",
)
def q_graph_one_hop(spark, sf_dir):
    """``MATCH (c:Customer)-[:IN]->(:Nation {key: 7}) RETURN c`` — one hop in
    against the edge direction from the anchored nation."""
    nodes, edges = typed_graph(Tables(spark, sf_dir))
    anchor = nodes.filter(F.col("id") == typed_id("nation", 7)).select("id")
    hits = graph.hop(anchor, edges, rel="IN", direction="in").select(F.col("nbr").alias("id"))
    return hits.join(nodes.filter(F.col("label") == "Customer"), "id").select("id", "name")


@register(
    "q_graph_converge",
    f"""
WITH {_TYPED_SQL}
SELECT b.src AS b, COUNT(*) AS num_matches
FROM edges a JOIN edges b ON a.dst = b.dst
WHERE a.rel = 'BOUGHT' AND b.rel = 'SUPPLIES'
GROUP BY b.src
""",
)
def q_graph_converge(spark, sf_dir):
    """``(c:Customer)-[:BOUGHT]->(p:Part)<-[:SUPPLIES]-(s:Supplier)``: matches
    per supplier, counted per part instead of materialising the pairs."""
    _, edges = typed_graph(Tables(spark, sf_dir))
    return graph.converge_counts(edges, "BOUGHT", "SUPPLIES")


@register(
    "q_graph_chain",
    f"""
WITH {_TYPED_SQL}
SELECT s.name AS supplier, r.name AS region
FROM nodes s JOIN edges e1 ON e1.src = s.id AND e1.rel = 'IN'
JOIN edges e2 ON e2.src = e1.dst AND e2.rel = 'IN'
JOIN nodes r ON r.id = e2.dst AND r.label = 'Region'
WHERE s.label = 'Supplier'
""",
)
def q_graph_chain(spark, sf_dir):
    """``(s:Supplier)-[:IN]->()-[:IN]->(r:Region)`` — a fixed two-hop chain."""
    nodes, edges = typed_graph(Tables(spark, sf_dir))
    s = nodes.filter(F.col("label") == "Supplier").select("id", F.col("name").alias("supplier"))
    one = graph.hop(s, _from(edges, "supplier"), rel="IN").select("supplier", F.col("nbr").alias("id"))
    two = graph.hop(one, _from(edges, "nation"), rel="IN").select("supplier", F.col("nbr").alias("id"))
    r = nodes.filter(F.col("label") == "Region").select("id", F.col("name").alias("region"))
    return two.join(r, "id").select("supplier", "region")


@register(
    "q_graph_two_hop_sql",
    f"""
WITH {_TYPED_SQL}
SELECT e1.src AS customer, e2.dst AS region
FROM edges e1 JOIN edges e2 ON e1.dst = e2.src
WHERE e1.rel = 'IN' AND e2.rel = 'IN' AND e1.src % 8 = 2
""",
)
def q_graph_two_hop_sql(spark, sf_dir):
    """Two hops on the adjacency table with an aliased self-join (the SQL
    form of the chain): each customer's region through its nation."""
    _, edges = typed_graph(Tables(spark, sf_dir))
    e = edges.filter(F.col("rel") == "IN")
    e1 = e.filter(F.col("src") % 8 == KIND_CODE["customer"]).select(F.col("src").alias("customer"), F.col("dst").alias("mid"))
    e2 = _from(e, "nation").select(F.col("src").alias("mid"), F.col("dst").alias("region"))
    return e1.join(e2, "mid").select("customer", "region")


@register(
    "q_graph_collect",
    f"""
WITH {_TYPED_SQL}
SELECT r.name AS region, COUNT(*) AS supplier_count,
       array_to_string(list_sort(list_distinct(list(n.name))), ',') AS nations
FROM nodes s JOIN edges e1 ON e1.src = s.id AND e1.rel = 'IN'
JOIN nodes n ON n.id = e1.dst AND n.label = 'Nation'
JOIN edges e2 ON e2.src = n.id AND e2.rel = 'IN'
JOIN nodes r ON r.id = e2.dst
WHERE s.label = 'Supplier'
GROUP BY r.name
""",
)
def q_graph_collect(spark, sf_dir):
    """Per-region fact bundle: ``collect(DISTINCT n.name), count(*)`` over
    (region)<-(nation)<-(supplier) matches.  The collected list is bounded by
    the nation dimension, the count grows with the suppliers."""
    nodes, edges = typed_graph(Tables(spark, sf_dir))
    s = nodes.filter(F.col("label") == "Supplier").select("id")
    # one row per nation before anything else is joined
    sn = graph.hop(s, _from(edges, "supplier"), rel="IN").groupBy(F.col("nbr").alias("id")).agg(F.count(F.lit(1)).alias("suppliers"))
    named = sn.join(nodes.filter(F.col("label") == "Nation").select("id", F.col("name").alias("nation")), "id")
    nr = graph.hop(named, _from(edges, "nation"), rel="IN").select("nation", "suppliers", F.col("nbr").alias("id"))
    full = nr.join(nodes.filter(F.col("label") == "Region").select("id", F.col("name").alias("region")), "id")
    return full.groupBy("region").agg(
        F.sum("suppliers").alias("supplier_count"), F.array_join(F.sort_array(F.collect_set("nation")), ",").alias("nations")
    )


@register(
    "q_neighbourhood",
    f"""
WITH {_TYPED_SQL}, ue AS (
  SELECT src, dst, rel, src AS a, dst AS b FROM edges UNION ALL SELECT src, dst, rel, dst AS a, src AS b FROM edges
), two AS (
  SELECT e1.b AS id FROM ue e1 WHERE e1.a = 3 * 8 + 4
  UNION ALL
  SELECT e2.b FROM ue e1 JOIN ue e2 ON e1.b = e2.a
  WHERE e1.a = 3 * 8 + 4 AND NOT (e1.src = e2.src AND e1.dst = e2.dst AND e1.rel = e2.rel)
)
SELECT DISTINCT n.label AS kind, n.id, n.name FROM two JOIN nodes n ON two.id = n.id
""",
)
def q_neighbourhood(spark, sf_dir):
    """``MATCH (b:Nation {key: 3})-[*1..2]-(ctx) RETURN DISTINCT label(ctx), ctx``."""
    nodes, edges = typed_graph(Tables(spark, sf_dir))
    ctx = graph.neighbourhood(nodes, edges, typed_id("nation", 3), 1, 2)
    return ctx.select(F.col("label").alias("kind"), "id", "name")


# --------------------------------------------------------------------------- place tree


def _anchor(spark, kind, key):
    return spark.range(1).select(F.lit(typed_id(kind, key)).cast("long").alias("id"))


@register(
    "q_descendants",
    f"""
WITH RECURSIVE {_TREE_SQL},
sub(id, depth) AS (
  SELECT id, 1 FROM tree WHERE parent = 1 * 8 + 5
  UNION ALL SELECT t.id, s.depth + 1 FROM tree t JOIN sub s ON t.parent = s.id
)
SELECT id, depth FROM sub
""",
)
def q_descendants(spark, sf_dir):
    """Everything below region 1 at any depth (``-[:HAS*]->``)."""
    return graph.descendants(tree_edges(Tables(spark, sf_dir)), _anchor(spark, "region", 1), rel="HAS").select("id", "depth")


@register(
    "q_expand_bounded",
    f"""
WITH {_TREE_SQL}
SELECT n.id, 1 AS depth FROM tree n WHERE n.parent = 2 * 8 + 5
UNION ALL SELECT c.id, 2 FROM tree n JOIN tree c ON c.parent = n.id WHERE n.parent = 2 * 8 + 5
""",
)
def q_expand_bounded(spark, sf_dir):
    """``MATCH p = (:Region {key: 2})-[:HAS*1..3]->(r) RETURN r, length(p)``."""
    p = graph.expand(tree_edges(Tables(spark, sf_dir)), _anchor(spark, "region", 2), 1, 3, rel="HAS")
    return p.select(F.col("end").alias("id"), F.col("hops").alias("depth")).orderBy("depth", "id")


# --------------------------------------------------------------------------- supply graph


# The anchor's own edges come first, so that no join order is large.
_MINE_SQL = f"""
WITH mine AS (
  SELECT DISTINCT {START} * 8 + 2 AS customer, l.l_partkey * 8 + 3 AS part
  FROM lineitem l JOIN (SELECT o_orderkey FROM orders WHERE o_custkey = {START}) o ON l.l_orderkey = o.o_orderkey
), sold AS (
  SELECT DISTINCT m.customer, m.part, l.l_suppkey * 8 + 1 AS supplier
  FROM mine m JOIN lineitem l ON l.l_partkey * 8 + 3 = m.part
)"""


@register("q_expand_exact", f"{_MINE_SQL} SELECT supplier AS reached FROM sold")
def q_expand_exact(spark, sf_dir):
    """``(:Customer {key: 1})-[*2]->(x)``: one row per path."""
    p = graph.expand(supply_graph(Tables(spark, sf_dir)), _anchor(spark, "customer", START), 2, 2)
    return p.select(F.col("end").alias("reached"))


# A path of this graph has one node of each kind in a fixed order, so the
# answer is written kind by kind.
_CHAIN_SQL = f"""
{_MINE_SQL}
SELECT m.customer, m.part, m.supplier, s.s_nationkey * 8 + 4 AS nation, n.n_regionkey * 8 + 5 AS region
FROM sold m JOIN supplier s ON s.s_suppkey * 8 + 1 = m.supplier JOIN nation n ON n.n_nationkey = s.s_nationkey
"""


@register(
    "q_graph_paths",
    f"""
SELECT customer AS start_id, region AS end_id, 4 AS hops, concat_ws(',', customer, part, supplier, nation, region) AS path
FROM ({_CHAIN_SQL}) WHERE region = 1 * 8 + 5
""",
)
def q_graph_paths(spark, sf_dir):
    """All simple paths (no repeated node) from customer 1 to region 1 with at
    most 10 hops."""
    t = Tables(spark, sf_dir)
    p = graph.expand(supply_graph(t), _anchor(spark, "customer", START), 1, MAX_PATH_HOPS, unique="node", targets=_anchor(spark, "region", 1))
    p = p.select(F.col("start").alias("start_id"), F.col("end").alias("end_id"), "hops", graph.path_text(F.col("nodes")).alias("path"))
    return p.orderBy("hops", "path")


@register(
    "q_graph_routes",
    f"""
WITH chain AS ({_CHAIN_SQL})
SELECT concat_ws(',', customer, part) AS path_nodes, 1 AS hops FROM chain GROUP BY ALL
UNION ALL SELECT concat_ws(',', customer, part, supplier), 2 FROM chain
UNION ALL SELECT concat_ws(',', customer, part, supplier, nation), 3 FROM chain
UNION ALL SELECT concat_ws(',', customer, part, supplier, nation, region), 4 FROM chain
""",
)
def q_graph_routes(spark, sf_dir):
    """``MATCH p = (:Customer {key: 1})-[*]->(x) RETURN nodes(p), length(p)``:
    every route of any length, edge-unique, without a hop limit."""
    p = graph.expand(supply_graph(Tables(spark, sf_dir)), _anchor(spark, "customer", START), 1, None, unique="edge")
    return p.select(graph.path_text(F.col("nodes")).alias("path_nodes"), "hops").orderBy("hops", "path_nodes")


@register(
    "q_graph_routes_to",
    f"""
SELECT concat_ws(',', customer, part, supplier, nation) AS path_nodes, 3 AS hops FROM ({_CHAIN_SQL}) WHERE nation = 3 * 8 + 4
""",
)
def q_graph_routes_to(spark, sf_dir):
    """``MATCH p = (:Customer {key: 1})-[*]->(:Nation {key: 3}) RETURN nodes(p),
    length(p)``: every route between the two, edge-unique, without a hop limit."""
    t = Tables(spark, sf_dir)
    p = graph.expand(supply_graph(t), _anchor(spark, "customer", START), 1, None, unique="edge", targets=_anchor(spark, "nation", 3))
    return p.select(graph.path_text(F.col("nodes")).alias("path_nodes"), "hops").orderBy("hops", "path_nodes")


@register(
    "q_suggest_links",
    f"{_MINE_SQL} SELECT DISTINCT supplier AS suggestion FROM sold",
)
def q_suggest_links(spark, sf_dir):
    """Nodes that customer 1 may link to: within 1..2 hops of the supply graph
    and not linked yet."""
    s = graph.suggest_links(supply_graph(Tables(spark, sf_dir)), _anchor(spark, "customer", START))
    return s.select(F.col("end").alias("suggestion"))


SUGGESTIONS = 3


@register(
    "q_suggest_all",
    f"""
WITH bought AS (SELECT DISTINCT o.o_custkey AS c, l.l_partkey AS p FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
degree AS (SELECT c, count(*) AS degree FROM bought GROUP BY c),
pairs AS (SELECT DISTINCT a.c AS customer, b.c AS suggestion FROM bought a JOIN bought b ON a.p = b.p AND a.c <> b.c)
SELECT customer, suggestion, degree, CAST(row_number() OVER (PARTITION BY customer ORDER BY degree DESC, suggestion) AS INTEGER) AS rank
FROM pairs JOIN degree ON degree.c = suggestion QUALIFY rank <= {SUGGESTIONS}
""",
)
def q_suggest_all(spark, sf_dir):
    """For every customer the three customers with the most parts among those
    who bought a part that they bought too."""
    t = Tables(spark, sf_dir)
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("src"))
    bought = cut_table(t.lineitem.select("l_orderkey", F.col("l_partkey").alias("dst")).join(orders, "l_orderkey").select("src", "dst").distinct())
    back = bought.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    out = graph.suggest_top(bought, back, SUGGESTIONS)
    return out.select(F.col("start").alias("customer"), F.col("end").alias("suggestion"), "degree", "rank")


@register(
    "q_shortest_path",
    f"""
WITH {_TYPED_SQL}, ue AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
mid AS (
  SELECT x.b AS m FROM ue x JOIN ue y ON y.a = x.b WHERE x.a = {START} * 8 + 2 AND y.b = {FAR} * 8 + 2
), near AS (SELECT DISTINCT b AS id FROM ue WHERE a = {START} * 8 + 2),
second AS (
  SELECT u.b AS id, min(u.a) AS parent FROM ue u JOIN near n ON n.id = u.a
  WHERE u.b <> {START} * 8 + 2 AND u.b NOT IN (SELECT id FROM near) GROUP BY u.b
), third AS (
  SELECT u.b AS id, min(u.a) AS parent FROM ue u JOIN second s ON s.id = u.a
  WHERE u.b <> {START} * 8 + 2 AND u.b NOT IN (SELECT id FROM near) AND u.b NOT IN (SELECT id FROM second) GROUP BY u.b
), fourth AS (
  SELECT u.b AS id, min(u.a) AS parent FROM ue u JOIN third s ON s.id = u.a
  WHERE u.b <> {START} * 8 + 2 AND u.b NOT IN (SELECT id FROM near)
    AND u.b NOT IN (SELECT id FROM second) AND u.b NOT IN (SELECT id FROM third) GROUP BY u.b
)
SELECT concat_ws(',', {START} * 8 + 2, (SELECT min(m) FROM mid), {FAR} * 8 + 2) AS path_nodes, 2 AS hops WHERE (SELECT count(*) FROM mid) > 0
UNION ALL
SELECT concat_ws(',', {START} * 8 + 2, s.parent, t.parent, f.parent, f.id), 4
FROM fourth f JOIN third t ON t.id = f.parent JOIN second s ON s.id = t.parent WHERE f.id = {FAR} * 8 + 2
""",
)
def q_shortest_path(spark, sf_dir):
    """Shortest connection of customers 1 and 13 in the typed graph, any
    direction, at most 4 hops; among equally short paths the one whose
    predecessors are smallest."""
    _, edges = typed_graph(Tables(spark, sf_dir))
    p = graph.shortest_path(edges, typed_id("customer", START), typed_id("customer", FAR), 4, direction="both")
    return p.select(graph.path_text(F.col("nodes")).alias("path_nodes"), "hops")
