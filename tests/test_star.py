"""Dimensional modelling on the retail fixture (Kimball example rows)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions.money import out, pct, ratio
from tessera.operators import star
from tessera.operators.keys import assign_keys, number_rows

D = dt.date

PRODUCTS = [
    (1, "Computers", "Electronics", "999.99"),
    (2, "Accessories", "Electronics", "24.99"),
    (3, "Accessories", "Electronics", "49.99"),
    (4, "Seating", "Furniture", "249.99"),
    (5, "Desks", "Furniture", "399.99"),
    (6, "Notebooks", "Stationery", "4.99"),
    (7, "Pens", "Stationery", "3.99"),
]
# date_key, product, store, customer, promotion, txn, qty, amount, cost, profit
FACT = [
    (20240101, 1, 1, 1, 0, "TXN-0001", 1, "999.99", "650.00", "349.99"),
    (20240101, 2, 1, 1, 0, "TXN-0001", 1, "24.99", "10.00", "14.99"),
    (20240103, 3, 2, 2, 1, "TXN-0002", 2, "99.98", "40.00", "59.98"),
    (20240105, 4, 3, 3, 0, "TXN-0003", 1, "249.99", "120.00", "129.99"),
    (20240105, 5, 3, 3, 0, "TXN-0003", 1, "399.99", "200.00", "199.99"),
    (20240108, 6, 4, 4, 2, "TXN-0004", 3, "14.97", "6.00", "8.97"),
    (20240108, 7, 4, 4, 2, "TXN-0004", 2, "7.98", "3.00", "4.98"),
    (20240115, 5, 1, 1, 3, "TXN-0005", 1, "399.99", "200.00", "199.99"),
    (20240120, 1, 2, 2, 0, "TXN-0006", 1, "999.99", "650.00", "349.99"),
    (20240122, 2, 3, 3, 0, "TXN-0007", 1, "24.99", "10.00", "14.99"),
    (20240122, 3, 3, 3, 0, "TXN-0007", 1, "49.99", "20.00", "29.99"),
    (20240125, 1, 4, 4, 1, "TXN-0008", 1, "999.99", "650.00", "349.99"),
    (20240130, 6, 2, 0, 0, "TXN-0009", 5, "24.95", "10.00", "14.95"),
]
FACT_SCHEMA = (
    "date_key int, product_key int, store_key int, customer_key int, promotion_key int, "
    "pos_transaction_number string, sales_quantity int, sales_amount decimal(10,2), cost_amount decimal(10,2), "
    "gross_profit_amount decimal(10,2)"
)


def _fact(spark):
    rows = [r[:7] + tuple(Decimal(x) for x in r[7:]) for r in FACT]
    return spark.createDataFrame(rows, FACT_SCHEMA)


def _products(spark):
    return spark.createDataFrame([(k, c, d, Decimal(p)) for k, c, d, p in PRODUCTS], "product_key int, category string, department string, unit_price decimal(10,2)")


def test_date_dimension_q1_2024(spark):
    d = star.date_dimension(spark, "2024-01-01", "2024-03-31")
    assert d.count() == 91
    first = d.filter(F.col("date_key") == 20240101).first()
    assert first.full_date == D(2024, 1, 1)
    assert first.day_of_week == "Monday"
    assert first.day_num_in_week == 2  # 1 = Sunday
    assert first.calendar_month == "January" and first.calendar_quarter == "Q1"
    sat = d.filter(F.col("full_date") == D(2024, 1, 6)).first()
    assert sat.is_weekend and sat.day_num_in_week == 7
    assert d.filter("is_weekend").count() == 26
    assert [f.name for f in d.schema.fields][:2] == ["date_key", "full_date"]


def test_margin_by_department_category(spark):
    f, p = _fact(spark), _products(spark)
    g = f.join(p, "product_key").groupBy("department", "category").agg(
        F.sum("sales_quantity").alias("units"), F.sum("sales_amount").alias("rev"), F.sum("gross_profit_amount").alias("profit")
    )
    res = {r.category: (r.units, r.rev, r.margin) for r in g.select("category", "units", out(F.col("rev")).alias("rev"), pct(F.col("profit"), F.col("rev")).alias("margin")).collect()}
    assert res["Computers"] == (3, 2999.97, 35.0)
    assert res["Desks"] == (2, 799.98, 50.0)
    assert res["Seating"] == (1, 249.99, 52.0)
    assert res["Accessories"] == (5, 199.95, 59.99)
    assert res["Notebooks"] == (8, 39.92, 59.92)
    assert res["Pens"] == (2, 7.98, 62.41)


def test_segment_avg_rounds_on_decimals(spark):
    f = _fact(spark).filter("customer_key in (1)")
    r = f.agg(F.sum("sales_amount").alias("s"), F.count("sales_amount").alias("n")).select(ratio(F.col("s"), F.col("n")).alias("avg")).first()
    assert r.avg == 474.99  # (999.99 + 24.99 + 399.99) / 3 = 474.99


def test_daytype_through_date_dimension(spark):
    dd = star.date_dimension(spark, "2024-01-01", "2024-03-31")
    g = _fact(spark).join(F.broadcast(dd), "date_key").groupBy("is_weekend").agg(F.count(F.lit(1)).alias("n"), out(F.sum("sales_amount")).alias("rev"))
    res = {r.is_weekend: (r.n, r.rev) for r in g.collect()}
    assert res[False] == (12, 3297.80)
    assert res[True] == (1, 999.99)


def test_number_rows_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out_ = number_rows(df, ["k"], "sk").orderBy("k").collect()
    assert [r.sk for r in out_] == list(range(1, 1001))
    assert [r.k for r in out_] == list(range(1000))


def test_assign_keys_stable_for_existing_members(spark):
    first = assign_keys(spark.createDataFrame([("b",), ("d",), ("a",)], "name string"), ["name"], "k")
    assert {r.name: r.k for r in first.collect()} == {"a": 1, "b": 2, "d": 3}
    second = assign_keys(spark.createDataFrame([("c",), ("a",), ("e",), ("c",)], "name string"), ["name"], "k", existing=first)
    got = {r.name: r.k for r in second.collect()}
    assert got == {"a": 1, "b": 2, "d": 3, "c": 4, "e": 5}


def test_unknown_member_and_lookup(spark):
    dim = spark.createDataFrame([(1, "C001"), (2, "C002")], "customer_key int, durable string")
    dim = star.with_unknown_member(dim, "customer_key", {"durable": "UNKNOWN"})
    assert dim.filter("customer_key = 0").first().durable == "UNKNOWN"
    facts = spark.createDataFrame([("C001",), ("C999",)], "durable string")
    got = {r.durable: r.customer_key for r in star.lookup_key(facts, dim.filter("customer_key <> 0"), ["durable"], "customer_key").collect()}
    assert got == {"C001": 1, "C999": 0}


CUSTOMERS = [
    (1, "C001", "Alice Brown", "London", "Premium"),
    (2, "C002", "Bob Smith", "Manchester", "Standard"),
    (3, "C003", "Carol White", "Birmingham", "Premium"),
    (4, "C004", "David Jones", "Edinburgh", "Budget"),
]


def _scd_dim(spark):
    rows = [(k, d, n, c, s, D(2020, 1, 1), star.OPEN_END, True) for k, d, n, c, s in CUSTOMERS]
    return spark.createDataFrame(
        rows,
        "customer_key long, customer_durable_id string, full_name string, city string, segment string, effective_date date, expiry_date date, is_current boolean",
    )


def test_scd2_apply_expires_and_inserts(spark):
    batch = spark.createDataFrame([("C001", "Bristol", "Premium", D(2024, 2, 1)), ("C002", "Manchester", "Standard", D(2024, 2, 1))],
                                  "customer_durable_id string, city string, segment string, effective_date date")
    res = star.scd2_apply(_scd_dim(spark), batch, "customer_durable_id", ["city", "segment"], surrogate="customer_key")
    rows = sorted(res.filter("customer_durable_id = 'C001'").collect(), key=lambda r: r.effective_date)
    assert [(r.city, r.expiry_date, r.is_current) for r in rows] == [("London", D(2024, 1, 31), False), ("Bristol", star.OPEN_END, True)]
    assert rows[1].customer_key == 5 and rows[1].full_name == "Alice Brown"
    assert res.count() == 5  # C002 unchanged: no new version
    asof = star.as_of(res, "2024-01-15").filter("customer_durable_id = 'C001'").collect()
    assert [r.city for r in asof] == ["London"]
    again = star.scd2_apply(res, batch, "customer_durable_id", ["city", "segment"], surrogate="customer_key")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, res.collect()))  # idempotent


def test_scd2_apply_null_safe_and_new_keys(spark):
    batch = spark.createDataFrame([("C003", None, "Premium", D(2024, 3, 1)), ("C009", "York", "Budget", D(2024, 3, 1))],
                                  "customer_durable_id string, city string, segment string, effective_date date")
    res = star.scd2_apply(_scd_dim(spark), batch, "customer_durable_id", ["city", "segment"], surrogate="customer_key")
    cur = {r.customer_durable_id: r for r in res.filter("is_current").collect()}
    assert cur["C003"].city is None and cur["C003"].effective_date == D(2024, 3, 1)
    assert cur["C009"].city == "York"
    assert sorted(r.customer_key for r in res.filter("customer_key > 4").collect()) == [5, 6]


def test_scd2_from_changes_drops_noops_and_is_gapless(spark):
    feed = spark.createDataFrame(
        [
            (1, dt.datetime(2024, 1, 1, 9), "A", 1),
            (1, dt.datetime(2024, 1, 1, 17), "B", 2),  # same day: last wins
            (1, dt.datetime(2024, 1, 3), "B", 3),  # no-op
            (1, dt.datetime(2024, 1, 5), None, 4),
            (1, dt.datetime(2024, 1, 7), None, 5),  # no-op (NULL-safe)
            (1, dt.datetime(2024, 1, 9), "A", 6),
            (2, dt.datetime(2024, 1, 2), "X", 7),
        ],
        "k int, ts timestamp, v string, seq int",
    )
    h = star.scd2_from_changes(feed, "k", ["v"], "ts", order="seq").orderBy("k", "effective_date").collect()
    k1 = [(r.v, r.effective_date, r.expiry_date, r.is_current) for r in h if r.k == 1]
    assert k1 == [
        ("B", D(2024, 1, 1), D(2024, 1, 4), False),
        (None, D(2024, 1, 5), D(2024, 1, 8), False),
        ("A", D(2024, 1, 9), star.OPEN_END, True),
    ]
    for a, b in zip(k1, k1[1:]):
        assert (b[1] - a[2]).days == 1


def test_drill_across_full_joins_aggregates(spark):
    a = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "m int, v int")
    b = spark.createDataFrame([(2, 1), (3, 4)], "m int, w int")
    res = star.drill_across([(a, {"sv": F.sum("v")}), (b, {"sw": F.sum("w")})], ["m"])
    assert sorted(map(tuple, res.collect()), key=lambda r: r[0]) == [(1, 15, None), (2, 7, 1), (3, None, 4)]


def _customers(spark):
    rows = [(1, "C001", "Premium"), (2, "C002", "Standard"), (3, "C003", "Budget"), (4, "C004", "Premium")]
    dim = spark.createDataFrame([(k, d, s, True) for k, d, s in rows], "customer_key int, customer_durable_id string, segment string, is_current boolean")
    return star.with_unknown_member(dim, "customer_key", {"customer_durable_id": "UNKNOWN", "is_current": True})


def test_q2_segment_current_non_placeholder(spark):
    f, c = _fact(spark), _customers(spark)
    j = f.join(c.filter(F.col("is_current") & (F.col("customer_key") != 0)), "customer_key")
    g = j.groupBy("segment").agg(
        F.countDistinct("pos_transaction_number").alias("n"), F.sum("sales_amount").alias("rev"), F.count("sales_amount").alias("c")
    ).select("segment", "n", out(F.col("rev")).alias("rev"), ratio(F.col("rev"), F.col("c")).alias("avg"))
    got = {r.segment: (r.n, r.rev, r.avg) for r in g.collect()}
    assert got == {"Premium": (4, 2447.91, 407.99), "Standard": (2, 1099.97, 549.99), "Budget": (2, 724.96, 181.24)}


def test_q3_q4_month_and_tiers(spark):
    f, p = _fact(spark), _products(spark)
    dd = star.date_dimension(spark, "2024-01-01", "2024-03-31")
    m = f.join(dd, "date_key").groupBy("calendar_month", "month_num").agg(F.count(F.lit(1)).alias("n"), out(F.sum("sales_amount")).alias("rev")).collect()
    assert [(r.calendar_month, r.n, r.rev) for r in m] == [("January", 13, 4297.79)]
    amt = F.col("sales_amount")
    tiers = f.join(p, "product_key").groupBy("department").agg(
        F.sum(F.when(amt > 500, 1).otherwise(0)).alias("hi"),
        F.sum(F.when(amt.between(50, 500), 1).otherwise(0)).alias("mid"),
        F.sum(F.when(amt < 50, 1).otherwise(0)).alias("lo"),
        F.count(F.lit(1)).alias("n"),
    )
    got = {r.department: (r.hi, r.mid, r.lo, r.n) for r in tiers.collect()}
    assert got == {"Electronics": (3, 1, 3, 7), "Furniture": (0, 3, 0, 3), "Stationery": (0, 0, 3, 3)}


def test_q5_q6_store_and_promotion(spark):
    f = _fact(spark)
    stores = spark.createDataFrame(
        [(1, "London City", "London"), (2, "Manchester Deansgate", "North West"), (3, "Birmingham Centre", "Midlands"), (4, "Edinburgh Royal", "Scotland")],
        "store_key int, store_name string, region string",
    )
    g = f.join(stores, "store_key").groupBy("region", "store_name", "store_key").agg(
        out(F.sum("sales_amount")).alias("rev"), out(F.sum("gross_profit_amount")).alias("profit")
    )
    got = {r.store_key: (r.rev, r.profit) for r in g.collect()}
    assert got == {1: (1424.97, 564.97), 2: (1124.92, 424.92), 3: (724.96, 374.96), 4: (1022.94, 363.94)}
    promos = spark.createDataFrame(
        [(1, "Winter Sale", "Temporary Price Reduction"), (2, "Newsletter Coupon", "Coupon"), (3, "Weekend Ad", "Ad")],
        "promotion_key int, promotion_name string, promo_type string",
    )
    promos = star.with_unknown_member(promos, "promotion_key", {"promotion_name": "No Promotion"})
    q6 = f.join(promos, "promotion_key").groupBy("promotion_name", "promo_type").agg(F.count(F.lit(1)).alias("n"), out(F.sum("sales_amount")).alias("rev"))
    got = {r.promotion_name: (r.n, r.rev) for r in q6.collect()}
    assert got == {"No Promotion": (8, 2774.88), "Winter Sale": (2, 1099.97), "Weekend Ad": (1, 399.99), "Newsletter Coupon": (2, 22.95)}


def test_row_count_audit(spark):
    parts = [("dim_date", star.date_dimension(spark, "2024-01-01", "2024-03-31")), ("dim_product", _products(spark)),
             ("dim_customer", _customers(spark)), ("fact_retail_sales", _fact(spark))]
    audit = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        audit = c if audit is None else audit.unionByName(c)
    assert {r.table_name: r.rows for r in audit.collect()} == {"dim_date": 91, "dim_product": 7, "dim_customer": 5, "fact_retail_sales": 13}
