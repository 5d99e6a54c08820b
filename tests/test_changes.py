"""Row changes on the inventory document fixture, keyed upserts, ledgers."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions.names import composite_id, first_present, normalise_name, to_text
from tessera.operators import changes

TS = dt.datetime(2024, 1, 1)
INV_SCHEMA = "idx int, item string, qty int, status string, tags array<string>, dim_cm array<double>, size struct<h:double,w:double,uom:string>"
INVENTORY = [
    (0, "canvas", 100, "A", ["cotton"], [28.0, 35.5], (28.0, 35.5, "cm")),
    (1, "journal", 25, "A", ["blank", "red"], [14.0, 21.0], (14.0, 21.0, "cm")),
    (2, "notebook", 50, "A", ["red", "blank"], [14.0, 21.0], (8.5, 11.0, "in")),
    (3, "paper", 100, "D", ["red", "blank", "plain"], [14.0, 21.0], (8.5, 11.0, "in")),
    (4, "planner", 75, "D", ["blank", "red"], [22.85, 30.0], (22.85, 30.0, "cm")),
    (5, "postcard", 45, "A", ["blue"], [10.0, 15.25], (10.0, 15.25, "cm")),
]


def _inv(spark):
    return spark.createDataFrame(INVENTORY, INV_SCHEMA)


def test_reads(spark):
    inv = _inv(spark)
    assert sorted(r.item for r in inv.filter(F.col("size.uom") == "in").collect()) == ["notebook", "paper"]
    assert inv.filter(F.array_contains("tags", "red")).count() == 4
    want = F.array(F.lit("red"), F.lit("blank"))
    assert inv.filter(F.size(F.array_except(want, F.col("tags"))) == 0).count() == 4
    em = inv.filter(F.exists("dim_cm", lambda x: (x > 22) & (x < 30)))
    assert sorted(r.item for r in em.collect()) == ["canvas", "planner"]


def test_update_sequence(spark):
    inv = _inv(spark)
    inv = changes.update_first(inv, F.col("item") == "paper", {"size.uom": "cm", "status": "P", "lastModified": F.lit(TS)}, ["idx"])
    inv = changes.update_where(inv, F.col("qty") < 50, {"size.uom": "in", "status": "P", "lastModified": F.lit(TS)})
    inv = changes.push(inv, "tags", "featured", F.col("item") == "journal")
    inv = changes.inc(inv, "qty", 5, F.col("item") == "journal")
    got = {r.item: r for r in inv.collect()}
    assert (got["paper"].status, got["paper"].size.uom, got["paper"].qty, got["paper"].lastModified) == ("P", "cm", 100, TS)
    assert (got["journal"].status, got["journal"].size.uom, got["journal"].qty) == ("P", "in", 30)
    assert list(got["journal"].tags) == ["blank", "red", "featured"]
    assert (got["postcard"].status, got["postcard"].size.uom, got["postcard"].qty) == ("P", "in", 45)
    assert got["canvas"].lastModified is None and got["canvas"].status == "A"


def test_match_project_and_group(spark):
    inv = _inv(spark)
    mp = inv.filter(F.col("qty") > 50).select("item", F.col("status").alias("inventory_status"), F.col("size.uom").alias("unit"))
    assert sorted(map(tuple, mp.collect())) == [("canvas", "A", "cm"), ("paper", "D", "in"), ("planner", "D", "cm")]
    g = inv.groupBy("status").agg(F.sum("qty").alias("t"), F.count(F.lit(1)).alias("n"), F.avg("qty").alias("a"))
    got = {r.status: (r.t, r.n, round(r.a, 2)) for r in g.collect()}
    assert got == {"A": (220, 4, 55.0), "D": (175, 2, 87.5)}


def test_deletes(spark):
    inv = _inv(spark)
    after_one = changes.delete_first(inv, F.col("status") == "D", ["idx"])
    assert sorted(r.item for r in after_one.collect()) == ["canvas", "journal", "notebook", "planner", "postcard"]
    after_many = changes.delete_where(after_one, F.col("status") == "A")
    assert [r.item for r in after_many.collect()] == ["planner"]
    empty = changes.delete_where(after_many, True)
    assert empty.count() == 0 and empty.columns == inv.columns


def test_null_condition_matches_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    out = changes.update_where(df, F.col("v") > 1, {"v": F.lit(0)})
    assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == [(1, None), (2, 0)]
    assert changes.delete_where(df, F.col("v") > 1).count() == 1


def test_push_onto_missing_array(spark):
    df = spark.createDataFrame([(1, None), (2, ["x"])], "k int, tags array<string>")
    out = {r.k: list(r.tags) for r in changes.push(df, "tags", "featured").collect()}
    assert out == {1: ["featured"], 2: ["x", "featured"]}


def test_fill_from_lookup_and_insert(spark):
    emp = spark.createDataFrame([(1, "Alice", "Engineering"), (2, "Bob", "Sales"), (3, "Carol", "Engineering"), (4, "David", "HR")], "emp_id int, name string, dept string")
    dept = spark.createDataFrame([(10, "Engineering"), (20, "Sales")], "dept_id int, dept_name string")
    filled = changes.fill_from_lookup(emp, dept, ("dept", "dept_name"), "dept_id", "dept_id")
    assert {r.name: r.dept_id for r in filled.collect()} == {"Alice": 10, "Bob": 20, "Carol": 10, "David": None}
    more = changes.insert(dept, spark.createDataFrame([("Finance",)], "dept_name string"))
    assert more.count() == 3 and more.filter("dept_id IS NULL").first().dept_name == "Finance"


def test_ledger_and_append_aggregate(spark):
    acc = spark.createDataFrame([("Alice", Decimal("1000.00")), ("Bob", Decimal("500.00")), ("Carol", Decimal("500.00"))], "name string, balance decimal(12,2)")
    mv = spark.createDataFrame([("Alice", Decimal("-100.00")), ("Carol", Decimal("100.00"))], "name string, delta decimal(12,2)")
    got = {r.name: r.balance for r in changes.apply_movements(acc, mv, "name", "balance", "delta").collect()}
    assert got == {"Alice": Decimal("900.00"), "Bob": Decimal("500.00"), "Carol": Decimal("600.00")}
    mytab = spark.createDataFrame([(1, 10), (1, 20), (2, 100), (2, 200)], "class int, value int")
    grown = changes.append_aggregate(mytab, F.col("class") == 1, {"class": 2}, "value")
    sums = {r["class"]: r.s for r in grown.groupBy("class").agg(F.sum("value").alias("s")).collect()}
    assert sums == {1: 30, 2: 330}


def test_name_functions(spark):
    df = spark.createDataFrame(
        [("Foo_Bar.baz", None, "x"), ("  A--b  ", "", None), ("", "fallback", "s"), ("   ", "fb", "")],
        "name string, pkg string, source string",
    )
    rows = df.select(
        normalise_name("name").alias("n"), first_present("name", "pkg").alias("f"), composite_id("source", "name").alias("i")
    ).collect()
    assert [r.n for r in rows] == ["foo-bar-baz", "a-b", "", ""]
    assert [r.f for r in rows] == ["Foo_Bar.baz", "  A--b  ", "fallback", "   "]
    assert [r.i for r in rows] == ["x:foo-bar-baz", "osv:a-b", "s:", "osv:"]
    assert spark.range(1).select(to_text(F.lit(5)).alias("t"), to_text(F.lit(None).cast("int")).alias("u")).first() == ("5", None)


def test_upsert_dimension_keeps_keys_last_wins(spark):
    b1 = spark.createDataFrame([("requests", "Requests", "a@x", 1), ("numpy", "NumPy", "b@x", 2), ("requests", "requests", "c@x", 3)],
                               "norm string, package_name string, author_email string, seq int")
    d1 = changes.upsert_dimension(None, b1, "norm", "seq", "package_key", ["package_name", "author_email"])
    assert {r.norm: (r.package_key, r.package_name, r.author_email) for r in d1.collect()} == {
        "numpy": (1, "NumPy", "b@x"), "requests": (2, "requests", "c@x")}
    b2 = spark.createDataFrame([("requests", "Requests", None, 4), ("attrs", "attrs", "d@x", 5)], "norm string, package_name string, author_email string, seq int")
    d2 = changes.upsert_dimension(d1, b2, "norm", "seq", "package_key", ["package_name", "author_email"])
    assert {r.norm: (r.package_key, r.package_name, r.author_email) for r in d2.collect()} == {
        "numpy": (1, "NumPy", "b@x"), "requests": (2, "Requests", None), "attrs": (3, "attrs", "d@x")}


def test_upsert_replace_whole_document(spark):
    store = spark.createDataFrame([("a", 1, "old", 5)], "_id string, seq int, body string, extra int")
    batch = spark.createDataFrame([("a", 2, "new", None), ("b", 3, "x", 1), ("a", 1, "older-in-batch", 9)], "_id string, seq int, body string, extra int")
    got = {r._id: (r.body, r.extra) for r in changes.upsert_replace(store, batch, "_id", "seq").collect()}
    assert got == {"a": ("new", None), "b": ("x", 1)}
