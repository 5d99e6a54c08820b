"""Relational fixture queries (weather/cities, authors/books, regional sales,
employees/departments, index-demo series) with the expected results."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.operators import changes
from tessera.operators.joins import outer_join


def _weather(spark):
    return spark.createDataFrame(
        [("San Francisco", 46, 50, 0.25, dt.date(1994, 11, 27)), ("San Francisco", 43, 57, 0.0, dt.date(1994, 11, 29)),
         ("Hayward", 37, 54, None, dt.date(1994, 11, 29))],
        "city string, temp_lo int, temp_hi int, prcp float, date date",
    )


def test_weather_subquery_and_left_join(spark):
    w = _weather(spark)
    top = w.select(F.max("temp_lo")).scalar()
    assert [r.city for r in w.filter(F.col("temp_lo") == top).collect()] == ["San Francisco"]
    cities = spark.createDataFrame([("San Francisco", (-194.0, 53.0))], "name string, location struct<x:double,y:double>")
    j = w.join(cities, w.city == cities.name, "left").select("city", "location").collect()
    assert sorted((r.city, None if r.location is None else (r.location.x, r.location.y)) for r in j) == [
        ("Hayward", None), ("San Francisco", (-194.0, 53.0)), ("San Francisco", (-194.0, 53.0))]


def test_count_of_nullable_side(spark):
    cities = spark.createDataFrame([("San Francisco",), ("Hayward",)], "name string")
    w = _weather(spark)
    g = cities.join(w, w.city == cities.name, "left").groupBy("name").agg(F.count("city").alias("weather_rows"))
    assert {r.name: r.weather_rows for r in g.collect()} == {"Hayward": 1, "San Francisco": 2}


def test_top_regions_two_ctes(spark):
    o = spark.createDataFrame(
        [("North", "Laptop", 10, Decimal("12000.00")), ("North", "Mouse", 40, Decimal("800.00")), ("South", "Laptop", 4, Decimal("4800.00")),
         ("South", "Keyboard", 15, Decimal("1500.00")), ("West", "Monitor", 3, Decimal("900.00"))],
        "region string, product string, quantity int, amount decimal(10,2)",
    )
    sales = o.groupBy("region").agg(F.sum("amount").alias("total_sales"))
    cut = sales.select(F.sum("total_sales") / 10).scalar()
    assert sorted(r.region for r in sales.filter(F.col("total_sales") > cut).collect()) == ["North", "South"]


def _authors_books(spark):
    authors = spark.createDataFrame(
        [(1, "George Orwell", "UK"), (2, "J.K. Rowling", "UK"), (3, "Isaac Asimov", "USA"), (4, "Chimamanda Ngozi Adichie", "Nigeria")],
        "id int, name string, country string",
    )
    books = spark.createDataFrame(
        [(1, "1984", 1, 1949, Decimal("15.99")), (2, "Animal Farm", 1, 1945, Decimal("9.99")),
         (3, "Harry Potter and the Philosopher's Stone", 2, 1997, Decimal("19.99")), (4, "Foundation", 3, 1951, Decimal("12.99"))],
        "id int, title string, author_id int, published_year int, price decimal(6,2)",
    )
    return authors, books


def test_books_subqueries(spark):
    authors, books = _authors_books(spark)
    avg_price = books.select(F.avg("price")).scalar()
    above = sorted((r.title, float(r.price)) for r in books.filter(F.col("price") > avg_price).collect())
    assert above == [("1984", 15.99), ("Harry Potter and the Philosopher's Stone", 19.99)]
    top = authors.groupBy("country").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "country").limit(1)
    uk = books.join(authors.join(F.broadcast(top.select("country")), "country", "left_semi"), books.author_id == authors.id)
    assert sorted(r.title for r in uk.collect()) == ["1984", "Animal Farm", "Harry Potter and the Philosopher's Stone"]
    avg_len = books.select(F.avg(F.length("title"))).scalar()
    assert [r.title for r in books.filter(F.length("title") > avg_len).collect()] == ["Harry Potter and the Philosopher's Stone"]
    counts = authors.join(books, books.author_id == authors.id, "left").groupBy(authors.id, "name").agg(F.count(books.id).alias("n"))
    assert [r.n for r in counts.orderBy(authors.id).collect()] == [2, 1, 1, 0]


def test_employees_joins_and_full_outer_emulation(spark):
    emp = spark.createDataFrame([(1, "Alice", "Engineering"), (2, "Bob", "Sales"), (3, "Carol", "Engineering")], "emp_id int, name string, dept string")
    dept = spark.createDataFrame([(10, "Engineering"), (20, "Sales")], "dept_id int, dept_name string")
    emp = changes.fill_from_lookup(emp, dept, ("dept", "dept_name"), "dept_id", "dept_id")
    emp = changes.insert(emp, spark.createDataFrame([(4, "David", "HR", 3)], "emp_id int, name string, dept string, dept_id int"))
    dept = changes.insert(dept, spark.createDataFrame([(4, "Finance")], "dept_id int, dept_name string"))
    inner = sorted(map(tuple, emp.join(dept, "dept_id").select("name", "dept_name").collect()))
    assert inner == [("Alice", "Engineering"), ("Bob", "Sales"), ("Carol", "Engineering")]
    full = emp.join(dept, emp.dept_id == dept.dept_id, "full").select("name", "dept_name")
    emulated = outer_join(emp, dept, ["dept_id"], ["dept_id"], "full").select("name", "dept_name")
    want = sorted(map(tuple, full.collect()), key=str)
    assert want == sorted(map(tuple, emulated.collect()), key=str)
    assert ("David", None) in want and (None, "Finance") in want


def test_series_index_demo(spark):
    gs = F.col("id")
    t = spark.range(1, 10001).select(gs.alias("order_id"), ((gs - 1) % 100 + 1).alias("cust_id"), (((gs - 1) % 20 + 1) * 10).alias("amount"))
    assert t.count() == 10000
    c42 = t.filter("cust_id = 42")
    assert c42.count() == 100 and {r.amount for r in c42.collect()} == {20}
    top5 = c42.orderBy("amount", "order_id").limit(5).collect()
    assert [r.order_id for r in top5] == [42, 142, 242, 342, 442]


def test_url_search_is_case_insensitive(spark):
    h = spark.createDataFrame([(1, "https://x.org/Bayes"), (2, "https://y.org/other"), (3, "HTTPS://BAYES.ac.uk")], "id long, url string")
    hits = h.filter(F.col("url").ilike("%bayes%")).orderBy(F.desc("id")).limit(10)
    assert [r.id for r in hits.collect()] == [3, 1]
