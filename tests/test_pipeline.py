"""Layered pipeline, versions, JSON-array ingestion, quality checks and
normalisation."""

import json
import os
import random
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import layers, normalise, quality
from tessera.sources.ingest import _numbered, _pieces, read_json_array, write_json_arrays
from tessera.sources.json_items import MALFORMED, ArrayItems, Effect, State, after

LAB = [(1, "C01", "Laptop", 120.50), (2, "C02", "Mouse", 25.00), (3, "C01", "Monitor", 70.00), (4, "C03", "Desk", 220.00)]


def _lab(spark):
    return spark.createDataFrame(LAB, "order_id int, customer_id string, product string, amount double")


def test_medallion_flow(spark):
    raw = _lab(spark)
    assert raw.filter(F.col("amount") > 50).count() == 3
    bronze_p = layers.write_table(raw.unionByName(raw), layers.lake_dir(spark, "bronze"))
    silver = layers.to_silver(layers.read_table(spark, bronze_p), {"amount": "decimal(12,2)"}, ["order_id"])
    assert silver.count() == 4 and str(silver.schema["amount"].dataType) == "DecimalType(12,2)"
    gold = silver.groupBy("customer_id").agg(F.sum("amount").alias("total"))
    got = {r.customer_id: float(r.total) for r in gold.collect()}
    assert got == {"C01": 190.5, "C02": 25.0, "C03": 220.0}


def test_silver_keeps_smallest_duplicate(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (2, "z", 1.0)], "k int, s string, v double")
    got = {r.k: (r.s, r.v) for r in layers.to_silver(df, {}, ["k"]).collect()}
    assert got == {1: ("a", 9.0), 2: ("z", 1.0)}


def test_versioned_table(spark):
    vt = layers.VersionedTable(spark, layers.lake_dir(spark, "v"), ["order_id"])
    vt.write(_lab(spark))
    vt.update(F.col("order_id") == 1, {"amount": F.col("amount") + 1})
    vt.delete(F.col("customer_id") == "C02")
    h = sorted((r.version, r.operation, r.num_affected_rows) for r in vt.history().collect())
    assert h == [(0, "WRITE", 4), (1, "UPDATE", 1), (2, "DELETE", 1)]
    v0 = {r.order_id: r.amount for r in vt.read(0).collect()}
    assert v0[1] == 120.5
    cur = {r.order_id: r.amount for r in vt.read().collect()}
    assert cur[1] == 121.5 and 2 not in cur and len(cur) == 3
    stamps = [r.timestamp for r in vt.history().orderBy("version").collect()]
    assert stamps == sorted(stamps) and None not in stamps
    latest = vt.read(2)
    assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, vt.read().collect()))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_dead_commit_stays_invisible(spark):
    vt = layers.VersionedTable(spark, layers.lake_dir(spark, "dead"), ["order_id"])
    vt.write(_lab(spark))
    before = _rows(vt.read())
    # a commit that died before its log row: records only
    layers.record_update(vt.changes(), ["order_id"], "order_id = 2", {"amount": 999.0}, version=1).write.parquet(f"{vt.path}/data/000000000001-dead")
    assert _rows(vt.read()) == before
    vt.update("order_id = 1", {"amount": 1.0})
    assert {r.order_id: r.amount for r in vt.read().collect()}[2] == 25.0 and vt.last_version() == 1


def test_two_writers_of_one_version_conflict(spark):
    path = layers.lake_dir(spark, "race")
    a, b = (layers.VersionedTable(spark, path, ["order_id"]) for _ in range(2))
    a.write(_lab(spark))

    def late(version):  # the other writer commits the same version meanwhile
        assert a.delete("order_id = 1") == version
        return layers.record_delete(b.changes(), ["order_id"], "order_id = 2", version=version)

    with pytest.raises(layers.CommitConflict):
        b.commit(late, "DELETE")
    assert [r.version for r in a.log().orderBy("version").collect()] == [0, 1]
    for table in (a, b):  # what was reported is there, the other writer's rows are not
        assert sorted(r.order_id for r in table.read().collect()) == [2, 3, 4]
    assert b.delete("order_id = 2") == 2 and sorted(r.order_id for r in a.read().collect()) == [3, 4]


def test_snapshots_equal_the_whole_history(spark):
    vt = layers.VersionedTable(spark, layers.lake_dir(spark, "folds"), ["order_id"])
    vt.write(_lab(spark))
    for k in range(6):
        vt.delete(f"order_id = {k}") if k == 3 else vt.update(f"order_id <= {k}", {"amount": F.col("amount") + 1})
        if k in (1, 4):
            vt.fold()
            vt.fold()  # again: no second snapshot
    assert vt.fold(1) == 1  # afterwards, of an old version
    for v in range(7):
        assert _rows(vt.read(v)) == _rows(layers.as_of_version(vt.changes(v), ["order_id"])), v
        assert len(vt._folders("folds", 0, v)) == sum(f <= v for f in (1, 2, 5))
    assert len(vt._records(6).inputFiles()) < len(vt.changes(6).inputFiles())
    folded = layers.fold(vt.changes(), ["order_id"], 4).unionByName(vt.changes().where("_version > 4"))
    assert _rows(layers.as_of_version(folded, ["order_id"])) == _rows(vt.read())


def test_an_unreadable_log_is_an_error(spark):
    vt = layers.VersionedTable(spark, layers.lake_dir(spark, "bad"), ["order_id"])
    assert vt.last_version() == -1 and vt.history().collect() == []
    folder = vt.path.removeprefix("file:") + "/log"
    os.makedirs(folder)
    with open(folder + "/000000000000.json", "w") as f:
        f.write("not json")
    with pytest.raises(Exception, match="(?i)malformed"):
        vt.last_version()


def _files(path):
    root = path.removeprefix("file:")
    return {os.path.join(d, f)[len(root) :] for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_keyed_store_rewrites_only_the_batch_s_buckets(spark):
    store = layers.KeyedStore(spark, layers.lake_dir(spark, "store"), "k", "seq", buckets=16)
    first = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("seq"), F.concat(F.lit("a"), "id").alias("v"))
    assert store.load(first) == list(range(16)) and _rows(store.read()) == _rows(first)
    before = _files(store.path)
    batch = spark.createDataFrame([(5, 2, "x"), (5, 3, "y"), (5000, 1, "new"), (None, 1, "no key")], "k long, seq int, v string")
    touched = store.load(batch)
    assert len(touched) <= 3
    kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert kept and kept < _files(store.path) and not (before - kept) & _files(store.path)
    want = {(r.k, r.seq, r.v) for r in first.where("k <> 5").collect()} | {(5, 3, "y"), (5000, 1, "new"), (None, 1, "no key")}
    assert set(map(tuple, store.read().collect())) == want
    assert store.load(batch) == touched and set(map(tuple, store.read().collect())) == want  # again: no change
    assert store.load(batch.limit(0)) == []


def test_keyed_store_finishes_a_load_that_died(spark, monkeypatch):
    store = layers.KeyedStore(spark, layers.lake_dir(spark, "died"), "k", "seq", buckets=4)
    rows = spark.createDataFrame([(i, 1, "a") for i in range(20)], "k long, seq int, v string")
    store.load(rows)
    swap = layers.KeyedStore._swap
    monkeypatch.setattr(layers.KeyedStore, "_swap", lambda self: None)
    store.load(spark.createDataFrame([(3, 2, "b")], "k long, seq int, v string"))  # dies before the rows are in place
    monkeypatch.setattr(layers.KeyedStore, "_swap", swap)
    assert {r.k: r.v for r in store.read().collect()} == {i: "b" if i == 3 else "a" for i in range(20)}
    monkeypatch.setattr(layers, "remove_folder", lambda *a: None)  # dies while it cleans up
    store.load(spark.createDataFrame([(4, 2, "c")], "k long, seq int, v string"))
    monkeypatch.undo()
    assert {r.k: r.v for r in store.read().collect()}[4] == "c"


def test_clustered_files_skip_what_a_lookup_does_not_need(spark):
    rows = spark.range(40_000).select(F.col("id").alias("k"), F.expr("cast(pmod(xxhash64(id), 1000000) as long)").alias("other"), F.repeat(F.lit("x"), 20).alias("v"))
    table = layers.write_clustered(rows, layers.lake_dir(spark, "clustered"), "k", ["other"], 8)
    assert table.count() == 40_000
    spans = sorted((r.low, r.high) for r in table.groupBy(F.input_file_name()).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect())
    assert len(spans) == 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    some = rows.where("k = 12345").first()
    assert [tuple(r) for r in table.where(F.col("other") == some.other).collect()] == [tuple(r) for r in rows.where(F.col("other") == some.other).collect()]
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(table.inputFiles()[0].removeprefix("file://")).metadata.row_group(0)
    assert meta.column(1).statistics.has_min_max


def test_bucketed_managed_tables_join_without_exchange(spark):
    big = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("x"))
    small = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [layers.publish_bucketed(df, name, "k", 4) for df, name in ((big, "t_big"), (small, "t_small"))]
        joined = tables[0].join(tables[1], "k").groupBy("k").agg(F.sum("x").alias("x"), F.max("y").alias("y"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert _rows(joined) == _rows(big.join(small, "k").groupBy("k").agg(F.sum("x"), F.max("y")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("t_big", "t_small"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(text)
    return p


SCHEMA = "info struct<name:string, author_email:string>, package_name string"


def test_json_array_reader(spark):
    d = tempfile.mkdtemp(prefix="tessera-json-")
    _write(d, "good.json", '[ , {"info": {"name": "Foo_Bar", "author_email": "a@x"}, "extra": [1, 2]},, {"package_name": "baz,]"} ,]')
    _write(d, "mixed.json", '[{"info": {"name": "ok"}}, 5, "text"]')
    _write(d, "notarray.json", '{"info": {"name": "x"}}')
    _write(d, "broken.json", '[{"info": {"name": "x"}')
    _write(d, "empty.json", "   ")
    docs, bad = read_json_array(spark, d, SCHEMA)
    rows = sorted(docs.collect(), key=lambda r: (os.path.basename(r.source_file), r.item_no))
    assert [(os.path.basename(r.source_file), r.item_no) for r in rows] == [("good.json", 0), ("good.json", 1), ("mixed.json", 0)]
    assert {os.path.basename(r.source_file): r.raw for r in bad.collect()}["broken.json"] == '{"info": {"name": "x"}'
    assert rows[0].info.name == "Foo_Bar" and '"extra":[1,2]' in rows[0].raw.replace(" ", "")
    assert rows[1].package_name == "baz,]"
    reasons = sorted((os.path.basename(r.source_file), r.reason) for r in bad.collect())
    assert reasons == [
        ("broken.json", "malformed JSON"),
        ("mixed.json", "item is not an object"),
        ("mixed.json", "item is not an object"),
        ("notarray.json", "not a JSON array"),
    ]
    with pytest.raises(quality.ConstraintViolation):
        read_json_array(spark, d, SCHEMA, strict=True)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1, "a", 5.0), (1, 1, "b", None), (2, 1, None, -1.0)], "k1 int, k2 int, s string, price double")
    assert [tuple(r) for r in quality.unique_violations(df, ["k1", "k2"]).collect()] == [(1, 1, 2)]
    nulls = {r.column_name: r.null_count for r in quality.null_counts(df).collect()}
    assert nulls == {"k1": 0, "k2": 0, "s": 1, "price": 1}
    assert [r.k1 for r in quality.check_violations(df, F.col("price") >= 0).collect()] == [2]
    parent = spark.createDataFrame([(1,)], "id int")
    child = spark.createDataFrame([(1,), (2,), (None,)], "ref int")
    assert [r.ref for r in quality.fk_violations(child, ["ref"], parent, ["id"]).collect()] == [2]
    good, bad = quality.split(df, {"missing s": quality.required_text("s")})
    assert good.count() == 2 and bad.first().reason == "missing s"
    with pytest.raises(quality.ConstraintViolation):
        quality.raise_if_any(quality.check_violations(df, F.col("price") >= 0), "price >= 0")
    d = quality.with_defaults(df, {"price": 0.0, "active": True})
    assert d.filter("price IS NULL").count() == 0 and d.first().active is True


def test_normalise_round_trip(spark):
    wide = spark.createDataFrame(
        [(1, "Alice", 101, "Math", "Dr. Smith", 90), (1, "Alice", 102, "Physics", "Dr. Jones", 85), (2, "Bob", 101, "Math", "Dr. Smith", 88)],
        "student_id int, student_name string, course_id int, course_name string, professor_name string, grade int",
    )
    parts = normalise.split_entities(wide, {
        "students": ["student_id", "student_name"],
        "courses": ["course_id", "course_name", "professor_name"],
        "enrolments": ["student_id", "course_id", "grade"],
    })
    back = normalise.rejoin([(parts["enrolments"], []), (parts["students"], ["student_id"]), (parts["courses"], ["course_id"])])
    assert normalise.is_lossless(wide, back)
    assert parts["courses"].count() == 2
    lect = spark.createDataFrame([(1, 1, "Math"), (2, 1, "Physics"), (3, 2, "Math")], "student_id int, lecturer int, course string")
    assert normalise.fd_violations(lect, ["lecturer"], "course").collect()[0].lecturer == 1


def test_managed_tables_by_name(spark):
    raw = _lab(spark)
    bronze = layers.publish(raw, "lab_bronze.orders")
    assert bronze.count() == 4
    silver = layers.publish(layers.to_silver(spark.table("lab_bronze.orders"), {"amount": "decimal(12,2)"}, ["order_id"]), "lab_silver.orders")
    spark.sql("USE lab_silver")
    gold = spark.sql("SELECT customer_id, SUM(amount) AS total FROM orders GROUP BY customer_id")
    assert {r.customer_id: float(r.total) for r in gold.collect()} == {"C01": 190.5, "C02": 25.0, "C03": 220.0}
    spark.sql("USE default")
    assert silver.count() == 4


def test_json_array_reader_long_strings_and_small_splits(spark):
    d = tempfile.mkdtemp(prefix="tessera-json-")
    text = ('say "x", \\ {[,]} ' * 8_000)[:100_000]
    items = [{"package_name": text}, {"package_name": "b" * 100_000}, {"package_name": "é,日,\n\\"}]
    _write(d, "long.json", "[" + ",\n,".join(json.dumps(i, ensure_ascii=i is items[0]) for i in items) + "]")
    for size in ("128m", "16k"):  # a file in one split, and in many
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        docs, bad = read_json_array(spark, d, SCHEMA)
        got = sorted((r.item_no, r.package_name) for r in docs.collect())
        assert got == [(i, x["package_name"]) for i, x in enumerate(items)] and bad.count() == 0
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_array_round_trip(spark):
    d = layers.lake_dir(spark, "arrays")
    docs = spark.createDataFrame([(i, None if i % 7 == 0 else "x,]" * i) for i in range(50)], "id long, t string")
    write_json_arrays(docs, d, 3)
    back, bad = read_json_array(spark, d, "id long, t string")
    assert sorted(map(str, back.select("id", "t").collect())) == sorted(map(str, docs.collect())) and bad.count() == 0


def _items(text):
    """(item_no, raw, reason) of one reader that gets the whole file."""
    reader, out = ArrayItems(), []
    fragments = [x for i, part in enumerate(text.split(",")) for x in reader.feed("," * (i > 0) + part)]
    for item, reason in fragments:
        if reason or item.strip(" \t\r\n"):
            out.append((None if reason else len(out), item.strip(" \t\r\n"), reason))
    left = reader.open_text()
    return out if left is None else [*out, (None, left.strip(" \t\r\n"), MALFORMED)]


def test_array_items_over_any_fragments():
    text = '\ufeff [ , {"a": "x\\"],{"}, [1, [2]],, 3 ,"s,]" ] junk'
    want = ['{"a": "x\\"],{"}', "[1, [2]]", "3", '"s,]"']
    assert _items(text) == [(i, x, None) for i, x in enumerate(want)]
    for size in (1, 2, 3, 7, 100):
        reader = ArrayItems()
        got = [x.strip() for i in range(0, len(text), size) for x, _ in reader.feed(text[i : i + size])]
        assert [x for x in got if x] == want and reader.open_text() is None


@given(st.text(alphabet='[]{}",\\ a\n', max_size=80), st.booleans(), st.integers(1, 4))
@settings(max_examples=400, deadline=None)
def test_split_states_follow_from_effects(text, in_array, per_split):
    """Borders inside strings, behind escapes, in broken nesting."""
    fragments = (("[" if in_array else "") + text).split(",")
    reader, state = ArrayItems(), State()
    for i in range(0, len(fragments), per_split):
        assert state.done == reader.done and (state.done or state == reader.state())
        body = ",".join(fragments[i : i + per_split])
        if i == 0:
            list(reader.feed(body))
            state = reader.state()
        else:
            list(reader.feed("," + body))
            outside, inside = Effect(False), Effect(True)
            outside.feed(body)
            inside.feed(body)
            state = after(state, outside, inside)


def test_json_arrays_read_from_all_splits(spark):
    """Small splits of many files, with an item longer than several of them,
    against one reader per file."""
    d, rnd, files = tempfile.mkdtemp(prefix="tessera-json-"), random.Random(11), {}
    for k in range(12):
        items = [json.dumps({"package_name": "".join(rnd.choice('ab,[]{}"\\ \n') for _ in range(rnd.choice([0, 3, 30, 200]))), "n": [1, {"x": i}]}) for i in range(rnd.randint(0, 8))]
        text = rnd.choice(["[", " [\n,"]) + rnd.choice([",", ",,", " ,\n"]).join(items) + rnd.choice(["]", ",]", "] x, y", "", ", [1, 2", "}]"])
        text = text if k % 4 else rnd.choice(["", "   ", "x" + text, " " * 200 + "," + text, "[" + '{"a": ' * 50 + "}" * 70 + ", 5]"])
        files[f"f{k}.json"] = text if k % 7 else "".join(c for c in text if rnd.random() < 0.97)  # damaged
    for name, text in files.items():
        _write(d, name, text)
    want = sorted((name, *row) for name, text in files.items() for row in map(lambda r: (str(r[0]), r[1], str(r[2])), _items(text)))
    for size in ("128m", "90"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = _numbered(_pieces(spark, d)).collect()
        assert sorted((os.path.basename(r.source_file), str(r.item_no), r.raw, str(r.reason)) for r in got) == want, size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(want) > 40 and len({w[3] for w in want}) == 3


def test_json_array_reader_ignores_content_after_the_array(spark):
    d = tempfile.mkdtemp(prefix="tessera-json-")
    _write(d, "two.json", '[{"package_name": "a"}]\n[{"package_name": "b"}]')
    docs, bad = read_json_array(spark, d, SCHEMA)
    assert [r.package_name for r in docs.collect()] == ["a"] and bad.count() == 0
