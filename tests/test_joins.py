"""Outer joins that split hot keys, and the order of sorted results."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators.joins import outer_join, without_match

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("how", ["left", "full"])
def test_outer_join_equals_the_native_one(spark, how):
    left = spark.createDataFrame([(i % 3 if i % 5 else None, i) for i in range(40)], "a int, x int")
    right = spark.createDataFrame([(i % 4 if i % 7 else None, i) for i in range(30)], "b int, y int")
    native = left.join(right, left.a == right.b, how)
    got = outer_join(left, right, ["a"], ["b"], how)
    assert sorted(map(str, got.collect())) == sorted(map(str, native.collect()))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("how", ["left", "full"])
def test_outer_join_without_broadcast_equals_the_native_one(spark, no_broadcast, how):
    left = spark.createDataFrame([(i % 3 if i % 5 else None, i % 2, i // 2) for i in range(40)], "a int, c int, x int")
    right = spark.createDataFrame([(i % 4 if i % 7 else None, i % 3, i // 2) for i in range(30)], "b int, d int, y int")
    native = left.join(right, (left.a == right.b) & (left.c == right.d), how)
    got = outer_join(left, right, ["a", "c"], ["b", "d"], how)
    assert sorted(map(str, got.collect())) == sorted(map(str, native.collect()))


def test_unmatched_rows_are_found_by_as_many_tasks_as_set(spark, no_broadcast):
    """Keys shrink in a shuffle: merged by their bytes, they fill few tasks' memory."""
    left, right = spark.range(4000).toDF("a"), spark.range(0, 8000, 2).toDF("b")
    only = outer_join(left, right, ["a"], ["b"], "left").filter("b IS NULL")
    assert only.count() == 2000
    assert only.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_unmatched_rows_with_keys_of_two_types(spark, no_broadcast):
    left, right = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a int"), spark.createDataFrame([(1,), (3,), (None,)], "b bigint")
    assert sorted(str(r.a) for r in without_match(left, right, ["a"], ["b"]).collect()) == ["2", "2", "None"]


ORDERED = {
    "q_star_region": lambda r: (r.region, -r.store_revenue, r.store_name),
    "q_star_margin": lambda r: (-r.total_revenue, r.department, r.category),
    "q_star_month": lambda r: (r.calendar_year, r.month_num),
    "q_expand_bounded": lambda r: (r.depth, r.id),
    "q_row_counts": lambda r: r.table_name,
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("key", sorted(ORDERED))
def test_sorted_results_come_in_order(spark, key):
    rows = E.queries()[key](spark, SF).collect()
    assert rows == sorted(rows, key=ORDERED[key]) and len(rows) > 1
