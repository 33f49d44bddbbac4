"""Facts stored in buckets of their join key: rows, appends, hot keys, plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ovenbird.sources import layout

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def facts(spark):
    left = spark.range(200).select("id", (F.col("id") * 2).alias("a"))
    right = spark.range(600).select((F.col("id") % 210).alias("id"), F.col("id").alias("b"))
    yield left, right
    for name in ("t_left", "t_right"):
        layout.drop(spark, name)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_and_grouping_without_exchange(spark, facts, no_broadcast):
    left, right = facts
    a = layout.store(left, "t_left", "id", 6, max_key_rows=None)
    b = layout.store(right, "t_right", "id", 6)
    assert layout.bucket_count(spark, "t_right") == 6
    joined = a.join(b.groupBy("id").agg(F.sum("b").alias("s")), "id", "left")
    assert "Exchange" not in _plan(joined)
    assert _rows(joined.select("id", "a", "s")) == _rows(
        left.join(right.groupBy("id").agg(F.sum("b").alias("s")), "id", "left").select("id", "a", "s"))


def test_append_keeps_buckets(spark, facts, no_broadcast):
    left, right = facts
    layout.store(right.filter("b < 300"), "t_right", "id", 6)
    layout.append(right.filter("b >= 300").select("b", "id"), "t_right", "id")  # columns by name
    a, b = layout.store(left, "t_left", "id", 6), spark.table("t_right")
    assert "Exchange" not in _plan(a.join(b, "id"))
    assert _rows(a.join(b, "id").select("id", "a", "b")) == _rows(left.join(right, "id").select("id", "a", "b"))


def test_hot_key_and_odd_rows(spark, facts):
    _, right = facts
    hot = right.withColumn("id", F.when(F.col("b") % 3 > 0, F.col("id")))  # a third has no key
    t = layout.store(hot, "t_right", "id", 6, max_key_rows=100)
    assert layout.bucket_count(spark, "t_right") == 0  # left to the planner
    layout.append(hot, "t_right", "id")
    assert _rows(t.sparkSession.table("t_right").fillna(-1)) == _rows(hot.unionByName(hot).fillna(-1))
    empty = layout.store(right.limit(0), "t_right", "id", 6)
    assert layout.bucket_count(spark, "t_right") == 6 and empty.count() == 0


def test_a_table_replaces_itself(spark, facts):
    _, right = facts
    layout.store(right, "t_right", "id", 6)
    out = layout.store(spark.table("t_right").filter("id < 5"), "t_right", "id", 3)
    assert layout.bucket_count(spark, "t_right") == 3
    assert _rows(out) == _rows(right.filter("id < 5"))


def test_order_facts_are_not_shuffled(spark, no_broadcast):
    assert "Exchange" not in _plan(E.queries()["colocated_silver_items"](spark, SF))
    plan = _plan(E.queries()["colocated_order_analytics"](spark, SF))
    assert "Exchange" in plan and "hashpartitioning(order_id" not in plan
    assert "hashpartitioning(order_id" in _plan(E.queries()["order_analytics"](spark, SF))
