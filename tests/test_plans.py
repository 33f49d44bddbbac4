"""Plan-shape guardrails for scale: no pairings, no multi-distinct expand,
filters and column pruning reach the parquet scan, top-k stays top-k."""

import datetime as dt
from decimal import Decimal

import pytest

import __spark_entry__ as E
from ovenbird.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
OWN = [k for k in REGISTRY if not k.startswith("streamed_")]  # streams run while being built


def _plan(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(OWN))
def test_no_pairing_or_expand(spark, key):
    plan = _plan(spark, key)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
        assert bad not in plan, f"{key}: {bad}"


def test_date_filter_reaches_scan(spark):
    plan = _plan(spark, "daily_metrics")
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_column_pruning_on_lines(spark):
    plan = _plan(spark, "menu_profitability")
    line_scans = [l for l in plan.split("\n") if "lineitem" in l and "ReadSchema" in l]
    assert line_scans and all("l_shipdate" not in l and "l_returnflag" not in l for l in line_scans)


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "customer_top10")


def test_partner_and_month_prune_folders(spark):
    plan = _plan(spark, "partner_month_scan")
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "partner" in filters and "order_month" in filters


def test_external_scan_reads_other_folders_never(spark, scratch):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from ovenbird.sources import external
    rows = spark.createDataFrame([(1, "x", 10), (2, "y", 20), (3, "y", None), (4, None, 40)], "id bigint, p string, v int")
    external.land_objects(rows, f"{scratch}/stage", by={"partner": F.col("p")})
    scan = external.external_scan(
        spark, f"{scratch}/stage", T.StructType.fromDDL("id bigint, v int"), objects=True,
        partitions=T.StructType.fromDDL("partner string"), file_columns={"from_path": external.path_value("partner")})
    assert sorted(map(tuple, scan.filter("partner = 'y'").collect())) == [(2, 20, "y", "y"), (3, None, "y", "y")]
    assert [tuple(r)[:3] for r in scan.filter("partner IS NULL").collect()] == [(4, 40, None)]
    assert len(scan.filter("partner = 'y'").select("id", "from_path").collect()) == 2


def test_gold_items_in_partitions_by_lines(spark):
    from ovenbird.operators.partitions import TASK_ROWS, by_rows
    from ovenbird.plans import medallion
    assert by_rows(spark.range(3), 2 * TASK_ROWS + 1, "id").rdd.getNumPartitions() == 3
    assert by_rows(spark.range(0), 0, "id").rdd.getNumPartitions() == 1
    day, other = dt.date(2001, 1, 1), None
    items = spark.createDataFrame([(day, 1, 1, "a", 2, Decimal(4), 7), (day, 1, 1, "a", 3, Decimal(6), 7), (day, 1, 1, "a", None, None, 8),
                                   (other, 1, 1, "a", 1, Decimal(2), 9), (day, 1, 2, "b", 1, Decimal(1), 7)],
                                  "order_date date, location_id bigint, item_id bigint, item_name string, quantity int, "
                                  "line_total decimal(10,2), order_id bigint")
    locations = spark.createDataFrame([(1, "x")], "location_id bigint, location_name string")
    menu = spark.createDataFrame([(i, 1, Decimal(2), Decimal(1)) for i in (1, 2, 2)],
                                 "item_id bigint, category_id bigint, base_price decimal(8,2), cost_to_make decimal(8,2)")
    categories = spark.createDataFrame([(1, "c")], "category_id bigint, category_name string")
    plain, split = (medallion.gold_item_performance(items, locations, menu, categories, lines=n) for n in (None, 30 * TASK_ROWS))
    assert sorted(plain.collect(), key=str) == sorted(split.collect(), key=str) and plain.count() == 3
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_date" in plan and ", 30)" in plan


def test_gold_items_query_counts_its_lines(spark, monkeypatch):
    from ovenbird.plans import medallion
    asked = []
    monkeypatch.setattr(medallion, "by_rows", lambda df, rows, *keys: asked.append(rows) or df)
    E.queries()["gold_items"](spark, SF)
    assert asked == [spark.read.parquet(f"{SF}/lineitem.parquet").count()]


def test_colocated_payload_is_built_once(spark):
    assert _plan(spark, "colocated_silver_items").count("VariantExpressionEvalUtils.parseJson") == 1


def test_items_of_invalid_orders_are_left_out(spark):
    from ovenbird.plans import medallion
    texts = {"a": '{"order_id": 1, "total": 5, "items": [{"item_id": 7}]}', "b": '{"order_id": 2, "total": 0, "items": [{"item_id": 7}]}',
             "c": '{"total": 5, "items": [{"item_id": 7}]}', "d": '{"order_id": 4, "items": [{"item_id": 8}, {"item_id": 9}]}',
             "e": '{"order_id": 5, "total": 5, "items": {"item_id": 7}}', "f": '{"order_id": 6, "total": 5, "items": []}'}
    bronze = spark.createDataFrame(list(texts.items()), "event_id string, text string").selectExpr(
        "event_id", "timestamp_ntz '2001-01-01 00:00:00' AS event_timestamp", "'ORDER_PLACED' AS event_type",
        "'DT-001' AS location_code", "parse_json(text) AS payload", "'WEB_APP' AS source_system")
    got = medallion.silver_order_items(medallion.silver_orders(bronze)).select("event_id", "item_id", "item_sequence").collect()
    assert sorted(map(tuple, got)) == [("a", 7, 1), ("d", 8, 1), ("d", 9, 2)]


def test_order_texts_are_dealt_by_lines(spark, monkeypatch):
    from ovenbird.operators import partitions
    from ovenbird.plans import medallion
    asked = []
    monkeypatch.setattr(medallion, "by_rows", lambda df, rows, *keys, **more: asked.append(rows) or partitions.by_rows(
        df, rows, *keys, task_rows=100, **more))
    plan = _plan(spark, "order_json_faults")
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert asked == [rows]
    # Both sides of the join to the orders: one shuffle each, in partitions by rows.
    assert plan.count(f", {-(-rows // 100)})") == 2 and plan.count("Exchange hashpartitioning(order_id") == 2
