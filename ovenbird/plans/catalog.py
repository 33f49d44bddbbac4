"""Registered queries: each callable takes ``(spark, sf_dir)`` and returns a
DataFrame over the driver's tables, with the parameters fixed in the survey.

Output columns are normalised for comparison: DECIMAL → double, small
integers → bigint.  Run-time columns (uuids, refresh times) are not returned.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql import types as T

from ..functions import timefn
from ..functions.variant import json_text, object_of
from ..operators import changes
from ..operators.ranking import surrogate_ids
from ..session import stored_steps, work_dir
from ..sources import external, layout, schemas, tables
from ..sources.star import AS_OF_ORDERS, Star
from ..streaming import feeds, keyed
from ..streaming.incremental import IncrementalAnomalies, IncrementalMedallion, IncrementalViews
from . import analytics, change_jobs, jobs, medallion, messages, quality, views

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ----------------------------------------------------------------- views
@register("daily_metrics")
def q_daily_metrics(spark, sf_dir):
    s = Star(spark, sf_dir)
    since = AS_OF_ORDERS - dt.timedelta(days=30)
    return normalise(views.daily_metrics(s.fact_order(since=since), AS_OF_ORDERS, 30))


@register("session_daily_metrics")
def q_session_daily_metrics(spark, sf_dir):
    """The daily metrics under a session-scoped name."""
    return tables.session_table(q_daily_metrics(spark, sf_dir), "session_daily_metrics")


@register("order_analytics")
def q_order_analytics(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(views.order_analytics(s.fact_order(), s.fact_order_item(), s.dim_location(),
                                           s.dim_customer(), fanout=True))


@register("order_analytics_header_grain")
def q_order_analytics_header(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(views.order_analytics(s.fact_order(), s.fact_order_item(), s.dim_location(),
                                           s.dim_customer(), fanout=False))


def _colocated(spark, s: Star) -> tuple[DataFrame, DataFrame]:
    """Orders and their lines (with item names), stored in buckets of the order id."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag = uuid.uuid4().hex
    lines = medallion.named_lines(s.fact_order_item(), s.dim_menu_item(with_category=False))
    return (layout.store(s.fact_order(), f"orders_by_id_{tag}", "order_id", buckets, max_key_rows=None),
            layout.store(lines, f"lines_by_order_{tag}", "order_id", buckets))


@register("colocated_order_analytics")
def q_colocated_order_analytics(spark, sf_dir):
    """The order analytics over stored co-located facts: lines are not shuffled."""
    s = Star(spark, sf_dir)
    orders, lines = _colocated(spark, s)
    return normalise(views.order_analytics(orders, lines, s.dim_location(), s.dim_customer(), fanout=True))


@register("colocated_silver_items")
def q_colocated_silver_items(spark, sf_dir):
    """The silver items of events built from co-located facts, without an exchange."""
    orders, lines = _colocated(spark, Star(spark, sf_dir))
    bronze = medallion.bronze_events(orders, lines, None)
    return normalise(medallion.silver_order_items(medallion.silver_orders(bronze)))


@register("order_status_board")
def q_order_status_board(spark, sf_dir):
    s = Star(spark, sf_dir)
    since = AS_OF_ORDERS - dt.timedelta(days=30)
    return normalise(views.order_status_board(s.fact_order(since=since), AS_OF_ORDERS, days=30))


@register("kitchen_queue")
def q_kitchen_queue(spark, sf_dir):
    s = Star(spark, sf_dir)
    since = AS_OF_ORDERS - dt.timedelta(days=30)
    board = views.order_status_board(s.fact_order(since=since), AS_OF_ORDERS, days=30)
    return normalise(views.kitchen_queue(board, location_id=1))


KEY_LOOKUP_ORDER = 1


@register("key_lookup")
def q_key_lookup(spark, sf_dir):
    """Point lookup on the status board of all orders."""
    board = views.order_status_board(Star(spark, sf_dir).fact_order(), AS_OF_ORDERS, days=None)
    return normalise(views.lookup_order(board, KEY_LOOKUP_ORDER))


@register("typed_orders")
def q_typed_orders(spark, sf_dir):
    """All orders in the declared columns and types."""
    return normalise(schemas.conform(Star(spark, sf_dir).fact_order(), schemas.FACT_ORDER))


@register("typed_customers")
def q_typed_customers(spark, sf_dir):
    return normalise(schemas.conform(Star(spark, sf_dir).dim_customer(), schemas.DIM_CUSTOMER))


@register("menu_profitability")
def q_menu_profitability(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(views.menu_profitability(s.dim_menu_item(), s.dim_category(), s.fact_order_item()))


@register("customer_metrics")
def q_customer_metrics(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(views.customer_metrics(s.dim_customer(), s.fact_order(), AS_OF_ORDERS))


@register("customer_top10")
def q_customer_top10(spark, sf_dir):
    s = Star(spark, sf_dir)
    m = views.customer_metrics(s.dim_customer(), s.fact_order(), AS_OF_ORDERS)
    return normalise(views.top_by(m, "lifetime_value", 10, "customer_id"))


@register("franchise_performance")
def q_franchise_performance(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(views.franchise_performance(s.fact_order(), s.dim_location(),
                                                  s.fact_review(with_text=False)))


@register("restricted_orders")
def q_restricted_orders(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(views.restricted_orders(s.fact_order(), s.dim_location(), role="ANALYST",
                                             location_id=1))


@register("hourly_sales")
def q_hourly_sales(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(views.hourly_sales(s.fact_order()))


# -------------------------------------------------------------- medallion

def _layers(spark, sf_dir):
    s = Star(spark, sf_dir)
    bronze = medallion.bronze_events(s.fact_order(), s.fact_order_item(), s.dim_menu_item(with_category=False))
    silver = medallion.silver_orders(bronze)
    return s, bronze, silver


@register("bronze_payload")
def q_bronze(spark, sf_dir):
    _, bronze, _ = _layers(spark, sf_dir)
    return normalise(bronze.withColumn("payload", json_text("payload")))


@register("silver_orders")
def q_silver_orders(spark, sf_dir):
    _, _, silver = _layers(spark, sf_dir)
    return normalise(silver.withColumn("order_items", json_text("order_items")))


@register("silver_items")
def q_silver_items(spark, sf_dir):
    _, _, silver = _layers(spark, sf_dir)
    return normalise(medallion.silver_order_items(silver))


@register("gold_daily")
def q_gold_daily(spark, sf_dir):
    s, _, silver = _layers(spark, sf_dir)
    return normalise(medallion.gold_daily_sales(silver, s.dim_location(), timefn.ts_lit(AS_OF_ORDERS)))


@register("gold_hourly")
def q_gold_hourly(spark, sf_dir):
    s, _, silver = _layers(spark, sf_dir)
    return normalise(medallion.gold_hourly_sales(silver, s.dim_location()))


def _gold_items(spark, sf_dir):
    s, _, silver = _layers(spark, sf_dir)
    return medallion.gold_item_performance(medallion.silver_order_items(silver), s.dim_location(),
                                           s.dim_menu_item(), s.dim_category(), lines=s.raw("lineitem").count())


@register("gold_items")
def q_gold_items(spark, sf_dir):
    return normalise(_gold_items(spark, sf_dir))


@register("gold_customers")
def q_gold_customers(spark, sf_dir):
    s, _, silver = _layers(spark, sf_dir)
    return normalise(medallion.gold_customer_activity(silver, s.dim_customer()))


@register("dash_daily")
def q_dash_daily(spark, sf_dir):
    s, _, silver = _layers(spark, sf_dir)
    return normalise(medallion.dash_daily(medallion.gold_daily_sales(silver, s.dim_location())))


def _silver_of(s: Star, orders: DataFrame) -> DataFrame:
    """Silver orders built from these orders and their lines only."""
    items = s.fact_order_item().join(orders.select("order_id"), "order_id", "left_semi")
    return medallion.silver_orders(medallion.bronze_events(orders, items, s.dim_menu_item(with_category=False)))


def _on_latest_day(orders: DataFrame, of: DataFrame) -> DataFrame:
    """The orders of the last day on which ``of`` has a valid order."""
    valid = of.filter(F.col("total_amount").isNull() | (F.col("total_amount") > 0))
    last = valid.agg(F.max(timefn.to_day("order_timestamp")).alias("last_day"))
    return orders.join(F.broadcast(last), timefn.to_day("order_timestamp") == F.col("last_day"), "left_semi")


@register("dash_hour")
def q_dash_hour(spark, sf_dir):
    s = Star(spark, sf_dir)
    orders = s.fact_order()
    silver = _silver_of(s, _on_latest_day(orders, orders))
    return normalise(medallion.dash_current_hour_at_latest(silver, s.dim_location()))


@register("dash_top_items")
def q_dash_top_items(spark, sf_dir):
    s = Star(spark, sf_dir)
    orders = s.fact_order()
    with_lines = orders.join(s.fact_order_item().select("order_id"), "order_id", "left_semi")
    silver = _silver_of(s, _on_latest_day(orders, with_lines))
    return normalise(medallion.dash_top_items_at_latest(medallion.silver_order_items(silver), s.dim_location(),
                                                        s.dim_menu_item(), s.dim_category(), 10))


@register("dash_vip")
def q_dash_vip(spark, sf_dir):
    s, _, silver = _layers(spark, sf_dir)
    return normalise(medallion.dash_vip(medallion.gold_customer_activity(silver, s.dim_customer())))


# ------------------------------------------------------------------- jobs

MERGE_WINDOW_START = AS_OF_ORDERS - dt.timedelta(days=30)
TARGET_START = AS_OF_ORDERS - dt.timedelta(days=60)
TARGET_END = AS_OF_ORDERS - dt.timedelta(days=15)
SALES_DATE = AS_OF_ORDERS - dt.timedelta(days=1)
CHANGE_T0 = dt.datetime(2001, 1, 1)
CHANGE_T1 = dt.datetime(2001, 8, 1, 12, 0)
INVENTORY_BATCH_START = dt.date(2001, 1, 1)


def _daily_sales_target(s: Star) -> DataFrame:
    """An existing daily-sales table: an earlier partial load (completed
    orders only) of [t-60 d, t-15 d) with a weather value filled in."""
    o = jobs.orders_between(s.fact_order(since=TARGET_START, until=TARGET_END), TARGET_START, TARGET_END)
    o = o.filter(F.col("order_status") == "COMPLETED")
    return jobs.daily_sales_source(o, s.fact_order_item(), s.dim_customer(), few_orders=True).withColumn(
        "weather_condition", F.lit("CLEAR"))


def _daily_sales_update(s: Star) -> DataFrame:
    src_orders = jobs.orders_between(s.fact_order(since=MERGE_WINDOW_START, until=AS_OF_ORDERS),
                                     MERGE_WINDOW_START, AS_OF_ORDERS)
    return jobs.daily_sales_source(src_orders, s.fact_order_item(), s.dim_customer(), few_orders=True)


def _merged_daily_sales(s: Star) -> DataFrame:
    return jobs.daily_sales_merge(_daily_sales_target(s), _daily_sales_update(s))


@register("stored_daily_sales")
def q_stored_daily_sales(spark, sf_dir):
    """The upsert on a stored table: only the touched dates are rewritten."""
    s = Star(spark, sf_dir)
    base = work_dir(spark, f"daily-sales-{uuid.uuid4().hex}")
    declared = schemas.FACT_DAILY_SALES
    tables.append_rows(schemas.conform(_daily_sales_target(s), declared), f"{base}/table", ["sales_date"])
    jobs.upsert_daily_sales(schemas.conform(_daily_sales_update(s), declared), f"{base}/table", f"{base}/staging")
    return normalise(spark.read.schema(declared).parquet(f"{base}/table").select(*declared.names))


@register("daily_sales_merge")
def q_daily_sales_merge(spark, sf_dir):
    return normalise(_merged_daily_sales(Star(spark, sf_dir)))


@register("daily_sales_all_locations")
def q_daily_sales_all_locations(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(jobs.daily_sales_all_locations(
        s.fact_order(since=SALES_DATE, until=SALES_DATE + dt.timedelta(days=1)), s.dim_location(),
        _merged_daily_sales(s), SALES_DATE))


@register("weekly_wow")
def q_weekly_wow(spark, sf_dir):
    s = Star(spark, sf_dir)
    recent = s.fact_order(since=AS_OF_ORDERS - dt.timedelta(weeks=8))
    daily = jobs.daily_sales_source(recent, s.fact_order_item(), s.dim_customer(), few_orders=True)
    return normalise(jobs.weekly_report(daily, s.dim_location(), AS_OF_ORDERS, 8))


@register("retention_logs")
def q_retention_logs(spark, sf_dir):
    s = Star(spark, sf_dir)
    log = jobs.order_log(changes.insert_feed(s.fact_order()), F.col("order_timestamp"))
    return normalise(jobs.purge_order_log(log, AS_OF_ORDERS, 30))


def _alert_table(s: Star) -> DataFrame:
    """Alert table of every inventory image at or below its reorder point,
    created at the record date; alerts with 10 or more on hand count as
    resolved a week later."""
    alerts = change_jobs.inventory_alerts(changes.insert_feed(s.fact_inventory()), s.dim_ingredient(), None)
    created = F.col("record_date").cast("timestamp_ntz")
    resolved = F.col("current_quantity") >= 10
    return alerts.select(
        "location_id", "ingredient_id", "ingredient_name", "current_quantity", "reorder_point", "alert_type",
        F.when(resolved, "RESOLVED").otherwise("OPEN").alias("alert_status"),
        created.alias("created_at"),
        F.when(resolved, created + F.expr("INTERVAL 7 DAYS")).alias("resolved_at"))


@register("retention_alerts")
def q_retention_alerts(spark, sf_dir):
    return normalise(jobs.purge_alerts(_alert_table(Star(spark, sf_dir)), AS_OF_ORDERS, 90))


def _customer_changes(s: Star) -> DataFrame:
    return changes.snapshot_diff(s.dim_customer("before"), s.dim_customer("after"), ["customer_id"])


@register("change_feed")
def q_change_feed(spark, sf_dir):
    return normalise(_customer_changes(Star(spark, sf_dir)))


@register("customer_history")
def q_customer_history(spark, sf_dir):
    return normalise(change_jobs.customer_history(_customer_changes(Star(spark, sf_dir))))


@register("as_of_snapshot")
def q_as_of_snapshot(spark, sf_dir):
    """Replay: the before snapshot loaded at T0, the diff applied at T1; the
    table as of T1 must equal the after snapshot."""
    s = Star(spark, sf_dir)
    initial = changes.insert_feed(s.dim_customer("before")).withColumn("_changed_at", timefn.ts_lit(CHANGE_T0))
    diff = _customer_changes(s).drop(changes.ROW_ID).withColumn("_changed_at", timefn.ts_lit(CHANGE_T1))
    history = initial.unionByName(diff)
    return normalise(changes.as_of(history, ["customer_id"], "_changed_at", timefn.ts_lit(CHANGE_T1)))


@register("inventory_alerts")
def q_inventory_alerts(spark, sf_dir):
    s = Star(spark, sf_dir)
    prior = s.fact_inventory().filter(F.col("record_date") < timefn.date_lit(INVENTORY_BATCH_START))
    open_alerts = change_jobs.inventory_alerts(changes.insert_feed(prior), s.dim_ingredient(), None)
    batch = changes.insert_feed(s.fact_inventory(since=INVENTORY_BATCH_START))
    return normalise(change_jobs.inventory_alerts(batch, s.dim_ingredient(), open_alerts).drop("record_date"))


@register("sentiment_labels")
def q_sentiment_labels(spark, sf_dir):
    return normalise(change_jobs.sentiment_labels(Star(spark, sf_dir).fact_review()))


def _loyalty(s: Star) -> DataFrame:
    """The whole order history replayed as one batch of order totals."""
    batch = s.fact_order().select("customer_id", F.col("total_amount").alias("order_total"))
    return jobs.loyalty_update(s.dim_customer(), batch)


@register("sentiment_mixed")
def q_sentiment_mixed(spark, sf_dir):
    """Labels of reviews with words of praise or blame added to their texts."""
    k = F.col("review_id") % 3
    words = F.when(k == 0, " terrible and cold, awful").when(k == 1, " great, delicious").otherwise("")
    reviews = Star(spark, sf_dir).fact_review().withColumn("review_text", F.concat("review_text", words))
    return normalise(change_jobs.sentiment_labels(reviews))


@register("loyalty_batch")
def q_loyalty_batch(spark, sf_dir):
    return normalise(_loyalty(Star(spark, sf_dir)))


@register("keyed_update")
def q_keyed_update(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(jobs.apply_loyalty(s.dim_customer(), _loyalty(s)))


@register("promotion_offers")
def q_promotion_offers(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(jobs.promotion_offers(spark, s.dim_customer(), s.fact_order(), AS_OF_ORDERS,
                                           AS_OF_ORDERS + dt.timedelta(days=30), 20, AS_OF_ORDERS))


# -------------------------------------------------------------- analytics

RECOMMEND_FOR_CUSTOMER = 5


@register("rfm_segments")
def q_rfm_segments(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(analytics.rfm_segments(s.dim_customer(), s.fact_order(), AS_OF_ORDERS))


@register("sales_anomalies")
def q_sales_anomalies(spark, sf_dir):
    s = Star(spark, sf_dir)
    daily = jobs.daily_sales_source(s.fact_order(), s.fact_order_item(), s.dim_customer())
    return normalise(analytics.sales_anomalies(daily, s.dim_location(), AS_OF_ORDERS, None, 2.0))


@register("recommendations")
def q_recommendations(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(analytics.recommend_items(s.fact_order(), s.fact_order_item(), s.dim_menu_item(),
                                               s.dim_category(), s.fact_review(with_text=False),
                                               RECOMMEND_FOR_CUSTOMER, 5))


def _recommend(s: Star, customer_id: int, n: int | None) -> DataFrame:
    return normalise(analytics.recommend_items(s.fact_order(), s.fact_order_item(), s.dim_menu_item(), s.dim_category(),
                                               s.fact_review(with_text=False), customer_id, n))


@register("recommendations_all")
def q_recommendations_all(spark, sf_dir):
    """Every candidate of the customer, so every kind of reason."""
    return _recommend(Star(spark, sf_dir), RECOMMEND_FOR_CUSTOMER, None)


@register("recommendations_fallback")
def q_recommendations_fallback(spark, sf_dir):
    """A customer without orders gets the fallback items."""
    return _recommend(Star(spark, sf_dir), 0, 5)


@register("dq_faults")
def q_dq_faults(spark, sf_dir):
    """The checks on orders with missing rows, customers and negative totals."""
    s = Star(spark, sf_dir)
    key = F.col("order_id")
    orders = s.fact_order().filter(key % 10 != 3).withColumns({
        "customer_id": F.when(key % 11 != 5, F.col("customer_id")),
        "total_amount": F.when(key % 7 == 2, -F.col("total_amount")).otherwise(F.col("total_amount"))})
    return normalise(quality.run_quality_checks(orders, s.fact_order_item(), s.fact_review(with_text=False),
                                                s.dim_customer()))


@register("dq_checks")
def q_dq_checks(spark, sf_dir):
    s = Star(spark, sf_dir)
    return normalise(quality.run_quality_checks(s.fact_order(), s.fact_order_item(),
                                                s.fact_review(with_text=False), s.dim_customer()))


# --------------------------------------------------------------- messages


def _json_inputs(spark, sf_dir) -> DataFrame:
    """Order JSON texts to validate: every bronze payload plus the event
    property texts (objects without order fields)."""
    s = Star(spark, sf_dir)
    bronze = medallion.bronze_events(s.fact_order(), s.fact_order_item(), s.dim_menu_item(with_category=False),
                                     lines=s.raw("lineitem").count())
    payloads = bronze.select(F.lit("bronze").alias("source"),
                             F.variant_get("payload", "$.order_id", "bigint").alias("record_id"),
                             json_text("payload").alias("order_json"))
    props = s.raw("events").select(F.lit("events").alias("source"), F.col("event_id").alias("record_id"),
                                   F.col("props").alias("order_json"))
    return payloads.unionByName(props)


@register("order_json_validation")
def q_order_json_validation(spark, sf_dir):
    v = messages.validate_orders(_json_inputs(spark, sf_dir), "order_json")
    return normalise(v.select("source", "record_id", "is_valid",
                              F.array_join("errors", " | ").alias("errors"),
                              F.size("errors").cast("bigint").alias("error_count"),
                              "parsed_order", "subtotal", "tax", "total"))


@register("order_json_faults")
def q_order_json_faults(spark, sf_dir):
    """Validation of order texts with one fault each, by order key."""
    inputs = _json_inputs(spark, sf_dir).filter(F.col("source") == "bronze")
    text, kind = F.col("order_json"), F.col("record_id") % 8
    change = lambda a, b: F.replace(text, F.lit(a), F.lit(b))
    faults = [change('"quantity":', '"quantity":-'), change('"items":[', '"items":[],"old":['),
              change('"order_type":"', '"order_type":"X'), F.expr("left(order_json, length(order_json) - 1)"),
              change('"customer_id":', '"customer":'), change('"items":[', '"items":[null,'),
              change('"item_id":', '"item":')]
    faulty = F.lit("null")
    for k, fault in enumerate(faults):
        faulty = F.when(kind == k, fault).otherwise(faulty)
    v = messages.validate_orders(inputs.withColumn("order_json", faulty), "order_json")
    return normalise(v.select("source", "record_id", "is_valid", F.array_join("errors", " | ").alias("errors"),
                              F.size("errors").cast("bigint").alias("error_count")))


@register("email_unknown")
def q_email_unknown(spark, sf_dir):
    """E-mail requests of which half name a customer that doesn't exist."""
    s = Star(spark, sf_dir)
    cust = s.dim_customer()
    requests = messages.all_customer_requests(cust, ["WELCOME"]).withColumn(
        "customer_id", F.col("customer_id") + F.when(F.col("customer_id") % 2 == 0, 1_000_000_000).otherwise(0))
    return normalise(messages.email_content(cust, s.fact_order(), requests))


@register("email_content")
def q_email_content(spark, sf_dir):
    s = Star(spark, sf_dir)
    cust = s.dim_customer()
    requests = messages.all_customer_requests(cust, messages.EMAIL_TYPES + ["BIRTHDAY"])
    return normalise(messages.email_content(cust, s.fact_order(), requests))


@register("staged_orders")
def q_staged_orders(spark, sf_dir):
    return normalise(messages.staged_online_orders(Star(spark, sf_dir).dim_customer()))


# ----------------------------------------------------- sources and audit


@register("customer_360")
def q_customer_360(spark, sf_dir):
    s = Star(spark, sf_dir)
    seg = analytics.rfm_segments(s.dim_customer(), s.fact_order(), AS_OF_ORDERS)
    return normalise(analytics.customer_360(s.dim_customer(), s.fact_order(), s.fact_order_item(),
                                            s.dim_menu_item(), s.fact_review(with_text=False), seg, AS_OF_ORDERS))


def append_audit(events: DataFrame) -> DataFrame:
    """Audit rows for a batch of (event_type, table_name, record_id, details):
    stamped with the run time, the user and the application id."""
    spark = events.sparkSession
    return events.select(
        F.current_timestamp().cast("timestamp_ntz").alias("event_timestamp"), "event_type", "table_name",
        "record_id", F.expr("current_user()").alias("user_name"),
        F.lit(spark.sparkContext.applicationId).alias("session_id"), "details")


@register("audit_batch")
def q_audit_batch(spark, sf_dir):
    """Audit events of the loyalty batch; run-context columns are left out of
    the compared result."""
    s = Star(spark, sf_dir)
    upd = _loyalty(s)
    ev = upd.select(F.lit("LOYALTY_UPDATE").alias("event_type"), F.lit("DIM_CUSTOMER").alias("table_name"),
                    F.col("customer_id").alias("record_id"),
                    json_text(object_of(points_before=F.col("points_before"), points_earned=F.col("points_earned"),
                                        points_after=F.col("points_after"), loyalty_tier=F.col("loyalty_tier")))
                    .alias("details"))
    return normalise(append_audit(ev).select("event_type", "table_name", "record_id", "details"))


@register("audit_user")
def q_audit_user(spark, sf_dir):
    """Audit rows name the user and the session that wrote them."""
    ev = Star(spark, sf_dir).dim_customer().select(
        F.lit("CHECK").alias("event_type"), F.lit("DIM_CUSTOMER").alias("table_name"),
        F.col("customer_id").alias("record_id"), F.lit(None).cast("string").alias("details"))
    return append_audit(ev).select(
        "event_type", "record_id", (F.col("user_name") == F.lit(spark.sparkContext.sparkUser())).alias("by_user"),
        (F.col("session_id") == F.lit(spark.sparkContext.applicationId)).alias("in_session"),
        (F.col("event_timestamp") <= F.current_timestamp().cast("timestamp_ntz")).alias("stamped"))


@register("defaults_on_insert")
def q_defaults_on_insert(spark, sf_dir):
    """Customers inserted without the columns that have defaults; a column that is
    given keeps its values, NULLs included."""
    rows = Star(spark, sf_dir).dim_customer().select("customer_id", "first_name", "email")
    defaults = {"email": F.lit("none"), "loyalty_points": F.lit(0), "registration_date": timefn.date_lit(AS_OF_ORDERS)}
    return _stored(spark, "defaults", normalise(tables.apply_defaults(rows, defaults)), tables.append_rows)


def _stored(spark, name: str, df: DataFrame, write) -> DataFrame:
    """A result written with one of the table sinks and read back."""
    path = work_dir(spark, f"{name}-{uuid.uuid4().hex}")
    write(df, path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


@register("stored_order_analytics")
def q_stored_order_analytics(spark, sf_dir):
    """Order analytics appended to a table partitioned by ``partition_month``."""
    return _stored(spark, "order-analytics", q_order_analytics(spark, sf_dir),
                   lambda df, path: tables.append_rows(df, path, ["partition_month"]))


@register("stored_weekly_report")
def q_stored_weekly_report(spark, sf_dir):
    """The weekly report, replaced as a whole on every run."""
    def twice(df, path):
        tables.replace_table(df.limit(0), path)
        tables.replace_table(df, path)
    return _stored(spark, "weekly-report", q_weekly_wow(spark, sf_dir), twice)


@register("stored_staged_orders")
def q_stored_staged_orders(spark, sf_dir):
    return _stored(spark, "staged-orders", q_staged_orders(spark, sf_dir), tables.append_rows)


@register("stored_audit")
def q_stored_audit(spark, sf_dir):
    return _stored(spark, "audit", q_audit_batch(spark, sf_dir), tables.append_rows)


def _stage_base(spark) -> str:
    return work_dir(spark, f"stage-{uuid.uuid4().hex}")


def _partner_a_rows(s: Star) -> DataFrame:
    o = s.fact_order().filter(F.col("order_type") == "DELIVERY")
    c = s.dim_customer().select("customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"))
    return o.join(c, "customer_id", "left").select(
        F.concat(F.lit("DD-"), F.col("order_id").cast("string")).alias("order_id"),
        F.concat(F.lit("LOC-"), F.col("location_id").cast("string")).alias("restaurant_id"),
        "customer_name", F.col("total_amount").alias("order_total"),
        (F.lit(2.99).cast("decimal(8,2)") + (F.col("order_id") % 3).cast("decimal(8,2)")).cast("decimal(8,2)")
        .alias("delivery_fee"),
        F.col("tip_amount").cast("decimal(8,2)").alias("tip_amount"),
        F.col("order_timestamp").alias("order_placed_at"),
        (F.col("actual_ready_time") + F.expr("INTERVAL 25 MINUTES")).alias("delivered_at"),
        (F.col("order_id") % 5 + 1).cast("int").alias("driver_rating"))


@register("partner_a_scan")
def q_partner_a_scan(spark, sf_dir):
    """Land partner A files (delivery orders) in the stage and scan them
    through the typed external-table projection."""
    path = external.stage_path(_stage_base(spark), "doordash")
    external.land_objects(_partner_a_rows(Star(spark, sf_dir)), path)
    return normalise(external.external_scan(spark, path, schemas.PARTNER_A, objects=True))


def _partner_b_rows(s: Star) -> DataFrame:
    o = s.fact_order().filter(F.col("order_type") == "PICKUP")
    lines = s.fact_order_item().join(s.dim_menu_item().select("item_id", F.col("item_name").alias("name")), "item_id")
    arr = lines.groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct("item_id", "name", "quantity"))).alias("items"))
    return o.join(arr, "order_id", "left").select(
        F.concat(F.lit("UE-"), F.col("order_id").cast("string")).alias("uber_order_id"),
        F.concat(F.lit("M"), F.col("location_id").cast("string")).alias("merchant_id"),
        "items", F.col("subtotal"),
        F.round(F.col("subtotal") * F.lit(0.05).cast("decimal(3,2)"), 2).cast("decimal(8,2)").alias("service_fee"),
        F.lit(0).cast("decimal(8,2)").alias("delivery_fee"),
        F.col("order_timestamp").alias("created_at"))


@register("partner_b_scan")
def q_partner_b_scan(spark, sf_dir):
    path = external.stage_path(_stage_base(spark), "ubereats")
    external.land_objects(_partner_b_rows(Star(spark, sf_dir)), path)
    scan = external.external_scan(spark, path, schemas.PARTNER_B, objects=True)
    arr = F.try_variant_get("items", "$", "array<variant>")
    return normalise(scan.withColumn("item_count", F.when(arr.isNotNull(), F.size(arr)))
                     .withColumn("items", json_text("items")))


STAGE_FOLDERS = StructType([StructField("partner", StringType()), StructField("order_month", StringType())])


@register("partner_month_scan")
def q_partner_month_scan(spark, sf_dir):
    """Both partners land in one stage, in folders by partner and month; partner A's
    orders of 1997 are scanned, other folders are left out.  The month is that of the
    file's path."""
    s, base = Star(spark, sf_dir), _stage_base(spark)
    for partner, rows, at in (("a", _partner_a_rows(s), "order_placed_at"), ("b", _partner_b_rows(s), "created_at")):
        external.land_objects(rows, base, by={"partner": F.lit(partner), "order_month": F.date_format(at, "yyyy-MM")})
    scan = external.external_scan(spark, base, schemas.PARTNER_A, objects=True, partitions=STAGE_FOLDERS,
                                  file_columns={"file_month": external.path_value("order_month")})
    return normalise(scan.filter((F.col("partner") == "a") & F.col("order_month").between("1997-01", "1997-12"))
                     .select("order_id", "restaurant_id", "order_total", "order_placed_at", "partner", "file_month"))


# -------------------------------------------------------------- streaming

FEED_SPLIT = dt.datetime(2001, 1, 1)


def _order_feed(spark, sf_dir, job=None) -> feeds.AppendFeed:
    """Orders land in two drops; the feed is created after the first drop
    (its rows are skipped) and consumes the second."""
    s = Star(spark, sf_dir)
    base = work_dir(spark, f"feed-{uuid.uuid4().hex}")
    landing = os.path.join(base, "landing")
    orders = s.fact_order()
    feeds.land(orders.filter(F.col("order_timestamp") < timefn.ts_lit(FEED_SPLIT)), landing)
    feed = feeds.AppendFeed(spark, landing, os.path.join(base, "state"), orders.schema, job)
    feed.prime()
    feeds.land(orders.filter(F.col("order_timestamp") >= timefn.ts_lit(FEED_SPLIT)), landing)
    return feed


@register("append_feed")
def q_append_feed(spark, sf_dir):
    feed = _order_feed(spark, sf_dir)
    feed.consume()
    return normalise(feed.consumed())


@register("append_feed_idle")
def q_append_feed_idle(spark, sf_dir):
    """The feed is run again when nothing new has landed: no batch, same rows."""
    feed = _order_feed(spark, sf_dir)
    for _ in range(3):
        feed.consume()
    return normalise(feed.consumed())


@register("order_log")
def q_order_log(spark, sf_dir):
    feed = _order_feed(spark, sf_dir, jobs.order_log)
    feed.consume()
    return normalise(surrogate_ids(feed.consumed(), ["order_id"], "log_id"))


def _streamed(spark, name: str, drops: list[DataFrame], job) -> DataFrame:
    """A change job as a stream: each drop lands and is consumed by one run."""
    base = work_dir(spark, f"{name}-{uuid.uuid4().hex}")
    landing = os.path.join(base, "landing")
    for drop in drops:
        feeds.land(drop, landing)
        feed = feeds.AppendFeed(spark, landing, os.path.join(base, "state"), drop.schema, job)
        feed.consume()
    return feed.consumed()


def _halves(df: DataFrame, key: str) -> list[DataFrame]:
    first = F.pmod(F.xxhash64(key), F.lit(2)) == 0
    return [df.filter(first), df.filter(~first)]


@register("streamed_sentiment")
def q_streamed_sentiment(spark, sf_dir):
    """Review sentiment as a stream, the reviews landing in two drops."""
    return normalise(_streamed(spark, "sentiment", _halves(Star(spark, sf_dir).fact_review(), "review_id"),
                               change_jobs.sentiment_labels))


def _stock_changes(changes_: DataFrame) -> DataFrame:
    return changes_.withColumn("kind", F.lit(keyed.CHANGE))


def _run_alerts(spark, s: Star, drops: list[DataFrame]) -> keyed.AlertStream:
    base = work_dir(spark, f"alerts-{uuid.uuid4().hex}")
    stream = keyed.AlertStream(spark, os.path.join(base, "landing"), os.path.join(base, "state"), s.dim_ingredient())
    for drop in drops:
        feeds.land(drop.select(*stream.schema.names), stream.landing_dir)
        stream.consume()
    return stream


ALERT_COLUMNS = ["location_id", "ingredient_id", "ingredient_name", "current_quantity", "reorder_point", "alert_type",
                 "alert_status"]


@register("streamed_alerts")
def q_streamed_alerts(spark, sf_dir):
    """Inventory alerts as a stream: all earlier years land, then the rest; what is
    open is keyed state."""
    s = Star(spark, sf_dir)
    prior = s.fact_inventory().filter(F.col("record_date") < timefn.date_lit(INVENTORY_BATCH_START))
    drops = [_stock_changes(prior), _stock_changes(s.fact_inventory(since=INVENTORY_BATCH_START))]
    return normalise(_run_alerts(spark, s, drops).alerts().select(*ALERT_COLUMNS))


@register("streamed_alerts_resolved")
def q_streamed_alerts_resolved(spark, sf_dir):
    """Alerts that open, are resolved (those of even locations, the day before the
    last batch) and open again with the changes of the last batch."""
    s = Star(spark, sf_dir)
    prior = s.fact_inventory().filter(F.col("record_date") < timefn.date_lit(INVENTORY_BATCH_START))
    done = prior.filter(F.col("location_id") % 2 == 0).withColumns({
        "record_date": F.date_sub(timefn.date_lit(INVENTORY_BATCH_START), 1), "kind": F.lit(keyed.RESOLVED)})
    drops = [_stock_changes(prior), done, _stock_changes(s.fact_inventory(since=INVENTORY_BATCH_START))]
    return normalise(_run_alerts(spark, s, drops).alerts().select(*ALERT_COLUMNS, "alert_number", "resolved_date"))


@register("streamed_history")
def q_streamed_history(spark, sf_dir):
    """Customer history from the change stream of two customer snapshots; the
    stream begins after the first one."""
    s = Star(spark, sf_dir)
    base = work_dir(spark, f"history-{uuid.uuid4().hex}")
    snapshot = lambda when, at: s.dim_customer(when).withColumn(keyed.SNAPSHOT_AT, F.lit(at).cast("timestamp"))
    first, second = snapshot("before", "2001-08-01 00:00:00"), snapshot("after", "2001-08-02 00:00:00")
    reader = keyed.SnapshotChanges(spark, os.path.join(base, "landing"), os.path.join(base, "state"),
                                   s.dim_customer("before").schema, ["customer_id"], change_jobs.customer_history)
    feeds.land(first, reader.landing_dir)
    reader.prime()
    feeds.land(second, reader.landing_dir)
    reader.consume()
    return normalise(reader.consumed())


VERSION_T0, VERSION_T1 = dt.datetime(1996, 1, 1), dt.datetime(1999, 1, 1)


@register("order_customer_versions")
def q_order_customer_versions(spark, sf_dir):
    """Orders with the customer as it was at order time: the first snapshot is
    valid from 1996 on, its changes from 1999 on."""
    s = Star(spark, sf_dir)
    initial = changes.insert_feed(s.dim_customer("before")).withColumn("_changed_at", timefn.ts_lit(VERSION_T0))
    later = _customer_changes(s).drop(changes.ROW_ID).withColumn("_changed_at", timefn.ts_lit(VERSION_T1))
    valid = changes.versions(initial.unionByName(later), ["customer_id"], "_changed_at").select(
        "customer_id", "phone", "loyalty_points", "valid_from", "valid_to")
    orders = s.fact_order().select("order_id", "customer_id", "order_timestamp", "total_amount")
    return normalise(changes.join_valid(orders, valid, ["customer_id"], "order_timestamp"))


PIPELINE_SPLIT = dt.datetime(1999, 1, 1)


def _run_pipeline(spark, sf_dir) -> IncrementalMedallion:
    """The continuous pipeline end to end: bronze events land in two drops and
    each drop is one AvailableNow run."""
    s = Star(spark, sf_dir)
    base = work_dir(spark, f"medallion-{uuid.uuid4().hex}")
    landing = os.path.join(base, "bronze")
    # The test data spreads few orders over seven years: yearly partitions.
    pipe = IncrementalMedallion(spark, os.path.join(base, "tables"), s.dim_location(), s.dim_customer(),
                                s.dim_menu_item(), s.dim_category(), period="year")
    for since, until in ((None, PIPELINE_SPLIT), (PIPELINE_SPLIT, None)):
        orders = s.fact_order(since=since, until=until)
        items = s.fact_order_item().join(orders.select("order_id"), "order_id", "left_semi")
        bronze = medallion.bronze_events(orders, items, s.dim_menu_item(with_category=False))
        with stored_steps(spark):
            bronze.write.mode("append").parquet(landing)
        pipe.start(landing, bronze.schema, os.path.join(base, "checkpoint")).awaitTermination()
    return pipe


@register("streamed_gold_daily")
def q_streamed_gold_daily(spark, sf_dir):
    return normalise(_run_pipeline(spark, sf_dir).table("gold_daily_sales").drop("last_refreshed"))


@register("streamed_gold_items")
def q_streamed_gold_items(spark, sf_dir):
    return normalise(_run_pipeline(spark, sf_dir).table("gold_item_performance").drop("last_refreshed"))


@register("streamed_gold_customers")
def q_streamed_gold_customers(spark, sf_dir):
    return normalise(_run_pipeline(spark, sf_dir).table("gold_customer_activity").drop("last_refreshed"))


@register("refreshed_gold_hourly")
def q_refreshed_gold_hourly(spark, sf_dir):
    """Manual refresh: of two drops the pipeline has processed one; the refresh takes
    in the other first."""
    s = Star(spark, sf_dir)
    base = work_dir(spark, f"refresh-{uuid.uuid4().hex}")
    landing = os.path.join(base, "bronze")
    pipe = IncrementalMedallion(spark, os.path.join(base, "tables"), s.dim_location(), s.dim_customer(),
                                s.dim_menu_item(), s.dim_category(), period="year")
    for since, until in ((None, PIPELINE_SPLIT), (PIPELINE_SPLIT, None)):
        orders = s.fact_order(since=since, until=until)
        items = s.fact_order_item().join(orders.select("order_id"), "order_id", "left_semi")
        bronze = medallion.bronze_events(orders, items, s.dim_menu_item(with_category=False))
        with stored_steps(spark):
            bronze.write.mode("append").parquet(landing)
        if since is None:
            pipe.start(landing, bronze.schema, os.path.join(base, "checkpoint")).awaitTermination()
    pipe.refresh("gold_hourly_sales")
    return normalise(pipe.table("gold_hourly_sales").drop("last_refreshed"))


def _run_views(spark, sf_dir) -> IncrementalViews:
    s = Star(spark, sf_dir)
    base = work_dir(spark, f"views-{uuid.uuid4().hex}")
    landing = os.path.join(base, "orders")
    schema = s.fact_order().schema
    kept = IncrementalViews(spark, os.path.join(base, "tables"), s.dim_customer(), schema)
    for since, until in ((None, PIPELINE_SPLIT), (PIPELINE_SPLIT, None)):
        feeds.land(s.fact_order(since=since, until=until), landing)
        kept.start(landing, os.path.join(base, "checkpoint")).awaitTermination()
    return kept


@register("streamed_hourly_sales")
def q_streamed_hourly_sales(spark, sf_dir):
    """``hourly_sales`` kept in step with two order drops."""
    return normalise(_run_views(spark, sf_dir).hourly_sales())


@register("streamed_customer_metrics")
def q_streamed_customer_metrics(spark, sf_dir):
    """``customer_metrics`` kept in step with two order drops."""
    return normalise(_run_views(spark, sf_dir).customer_metrics(AS_OF_ORDERS))


@register("streamed_anomalies")
def q_streamed_anomalies(spark, sf_dir):
    """Anomalies from moments kept batch by batch.  First the days up to the split land,
    those of every third location with half their revenue; then those
    days are corrected (both halves of the update) and the other days land."""
    s = Star(spark, sf_dir)
    daily = lambda o: jobs.daily_sales_source(o, s.fact_order_item(), s.dim_customer()).select(
        "sales_date", "location_id", "total_revenue")
    early, late = s.fact_order(until=PIPELINE_SPLIT), s.fact_order(since=PIPELINE_SPLIT)
    short = F.col("location_id") % 3 == 0
    wrong = daily(early).filter(short).withColumn("total_revenue", (F.col("total_revenue") / 2).cast("decimal(12,2)"))
    kept = IncrementalAnomalies(spark, work_dir(spark, f"anomalies-{uuid.uuid4().hex}"), s.dim_location())
    kept.land(daily(early).filter(~short).unionByName(wrong))
    kept.consume()
    kept.land(wrong, "DELETE")
    kept.land(daily(early).filter(short).unionByName(daily(late)))
    kept.consume()
    return normalise(kept.anomalies())
