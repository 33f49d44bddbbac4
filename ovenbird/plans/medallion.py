"""Layered order pipeline: bronze events -> silver orders / items -> gold
aggregates -> dashboard reads.

Every layer is a pure ``DataFrame -> DataFrame`` transform, so the same code
serves a full batch build and an incremental refresh (``streaming.incremental``)
that recomputes only the group keys touched by new events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money, timefn
from ..functions.variant import object_of
from ..operators.joins import dim_join
from ..operators.partitions import by_rows

# Location codes written to and read back from events.
LOCATION_CODE_OUT = {1: "DT-001", 2: "WL-002"}
LOCATION_CODE_OUT_ELSE = "RR-003"
LOCATION_CODE_IN = {"DT-001": 1, "WL-002": 2, "RR-003": 3}
SOURCE_BY_MOD3 = {0: "POS_TERMINAL", 1: "WEB_APP"}
SOURCE_BY_MOD3_ELSE = "MOBILE_APP"


def _map(col, mapping, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def named_lines(items: DataFrame, menu: DataFrame) -> DataFrame:
    """Order lines with the names of their items."""
    return items.join(menu.select("item_id", "item_name"), "item_id", "inner")


def order_items_array(items: DataFrame, menu: DataFrame | None, lines: int | None = None) -> DataFrame:
    """Per order, the array of line objects (item_id, item_name, quantity,
    price), sorted so the array is repeatable.  Lines are grouped by order
    before the order join, which therefore stays one-to-one.  ``menu=None``:
    ``items`` are ``named_lines`` stored by order, and are not shuffled.
    ``lines``: about how many lines there are, if the work on an order is long for
    its bytes (payloads, their texts and rules) and should be dealt by rows."""
    # Hash-partition the lines by order first: collecting a list does not
    # shrink the data, so a map-side partial collect only adds work in the
    # scan tasks; the aggregate then reuses this partitioning (no second
    # exchange) and so does the join to the orders.
    if menu is None:
        by_order = items
    elif lines is None:
        by_order = named_lines(items, menu).repartition("order_id")
    else:
        # Not fewer partitions than the session's, or the join to the orders would shuffle again.
        least = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by_order = by_rows(named_lines(items, menu), lines, "order_id", least=least)
    return by_order.groupBy("order_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "item_id", "item_name", "quantity", F.col("unit_price").alias("price")))).alias("items"))


def bronze_events(orders: DataFrame, items: DataFrame, menu: DataFrame | None, as_of: dt.date | None = None,
                  days: int | None = None, lines: int | None = None) -> DataFrame:
    """One ORDER_PLACED event per order, of all orders or (``days``) of the last
    days before ``as_of``.

    The payload is a VARIANT built from the order and its lines; keys whose
    value is NULL are left out (an order without lines has no ``items``).
    Event ids are a hash of the order key, so a recomputed task writes the
    same ids.
    """
    o = orders
    if days is not None:
        o = o.filter(F.col("order_timestamp") >= timefn.ts_lit(as_of - dt.timedelta(days=days)))
        # Only the window's lines are shuffled and collected.
        items = items.join(o.select("order_id"), "order_id", "left_semi")
    o = o.join(order_items_array(items, menu, lines), "order_id", "left")
    payload = object_of(
        order_id=F.col("order_id"), customer_id=F.col("customer_id"),
        order_type=F.col("order_type"), subtotal=F.col("subtotal"), tax=F.col("tax_amount"),
        tip=F.col("tip_amount"), total=F.col("total_amount"),
        payment_method=F.col("payment_method"), items=F.col("items"))
    return o.select(
        F.sha2(F.concat(F.lit("ORDER_PLACED:"), F.col("order_id").cast("string")), 256).substr(1, 32)
         .alias("event_id"),
        F.col("order_timestamp").alias("event_timestamp"),
        F.lit("ORDER_PLACED").alias("event_type"),
        _map(F.col("location_id"), LOCATION_CODE_OUT, LOCATION_CODE_OUT_ELSE).alias("location_code"),
        payload.alias("payload"),
        _map(F.col("order_id") % 3, SOURCE_BY_MOD3, SOURCE_BY_MOD3_ELSE).alias("source_system"),
        F.lit(False).alias("processed"),
    )


def with_payload_of(bronze: DataFrame, *names: str) -> DataFrame:
    """The events with these payload fields only, as they are (a field that a payload
    lacks stays away): for a shuffle of events whose other fields nobody reads."""
    field = lambda name: F.struct(F.lit(name).alias("k"), F.variant_get("payload", f"$.{name}", "variant").alias("v"))
    fields = F.filter(F.array(*[field(name) for name in names]), lambda f: f["v"].isNotNull())
    return bronze.withColumn("payload", F.to_variant_object(F.map_from_entries(fields)))


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Typed order rows from ORDER_PLACED payloads, with a validity flag."""
    e = bronze.filter(F.col("event_type") == "ORDER_PLACED")
    p = F.col("payload")

    def get(path, typ):
        return F.variant_get(p, f"$.{path}", typ)

    total = get("total", "decimal(10,2)")
    items = F.try_variant_get(p, "$.items", "array<variant>")
    valid = (F.when(get("order_id", "variant").isNull(), False)
             .when(total <= 0, False).otherwise(True))
    return e.select(
        "event_id", "event_timestamp", "event_type", "source_system",
        get("order_id", "bigint").alias("order_id"),
        get("customer_id", "bigint").alias("customer_id"),
        _map(F.col("location_code"), LOCATION_CODE_IN).cast("bigint").alias("location_id"),
        get("order_type", "string").alias("order_type"),
        get("subtotal", "decimal(10,2)").alias("subtotal"),
        get("tax", "decimal(10,2)").alias("tax_amount"),
        get("tip", "decimal(10,2)").alias("tip_amount"),
        total.alias("total_amount"),
        get("payment_method", "string").alias("payment_method"),
        get("items", "variant").alias("order_items"),
        F.when(items.isNotNull(), F.size(items)).alias("item_count"),
        timefn.to_day("event_timestamp").alias("order_date"),
        F.hour("event_timestamp").alias("order_hour"),
        timefn.day_name("event_timestamp").alias("day_of_week"),
        valid.alias("is_valid_order"),
    )


def silver_order_items(silver: DataFrame) -> DataFrame:
    """Item rows of valid orders: one per array element, 1-based sequence.
    Orders whose items are NULL or empty produce no rows (inner flatten), nor do
    invalid ones: as a filter, the condition would be pushed below the payload and
    build it again for each field that it reads."""
    arr = F.when(F.col("is_valid_order"), F.try_variant_get(F.col("order_items"), "$", "array<variant>"))
    x = silver.select("event_id", "order_id", "order_date", "location_id",
                 F.posexplode(arr).alias("pos", "item"))
    v = F.col("item")
    qty = F.variant_get(v, "$.quantity", "int")
    price = F.variant_get(v, "$.price", "decimal(8,2)")
    return x.select(
        "event_id", "order_id", "order_date", "location_id",
        F.variant_get(v, "$.item_id", "bigint").alias("item_id"),
        F.variant_get(v, "$.item_name", "string").alias("item_name"),
        qty.alias("quantity"), price.alias("unit_price"),
        (qty * price).alias("line_total"),
        (F.col("pos") + 1).alias("item_sequence"))


def _count_if(cond):
    return F.sum(F.when(cond, 1).otherwise(0))


def _sum_if(cond, value):
    return F.sum(F.when(cond, value).otherwise(0))


def gold_daily_sales(silver: DataFrame, locations: DataFrame, refreshed_at=None) -> DataFrame:
    """Daily sales per date x location over valid orders."""
    s = silver.filter(F.col("is_valid_order"))
    s = dim_join(s, locations.select("location_id", "location_name"), "location_id")
    t, pm, src, amt = F.col("order_type"), F.col("payment_method"), F.col("source_system"), F.col("total_amount")
    out = s.groupBy("order_date", "location_id", "location_name").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum(amt).alias("total_revenue"),
        F.avg(amt).alias("avg_order_value"),
        _count_if(t == "DELIVERY").alias("delivery_orders"),
        _count_if(t == "PICKUP").alias("pickup_orders"),
        _count_if(t == "DINE_IN").alias("dine_in_orders"),
        _sum_if(t == "DELIVERY", amt).alias("delivery_revenue"),
        _sum_if(t == "PICKUP", amt).alias("pickup_revenue"),
        _sum_if(t == "DINE_IN", amt).alias("dine_in_revenue"),
        _count_if(pm == "CREDIT").alias("credit_orders"),
        _count_if(pm == "CASH").alias("cash_orders"),
        _count_if(pm == "MOBILE").alias("mobile_orders"),
        _count_if(src == "WEB_APP").alias("web_orders"),
        _count_if(src == "MOBILE_APP").alias("mobile_app_orders"),
        _count_if(src == "POS_TERMINAL").alias("pos_orders"))
    if refreshed_at is not None:
        out = out.withColumn("last_refreshed", refreshed_at)
    return out


def period_type(hour_col):
    return (F.when(hour_col.between(11, 13), "LUNCH_RUSH")
            .when(hour_col.between(17, 20), "DINNER_RUSH").otherwise("REGULAR"))


def gold_hourly_sales(silver: DataFrame, locations: DataFrame) -> DataFrame:
    s = silver.filter(F.col("is_valid_order"))
    s = dim_join(s, locations.select("location_id", "location_name"), "location_id")
    g = s.groupBy("order_date", "order_hour", "location_id", "location_name", "day_of_week").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum("total_amount").alias("revenue"),
        F.avg("total_amount").alias("avg_order_value"),
        money.avg("item_count").alias("avg_items_per_order"))
    return g.withColumn("period_type", period_type(F.col("order_hour")))


def gold_item_performance(silver_items: DataFrame, locations: DataFrame, menu: DataFrame,
                          categories: DataFrame, lines: int | None = None) -> DataFrame:
    """``lines``: about how many item rows there are.  Nearly every line is a group of
    its own, which the distinct count holds several times in memory."""
    i = dim_join(silver_items, locations.select("location_id", "location_name"), "location_id")
    i = i.join(menu.select("item_id", "category_id", "base_price", "cost_to_make"), "item_id")
    i = dim_join(i, categories.select("category_id", "category_name"), "category_id")
    if lines is not None:
        i = by_rows(i, lines, "order_date", "location_id", "item_id")
    return i.groupBy("order_date", "location_id", "location_name", "item_id", "item_name",
                     "category_id", "category_name").agg(
        F.sum("quantity").alias("quantity_sold"),
        F.sum("line_total").alias("item_revenue"),
        F.countDistinct("order_id").alias("orders_containing_item"),
        money.avg("quantity").alias("avg_quantity_per_order"),
        F.sum(F.col("quantity") * (F.col("base_price") - F.col("cost_to_make"))).alias("estimated_profit"))


def average(total, n):
    """``AVG`` of a DECIMAL(10,2) column from its exact sum and count."""
    return F.round(money.exact_ratio(total, n), 6).cast("decimal(14,6)")


def activity_level(n):
    return F.when(n >= 5, "HIGH").when(n >= 2, "MEDIUM").otherwise("LOW")


def gold_customer_activity(silver: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer activity.  MODE ties resolve to the smallest value."""
    s = silver.filter(F.col("is_valid_order"))
    g = s.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("recent_orders"),
        F.sum("total_amount").alias("recent_spend"),
        F.avg("total_amount").alias("avg_order_value"),
        F.min("event_timestamp").alias("first_order_in_window"),
        F.max("event_timestamp").alias("last_order_in_window"),
        F.mode("order_type", True).alias("preferred_order_type"),
        F.mode("payment_method", True).alias("preferred_payment"),
        F.mode("location_id", True).alias("preferred_location"))
    c = customers.select("customer_id", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))
                         .alias("customer_name"), "email", "city")
    g = g.join(c, "customer_id", "inner")
    return g.select("customer_id", "customer_name", "email", "city", "recent_orders", "recent_spend",
                    "avg_order_value", "first_order_in_window", "last_order_in_window",
                    "preferred_order_type", "preferred_payment", "preferred_location",
                    activity_level(F.col("recent_orders")).alias("activity_level"))


# ----------------------------------------------------------- dashboard reads
def dash_daily(gold_daily: DataFrame) -> DataFrame:
    return (gold_daily.select(
        "order_date", "location_name", "total_orders",
        F.round("total_revenue", 2).alias("revenue"),
        F.round("avg_order_value", 2).alias("aov"),
        "delivery_orders", "pickup_orders", "dine_in_orders")
        .orderBy(F.desc_nulls_first("order_date"), F.desc_nulls_first("revenue")))


def latest(df: DataFrame, ts_col: str) -> DataFrame:
    """One-row frame with the latest value of ``ts_col`` (data freshness)."""
    return df.agg(F.max(ts_col).alias("now"))


def dash_current_hour_at_latest(silver: DataFrame, locations: DataFrame) -> DataFrame:
    """Current-hour board at the data's latest event time.  The (date, hour)
    key is fixed before aggregating, so only that hour's orders are read and
    grouped — the same rows the hourly gold table holds for that key."""
    valid = silver.filter(F.col("is_valid_order"))
    now = latest(valid, "event_timestamp").select(
        F.to_date("now").alias("order_date"), F.hour("now").alias("order_hour"))
    hour_rows = valid.join(F.broadcast(now), ["order_date", "order_hour"], "left_semi")
    g = gold_hourly_sales(hour_rows, locations)
    return g.select("location_name", "orders", F.round("revenue", 2).alias("revenue"),
                    "period_type").orderBy(F.desc_nulls_first("revenue"))


def dash_top_items(gold_items: DataFrame, day_col, n: int = 10) -> DataFrame:
    g = gold_items.filter(F.col("order_date") == day_col)
    agg = g.groupBy("item_name", "category_name").agg(
        F.sum("quantity_sold").alias("total_sold"),
        F.round(F.sum("item_revenue"), 2).alias("revenue"),
        F.round(F.sum("estimated_profit"), 2).alias("profit"))
    return agg.orderBy(F.desc_nulls_first("total_sold"), F.desc_nulls_first("revenue"), F.asc_nulls_last("item_name"),
                       F.asc_nulls_last("category_name")).limit(n)


def dash_top_items_at_latest(silver_items: DataFrame, locations: DataFrame, menu: DataFrame,
                             categories: DataFrame, n: int = 10) -> DataFrame:
    """Top items of the latest order date.  The date is fixed before the item
    aggregation (one-row broadcast semi join), so only that day's lines are
    grouped — the same rows the item gold table holds for that date."""
    today = silver_items.agg(F.max("order_date").alias("order_date"))
    day_items = silver_items.join(F.broadcast(today), "order_date", "left_semi")
    g = gold_item_performance(day_items, locations, menu, categories)
    return dash_top_items(g, F.col("order_date"), n)


def dash_vip(gold_customers: DataFrame) -> DataFrame:
    return (gold_customers.filter(F.col("activity_level") == "HIGH").select(
        "customer_name", "email", "recent_orders", F.round("recent_spend", 2).alias("spend"),
        "preferred_order_type", "activity_level").orderBy(F.desc_nulls_first("spend")))
