"""Scheduled jobs: daily sales upsert, per-location daily sales, weekly report,
retention cleanup, loyalty update and promotion offers — each a set-based
transform over whole tables, with the reference time as an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, timefn
from ..operators.joins import dim_join, fixed_rows
from ..operators.upsert import keyed_update, merge_upsert, purge
from ..sources.tables import replace_partitions
from .views import PIZZA_ITEM_RANGE, pizza_lines

DAILY_SALES_UPDATE = ["total_orders", "total_revenue", "avg_order_value", "dine_in_orders",
                      "pickup_orders", "delivery_orders", "total_pizzas_sold", "new_customers"]
DAILY_SALES_INSERT = ["sales_date", "location_id"] + DAILY_SALES_UPDATE + ["is_weekend", "is_holiday"]


def daily_sales_source(orders: DataFrame, items: DataFrame, customers: DataFrame,
                       item_range=PIZZA_ITEM_RANGE, few_orders: bool = False) -> DataFrame:
    """Per date x location: orders, revenue, average (stored as DECIMAL(8,2)),
    order-type counts, pizzas (lines pre-aggregated per order), new customers
    and the weekend flag of the sales date.

    ``few_orders``: the orders are a window of the table; only their lines are
    grouped (a semi join in front of the aggregate).

    The two distinct counts are taken in two grouping levels: first per
    (date, location, customer), then per (date, location).
    """
    if few_orders:
        items = items.join(orders.select("order_id"), "order_id", "left_semi")
    lines = pizza_lines(items, item_range).select("order_id", "pizzas")
    o = orders.join(lines, "order_id", "left")
    t = F.col("order_type")
    per_c = o.groupBy(timefn.to_day("order_timestamp").alias("sales_date"), "location_id", "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_amount").alias("rev"),
        F.count("total_amount").alias("rev_n"),
        F.sum(F.when(t == "DINE_IN", 1).otherwise(0)).alias("dine_in"),
        F.sum(F.when(t == "PICKUP", 1).otherwise(0)).alias("pickup"),
        F.sum(F.when(t == "DELIVERY", 1).otherwise(0)).alias("delivery"),
        F.sum("pizzas").alias("pizzas"))
    per_c = per_c.join(customers.select("customer_id", "registration_date"), "customer_id", "left")
    g = per_c.groupBy("sales_date", "location_id").agg(
        F.sum("n").alias("total_orders"),
        F.sum("rev").alias("total_revenue"),
        F.sum("rev_n").alias("rev_n"),
        F.sum("dine_in").alias("dine_in_orders"),
        F.sum("pickup").alias("pickup_orders"),
        F.sum("delivery").alias("delivery_orders"),
        F.sum("pizzas").alias("total_pizzas_sold"),
        F.count(F.when(F.col("registration_date") == F.col("sales_date"), 1)).alias("new_customers"))
    return g.select(
        "sales_date", "location_id",
        F.col("total_orders").cast("int").alias("total_orders"),
        F.col("total_revenue").cast("decimal(12,2)").alias("total_revenue"),
        F.round(money.exact_ratio("total_revenue", "rev_n"), 2)
         .cast("decimal(8,2)").alias("avg_order_value"),
        F.col("dine_in_orders").cast("int").alias("dine_in_orders"),
        F.col("pickup_orders").cast("int").alias("pickup_orders"),
        F.col("delivery_orders").cast("int").alias("delivery_orders"),
        F.col("total_pizzas_sold").cast("int").alias("total_pizzas_sold"),
        F.col("new_customers").cast("int").alias("new_customers"),
        F.lit(None).cast("string").alias("weather_condition"),
        timefn.is_weekend("sales_date").alias("is_weekend"),
        F.lit(False).alias("is_holiday"))


def orders_between(orders: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Orders with ``start <= date < end`` as a pushable range predicate."""
    return orders.filter((F.col("order_timestamp") >= timefn.ts_lit(start))
                         & (F.col("order_timestamp") < timefn.ts_lit(end)))


def daily_sales_merge(target: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert of daily sales keyed by (sales_date, location_id): matched rows
    get the eight measures; weather / weekend / holiday keep their value."""
    return merge_upsert(target, source, ["sales_date", "location_id"], DAILY_SALES_UPDATE, DAILY_SALES_INSERT)


def upsert_daily_sales(source: DataFrame, path: str, staging: str) -> None:
    """The upsert on a stored table partitioned by ``sales_date``: only the
    partitions of the source's dates (as many as its window has days) are read,
    merged in ``staging`` and replaced; all others stay as they are."""
    spark = source.sparkSession
    dates = [r[0] for r in source.select("sales_date").distinct().collect()]
    target = spark.read.parquet(path).filter(F.col("sales_date").isin(dates))
    daily_sales_merge(target.select(*source.columns), source).write.mode("overwrite").parquet(staging)
    replace_partitions(spark.read.parquet(staging), path, ["sales_date"])


def daily_sales_all_locations(orders: DataFrame, locations: DataFrame, target: DataFrame,
                              sales_date: dt.date) -> DataFrame:
    """Per-location daily totals for one date, every location included
    (0 orders / 0 revenue / 0 average when none), merged into ``target``."""
    o = orders.filter(timefn.on_day("order_timestamp", sales_date))
    per = o.groupBy("location_id").agg(F.countDistinct("order_id").alias("n"),
                                        F.sum("total_amount").alias("rev"))
    loc = locations.select("location_id").join(per, "location_id", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    rev = F.coalesce(F.col("rev"), F.lit(0)).cast("decimal(12,2)")
    src = loc.select(
        timefn.date_lit(sales_date).alias("sales_date"), "location_id",
        n.cast("int").alias("total_orders"), rev.alias("total_revenue"),
        F.when(n > 0, F.round(money.exact_ratio(rev, n), 2)).otherwise(0)
         .cast("decimal(8,2)").alias("avg_order_value"),
        timefn.is_weekend(timefn.date_lit(sales_date)).alias("is_weekend"))
    return merge_upsert(target, src, ["sales_date", "location_id"],
                        ["total_orders", "total_revenue", "avg_order_value"],
                        ["sales_date", "location_id", "total_orders", "total_revenue", "avg_order_value",
                         "is_weekend"])


def weekly_report(daily_sales: DataFrame, locations: DataFrame, as_of: dt.date, weeks: int = 8) -> DataFrame:
    """Weekly performance per location with week-over-week growth.  The
    previous week's revenue is one LAG computed once and reused."""
    since = as_of - dt.timedelta(weeks=weeks)
    ds = daily_sales.filter(F.col("sales_date") >= timefn.date_lit(since))
    ds = dim_join(ds, locations.select("location_id", "location_name"), "location_id")
    g = ds.groupBy(timefn.week_start("sales_date").alias("week_starting"), "location_name").agg(
        F.sum("total_orders").alias("weekly_orders"),
        F.sum("total_revenue").alias("rev"),
        F.sum("avg_order_value").alias("aov_sum"), F.count("avg_order_value").alias("aov_n"),
        F.sum("delivery_orders").alias("delivery_orders"),
        F.sum("pickup_orders").alias("pickup_orders"),
        F.sum("dine_in_orders").alias("dine_in_orders"),
        F.sum("total_pizzas_sold").alias("pizzas_sold"),
        F.sum("new_customers").alias("new_customers"))
    w = Window.partitionBy("location_name").orderBy("week_starting")
    g = g.withColumn("prev_week_revenue", F.lag("rev").over(w))
    prev = F.col("prev_week_revenue")
    growth = F.round((F.col("rev") - prev).cast("decimal(38,12)") / money.nullif_zero(prev).cast("decimal(38,2)")
                     * 100, 1)
    return g.select("week_starting", "location_name", "weekly_orders",
                    F.round("rev", 2).alias("weekly_revenue"),
                    money.round_avg("aov_sum", "aov_n", 2).alias("avg_order_value"),
                    "delivery_orders", "pickup_orders", "dine_in_orders", "pizzas_sold", "new_customers",
                    "prev_week_revenue", growth.alias("wow_growth_pct"))


def order_log(new_orders: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Processed-order log rows for a batch of new-order changes, with the time
    of processing if it is given."""
    return new_orders.select(
        "order_id", F.col("_action").alias("action_type"),
        F.col("total_amount").alias("order_total"), "customer_id", "location_id",
        F.lit(False).alias("notification_sent"),
        *([] if processed_at is None else [processed_at.alias("processed_at")]))


def purge_order_log(log: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Keep log rows processed within ``days`` of ``as_of``."""
    return purge(log, F.col("processed_at") < timefn.ts_lit(as_of - dt.timedelta(days=days)))


def purge_alerts(alerts: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    """Drop RESOLVED alerts resolved more than ``days`` before ``as_of``."""
    return purge(alerts, (F.col("alert_status") == "RESOLVED")
                 & (F.col("resolved_at") < timefn.ts_lit(as_of - dt.timedelta(days=days))))


def loyalty_tier(points):
    return (F.when(points >= 1000, "GOLD").when(points >= 500, "SILVER")
            .when(points >= 100, "BRONZE").otherwise("MEMBER"))


def loyalty_update(customers: DataFrame, order_totals: DataFrame) -> DataFrame:
    """Loyalty points for a batch of (customer_id, order_total[, points_earned]).

    Each order earns ``points_earned`` when given, else ``floor(order_total)``;
    a customer's batch is summed.  Unknown customers get NULL before/after and
    tier MEMBER (the tier's ELSE branch).
    """
    ot = order_totals
    if "points_earned" not in ot.columns:
        ot = ot.withColumn("points_earned", F.lit(None).cast("int"))
    earned = F.coalesce(F.col("points_earned"), F.floor("order_total")).cast("bigint")
    per = ot.groupBy("customer_id").agg(F.sum(earned).alias("points_earned"))
    j = per.join(customers.select("customer_id", "loyalty_points"), "customer_id", "left")
    after = F.col("loyalty_points") + F.col("points_earned")
    return j.select("customer_id", F.col("loyalty_points").cast("bigint").alias("points_before"),
                    "points_earned", after.alias("points_after"), loyalty_tier(after).alias("loyalty_tier"))


def apply_loyalty(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """Write the new totals back to the customer table (keyed update)."""
    ch = updates.filter(F.col("points_after").isNotNull()).select(
        "customer_id", F.col("points_after").cast("int").alias("loyalty_points"))
    return keyed_update(customers, ch, ["customer_id"], ["loyalty_points"])


PROMO_SCHEMA = ("promo_code string, description string, discount_percent int, start_date date, "
                "end_date date, target_segment string, min_order_value decimal(8,2), max_uses int")


def promotions(spark, start: dt.date, end: dt.date, discount_percent: int = 15) -> DataFrame:
    """The three promotion definitions for a period (a three-row table)."""
    from decimal import Decimal
    code = start.strftime("%m%d")
    rows = [
        (f"COMEBACK{code}", f"We miss you! {discount_percent}% off your next order", discount_percent,
         start, end, "LAPSED_CUSTOMERS", Decimal("15.00"), 1000),
        (f"BDAY{code}", "Happy Birthday! Free dessert with any order", 100, start, end,
         "BIRTHDAY_MONTH", Decimal("20.00"), 500),
        (f"VIP{code}", f"VIP Exclusive: {discount_percent + 5}% off", discount_percent + 5, start, end,
         "VIP_CUSTOMERS", Decimal("30.00"), 200),
    ]
    return fixed_rows(spark, rows, PROMO_SCHEMA)


def promotion_offers(spark, customers: DataFrame, orders: DataFrame, start: dt.date, end: dt.date,
                     discount_percent: int, as_of: dt.date, lapsed_days: int = 60,
                     vip_min_orders: int = 5) -> DataFrame:
    """Offer rows: each promotion joined to the customers in its segment.

    Lapsed = no order in the last ``lapsed_days`` (customers without orders
    included); birthday month = the start month; VIP = at least
    ``vip_min_orders`` distinct orders (the HIGH activity level).
    """
    per = orders.groupBy("customer_id").agg(F.max("order_timestamp").alias("last_ts"),
                                            F.countDistinct("order_id").alias("n_orders"))
    c = customers.select("customer_id", "birthday").join(per, "customer_id", "left")
    cutoff = timefn.ts_lit(as_of - dt.timedelta(days=lapsed_days))
    seg = F.filter(F.array(
        F.when(F.col("last_ts").isNull() | (F.col("last_ts") < cutoff), F.lit("LAPSED_CUSTOMERS")),
        F.when(F.month("birthday") == start.month, F.lit("BIRTHDAY_MONTH")),
        F.when(F.coalesce(F.col("n_orders"), F.lit(0)) >= vip_min_orders, F.lit("VIP_CUSTOMERS"))),
        lambda x: x.isNotNull())
    elig = c.select("customer_id", F.explode(seg).alias("target_segment"))
    promos = promotions(spark, start, end, discount_percent)
    return elig.join(F.broadcast(promos), "target_segment").select(
        "customer_id", "promo_code", "description", "discount_percent", "start_date", "end_date",
        "target_segment", "min_order_value", "max_uses")
