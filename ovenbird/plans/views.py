"""Views and materialised views over the star model (session table, open-format
tables, key-lookup board, standard / row-restricted / materialised views).

Each function takes DataFrames and returns a lazy DataFrame; reference times are
arguments.  Where the source SQL joins a fact to a finer fact before summing,
the finer side is pre-aggregated per parent key first, so the join happens at
the parent's grain and repeats nothing but a weight.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money, timefn
from ..operators.joins import dim_join

PIZZA_ITEM_RANGE = (1, 14)


def daily_metrics(orders: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Session table of daily metrics for orders since ``as_of - days``."""
    since = as_of - dt.timedelta(days=days)
    o = orders.filter(F.col("order_timestamp") >= timefn.ts_lit(since))
    return (o.groupBy(timefn.to_day("order_timestamp").alias("metric_date"), "location_id")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("total_amount").alias("daily_revenue"),
                 money.avg("total_amount").alias("avg_order_value")))


def pizza_lines(items: DataFrame, item_range=PIZZA_ITEM_RANGE) -> DataFrame:
    """Per order: number of lines and pizza quantity (items in ``item_range``)."""
    lo, hi = item_range
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("item_id").between(lo, hi), F.col("quantity")).otherwise(0)).alias("pizzas"))


def order_analytics(orders: DataFrame, items: DataFrame, locations: DataFrame,
                    customers: DataFrame, fanout: bool = True,
                    item_range=PIZZA_ITEM_RANGE) -> DataFrame:
    """Open-format order analytics per date x location.

    ``fanout=True`` keeps the source's literal semantics: order measures are
    summed once per joined order line (an order with k lines counts k times,
    an order without lines once).  ``fanout=False`` gives the header-grain
    figures.  Either way lines are reduced to one row per order before the
    join, and the distinct counts are taken in two grouping levels instead of
    a multi-distinct expand.
    """
    lines = pizza_lines(items, item_range)
    o = orders.join(lines, "order_id", "left")
    w = F.coalesce(F.col("n_lines"), F.lit(1)) if fanout else F.lit(1)
    prep = timefn.minutes_between("order_timestamp", "actual_ready_time")
    o = dim_join(o, locations.select("location_id", "location_name"), "location_id")
    per_order = o.select(
        timefn.to_day("order_timestamp").alias("order_date"), "location_id", "location_name",
        "customer_id",
        w.cast("bigint").alias("w"),
        (F.col("total_amount") * w).alias("total_w"),
        F.when(F.col("total_amount").isNotNull(), w).alias("total_n"),
        F.coalesce(F.col("pizzas"), F.lit(0)).cast("bigint").alias("pizzas"),
        F.when(F.col("order_type") == "DELIVERY", w).otherwise(0).alias("delivery"),
        F.when(F.col("order_type") == "PICKUP", w).otherwise(0).alias("pickup"),
        F.when(F.col("order_type") == "DINE_IN", w).otherwise(0).alias("dine_in"),
        (prep * w).alias("prep_w"),
        F.when(prep.isNotNull(), w).alias("prep_n"),
    )
    keys = ["order_date", "location_id", "location_name"]
    # Level 1: one row per (date, location, customer).
    per_customer = per_order.groupBy(*keys, "customer_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        *[F.sum(c).alias(c) for c in ("total_w", "total_n", "pizzas", "delivery", "pickup",
                                         "dine_in", "prep_w", "prep_n")])
    reg = customers.select("customer_id", "registration_date")
    per_customer = per_customer.join(reg, "customer_id", "left").withColumn(
        "is_new", F.col("registration_date") == F.col("order_date"))
    # Level 2: one row per (date, location).
    g = per_customer.groupBy(*keys).agg(
        F.sum("n_orders").alias("total_orders"),
        F.sum("total_w").alias("total_revenue"),
        money.mean(F.sum("total_w"), F.sum("total_n")).alias("avg_order_value"),
        F.sum("pizzas").alias("total_pizzas"),
        F.sum("delivery").alias("delivery_orders"),
        F.sum("pickup").alias("pickup_orders"),
        F.sum("dine_in").alias("dine_in_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.count(F.when(F.col("is_new"), 1)).alias("new_customers"),
        money.mean(F.sum("prep_w"), F.sum("prep_n")).alias("avg_prep_time_minutes"),
    )
    return g.select(*keys, "total_orders", "total_revenue", "avg_order_value", "total_pizzas",
                    "delivery_orders", "pickup_orders", "dine_in_orders", "unique_customers",
                    "new_customers",
                    (F.col("unique_customers") - F.col("new_customers")).alias("repeat_customers"),
                    "avg_prep_time_minutes",
                    timefn.month_key("order_date").alias("partition_month"))


STATION_BY_STATUS = {"PENDING": "QUEUE", "PREPARING": "PREP", "READY": "READY",
                     "COMPLETED": "COMPLETED"}


def order_status_board(orders: DataFrame, as_of: dt.date, days: int | None = 1) -> DataFrame:
    """Key-lookup status board for orders dated on or after ``as_of - days``
    (``None``: all orders)."""
    o = orders
    if days is not None:
        o = o.filter(F.col("order_timestamp") >= timefn.ts_lit(as_of - dt.timedelta(days=days)))
    station = None
    for status, st in STATION_BY_STATUS.items():
        cond = F.col("order_status") == status
        station = F.when(cond, st) if station is None else station.when(cond, st)
    return o.select(
        "order_id", "location_id", "order_status",
        station.otherwise("UNKNOWN").alias("current_station"),
        F.col("employee_id").alias("assigned_chef_id"),
        "estimated_ready_time", "actual_ready_time",
        F.lit(False).alias("customer_notified"))


def kitchen_queue(board: DataFrame, location_id: int,
                  statuses=("PENDING", "PREPARING")) -> DataFrame:
    """Kitchen display: one location's open tickets by estimated ready time."""
    return (board.filter((F.col("location_id") == location_id) & F.col("order_status").isin(*statuses))
            .orderBy(F.asc_nulls_last("estimated_ready_time"), "order_id"))


def lookup_order(board: DataFrame, order_id: int) -> DataFrame:
    """Point lookup by key (parquet min/max statistics prune the scan)."""
    return board.filter(F.col("order_id") == order_id)


def menu_profitability(menu: DataFrame, categories: DataFrame, items: DataFrame) -> DataFrame:
    """Standard view: per menu item margins and sales; unsold items kept."""
    per_order = items.groupBy("item_id", "order_id").agg(
        F.sum("quantity").alias("q"), F.sum("line_total").alias("rev"))
    per_item = per_order.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("times_ordered"),
        F.sum("q").alias("total_quantity_sold"),
        F.sum("rev").alias("total_revenue"))
    m = dim_join(menu, categories.select("category_id", "category_name"), "category_id")
    m = m.join(per_item, "item_id", "left")
    profit = F.col("base_price") - F.col("cost_to_make")
    total_cost = F.col("total_quantity_sold") * F.col("cost_to_make")
    return m.select(
        "item_id", "item_name", "category_name", "base_price", "cost_to_make",
        profit.alias("profit_per_item"),
        F.round(money.exact_ratio(profit * 100, F.col("base_price") * 100) * 100, 1).alias("profit_margin_pct"),
        F.coalesce(F.col("times_ordered"), F.lit(0)).alias("times_ordered"),
        "total_quantity_sold", "total_revenue",
        total_cost.alias("total_cost"),
        (F.col("total_revenue") - total_cost).alias("total_profit"))


def customer_metrics(customers: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Materialised customer metrics; customers without orders are kept."""
    per = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("lifetime_value"),
        F.count("total_amount").alias("n_total"),
        F.min("order_timestamp").alias("first_order_date"),
        F.max("order_timestamp").alias("last_order_date"))
    c = customers.join(per, "customer_id", "left")
    return c.select(
        "customer_id",
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
        "city", "loyalty_points",
        F.coalesce(F.col("total_orders"), F.lit(0)).alias("total_orders"),
        "lifetime_value",
        money.mean("lifetime_value", "n_total").alias("avg_order_value"),
        "first_order_date", "last_order_date",
        timefn.days_between("last_order_date", timefn.date_lit(as_of)).alias("days_since_last_order"))


def top_by(df: DataFrame, col: str, n: int, tiebreak: str) -> DataFrame:
    """``ORDER BY col DESC LIMIT n`` with NULLs first (source dialect) and a
    unique tiebreak; planned as a single TakeOrderedAndProject."""
    return df.orderBy(F.desc_nulls_first(col), F.asc(tiebreak)).limit(n)


def franchise_performance(orders: DataFrame, locations: DataFrame, reviews: DataFrame) -> DataFrame:
    """Franchise view per location x week.  Reviews are left-joined on the
    order as in the source (an order with k reviews counts k times); they are
    reduced to one row per order first."""
    r = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum("overall_rating").alias("rating_sum"),
        F.count("overall_rating").alias("rating_n"))
    o = orders.join(r, "order_id", "left")
    o = dim_join(o, locations.select("location_id", "location_name"), "location_id")
    w = F.coalesce(F.col("n_reviews"), F.lit(1))
    per = o.select("location_name", timefn.week_start("order_timestamp").alias("week_starting"),
                   (F.col("total_amount") * w).alias("total_w"),
                   F.when(F.col("total_amount").isNotNull(), w).alias("total_n"),
                   "rating_sum", "rating_n")
    g = per.groupBy("location_name", "week_starting").agg(
        F.count(F.lit(1)).alias("weekly_orders"),
        F.sum("total_w").alias("rev"), F.sum("total_n").alias("rev_n"),
        F.sum("rating_sum").alias("rs"), F.sum("rating_n").alias("rn"))
    return g.select(
        "location_name", "week_starting", "weekly_orders",
        F.round("rev", 2).alias("weekly_revenue"),
        money.round_avg("rev", "rev_n", 2).alias("avg_order_value"),
        money.round_avg("rs", "rn", 2).alias("avg_rating"),
        F.round(F.col("rev") * F.lit(0.06).cast("decimal(3,2)"), 2).alias("franchise_royalty"))


def restricted_orders(orders: DataFrame, locations: DataFrame, role: str,
                      location_id: int | None) -> DataFrame:
    """Row-restricted view: the caller's location, or every row for ADMIN /
    CORPORATE.  Role and location are arguments, never session globals."""
    o = dim_join(orders, locations.select("location_id", "location_name"), "location_id")
    if role not in ("ADMIN", "CORPORATE"):
        o = o.filter(F.col("location_id") == F.lit(location_id))
    return o.select("order_id", "order_timestamp", "order_type", "total_amount", "order_status",
                    "location_name")


def hourly_sales(orders: DataFrame) -> DataFrame:
    """Materialised hourly sales per date x hour x location."""
    t = F.col("order_type")
    return orders.groupBy(
        timefn.to_day("order_timestamp").alias("order_date"),
        F.hour("order_timestamp").alias("order_hour"), "location_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("total_revenue"),
        money.avg("total_amount").alias("avg_order_value"),
        F.sum(F.when(t == "DELIVERY", 1).otherwise(0)).alias("delivery_count"),
        F.sum(F.when(t == "PICKUP", 1).otherwise(0)).alias("pickup_count"),
        F.sum(F.when(t == "DINE_IN", 1).otherwise(0)).alias("dine_in_count"))
