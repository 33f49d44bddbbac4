"""Customer analytics: RFM segments, sales anomalies and item recommendations.

The source pulls each query result into one process and scores it with
pandas; here the scoring stays distributed: quintiles come from a few boundary
rows (``operators.selection``), group statistics from grouped aggregates joined back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, timefn
from ..operators.joins import attach_constants, dim_join
from ..operators.ranking import quintile_bounds
from ..operators.selection import rows_at

NO_ORDER_RECENCY = 999
RANKED = ("frequency", "monetary_cents")  # scored by rank; recency by value
QUINTILES = (1, 2, 3, 4)  # their upper edges


def rfm_base(customers: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    per = orders.groupBy("customer_id").agg(
        F.max("order_timestamp").alias("last_ts"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("total_amount").alias("monetary"))
    c = customers.select("customer_id", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))
                         .alias("customer_name")).join(per, "customer_id", "left")
    return c.select(
        "customer_id", "customer_name",
        F.coalesce(timefn.days_between("last_ts", timefn.date_lit(as_of)), F.lit(NO_ORDER_RECENCY))
         .cast("bigint").alias("recency_days"),
        F.coalesce(F.col("frequency"), F.lit(0)).cast("bigint").alias("frequency"),
        F.coalesce(F.col("monetary").cast("double"), F.lit(0.0)).alias("monetary"),
        F.coalesce((F.col("monetary") * 100).cast("bigint"), F.lit(0).cast("bigint")).alias("monetary_cents"))


def rfm_segment(r, f, m):
    """Fixed rules, first match wins."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
            .when((r >= 4) & (f <= 2), "New Customers")
            .when((r <= 2) & (f >= 3), "At Risk")
            .when((r <= 2) & (f <= 2) & (m >= 3), "Cant Lose Them")
            .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
            .when((r >= 3) & (f >= 2), "Potential Loyalists")
            .otherwise("Need Attention"))


def rfm_segments(customers: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    """RFM scores 1..5 and segment per customer.

    r: quintile bins of recency on its values (edges by linear interpolation,
    bins right-closed, labels reversed; tied edges skip scores instead of
    failing).  f, m: quintiles of the ordinal rank (ties broken by customer id).
    """
    # Of each measure a few boundary rows are selected (no sort, nothing stored), and
    # every customer is compared with them.
    base = rfm_base(customers, orders, as_of)
    measure = lambda name: F.struct(F.lit(name).alias("measure"), F.col(name).cast("bigint").alias("v"), "customer_id")
    rows = base.select(F.explode(F.array(*map(measure, ("recency_days", *RANKED)))).alias("m")).select("m.*")
    at = rows_at(rows, "measure", "v", "customer_id", 5, next_too=True)
    bounds = quintile_bounds(at, "measure", "v", "customer_id")
    one = lambda name, k, c: F.max(F.when((F.col("measure") == name) & (F.col("k") == k), F.col(c)))
    bounds = bounds.agg(*[one("recency_days", k, "edge").alias(f"edge_{k}") for k in QUINTILES],
                        *[one(name, k, "cut").alias(f"{name}_{k}") for name in RANKED for k in QUINTILES])
    scored = attach_constants(base, bounds)

    def above(*tests: Column) -> Column:
        return sum((F.when(t, 1).otherwise(0) for t in tests), F.lit(0)).cast("bigint")

    def over_edge(k: int) -> Column:
        lo, hi, m = (F.col(f"edge_{k}")[part] for part in ("lo", "hi", "m"))
        return F.col("recency_days") * 5 > lo * 5 + m * (hi - lo)

    def rank_score(name: str) -> Column:
        own = F.struct(F.col(name).alias("v"), "customer_id")
        return above(*[own > F.col(f"{name}_{k}") for k in QUINTILES]) + 1

    scored = scored.withColumns({"r_score": 5 - above(*[over_edge(k) for k in QUINTILES]),
                                 "f_score": rank_score("frequency"), "m_score": rank_score("monetary_cents")})
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select("customer_id", "customer_name", "recency_days", "frequency", "monetary",
                     "r_score", "f_score", "m_score", rfm_segment(r, f, m).alias("rfm_segment"))


def sales_anomalies(daily_sales: DataFrame, locations: DataFrame, as_of: dt.date, lookback_days: int | None = 90,
                    threshold: float = 2.0, min_points: int = 4) -> DataFrame:
    """Days whose revenue is more than ``threshold`` sample deviations from the
    mean of the same location and weekday (groups of at least ``min_points``
    days and non-zero deviation).

    ``lookback_days=None`` takes the whole history.

    Group sums of x and x^2 are exact decimals, so a zero deviation is
    detected exactly; the group statistics are joined back to the days.
    """
    ds = daily_sales
    if lookback_days is not None:
        ds = ds.filter(F.col("sales_date") >= timefn.date_lit(as_of - dt.timedelta(days=lookback_days)))
    return flag_anomalies(ds, revenue_moments(ds), locations, threshold, min_points)


def revenue_moments(days: DataFrame, retracted: Column | None = None) -> DataFrame:
    """Number of days and exact sums of revenue and its square per location and weekday.
    They add up, and a day that is ``retracted`` is taken away again, so that they
    can be kept batch by batch."""
    x = F.col("total_revenue")
    day, square = F.when(x.isNotNull(), 1).otherwise(0), x * x
    if retracted is not None:
        day, x, square = (F.when(retracted, -c).otherwise(c) for c in (day, x, square))
    return days.groupBy("location_id", timefn.day_of_week0("sales_date").alias("dow")).agg(
        F.sum(day).alias("cnt"), F.sum(x).alias("sx"), F.sum(square).alias("sxx"))


def flag_anomalies(days: DataFrame, moments: DataFrame, locations: DataFrame, threshold: float,
                   min_points: int) -> DataFrame:
    """The days that are far from the mean of their location and weekday."""
    ds = dim_join(days, locations.select("location_id", "location_name"), "location_id")
    ds = ds.select("sales_date", "location_id", "location_name", "total_revenue",
                   timefn.day_of_week0("sales_date").alias("dow"))
    x = F.col("total_revenue")
    num = F.col("cnt") * F.col("sxx") - F.col("sx") * F.col("sx")
    g = moments.filter((F.col("cnt") >= min_points) & (num != 0)).select(
        "location_id", "dow",
        money.mean("sx", "cnt").alias("expected_revenue"),
        F.sqrt(num.cast("double") / (F.col("cnt") * (F.col("cnt") - 1)).cast("double")).alias("std_dev"))
    j = ds.join(g, ["location_id", "dow"])
    z = (x.cast("double") - F.col("expected_revenue")) / F.col("std_dev")
    j = j.withColumn("z_score", z).filter(F.abs(F.col("z_score")) > threshold)
    return j.select(
        F.col("sales_date").alias("anomaly_date"), "location_id", "location_name",
        x.cast("double").alias("actual_revenue"), "expected_revenue", "std_dev", "z_score",
        F.when(F.col("z_score") > 0, "HIGH").otherwise("LOW").alias("anomaly_type"))


def one_decimal(v: Column) -> Column:
    """A non-negative double with one decimal, rounded half even on its exact
    binary value (as ``f"{v:.1f}"`` does in Python)."""
    tenth = F.floor(v * 10).cast("double")
    tenth = F.when(tenth / 10 > v, tenth - 1).otherwise(tenth)
    tie = (tenth * 10 + 5) / 100  # the double nearest to the middle
    # Where the exact middle lies: the error-free product of the tie and 20.
    split = tie * 134217729.0
    high = split - (split - tie)
    product = tie * 20
    error = (product - (tenth * 2 + 1)) + ((high * 20 - product) + (tie - high) * 20)
    up = (v > tie) | ((v == tie) & ((error > 0) | ((error == 0) & (tenth % 2 == 1))))
    return F.when(v.isNotNull(), F.format_string("%.1f", (tenth + F.when(up, 1).otherwise(0)) / 10))


def recommend_items(orders: DataFrame, items: DataFrame, menu: DataFrame, categories: DataFrame,
                    reviews: DataFrame, customer_id: int, n: int | None = 5,
                    fallback_category: int = 1) -> DataFrame:
    """Items for one customer from customers who bought any of the same items
    (the best ``n``, or with None all of them).

    Neighbours are found with a semi join on the customer's item set, so the
    work is one pass over orders and lines whatever the neighbour count.
    Candidate statistics follow the source query: distinct orders and
    customers among neighbours' orders, and the mean rating over the joined
    (line x review) rows with a missing rating counted as 4.
    """
    o = orders.select("order_id", "customer_id")
    lines = items.select("order_id", "item_id")
    ol = o.join(lines, "order_id")
    mine = ol.filter(F.col("customer_id") == customer_id).select("item_id").distinct()
    # No broadcast hint: Spark broadcasts the item set if its measured size allows.
    neighbours = (ol.filter(F.col("customer_id") != customer_id)
                  .join(mine, "item_id", "left_semi").select("customer_id").distinct())
    r = reviews.groupBy("order_id").agg(F.count(F.lit(1)).alias("nr"),
                                        F.sum(F.coalesce(F.col("overall_rating"), F.lit(4))).alias("rs"))
    cand = (ol.join(neighbours, "customer_id", "left_semi")
            .join(menu.filter(F.col("is_available")).select("item_id", "item_name", "category_id"), "item_id")
            .join(r, "order_id", "left"))
    cand = dim_join(cand, categories.select("category_id", "category_name"), "category_id")
    w = F.coalesce(F.col("nr"), F.lit(1))
    rsum = F.coalesce(F.col("rs"), F.lit(4))
    # Distinct orders and customers per item in three grouping levels (each
    # combines map-side) rather than one multi-distinct expand.
    item_keys = ["item_id", "item_name", "category_name"]
    per_order = cand.groupBy(*item_keys, "customer_id", "order_id").agg(
        F.sum(rsum).alias("rs"), F.sum(w).alias("ws"))
    per_cust = per_order.groupBy(*item_keys, "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("rs").alias("rs"), F.sum("ws").alias("ws"))
    stats = per_cust.groupBy(*item_keys).agg(
        F.sum("orders").alias("order_count"),
        F.count(F.lit(1)).alias("customer_count"),
        money.mean(F.sum("rs"), F.sum("ws")).alias("avg_rating"))
    stats = stats.join(mine, "item_id", "left_anti")
    maxes = stats.agg(F.max("order_count").alias("max_orders"), F.max("customer_count").alias("max_customers"),
                      F.count(F.lit(1)).alias("n_candidates"))
    s = attach_constants(stats, maxes)
    raw = ((F.col("order_count") / F.col("max_orders")) * 0.4 + (F.col("customer_count") / F.col("max_customers")) * 0.3
           + (F.col("avg_rating") / 5.0) * 0.3)
    s = s.withColumn("recommendation_score", F.rint(raw * 1000) / 1000)
    top = s if n is None else s.orderBy(F.desc("recommendation_score"), F.desc("order_count"), "item_id").limit(n)
    reason = (F.when(F.col("customer_count") > 10,
                     F.concat(F.lit("Popular with "), F.col("customer_count").cast("string"),
                              F.lit(" similar customers")))
              .when(F.col("avg_rating") >= 4.5,
                    F.concat(F.lit("Highly rated ("), one_decimal(F.col("avg_rating")), F.lit(" stars)")))
              .otherwise(F.lit("Recommended based on your taste")))
    # The text is made for the chosen rows only.
    top = (top.withColumn("reason", reason)
           .select("item_id", "item_name", "category_name", "recommendation_score", "reason"))
    # Fallback when no candidate exists: first five available items of the
    # fallback category, score 0.5.
    fb = menu.filter(F.col("is_available") & (F.col("category_id") == fallback_category))
    fb = dim_join(fb, categories.select("category_id", "category_name"), "category_id")
    fb = fb.orderBy("item_id").limit(5).select(
        "item_id", "item_name", "category_name", F.lit(0.5).alias("recommendation_score"),
        F.lit("Popular item").alias("reason"))
    fb = (attach_constants(fb, maxes).filter(F.col("n_candidates") == 0)
          .drop("max_orders", "max_customers", "n_candidates"))
    return top.unionByName(fb).withColumn("customer_id", F.lit(customer_id).cast("bigint"))


def customer_360(customers: DataFrame, orders: DataFrame, items: DataFrame, menu: DataFrame,
                 reviews: DataFrame, segments: DataFrame, as_of: dt.date,
                 updated_at: Column | None = None) -> DataFrame:
    """Customer 360 (the source declares the columns but no query; this is
    our definition): order history, favourite item by quantity (ties to the
    lowest item id), most frequent order type, mean rating given, RFM segment
    and order rate.  Every part is a keyed aggregate joined on customer_id."""
    per = orders.groupBy("customer_id").agg(
        F.min("order_timestamp").alias("first_ts"), F.max("order_timestamp").alias("last_ts"),
        F.count(F.lit(1)).alias("total_orders"), F.sum("total_amount").alias("total_revenue"),
        F.count("total_amount").alias("n_total"),
        F.mode("order_type", True).alias("preferred_order_type"))
    qty = (orders.select("order_id", "customer_id").join(items.select("order_id", "item_id", "quantity"), "order_id")
           .groupBy("customer_id", "item_id").agg(F.sum("quantity").alias("q")))
    fav = qty.groupBy("customer_id").agg(
        F.max_by("item_id", F.struct(F.col("q"), -F.col("item_id"))).alias("fav_item"))
    fav = fav.join(menu.select(F.col("item_id").alias("fav_item"), F.col("item_name").alias("favorite_pizza")),
                   "fav_item", "left")
    rat = reviews.groupBy("customer_id").agg(F.sum("overall_rating").alias("rs"), F.count("overall_rating").alias("rn"))
    c = (customers.drop("preferred_order_type").join(per, "customer_id", "left").join(fav, "customer_id", "left")
         .join(rat, "customer_id", "left").join(segments.select("customer_id", "rfm_segment"), "customer_id", "left"))
    first_d, last_d = F.to_date("first_ts"), F.to_date("last_ts")
    lifetime = F.datediff(last_d, first_d)
    n = F.coalesce(F.col("total_orders"), F.lit(0))
    return c.select(
        "customer_id", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
        "email", "city", _column_or_null(customers, "state"), "registration_date",
        first_d.alias("first_order_date"), last_d.alias("last_order_date"),
        F.datediff(timefn.date_lit(as_of), last_d).alias("days_since_last_order"),
        n.alias("total_orders"),
        F.col("total_revenue").cast("decimal(12,2)").alias("total_revenue"),
        F.round(money.exact_ratio("total_revenue", "n_total"), 2).cast("decimal(8,2)").alias("avg_order_value"),
        "favorite_pizza", "preferred_order_type",
        F.round(money.exact_ratio("rs", "rn"), 2).cast("decimal(3,2)").alias("avg_rating_given"),
        "loyalty_points", F.col("rfm_segment").alias("customer_segment"),
        lifetime.alias("lifetime_days"),
        F.round(money.exact_ratio(n * 30, F.greatest(lifetime, F.lit(30))), 2).cast("decimal(6,2)")
         .alias("orders_per_month"),
        (timefn.ts_lit(as_of) if updated_at is None else updated_at).alias("last_updated"))


def _column_or_null(df: DataFrame, name: str) -> Column:
    """A column that not every source of the table has."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string").alias(name)
