import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ovenbird.operators import changes
from ovenbird.plans import analytics, change_jobs, jobs, quality


def test_loyalty_sample_and_tiers(spark):
    cust = spark.createDataFrame([(1, 60), (2, 950), (3, 0)], "customer_id bigint, loyalty_points int")
    batch = spark.createDataFrame([(1, Decimal("45.99"), None), (2, Decimal("10.00"), 60), (4, Decimal("5.00"), None)],
                                  "customer_id bigint, order_total decimal(10,2), points_earned int")
    out = {r.customer_id: r for r in jobs.loyalty_update(cust, batch).collect()}
    assert (out[1].points_earned, out[1].points_after, out[1].loyalty_tier) == (45, 105, "BRONZE")
    assert (out[2].points_after, out[2].loyalty_tier) == (1010, "GOLD")
    assert out[4].points_before is None and out[4].loyalty_tier == "MEMBER"


def test_promotion_definitions(spark):
    start = dt.date(2024, 3, 5)
    rows = {r.target_segment: r for r in jobs.promotions(spark, start, start + dt.timedelta(days=30), 20).collect()}
    assert rows["LAPSED_CUSTOMERS"].promo_code == "COMEBACK0305" and rows["LAPSED_CUSTOMERS"].discount_percent == 20
    assert rows["BIRTHDAY_MONTH"].discount_percent == 100 and rows["VIP_CUSTOMERS"].discount_percent == 25
    assert rows["VIP_CUSTOMERS"].description == "VIP Exclusive: 25% off"


def test_quality_checks_count_null_email_group(spark):
    orders = spark.createDataFrame([(1, None, Decimal("5")), (2, 7, Decimal("-1"))],
                                   "order_id bigint, customer_id bigint, total_amount decimal(10,2)")
    items = spark.createDataFrame([(1,), (3,)], "order_id bigint")
    reviews = spark.createDataFrame([(0,), (3,), (None,)], "overall_rating int")
    cust = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "customer_id bigint, email string")
    out = {r.check_name: (r.status, r.issue_count) for r in quality.run_quality_checks(orders, items, reviews, cust).collect()}
    assert out == {"Null Customer ID": ("FAIL", 1), "Negative Totals": ("FAIL", 1),
                   "Orphaned Order Items": ("FAIL", 1), "Invalid Ratings": ("FAIL", 1),
                   "Duplicate Emails": ("WARN", 2)}


def test_sentiment_thresholds_with_pluggable_scorer(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None)], "review_id bigint, review_text string")
    scores = {"x": 0.3, "y": -0.3, "z": 0.0}
    scorer = lambda c: F.when(c == "x", 0.3).when(c == "y", -0.3).otherwise(0.0)
    out = {r.review_id: r for r in change_jobs.sentiment_labels(df, scorer).collect()}
    assert set(out) == {1, 2, 3}
    assert (out[1].sentiment_label, out[1].requires_response) == ("POSITIVE", False)
    assert (out[2].sentiment_label, out[2].requires_response) == ("NEGATIVE", True)
    assert out[3].sentiment_label == "NEUTRAL" and scores


def test_inventory_alerts_rules(spark):
    ch = changes.insert_feed(spark.createDataFrame(
        [(1, 10, Decimal("0"), Decimal("20")), (1, 11, Decimal("10"), Decimal("20")), (1, 12, Decimal("20"), Decimal("20")),
         (1, 12, Decimal("15"), Decimal("20")), (2, 10, Decimal("5"), Decimal("20")), (3, 10, Decimal("25"), Decimal("20"))],
        "location_id bigint, ingredient_id bigint, quantity_on_hand decimal(10,2), reorder_point decimal(10,2)"))
    ing = spark.createDataFrame([(10, "flour"), (11, "salt"), (12, "oil")], "ingredient_id bigint, ingredient_name string")
    open_alerts = spark.createDataFrame([(2, 10, "OPEN")], "location_id bigint, ingredient_id bigint, alert_status string")
    out = sorted((r.location_id, r.ingredient_id, r.alert_type) for r in
                 change_jobs.inventory_alerts(ch, ing, open_alerts).collect())
    # OUT_OF_STOCK at 0, CRITICAL at exactly half, LOW_STOCK at the point; two
    # changes of one key both alert; an existing OPEN alert suppresses.
    assert out == [(1, 10, "OUT_OF_STOCK"), (1, 11, "CRITICAL"), (1, 12, "LOW_STOCK"), (1, 12, "LOW_STOCK")]


def test_sales_anomaly_group_rules(spark):
    rows = []
    base = dt.date(2024, 1, 1)  # Monday
    for w in range(8):  # Mondays of location 1: one spike
        rows.append((base + dt.timedelta(weeks=w), 1, Decimal("100.00") if w != 5 else Decimal("900.00")))
    for w in range(3):  # Tuesdays of location 1: only three points
        rows.append((base + dt.timedelta(weeks=w, days=1), 1, Decimal("1000.00") * (w + 1)))
    for w in range(6):  # Mondays of location 2: zero deviation
        rows.append((base + dt.timedelta(weeks=w), 2, Decimal("50.00")))
    ds = spark.createDataFrame(rows, "sales_date date, location_id bigint, total_revenue decimal(12,2)")
    loc = spark.createDataFrame([(1, "A"), (2, "B")], "location_id bigint, location_name string")
    out = analytics.sales_anomalies(ds, loc, dt.date(2024, 3, 1), lookback_days=365, threshold=2.0).collect()
    assert [(r.anomaly_date, r.anomaly_type) for r in out] == [(base + dt.timedelta(weeks=5), "HIGH")]


def test_inventory_alerts_dedupe(spark):
    ch = changes.insert_feed(spark.createDataFrame(
        [(1, 12, Decimal("20"), Decimal("20")), (1, 12, Decimal("5"), Decimal("20"))],
        "location_id bigint, ingredient_id bigint, quantity_on_hand decimal(10,2), reorder_point decimal(10,2)"))
    ing = spark.createDataFrame([(12, "oil")], "ingredient_id bigint, ingredient_name string")
    out = change_jobs.inventory_alerts(ch, ing, None, dedupe=True).collect()
    assert [(r.ingredient_id, r.alert_type) for r in out] == [(12, "CRITICAL")]


def test_recommendation_fallback_when_no_neighbours(spark):
    orders = spark.createDataFrame([(1, 7), (2, 8)], "order_id bigint, customer_id bigint")
    items = spark.createDataFrame([(1, 100), (2, 200)], "order_id bigint, item_id bigint")
    menu = spark.createDataFrame([(i, f"item{i}", 1 if i < 108 else 2, True) for i in range(100, 110)] + [(200, "x", 2, True)],
                                 "item_id bigint, item_name string, category_id bigint, is_available boolean")
    cats = spark.createDataFrame([(1, "Pizzas"), (2, "Sides")], "category_id bigint, category_name string")
    reviews = spark.createDataFrame([], "order_id bigint, overall_rating int")
    out = analytics.recommend_items(orders, items, menu, cats, reviews, customer_id=7, n=5).collect()
    assert [(r.item_id, r.recommendation_score, r.reason) for r in out] == [
        (i, 0.5, "Popular item") for i in range(100, 105)]
