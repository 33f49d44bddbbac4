"""Bodies of the change-driven jobs (order log, review sentiment, inventory
alerts, customer history).  Each takes one batch of changes and returns the
rows to append; ``streaming.feeds.AppendFeed`` and ``streaming.keyed`` run them
per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import lexicon_score
from ..functions.variant import json_text, object_of
from ..operators.changes import ACTION, IS_UPDATE

POSITIVE_AT = 0.3
NEGATIVE_AT = -0.3


def sentiment_labels(reviews: DataFrame, scorer: Callable[[Column], Column] = lexicon_score) -> DataFrame:
    """Score each review with text once, then label: POSITIVE at >= 0.3,
    NEGATIVE at <= -0.3, else NEUTRAL; negative reviews need a response."""
    r = reviews.filter(F.col("review_text").isNotNull())
    r = r.withColumn("sentiment_score", scorer(F.col("review_text")))
    s = F.col("sentiment_score")
    return r.select(
        "review_id", "review_text", "sentiment_score",
        F.when(s >= POSITIVE_AT, "POSITIVE").when(s <= NEGATIVE_AT, "NEGATIVE").otherwise("NEUTRAL")
         .alias("sentiment_label"),
        F.when(s <= NEGATIVE_AT, True).otherwise(False).alias("requires_response"))


def alert_type(quantity: Column, reorder_point: Column) -> Column:
    return F.when(quantity == 0, "OUT_OF_STOCK").when(quantity <= reorder_point * 0.5, "CRITICAL").otherwise("LOW_STOCK")


def inventory_alerts(changes: DataFrame, ingredients: DataFrame, open_alerts: DataFrame | None,
                     dedupe: bool = False) -> DataFrame:
    """Alerts for inserted inventory images at or below the reorder point.

    A (location, ingredient) that already has an OPEN alert in the alert table
    as it was when the batch started is skipped (anti join on both keys).  Two
    changes of one key inside the batch both alert, as the source's NOT EXISTS
    only sees older alerts; ``dedupe=True`` keeps one alert per key and
    batch (the lowest quantity), as a keyed ``min_by`` aggregate.
    """
    c = changes.filter((F.col("quantity_on_hand") <= F.col("reorder_point")) & (F.col(ACTION) == "INSERT"))
    c = c.join(ingredients.select("ingredient_id", "ingredient_name"), "ingredient_id", "inner")
    if open_alerts is not None:
        existing = open_alerts.filter(F.col("alert_status") == "OPEN").select("location_id", "ingredient_id").distinct()
        c = c.join(existing, ["location_id", "ingredient_id"], "left_anti")
    q, rp = F.col("quantity_on_hand"), F.col("reorder_point")
    if dedupe:
        keys = ["location_id", "ingredient_id"]
        c = c.groupBy(*keys).agg(F.min_by(F.struct(*[x for x in c.columns if x not in keys]), q).alias("__r"))
        c = c.select(*keys, "__r.*")
    return c.select(
        "location_id", "ingredient_id", "ingredient_name",
        q.alias("current_quantity"), rp.alias("reorder_point"),
        alert_type(q, rp).alias("alert_type"),
        F.lit("OPEN").alias("alert_status"), *[c for c in ("record_date",) if c in changes.columns])


HISTORY_FIELDS = ["first_name", "last_name", "email", "phone", "address", "loyalty_points"]


def customer_history(changes: DataFrame) -> DataFrame:
    """One history row per change image: UPDATE for both halves of an update,
    else the action; the image's profile fields as a JSON object (NULL
    fields left out)."""
    values = object_of(**{f: F.col(f) for f in HISTORY_FIELDS})
    return changes.select(
        "customer_id",
        F.when(F.col(IS_UPDATE), "UPDATE").otherwise(F.col(ACTION)).alias("change_type"),
        json_text(values).alias("new_values"))
