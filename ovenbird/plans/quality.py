"""Data-quality checks: each check is one aggregate over a whole table and
the results are appended into one small table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _check(counted: DataFrame, name: str, table: str, details: str, fail_status: str = "FAIL") -> DataFrame:
    n = F.col("issue_count")
    return counted.select(
        F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
        F.when(n == 0, "PASS").otherwise(fail_status).alias("status"), n, F.lit(details).alias("details"))


def run_quality_checks(orders: DataFrame, items: DataFrame, reviews: DataFrame,
                       customers: DataFrame) -> DataFrame:
    """Five checks, sorted by status descending then name.  Duplicate e-mails
    count groups (all NULL e-mails form one group) and warn; others fail."""
    o = orders.agg(F.count(F.when(F.col("customer_id").isNull(), 1)).alias("null_customer"),
                   F.count(F.when(F.col("total_amount") < 0, 1)).alias("negative"))
    both = o.select(F.explode(F.array(  # one scan for the two checks of orders
        F.struct(F.lit("Null Customer ID").alias("name"), F.lit("Orders without customer reference").alias("details"),
                 F.col("null_customer").alias("n")),
        F.struct(F.lit("Negative Totals").alias("name"), F.lit("Orders with negative total_amount").alias("details"),
                 F.col("negative").alias("n")))).alias("c"))
    of_orders = both.select(
        F.col("c.name").alias("check_name"), F.lit("FACT_ORDER").alias("table_name"),
        F.when(F.col("c.n") == 0, "PASS").otherwise("FAIL").alias("status"), F.col("c.n").alias("issue_count"),
        F.col("c.details").alias("details"))
    orphans = items.select("order_id").join(orders.select("order_id"), "order_id", "left_anti")
    orphan = _check(orphans.agg(F.count(F.lit(1)).alias("issue_count")), "Orphaned Order Items",
                    "FACT_ORDER_ITEM", "Order items without parent order")
    bad = reviews.filter(~F.col("overall_rating").between(1, 5))
    ratings = _check(bad.agg(F.count(F.lit(1)).alias("issue_count")), "Invalid Ratings", "FACT_REVIEW",
                     "Reviews with rating outside 1-5 range")
    dup_groups = customers.groupBy("email").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
    dups = _check(dup_groups.agg(F.count(F.lit(1)).alias("issue_count")), "Duplicate Emails", "DIM_CUSTOMER",
                  "Customers with duplicate email addresses", "WARN")
    out = of_orders.unionByName(orphan).unionByName(ratings).unionByName(dups)
    return out.orderBy(F.desc("status"), "check_name")
