"""Domain tables of the star model, derived from the driver's TPC-H-style parquet.

Every table is a lazy DataFrame: Catalyst prunes the columns a job does not use
and pushes date predicates into the parquet scan.  The mapping is plain
arithmetic and CASE so the DuckDB oracle can repeat it row for row.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import dec

# Fixed values of the mapping (reference times of the test data).
AS_OF_ORDERS = dt.date(2001, 8, 2)
REGISTRATION_EPOCH = dt.date(1995, 1, 1)
BIRTHDAY_EPOCH = dt.date(1970, 1, 1)
TAX_RATE = Decimal("0.08")
COST_SHARE = Decimal("0.6")
REORDER_POINT = Decimal("25.00")
N_LOCATIONS = 25


# Declared schemas of the driver's input tables.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = F.when(col == key, F.lit(value)) if expr is None else expr.when(col == key, F.lit(value))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _ts(value) -> Column:
    """A timestamp_ntz literal."""
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value).cast("timestamp_ntz")


class Star:
    """Lazy domain tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """Typed scan: the declared schema is given to the reader, so no file
        footer is read on the driver to infer it (thousands of files at scale).
        One relation per table and instance (lazy; nothing is cached)."""
        if name not in self._raw:
            reader = self.spark.read
            if name in RAW_SCHEMAS:
                reader = reader.schema(RAW_SCHEMAS[name])
            self._raw[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    # ------------------------------------------------------------------ facts
    def fact_order(self, since=None, until=None) -> DataFrame:
        """FACT_ORDER.  ``since``/``until`` bound ``order_timestamp`` (inclusive /
        exclusive); a widened bound on the raw date column is added so parquet
        statistics prune row groups before the derivation runs."""
        o = self.raw("orders")
        if since is not None:
            o = o.filter(F.col("o_orderdate") >= _ts(since) - F.expr("INTERVAL 1 DAY"))
        if until is not None:
            o = o.filter(F.col("o_orderdate") < _ts(until))
        key = F.col("o_orderkey")
        ts = (F.col("o_orderdate")
              + F.make_dt_interval(F.lit(0), (key % 24).cast("int"), (key % 60).cast("int"), F.lit(0)))
        total = F.col("o_totalprice").cast(dec(10, 2))
        tax = F.round(total * F.lit(TAX_RATE), 2).cast(dec(10, 2))
        tip = (key % 5).cast(dec(10, 2))
        order_type = _case(F.col("o_orderpriority"), {"1-URGENT": "DELIVERY", "2-HIGH": "PICKUP"}, "DINE_IN")
        df = o.select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (key % 10 + 1).alias("employee_id"),
            (key % N_LOCATIONS).alias("location_id"),
            ts.alias("order_timestamp"),
            order_type.alias("order_type"),
            (total - tax - tip).cast(dec(10, 2)).alias("subtotal"),
            tax.alias("tax_amount"),
            tip.alias("tip_amount"),
            F.lit(Decimal("0.00")).cast(dec(10, 2)).alias("discount_amount"),
            total.alias("total_amount"),
            _case(F.col("o_custkey") % 3, {0: "CREDIT", 1: "CASH"}, "MOBILE").alias("payment_method"),
            _case(F.col("o_orderstatus"), {"F": "COMPLETED", "O": "PENDING", "P": "PREPARING"}).alias("order_status"),
            F.when(order_type == "DELIVERY",
                   F.concat(F.col("o_custkey").cast("string"), F.lit(" Main St"))).alias("delivery_address"),
            (ts + F.expr("INTERVAL 20 MINUTES")).alias("estimated_ready_time"),
            (ts + F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(10) + key % 35).cast("int"), F.lit(30))
             ).alias("actual_ready_time"),
        )
        if since is not None:
            df = df.filter(F.col("order_timestamp") >= _ts(since))
        if until is not None:
            df = df.filter(F.col("order_timestamp") < _ts(until))
        return df

    def fact_order_item(self) -> DataFrame:
        """FACT_ORDER_ITEM; the source has no unique line id, so none is made."""
        li = self.raw("lineitem")
        return li.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast(dec(10, 2)).alias("line_total"),
        ).withColumn(
            "unit_price",
            F.expr("cast((cast(line_total * 100 as bigint) div quantity) * 0.01 as decimal(8,2))"))

    def fact_review(self, with_text: bool = True) -> DataFrame:
        """FACT_REVIEW: purchase/click events that hit an order; text by doc id
        (``with_text=False`` for callers that don't read it: no join to the
        documents)."""
        ev = self.raw("events").filter(F.col("event_type").isin("purchase", "click"))
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        joined = ev.join(orders, ev.event_id == orders.o_orderkey, "inner")
        if with_text:
            docs = self.raw("documents").select(F.col("doc_id"), F.col("text").alias("review_text"))
            joined = joined.join(docs, joined.event_id == docs.doc_id, "left")
        return joined.select(
            F.col("event_id").alias("review_id"),
            F.col("event_id").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % N_LOCATIONS).alias("location_id"),
            F.col("ts").alias("review_date"),
            (F.floor(F.col("value")) % 7).cast("int").alias("overall_rating"),
            *([F.col("review_text")] if with_text else []),
            _case(F.col("event_id") % 4, {0: "WEBSITE", 1: "GOOGLE", 2: "YELP"}, "DOORDASH").alias("review_source"),
        )

    def fact_inventory(self, since=None) -> DataFrame:
        """FACT_INVENTORY rows (used as the inventory change feed)."""
        li = self.raw("lineitem")
        if since is not None:
            li = li.filter(F.col("l_shipdate") >= _ts(since))
        return li.select(
            F.col("l_suppkey").alias("location_id"),
            F.col("l_partkey").alias("ingredient_id"),
            F.to_date("l_shipdate").alias("record_date"),
            (F.col("l_quantity") - 1).cast(dec(10, 2)).alias("quantity_on_hand"),
            F.lit(REORDER_POINT).cast(dec(10, 2)).alias("reorder_point"),
        )

    # ------------------------------------------------------------- dimensions
    def dim_location(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(
            F.col("n_nationkey").cast("bigint").alias("location_id"),
            F.col("n_name").alias("location_name"),
            F.col("n_name").alias("city"),
            (F.lit(40) + F.col("n_nationkey")).alias("seating_capacity"),
            F.lit("11:00:00").alias("opening_time"),
            F.lit("22:00:00").alias("closing_time"),
            F.lit(True).alias("has_delivery"),
        )

    def dim_category(self) -> DataFrame:
        """Category id = 1-based position of ``p_type`` in its sorted distinct list.

        The distinct list is the bounded domain of part types, so ranking it in
        one window is cheap and independent of the fact size.
        """
        types = self.raw("part").select("p_type").distinct()
        from pyspark.sql.window import Window
        w = Window.orderBy("p_type")
        return types.select(
            F.row_number().over(w).cast("bigint").alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.lit(None).cast("string").alias("description"),
            F.row_number().over(w).alias("display_order"),
        )

    def dim_menu_item(self, with_category: bool = True) -> DataFrame:
        """DIM_MENU_ITEM.  Every part has a type, so the category join never
        drops an item; ``with_category=False`` skips it for callers that only
        read names and prices."""
        p = self.raw("part")
        price = F.col("p_retailprice").cast(dec(8, 2))
        if not with_category:
            return p.select(
                F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"), price.alias("base_price"),
                F.round(price * F.lit(COST_SHARE), 2).cast(dec(8, 2)).alias("cost_to_make"),
                (F.col("p_size") % 7 != 0).alias("is_available"))
        cat = self.dim_category().select("category_id", F.col("category_name").alias("p_type"))
        return p.join(cat, "p_type").select(
            F.col("p_partkey").alias("item_id"),
            F.col("category_id"),
            F.col("p_name").alias("item_name"),
            price.alias("base_price"),
            F.round(price * F.lit(COST_SHARE), 2).cast(dec(8, 2)).alias("cost_to_make"),
            (F.col("p_size") % 7 != 0).alias("is_available"),
        )

    def dim_ingredient(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            F.col("p_partkey").alias("ingredient_id"),
            F.col("p_name").alias("ingredient_name"),
            F.lit("EACH").alias("unit_of_measure"),
        )

    def dim_customer(self, variant: str = "current") -> DataFrame:
        """DIM_CUSTOMER.  ``variant`` 'before'/'after' gives the two snapshots
        used by the change-capture jobs."""
        c = self.raw("customer")
        n = self.raw("nation").select(F.col("n_nationkey"), F.col("n_name").alias("city"))
        key = F.col("c_custkey")
        acct = F.col("c_acctbal")
        if variant == "before":
            c = c.filter(key % 10 != 0)
        elif variant == "after":
            c = c.filter(key % 10 != 1)
            acct = F.when(key % 10 == 2, acct + 1).otherwise(acct)
        c = c.join(n, c.c_nationkey == n.n_nationkey, "left")
        parts = F.split(F.col("c_name"), "#")
        return c.select(
            key.alias("customer_id"),
            parts.getItem(0).alias("first_name"),
            parts.getItem(1).alias("last_name"),
            F.when(key % 250 == 7, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("u"), (key % 1400).cast("string"), F.lit("@x"))).alias("email"),
            F.concat(F.lit("555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
            F.concat(key.cast("string"), F.lit(" Main St")).alias("address"),
            F.col("city"),
            F.date_add(F.lit(REGISTRATION_EPOCH), (key % 2400).cast("int")).alias("registration_date"),
            F.floor(F.abs(acct)).cast("int").alias("loyalty_points"),
            _case(key % 3, {0: "DELIVERY", 1: "PICKUP"}, "DINE_IN").alias("preferred_order_type"),
            F.date_add(F.lit(BIRTHDAY_EPOCH), (key * 37 % 12000).cast("int")).alias("birthday"),
        )
