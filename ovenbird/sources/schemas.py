"""Declared schemas of the star model and of the tables jobs write.

Ids are ``bigint``; money is ``decimal``; TIME columns are kept as ``HH:mm:ss``
strings because Spark rejects TIME columns in files by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
BOOL = T.BooleanType()
DATE = T.DateType()
TS = T.TimestampNTZType()
DBL = T.DoubleType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _schema(*fields: tuple) -> T.StructType:
    out = []
    for f in fields:
        name, dtype = f[0], f[1]
        nullable = f[2] if len(f) > 2 else True
        out.append(T.StructField(name, dtype, nullable))
    return T.StructType(out)


DIM_CUSTOMER = _schema(
    ("customer_id", ID, False), ("first_name", STR), ("last_name", STR), ("email", STR),
    ("phone", STR), ("address", STR), ("city", STR), ("state", STR), ("zip_code", STR),
    ("registration_date", DATE), ("loyalty_points", INT), ("preferred_order_type", STR),
    ("birthday", DATE))


FACT_ORDER = _schema(
    ("order_id", ID, False), ("customer_id", ID), ("employee_id", ID), ("location_id", ID),
    ("order_timestamp", TS, False), ("order_type", STR), ("subtotal", dec(10, 2)),
    ("tax_amount", dec(10, 2)), ("tip_amount", dec(10, 2)), ("discount_amount", dec(10, 2)),
    ("total_amount", dec(10, 2)), ("payment_method", STR), ("order_status", STR),
    ("delivery_address", STR), ("estimated_ready_time", TS), ("actual_ready_time", TS),
    ("delivery_time", TS), ("special_instructions", STR))


FACT_DAILY_SALES = _schema(
    ("sales_date", DATE, False), ("location_id", ID, False), ("total_orders", INT),
    ("total_revenue", dec(12, 2)), ("avg_order_value", dec(8, 2)), ("dine_in_orders", INT),
    ("pickup_orders", INT), ("delivery_orders", INT), ("total_pizzas_sold", INT),
    ("new_customers", INT), ("weather_condition", STR), ("is_weekend", BOOL),
    ("is_holiday", BOOL))


PARTNER_A = _schema(
    ("order_id", STR), ("restaurant_id", STR), ("customer_name", STR),
    ("order_total", dec(10, 2)), ("delivery_fee", dec(8, 2)), ("tip_amount", dec(8, 2)),
    ("order_placed_at", TS), ("delivered_at", TS), ("driver_rating", INT))

PARTNER_B_ITEM = T.StructType([
    T.StructField("item_id", ID), T.StructField("name", STR), T.StructField("quantity", INT)])


PARTNER_B = _schema(
    ("uber_order_id", STR), ("merchant_id", STR), ("items", T.ArrayType(PARTNER_B_ITEM)),
    ("subtotal", dec(10, 2)), ("service_fee", dec(8, 2)), ("delivery_fee", dec(8, 2)),
    ("created_at", TS))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of a declared table; a column
    that the source lacks is NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
