"""Join helpers.

Broadcasting is left to the planner: with AQE on, a join side whose measured
shuffle output is under ``spark.sql.autoBroadcastJoinThreshold`` is switched to
a broadcast hash join at runtime, and anything larger stays a sort-merge join.
That runtime measurement is the size check; an explicit hint is given only for
sides whose size is bounded by construction (a handful of literal rows).
Global statistics reach the rows as scalar subqueries, never as joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Fact-to-dimension equi-join; the planner decides broadcast vs shuffle."""
    return fact.join(dim, on, how)


def attach_constants(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (global statistics) to every row
    as an uncorrelated scalar subquery: it is computed once, reused for each
    column, and involves no join at all.  More than one row is an error."""
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("__s")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in cols])


def fixed_rows(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A tiny literal table (parameters such as promotion definitions)."""
    return spark.createDataFrame(rows, schema)
