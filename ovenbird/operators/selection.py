"""Rows at given ranks, found without sorting the rows.

A histogram over the leading bits of the values says which buckets hold a wanted
rank; only their rows are counted again by the next bits, until a bucket is one
value.  Three rounds of 20 bits cover every 64-bit value.  Each round is an
aggregation that combines map-side, and hands on at most as many buckets as there
are wanted ranks; a value that very many rows share is one bucket like any other.
Everything is one lazy plan: no job runs while it is built, nothing is stored.

The wanted ranks are those of the ``parts``-quantiles: of n rows, for k from 1 to
``parts - 1``, rank ``1 + floor(k (n-1) / parts)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHIFTS = (40, 20, 0)


def idiv(a: Column, b: Column) -> Column:
    """Exact quotient, rounded towards zero, of integers below 2**53."""
    return ((a - a % b) / b).cast("bigint")


def wanted_rank(k: int | Column, n: Column, parts: int) -> Column:
    return idiv((F.lit(k) if isinstance(k, int) else k) * (n - 1), F.lit(parts)) + 1


def _wanted_up_to(x: Column, n: Column, parts: int) -> Column:
    """How many k have a wanted rank of x or less."""
    inner = F.least(F.lit(parts - 1), idiv(x * parts - 1, F.greatest(n - 1, F.lit(1))))
    return F.when(x <= 0, 0).when(n <= 1, parts - 1).otherwise(inner)


def _wanted(parts: int, next_too: bool) -> Column:
    """Whether a bucket holds a wanted rank (or, ``next_too``, the one after it)."""
    first, last, n = F.col("before"), F.col("before") + F.col("count"), F.col("n")
    hit = _wanted_up_to(last, n, parts) > _wanted_up_to(first, n, parts)
    return hit | (_wanted_up_to(last - 1, n, parts) > _wanted_up_to(first - 1, n, parts)) if next_too else hit


def _refine(rows: DataFrame, found: DataFrame | None, fixed: dict[str, Column], name: str, value: Column,
            wanted: Column) -> DataFrame:
    """The wanted buckets of ``value`` among the rows of the ``found`` buckets, with
    the number of rows ``before`` them in their group, their ``count`` and the
    group's ``n``.  ``fixed``: what identifies a found bucket, as seen from a row."""
    keys = list(fixed)
    hist = rows.select("*", *[c.alias(f"_{k}") for k, c in fixed.items()], value.alias(f"_{name}"))
    if found is None:
        hist = hist.groupBy(*[F.col(f"_{k}").alias(k) for k in keys], F.col(f"_{name}").alias(name)).count()
        hist = hist.withColumns({"start": F.lit(0).cast("bigint"),
                                 "n": F.sum("count").over(Window.partitionBy(*keys))})
    else:
        # At most as many buckets as there are wanted ranks.
        on = [F.col(f"_{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
        at = F.broadcast(found.select(*keys, F.col("before").alias("start"), "n").alias("f"))
        hist = hist.join(at, on).groupBy(*[F.col(f"f.{k}").alias(k) for k in keys], "start", "n",
                                         F.col(f"_{name}").alias(name)).count()
    up_to = Window.partitionBy(*keys).orderBy(F.col(name).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("before", F.col("start") + F.sum("count").over(up_to) - F.col("count"))
    return hist.filter(wanted).select(*keys, name, "before", "count", "n")


def values_at(rows: DataFrame, by: str, value: str, parts: int, next_too: bool = False) -> DataFrame:
    """Per group the values that hold a wanted rank: (by, value, before, count, n),
    the value being that of the ranks ``before + 1`` to ``before + count`` of n.
    ``value`` is an integer column; NULL comes first."""
    return _descend(rows, None, {by: F.col(by)}, value, _wanted(parts, next_too))


def rows_at(rows: DataFrame, by: str, value: str, key: str, parts: int, next_too: bool = False) -> DataFrame:
    """The same for the order by (value, key), ``key`` being unique in a group:
    (by, value, key, before, count, n)."""
    values = values_at(rows, by, value, parts, next_too)
    return _descend(rows, values, {by: F.col(by), value: F.col(value)}, key, _wanted(parts, next_too))


def _descend(rows: DataFrame, found: DataFrame | None, fixed: dict[str, Column], value: str, wanted: Column) -> DataFrame:
    prefix: dict[str, Column] = {}
    for shift in SHIFTS:
        name = f"{value}_{shift}" if shift else value
        at = F.shiftright(F.col(value).cast("bigint"), shift) if shift else F.col(value)
        found = _refine(rows, found, {**fixed, **prefix}, name, at, wanted)
        prefix = {name: at}
    return found.select(*fixed, value, "before", "count", "n")


def dense_numbers(df: DataFrame, key: str, number_col: str, parts: int | None = None) -> DataFrame:
    """Number the rows 1, 2, ... in the order of the integer column ``key`` (NULLs
    first, equal keys in any order), without a window over all rows: the exact
    quantiles of the key cut it into ``parts`` ranges whose first number is known,
    and rows are numbered inside their range."""
    from .joins import attach_constants
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = values_at(df.select(F.col(key).alias("__key"), F.lit(1).alias("__all")), "__all", "__key", parts)
    cuts = cuts.agg(F.sort_array(F.collect_list(F.struct("before", F.col("__key").alias("key")))).alias("__cuts"))
    start = F.filter("__cuts", lambda c: c["key"] <= F.col(key))
    ranged = attach_constants(df, cuts).withColumn("__range", F.size(start)).withColumn(
        "__start", F.when(F.col("__range") > 0, F.element_at("__cuts", F.col("__range"))["before"]).otherwise(0))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(F.col(key).asc_nulls_first()))
    return ranged.withColumn(number_col, F.col("__start") + inside).drop("__cuts", "__range", "__start")
