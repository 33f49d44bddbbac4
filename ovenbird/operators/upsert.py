"""Keyed upsert, keyed update and retention delete as DataFrame rewrites.

The built-in parquet catalog has no MERGE/UPDATE/DELETE, so each operation
produces the new table contents, or those of the partitions that it touches;
``sources.tables.replace_partitions`` writes the latter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """Fail the job (lazily, inside the plan) if a key occurs twice.

    The count is a window partitioned by the keys, i.e. the same hash
    partitioning the following keyed join needs, so it costs no extra shuffle.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ok = F.when(F.col("__n") > 1, F.raise_error(F.lit(f"duplicate key in {what}: ambiguous match"))) \
        .otherwise(F.lit(True))
    # A filter (not a dropped column) so the check cannot be pruned away.
    return df.withColumn("__n", n).filter(ok.cast("boolean")).drop("__n")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str], insert_cols: Sequence[str],
                 check_unique: bool = True) -> DataFrame:
    """``MERGE INTO target USING source ON keys``.

    Matched rows take ``update_cols`` from the source and keep every other
    column; unmatched source rows are inserted with ``insert_cols`` (other
    columns NULL); target rows without a match stay as they are.
    """
    keys = list(keys)
    if check_unique:
        source = assert_unique(source, keys)
    t_cols = [c for c in target.columns]
    t = target.select(*keys, F.struct(*[F.col(c) for c in t_cols]).alias("__t"), F.lit(True).alias("__in_t"))
    s_cols = [c for c in source.columns if c not in keys]
    s = source.select(*keys, F.struct(*[F.col(c) for c in s_cols]).alias("__s"), F.lit(True).alias("__in_s"))
    j = t.join(s, keys, "full_outer")
    matched = F.col("__in_t") & F.col("__in_s")
    only_s = F.col("__in_t").isNull()
    out = []
    for c in t_cols:
        if c in keys:
            out.append(F.col(c))
            continue
        tv = F.col(f"__t.{c}")
        sv = F.col(f"__s.{c}").cast(target.schema[c].dataType) if c in s_cols else F.lit(None)
        upd = sv if c in update_cols else tv
        ins = sv if c in insert_cols else F.lit(None)
        out.append(F.when(only_s, ins).when(matched, upd).otherwise(tv)
                   .cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def keyed_update(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                 set_cols: Sequence[str]) -> DataFrame:
    """``UPDATE target SET cols = … WHERE key = …`` for a whole change set.
    A key present in ``changes`` takes the new values (even NULL); others keep
    theirs."""
    keys = list(keys)
    ch = assert_unique(changes.select(*keys, *set_cols), keys, "change set")
    ch = ch.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in set_cols], F.lit(True).alias("__hit"))
    j = target.join(ch, keys, "left")
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def purge(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE FROM t WHERE predicate``: a row goes only when the predicate is
    TRUE; rows where it is NULL stay."""
    return df.filter(~predicate | predicate.isNull())
