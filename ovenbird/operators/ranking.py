"""Global ordinal rank without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task.  Here
the rows are range-partitioned on the sort key (the sampler splits even a hot
value, because the key ends in a unique id), sorted inside each partition and
checkpointed so partition contents are fixed; each partition's row count gives
its starting offset, and a row's rank is offset + position in its partition.
All of it is JVM-side DataFrame work; only one row per partition is combined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .selection import dense_numbers, idiv, wanted_rank

ROW_BITS = 33  # monotonically_increasing_id = partition id << 33 | row index


def global_rank(df: DataFrame, order: Sequence[Column | str], rank_col: str = "rank",
                count_col: str | None = "n", partitions: int | None = None) -> DataFrame:
    """Attach a 1-based dense-in-order rank (row_number over ``order``) and,
    optionally, the total row count.  ``order`` must end in a unique key."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
    # Reliable checkpoint: fixes the sampled range bounds and partition
    # contents for the two passes below, and cuts the lineage.
    fixed = ranged.checkpoint(eager=True)
    tagged = fixed.select("*", F.spark_partition_id().alias("__pid"),
                          F.monotonically_increasing_id().alias("__mid"))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # One row per partition: the running offset is a window over a frame
    # whose size is the partition count, not the data size.
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"),
                            F.sum("__cnt").over(Window.partitionBy()).alias("__total"))
    out = tagged.join(F.broadcast(offsets), "__pid")
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), ROW_BITS)
    out = out.withColumn(rank_col, F.col("__off") + local + 1)
    if count_col:
        out = out.withColumn(count_col, F.col("__total"))
    return out.drop("__pid", "__mid", "__off", "__total")


def quintile_of_rank(rank: Column, n: Column) -> Column:
    """Quintile 1..5 of an ordinal rank r of n (``qcut(rank, 5)`` labels):
    ``max(1, ceil(5 (r-1) / (n-1)))``, 1 when n = 1 — in integer arithmetic."""
    ceil = idiv((rank - 1) * 5 + (n - 2), n - 1)
    return F.when(n <= 1, F.lit(1).cast("bigint")).otherwise(F.greatest(F.lit(1).cast("bigint"), ceil))


def quintile_bounds(at: DataFrame, by: str, value_col: str, id_col: str, parts: int = 5) -> DataFrame:
    """What scores by value or by rank need, per group and k: rows (by, k, edge, cut).
    ``at``: the rows at the wanted ranks and the ones after them (``selection.rows_at``).

    ``edge``: the linear-interpolation quantile edge k/parts as (lo, hi, m), that is
    ``lo + m/parts * (hi - lo)``.  Position k (n-1)/parts splits into an integer part
    (which order statistic) and a remainder m, so comparisons against an edge stay
    exact integers for integer values.
    ``cut``: the last row, as (value, id), of the k lowest quintiles (see
    ``quintile_of_rank``): a rank r of n is above quintile k if ``r > 1 + k (n-1) / parts``."""
    k = at.select("*", F.explode(F.sequence(F.lit(1), F.lit(parts - 1))).alias("k"))
    rank = wanted_rank(F.col("k"), F.col("n"), parts)
    here, after = rank == F.col("before") + 1, rank == F.col("before")
    lo = F.max(F.when(here, F.col(value_col)))
    hi = F.coalesce(F.max(F.when(after, F.col(value_col))), lo)
    m = F.max(F.col("k") * (F.col("n") - 1) % parts)
    return k.groupBy(by, "k").agg(F.struct(lo.alias("lo"), hi.alias("hi"), m.alias("m")).alias("edge"),
                                  F.max(F.when(here, F.struct(value_col, id_col))).alias("cut"))


def surrogate_ids(new_rows: DataFrame, order: Sequence[str], id_col: str,
                  existing: DataFrame | None = None) -> DataFrame:
    """AUTOINCREMENT-style dense ids: ``max(existing id) + row_number()`` over
    ``order`` (which must end in a unique key), without a one-partition window.
    For one integer column the rows are numbered inside exact quantile ranges
    (``selection.dense_numbers``: no job runs while the frame is built); any other
    order goes through the distributed global rank."""
    fields = {f.name: f.dataType for f in new_rows.schema.fields}
    if len(order) == 1 and isinstance(fields.get(order[0]), T.IntegralType):
        ranked = dense_numbers(new_rows, order[0], "__rank")
    else:
        ranked = global_rank(new_rows, order, "__rank", None)
    if existing is None:
        return ranked.withColumn(id_col, F.col("__rank")).drop("__rank")
    from .joins import attach_constants
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__start"))
    return (attach_constants(ranked, start).withColumn(id_col, F.col("__start") + F.col("__rank"))
            .drop("__rank", "__start"))
