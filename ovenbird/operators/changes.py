"""Change capture: snapshot diff, change metadata and replay to a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTION = "_action"
IS_UPDATE = "_is_update"
ROW_ID = "_row_id"


def row_id(keys: Sequence[str]) -> Column:
    """Stable row identifier: hash of the key values.  Every value is preceded by
    its length (``-`` for NULL), so different keys have different texts."""
    def part(k: str) -> Column:
        text = F.col(k).cast("string")
        return F.when(text.isNull(), F.lit("-;")).otherwise(
            F.concat(F.char_length(text).cast("string"), F.lit(":"), text, F.lit(";")))
    return F.md5(F.concat(*[part(k) for k in keys]))


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  append_only: bool = False) -> DataFrame:
    """Changes that turn ``before`` into ``after``.

    INSERT for new keys, DELETE for vanished keys, and for a key whose other
    columns differ (NULL-safe) a DELETE of the old image plus an INSERT of the
    new one, both flagged ``_is_update``.  Unchanged rows produce nothing.
    With ``append_only`` only inserts of new keys are returned.

    One full outer join on the keys (both snapshots hash-partitioned by key),
    and the zero, one or two output images of a key are produced in the same
    pass by exploding a two-slot array.
    """
    keys = list(keys)
    cols = list(after.columns)
    b = before.select(*keys, F.struct(*[F.col(c) for c in cols]).alias("__b"))
    a = after.select(*keys, F.struct(*[F.col(c) for c in cols]).alias("__a"))
    j = b.join(a, keys, "full_outer")
    has_b, has_a = F.col("__b").isNotNull(), F.col("__a").isNotNull()
    changed = has_b & has_a & ~F.col("__b").eqNullSafe(F.col("__a"))

    def image(src: str, action: str, cond: Column) -> Column:
        fields = [F.col(f"{src}.{c}").alias(c) for c in cols]
        return F.when(cond, F.struct(*fields, F.lit(action).alias(ACTION), changed.alias(IS_UPDATE)))

    if append_only:
        slots = [image("__a", "INSERT", has_a & ~has_b)]
    else:
        slots = [image("__b", "DELETE", (has_b & ~has_a) | changed),
                 image("__a", "INSERT", (has_a & ~has_b) | changed)]
    out = j.select(F.explode(F.filter(F.array(*slots), lambda x: x.isNotNull())).alias("__r"))
    out = out.select("__r.*")
    return out.withColumn(ROW_ID, row_id(keys))


def insert_feed(df: DataFrame) -> DataFrame:
    """Rows of an append-only source as INSERT changes."""
    return df.withColumn(ACTION, F.lit("INSERT")).withColumn(IS_UPDATE, F.lit(False))


def as_of(history: DataFrame, keys: Sequence[str], ts_col: str, at, seq_col: str | None = None) -> DataFrame:
    """Table contents as of ``at`` from a change history.

    ``history`` holds change images with ``_action`` and a change time.  For
    each key the last change at or before ``at`` wins (a DELETE of an update
    pair sorts before its INSERT); keys whose last change is a DELETE are
    gone.  ``seq_col`` numbers the changes: of two at the same time the higher
    one wins.  Without it, or if that ties too, the greater image wins, so the
    result doesn't depend on the order of the rows.  Computed as a keyed ``max_by`` aggregate, so it combines map-side
    and never sorts a key's whole history.
    """
    keys = list(keys)
    image_cols = [c for c in history.columns if c not in (ACTION, IS_UPDATE, ROW_ID, ts_col, seq_col)]
    h = history.filter(F.col(ts_col) <= at)
    order = F.struct(F.col(ts_col), *([F.col(seq_col)] if seq_col else []),
                     F.when(F.col(ACTION) == "INSERT", 1).otherwise(0),
                     *[F.col(c) for c in image_cols if c not in keys])
    last = h.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in image_cols if c not in keys], F.col(ACTION)), order).alias("__l"))
    return (last.filter(F.col("__l." + ACTION) == "INSERT")
            .select(*keys, *[F.col(f"__l.{c}").alias(c) for c in image_cols if c not in keys])
            .select(*image_cols))


def versions(history: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """Interval history: the images of ``history`` (change images with ``_action``
    and a change time) with ``valid_from`` and ``valid_to`` (exclusive; NULL: still
    valid).  A key's image ends with its next change, an update's new image or a
    deletion.  Of several changes of a key at one time the last image counts (a
    DELETE of an update pair sorts before its INSERT)."""
    keys = list(keys)
    image_cols = [c for c in history.columns if c not in (ACTION, IS_UPDATE, ROW_ID, ts_col, *keys)]
    image = F.struct(*image_cols, ACTION)
    order = F.struct(F.when(F.col(ACTION) == "INSERT", 1).otherwise(0), *image_cols)
    last = history.groupBy(*keys, ts_col).agg(F.max_by(image, order).alias("__l"))
    ends = F.lead(ts_col).over(Window.partitionBy(*keys).orderBy(ts_col))
    return (last.withColumn("valid_to", ends).filter(F.col(f"__l.{ACTION}") == "INSERT")
            .select(*keys, *[F.col(f"__l.{c}").alias(c) for c in image_cols], F.col(ts_col).alias("valid_from"), "valid_to"))


def join_valid(facts: DataFrame, valid: DataFrame, keys: Sequence[str], ts_col: str, days: int = 365) -> DataFrame:
    """``facts`` with the columns of the version (see ``versions``) that was valid
    at ``ts_col``; NULLs where there was none.

    Range as-of join: time is cut into buckets of ``days``; a version is copied to
    the buckets that it spans, up to the last one that a fact lies in, and the join
    is on (key, bucket) plus the range.  So a key with very many facts is spread
    over its buckets, and a fact meets the versions of its bucket only."""
    keys = list(keys)
    span = days * 86400

    def bucket(c: Column) -> Column:
        # Seconds since 1970 of a time without a zone, whatever the session's zone is.
        return F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz")) / span)
    reach = facts.agg(F.min(bucket(F.col(ts_col))).alias("lo"), F.max(bucket(F.col(ts_col))).alias("hi"))
    lo, hi = (reach.select(c).scalar() for c in ("lo", "hi"))
    first = F.greatest(bucket(F.col("valid_from")), lo)
    final = F.least(F.coalesce(bucket(F.col("valid_to")), hi), hi)
    spread = valid.filter((F.col("valid_to").isNull()) | (F.col("valid_from") < F.col("valid_to")))
    spread = spread.withColumns({"__lo": first, "__hi": final}).filter(F.col("__lo") <= F.col("__hi"))
    spread = spread.withColumn("__bucket", F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi")
    f, v = facts.withColumn("__bucket", bucket(F.col(ts_col))).alias("f"), spread.alias("v")
    same = F.col("f.__bucket") == F.col("v.__bucket")
    for k in keys:
        same = same & (F.col(f"f.{k}") == F.col(f"v.{k}"))
    at = F.col(f"f.{ts_col}")
    same = same & (F.col("v.valid_from") <= at) & (F.col("v.valid_to").isNull() | (at < F.col("v.valid_to")))
    rest = [c for c in valid.columns if c not in keys]
    return f.join(v, same, "left").select(*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"v.{c}") for c in rest])
