"""Streams with a small state per key (Spark's state store).  Python handles keys
by shards of their hash, not one by one: the cost per key is that of a row.

``SnapshotChanges`` turns arriving snapshots of a table into its change stream;
``AlertStream`` knows which inventory alerts are open.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.changes import ACTION, IS_UPDATE, ROW_ID, row_id
from ..plans.change_jobs import alert_type
from .batches import BatchTable, start_query

SNAPSHOT_AT = "snapshot_at"
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


#: Shards of a state: each should hold some thousands of keys (at 100 TB some
#: hundred thousand shards).  Fixed for the life of a checkpoint.
SHARDS = 1024
SHARD = "shard"


def shard_of(keys: Sequence[str], shards: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(shards)).alias(SHARD)


# ---------------------------------------------------------------- change stream

_IMAGE_STATE = ["key", "image", "seen"]


def _differences(_shard: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the keys of a shard: their rows in newer snapshots against the images
    in the state.  ``seen`` is the snapshot (ms) that confirmed an image; a key that
    the watermark has left behind wasn't in a newer snapshot: it was deleted."""
    held = state.get if state.exists else [[]] * len(_IMAGE_STATE)
    old = pd.DataFrame({c: pd.Series(v, dtype="int64" if c == "seen" else object) for c, v in zip(_IMAGE_STATE, held, strict=True)})
    parts = [old.assign(at=pd.NaT, new=False)]
    if not state.hasTimedOut:
        parts += [f.assign(at=f[SNAPSHOT_AT], seen=f[SNAPSHOT_AT].astype("datetime64[ms]").astype("int64"), new=True)[
            [*_IMAGE_STATE, "at", "new"]] for f in frames]
    # Per key the image in the state, then one row per snapshot.
    rows = pd.concat([p for p in parts if len(p)] or parts, ignore_index=True)
    rows = rows.sort_values(["key", "at", "image"], na_position="first", kind="stable", ignore_index=True)
    before = rows.groupby("key", sort=False)["image"].shift()
    added = rows["new"] & before.isna()
    changed = rows["new"] & before.notna() & (rows["image"] != before)
    last = rows.drop_duplicates("key", keep="last")
    gone = ~last["new"] & (last["seen"] + 1 < state.getCurrentWatermarkMs())
    for images, where, action, update in ((rows["image"], added, "INSERT", False), (before, changed, "DELETE", True),
                                          (rows["image"], changed, "INSERT", True)):
        if where.any():
            yield pd.DataFrame({"key": rows.loc[where, "key"], "image": images[where], ACTION: action, IS_UPDATE: update})
    if gone.any():
        yield last.loc[gone, ["key", "image"]].assign(**{ACTION: "DELETE", IS_UPDATE: False})
    kept = last[~gone]
    if len(kept):
        state.update(tuple(kept[c].tolist() for c in _IMAGE_STATE))
        state.setTimeoutTimestamp(int(kept["seen"].min()) + 1)
    else:
        state.remove()


class SnapshotChanges:
    """The change stream of a table that lands as whole snapshots (rows of
    ``schema`` plus ``snapshot_at``, one row per key, each snapshot later than the
    one before and consumed on its own).

    Every key's image is kept in the state store as JSON; keys are dealt over ``shards``
    by their hash, and a shard's images are one row of state, compared together.  A
    snapshot's rows meet the images of their keys: new keys give an INSERT, changed ones both halves of an
    update; keys that it lacks give a DELETE, once the watermark (the snapshot's
    time) has passed the time up to which their image was confirmed."""

    def __init__(self, spark: SparkSession, landing_dir: str, state_dir: str, schema: T.StructType, keys: Sequence[str],
                 job: Callable[[DataFrame], DataFrame] = lambda df: df, shards: int = SHARDS):
        self.spark, self.landing_dir, self.schema, self.keys, self.job = spark, landing_dir, schema, list(keys), job
        self.shards = shards
        self.image = T.StructType([f for f in schema.fields if f.name not in self.keys])
        self.checkpoint = os.path.join(state_dir, "checkpoint")
        whole = T.StructType([*schema.fields, T.StructField(ACTION, T.StringType()), T.StructField(IS_UPDATE, T.BooleanType()),
                              T.StructField(ROW_ID, T.StringType())])
        self.sink = BatchTable(spark, os.path.join(state_dir, "sink"), job(spark.createDataFrame([], whole)).schema)

    def changes(self) -> DataFrame:
        """The change images as a stream (columns of the table, then metadata)."""
        rows = T.StructType([*self.schema.fields, T.StructField(SNAPSHOT_AT, T.TimestampType())])
        landed = self.spark.readStream.schema(rows).parquet(self.landing_dir)
        text = lambda names, alias: F.to_json(F.struct(*names), _JSON).alias(alias)
        rows = landed.select(shard_of(self.keys, self.shards), text(self.keys, "key"), text(self.image.names, "image"),
                             SNAPSHOT_AT).withWatermark(SNAPSHOT_AT, "0 seconds")
        out = rows.groupBy(SHARD).applyInPandasWithState(
            _differences, f"key string, image string, {ACTION} string, {IS_UPDATE} boolean",
            "key array<string>, image array<string>, seen array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
        keys = T.StructType([self.schema[k] for k in self.keys])
        out = out.select(F.from_json("key", keys, _JSON).alias("__k"), F.from_json("image", self.image, _JSON).alias("__i"),
                         ACTION, IS_UPDATE).select("__k.*", "__i", ACTION, IS_UPDATE)
        out = out.select(*self.keys, "__i.*", ACTION, IS_UPDATE).withColumn(ROW_ID, row_id(self.keys))
        return out.select(*self.schema.names, ACTION, IS_UPDATE, ROW_ID)

    def prime(self) -> None:
        """Take in the snapshots that are there without reporting changes (the
        stream begins after them)."""
        def absorb(df: DataFrame, _batch_id: int) -> None:
            df.write.format("noop").mode("overwrite").save()  # the state is only kept for rows that are read
        start_query(self.changes(), absorb, self.checkpoint).awaitTermination()

    def consume(self) -> None:
        """Report the changes of the snapshots that landed since the last time."""
        start_query(self.changes(), lambda df, batch_id: self.sink.write(self.job(df), batch_id),
                    self.checkpoint).awaitTermination()

    def consumed(self) -> DataFrame:
        return self.sink.read()


# ---------------------------------------------------------------------- alerts

CHANGE, RESOLVED, OPEN = "CHANGE", "RESOLVED", "OPEN"
ALERT_EVENTS = ("location_id bigint, ingredient_id bigint, quantity_on_hand decimal(10,2), reorder_point decimal(10,2), "
                "record_date date, kind string")
ALERT_KEYS = ["location_id", "ingredient_id"]


NO_LOCATION = "no_location"
#: Key of an alert in a Python worker: whole numbers without nulls.
_KEY = ["location_id", NO_LOCATION, "ingredient_id"]
_ALERT_STATE = [*_KEY, "open", "number"]


def _alerts_of_shard(_shard: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The alert rows of the (location, ingredient) keys of a shard: every low change
    of a batch alerts unless an alert of its key was open when the batch began.  A
    resolution closes the alerts that were open then.  Alerts of one opening share
    a number."""
    held = state.get if state.exists else [[]] * len(_ALERT_STATE)
    known = pd.DataFrame({c: np.array(v, np.int64) for c, v in zip(_ALERT_STATE, held, strict=True)})
    opened, closed = known.iloc[:0], None
    for f in frames:
        columns = [*f.columns, "alert_number"]
        f = f.merge(known, "left", _KEY)
        was_open, resolved = f["open"] == 1, f["kind"] == RESOLVED
        number = f["number"].fillna(0).astype("int64")
        now = f.assign(kind=OPEN, alert_number=number + 1)[~was_open & ~resolved]
        if len(now):
            opened = pd.concat([opened, now.assign(open=1, number=now["alert_number"])[_ALERT_STATE]]).drop_duplicates(_KEY)
            yield now[columns]
        done = f.assign(alert_number=number)[was_open & resolved][columns]
        if len(done):  # of a key the first day
            closed = done if closed is None else pd.concat([closed, done])
            closed = closed.sort_values("day", kind="stable").drop_duplicates(_KEY)
    if closed is not None:
        yield closed
        opened = pd.concat([opened, closed.assign(open=0, number=closed["alert_number"])[_ALERT_STATE]])
    if len(opened):
        kept = pd.concat([opened, known]).drop_duplicates(_KEY)
        state.update(tuple(kept[c].astype("int64").tolist() for c in _ALERT_STATE))


class AlertStream:
    """Low-stock alerts of inventory changes, with the open alerts as keyed state.

    Rows of ``ALERT_EVENTS`` land in a folder: changes of stock (``CHANGE``) and
    resolutions of alerts (``RESOLVED``).  Keys are dealt over ``shards`` by their hash,
    and a shard's keys are one row of state, worked on together.  A batch reads the
    state of the shards that it holds rows of, never the alerts written before."""

    def __init__(self, spark: SparkSession, landing_dir: str, state_dir: str, ingredients: DataFrame, shards: int = SHARDS):
        self.spark, self.landing_dir, self.ingredients, self.shards = spark, landing_dir, ingredients, shards
        self.schema = T.StructType.fromDDL(ALERT_EVENTS)
        self.checkpoint = os.path.join(state_dir, "checkpoint")
        self.sink = BatchTable(spark, os.path.join(state_dir, "sink"),
                               T.StructType.fromDDL(ALERT_EVENTS + ", alert_number bigint"))

    def events(self) -> DataFrame:
        landed = self.spark.readStream.schema(self.schema).parquet(self.landing_dir)
        low = F.col("quantity_on_hand") <= F.col("reorder_point")
        rows = landed.filter(((F.col("kind") == CHANGE) & low) | (F.col("kind") == RESOLVED))
        rows = rows.join(self.ingredients.select("ingredient_id"), "ingredient_id", "left_semi")
        # Whole numbers are cheaper than decimals and dates between Spark and pandas.
        cents = lambda c: (F.col(c) * 100).cast("bigint").alias(c)
        location = F.col("location_id")
        rows = rows.select(F.coalesce(location, F.lit(0)).alias("location_id"), location.isNull().cast("bigint").alias(NO_LOCATION),
                           "ingredient_id", cents("quantity_on_hand"), cents("reorder_point"),
                           F.unix_date("record_date").alias("day"), "kind", shard_of(ALERT_KEYS, self.shards))
        out = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", alert_number bigint"
        state = ", ".join(f"{c} array<bigint>" for c in _ALERT_STATE)
        got = rows.groupBy(SHARD).applyInPandasWithState(_alerts_of_shard, out, state, "append", GroupStateTimeout.NoTimeout)
        money = lambda c: (F.col(c).cast("decimal(12,0)") / 100).cast("decimal(10,2)").alias(c)
        return got.select(F.when(F.col(NO_LOCATION) == 0, location).alias("location_id"), "ingredient_id",
                          money("quantity_on_hand"), money("reorder_point"),
                          F.date_from_unix_date("day").alias("record_date"), "kind", "alert_number")

    def consume(self) -> None:
        """Process the rows that landed since the last time."""
        start_query(self.events(), self.sink.write, self.checkpoint).awaitTermination()

    def alerts(self) -> DataFrame:
        """The alert table as it is now."""
        rows, by = self.sink.read(), [*ALERT_KEYS, "alert_number"]
        closed = rows.filter(F.col("kind") == RESOLVED).select(*by, F.col("record_date").alias("resolved_date"))
        q, rp = F.col("quantity_on_hand"), F.col("reorder_point")
        out = rows.filter(F.col("kind") == OPEN).join(closed, by, "left").join(
            self.ingredients.select("ingredient_id", "ingredient_name"), "ingredient_id")
        return out.select(*ALERT_KEYS, "ingredient_name", q.alias("current_quantity"), rp.alias("reorder_point"),
                          alert_type(q, rp).alias("alert_type"),
                          F.when(F.col("resolved_date").isNull(), OPEN).otherwise(RESOLVED).alias("alert_status"),
                          "alert_number", "record_date", "resolved_date")
