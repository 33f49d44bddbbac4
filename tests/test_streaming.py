import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ovenbird.operators import changes
from ovenbird.plans import medallion
from ovenbird.sources.star import Star
from ovenbird.streaming import feeds, keyed
from ovenbird.streaming.batches import BatchTable, ChangedKeys
from ovenbird.streaming.incremental import (IncrementalMedallion, IncrementalViews, _customer_order_aggregates,
                                            _hour_aggregates)

SF = "/root/testdata/sf0.001"


def test_append_feed_restart_delivers_each_file_once(spark, scratch):
    s = Star(spark, SF)
    orders = s.fact_order().select("order_id", "order_timestamp", "total_amount", "customer_id", "location_id")
    landing = os.path.join(scratch, "landing")
    split1, split2 = dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1)
    feeds.land(orders.filter(F.col("order_timestamp") < split1), landing)
    feed = feeds.AppendFeed(spark, landing, os.path.join(scratch, "state"), orders.schema)
    feed.prime()  # existing rows are not part of the feed
    assert feed.consumed().count() == 0
    feeds.land(orders.filter((F.col("order_timestamp") >= split1) & (F.col("order_timestamp") < split2)), landing)
    feed.consume()
    feed.consume()  # nothing new: no batch, nothing duplicated
    # a new feed object over the same checkpoint = a restarted job
    feeds.land(orders.filter(F.col("order_timestamp") >= split2), landing)
    feeds.AppendFeed(spark, landing, os.path.join(scratch, "state"), orders.schema).consume()
    got = feed.consumed()
    expected = orders.filter(F.col("order_timestamp") >= split1)
    assert got.count() == expected.count()
    assert got.select("order_id").distinct().count() == expected.count()
    assert got.filter(F.col("_action") != "INSERT").count() == 0


def test_incremental_gold_equals_full_recompute(spark, scratch):
    s = Star(spark, SF)
    bronze = medallion.bronze_events(s.fact_order(), s.fact_order_item(), s.dim_menu_item())
    landing = os.path.join(scratch, "bronze")
    cut = dt.datetime(1999, 6, 1)
    bronze.filter(F.col("event_timestamp") < cut).write.mode("append").parquet(landing)
    pipe = IncrementalMedallion(spark, os.path.join(scratch, "tables"), s.dim_location(), s.dim_customer(),
                         s.dim_menu_item(), s.dim_category())
    ckpt = os.path.join(scratch, "ckpt")
    pipe.start(landing, bronze.schema, ckpt).awaitTermination()
    # Second drop touches some dates / customers already present.
    second = bronze.filter(F.col("event_timestamp") >= cut)
    second.write.mode("append").parquet(landing)
    pipe.start(landing, bronze.schema, ckpt).awaitTermination()

    silver = medallion.silver_orders(bronze)
    full_daily = medallion.gold_daily_sales(silver, s.dim_location())
    inc_daily = pipe.table("gold_daily_sales").select(*full_daily.columns)
    assert inc_daily.exceptAll(full_daily).count() == 0 and full_daily.exceptAll(inc_daily).count() == 0
    full_cust = medallion.gold_customer_activity(silver, s.dim_customer())
    inc_cust = pipe.table("gold_customer_activity").select(*full_cust.columns)
    assert inc_cust.exceptAll(full_cust).count() == 0 and full_cust.exceptAll(inc_cust).count() == 0
    full_items = medallion.gold_item_performance(medallion.silver_order_items(silver), s.dim_location(),
                                                 s.dim_menu_item(), s.dim_category())
    inc_items = pipe.table("gold_item_performance").select(*full_items.columns)
    assert inc_items.exceptAll(full_items).count() == 0 and full_items.exceptAll(inc_items).count() == 0
    pipe.refresh("gold_hourly_sales")
    assert "last_refreshed" in pipe.table("gold_daily_sales").columns
    full_hourly = medallion.gold_hourly_sales(silver, s.dim_location())
    inc_hourly = pipe.table("gold_hourly_sales").select(*full_hourly.columns)
    assert inc_hourly.exceptAll(full_hourly).count() == 0


def _pipe(spark, scratch):
    s = Star(spark, SF)
    return s, IncrementalMedallion(spark, os.path.join(scratch, "tables"), s.dim_location(), s.dim_customer(),
                                   s.dim_menu_item(), s.dim_category())


def _same(got, want):
    got = got.select(*want.columns)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _run(pipe, scratch, bronze, drop):
    landing = os.path.join(scratch, "bronze")
    drop.select(*bronze.columns).write.mode("append").parquet(landing)
    pipe.start(landing, bronze.schema, os.path.join(scratch, "ckpt")).awaitTermination()


def test_ordinary_batches_of_the_pipeline(spark, scratch):
    """Empty, update-only, without items, repeated events."""
    s, pipe = _pipe(spark, scratch)
    assert pipe.table("gold_daily_sales").count() == 0 and pipe.table("gold_customer_activity").count() == 0
    orders = s.fact_order().filter("order_id % 20 = 1")
    bronze = medallion.bronze_events(orders, s.fact_order_item(), s.dim_menu_item())
    bare = medallion.bronze_events(orders, s.fact_order_item().filter("false"), s.dim_menu_item())
    _run(pipe, scratch, bronze, bronze.filter("false"))
    _run(pipe, scratch, bronze, bronze.withColumn("event_type", F.lit("ORDER_UPDATED")))
    assert pipe.silver().count() == 0
    first = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    _run(pipe, scratch, bronze, bare.filter(first))
    assert pipe.silver_items().count() == 0 and pipe.table("gold_item_performance").count() == 0
    second = bronze.filter(~first)
    _run(pipe, scratch, bronze, second.unionByName(second))
    # Seen before: as it was, and with another time.
    later = second.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 90 DAYS"))
    _run(pipe, scratch, bronze, second.unionByName(bare.filter(first)).unionByName(later))
    want = medallion.silver_orders(bare.filter(first).unionByName(second))
    assert pipe.silver().count() == want.count()
    assert _same(pipe.table("gold_customer_activity"), medallion.gold_customer_activity(want, s.dim_customer()))
    assert _same(pipe.table("gold_daily_sales"), medallion.gold_daily_sales(want, s.dim_location()))
    assert _same(pipe.table("gold_item_performance"), medallion.gold_item_performance(
        medallion.silver_order_items(want), s.dim_location(), s.dim_menu_item(), s.dim_category()))


def test_failed_batch_is_replayed_once(spark, scratch, monkeypatch):
    """The sink fails after it has written; the restarted stream replays the batch."""
    s, pipe = _pipe(spark, scratch)
    bronze = medallion.bronze_events(s.fact_order().filter("order_id % 20 = 1"), s.fact_order_item(), s.dim_menu_item())
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    _run(pipe, scratch, bronze, bronze.filter(half))
    plain = (IncrementalMedallion._refresh_periods, ChangedKeys.write)

    def broken(self, *args):
        (plain[0] if isinstance(self, IncrementalMedallion) else plain[1])(self, *args)
        raise RuntimeError("lost")
    monkeypatch.setattr(IncrementalMedallion, "_refresh_periods", broken)
    monkeypatch.setattr(ChangedKeys, "write", broken)
    with pytest.raises(StreamingQueryException):
        _run(pipe, scratch, bronze, bronze.filter(~half))
    monkeypatch.undo()
    again = IncrementalMedallion(spark, os.path.join(scratch, "tables"), s.dim_location(), s.dim_customer(),
                                 s.dim_menu_item(), s.dim_category())  # a restarted job
    again.start(os.path.join(scratch, "bronze"), bronze.schema, os.path.join(scratch, "ckpt")).awaitTermination()
    want = medallion.silver_orders(bronze)
    assert again.silver().count() == want.count()
    assert _same(again.table("gold_customer_activity"), medallion.gold_customer_activity(want, s.dim_customer()))
    assert _same(again.table("gold_daily_sales"), medallion.gold_daily_sales(want, s.dim_location()))


def test_views_write_changed_keys_only(spark, scratch):
    s = Star(spark, SF)
    orders = s.fact_order().filter("customer_id % 3 = 1")
    landing, kept = os.path.join(scratch, "orders"), IncrementalViews(spark, os.path.join(scratch, "t"), s.dim_customer(), orders.schema)
    few = orders.filter("customer_id < 20")
    for drop in (orders, few.withColumn("order_id", -F.col("order_id"))):
        feeds.land(drop, landing)
        kept.start(landing, os.path.join(scratch, "ckpt")).awaitTermination()
    last = kept.metrics.table.rows().filter("batch_id = 1")
    assert {r[0] for r in last.select("customer_id").collect()} == {r[0] for r in few.select("customer_id").distinct().collect()}
    both = orders.unionByName(few)
    assert _same(kept.metrics.current(), _customer_order_aggregates(both)) and _same(kept.hours.current(), _hour_aggregates(both))


def test_batch_table_replays(spark, scratch):
    schema = spark.createDataFrame([], "a int, p string").schema
    table = BatchTable(spark, os.path.join(scratch, "t"), schema, "p")
    assert table.read().count() == 0
    for b in (0, 1, 1, 2):
        table.write(spark.createDataFrame([(b, f"p{b % 2}"), (100 + b, "hot")], schema), b)
    again = BatchTable(spark, os.path.join(scratch, "t"), schema, "p")
    assert sorted(r.a for r in again.read().collect()) == [0, 1, 2, 100, 101, 102]


# ------------------------------------------------------------- keyed streams

def _alert_run(spark, scratch, rows, stream=None):
    stream = stream or keyed.AlertStream(spark, os.path.join(scratch, "l"), os.path.join(scratch, "s"),
                                         spark.createDataFrame([(1, "flour"), (2, "salt")], "ingredient_id long, ingredient_name string"))
    feeds.land(spark.createDataFrame([(a, b, Decimal(q), Decimal(10), dt.date(2001, 1, d), k) for a, b, q, d, k in rows],
                                     stream.schema), stream.landing_dir)
    stream.consume()
    return stream


def test_alerts_close_and_open_again(spark, scratch):
    c, done = keyed.CHANGE, keyed.RESOLVED
    low = [(1, 1, 3, 1, c), (1, 1, 0, 2, c), (1, 2, 11, 1, c), (2, 1, 9, 1, c), (2, 9, 1, 1, c), (3, 1, 8, 1, done)]
    st = _alert_run(spark, scratch, low)  # two changes of one key alert both; ingredient 9 is unknown
    _alert_run(spark, scratch, [(1, 1, 2, 3, c), (3, 1, 4, 3, c)], st)  # the first is open already
    got = lambda: sorted((r.location_id, r.ingredient_id, int(r.current_quantity), r.alert_type, r.alert_status, r.alert_number,
                          r.resolved_date.day if r.resolved_date else 0) for r in st.alerts().collect())
    assert got() == [(1, 1, 0, "OUT_OF_STOCK", "OPEN", 1, 0), (1, 1, 3, "CRITICAL", "OPEN", 1, 0),
                     (2, 1, 9, "LOW_STOCK", "OPEN", 1, 0), (3, 1, 4, "CRITICAL", "OPEN", 1, 0)]
    # Resolved twice, the earlier day counts; a change of the same batch still finds it open.
    _alert_run(spark, scratch, [(1, 1, 0, 6, done), (1, 1, 0, 5, done), (1, 1, 7, 5, c), (2, 2, 0, 5, done)], st)
    st = keyed.AlertStream(spark, st.landing_dir, os.path.join(scratch, "s"), st.ingredients)  # a restarted job
    _alert_run(spark, scratch, [(1, 1, 6, 7, c), (2, 1, 1, 7, c)], st)
    assert got() == [(1, 1, 0, "OUT_OF_STOCK", "RESOLVED", 1, 5), (1, 1, 3, "CRITICAL", "RESOLVED", 1, 5),
                     (1, 1, 6, "LOW_STOCK", "OPEN", 2, 0), (2, 1, 9, "LOW_STOCK", "OPEN", 1, 0), (3, 1, 4, "CRITICAL", "OPEN", 1, 0)]
    _alert_run(spark, scratch, [(1, 1, 0, 9, done)], st)
    assert [r for r in got() if r[5] == 2] == [(1, 1, 6, "LOW_STOCK", "RESOLVED", 2, 9)]


def _state_rows(spark, checkpoint):
    return spark.read.format("statestore").load(checkpoint).count()


def test_alerts_of_many_keys_are_worked_on_together(spark, scratch):
    """A shard of keys is one row of state; its rows may come in several pieces."""
    c, done, keys = keyed.CHANGE, keyed.RESOLVED, 200
    st = keyed.AlertStream(spark, os.path.join(scratch, "l"), os.path.join(scratch, "s"),
                           spark.createDataFrame([(1, "flour")], "ingredient_id long, ingredient_name string"), shards=3)
    far = 1 << 53  # locations beyond what a double holds, and one without a number
    places = [None, *[far + i for i in range(keys)]]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        _alert_run(spark, scratch, [(p, 1, q, 1, c) for p in places for q in (3, 4)], st)
        _alert_run(spark, scratch, [(p, 1, 0, d, done) for p in places if p is None or p % 2 for d in (5, 4)], st)
        _alert_run(spark, scratch, [(p, 1, 5, 6, c) for p in places], st)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    got = {(r.location_id, int(r.current_quantity), r.alert_status, r.alert_number, r.resolved_date and r.resolved_date.day)
           for r in st.alerts().filter("location_id IS NOT NULL").collect()}
    odd = [p for p in places if p is not None and p % 2]
    assert got == ({(p, q, "RESOLVED", 1, 4) for p in odd for q in (3, 4)} | {(p, 5, "OPEN", 2, None) for p in odd}
                   | {(p, q, "OPEN", 1, None) for p in places if p is not None and p % 2 == 0 for q in (3, 4)})
    nowhere = [(r.kind, int(r.quantity_on_hand), r.alert_number) for r in st.sink.read().filter("location_id IS NULL").collect()]
    assert sorted(nowhere) == [("OPEN", 3, 1), ("OPEN", 4, 1), ("OPEN", 5, 2), ("RESOLVED", 0, 1)]
    assert _state_rows(spark, st.checkpoint) == 3


def test_snapshots_become_a_change_stream(spark, scratch):
    schema = "id long, name string, points int, rate decimal(6,2), since timestamp_ntz"
    t = dt.datetime(2001, 5, 6, 7, 8, 9, 123456)
    snaps = [[(1, "a", 1, Decimal("1.50"), t), (2, "b", 2, None, t), (3, None, 3, None, None), (None, "n", 0, None, t)],
             [(1, "a", 1, Decimal("1.50"), t), (2, "b", 5, None, t), (4, "d", 4, None, t), (None, "m", 0, None, t)],
             [(1, "a", 1, Decimal("1.50"), t + dt.timedelta(microseconds=1)), (3, "c", 3, None, None)]]
    like = spark.createDataFrame([], schema).schema
    make = lambda: keyed.SnapshotChanges(spark, os.path.join(scratch, "l"), os.path.join(scratch, "s"), like, ["id"])
    reader, frames = make(), [spark.createDataFrame(x, schema) for x in snaps]
    for day, (frame, step) in enumerate(zip(frames, ("prime", "consume", "consume"))):
        feeds.land(frame.withColumn(keyed.SNAPSHOT_AT, F.lit(f"2001-01-0{day + 1} 00:00:00").cast("timestamp")), reader.landing_dir)
        getattr(reader, step)()
        reader.consume()  # nothing new
        reader = make()  # a restarted job
    diff = [changes.snapshot_diff(a, b, ["id"]) for a, b in zip([x.filter("id IS NOT NULL") for x in frames],
                                                              [x.filter("id IS NOT NULL") for x in frames[1:]])]
    got = reader.consumed()
    assert _same(got.filter("id IS NOT NULL"), diff[0].unionByName(diff[1]))
    null = [(r.name, r._action, r._is_update) for r in got.filter("id IS NULL").collect()]
    assert sorted(null) == [("m", "DELETE", False), ("m", "INSERT", True), ("n", "DELETE", True)]


def test_snapshots_of_many_keys_are_compared_together(spark, scratch):
    like = spark.createDataFrame([], "id long, part string, v int").schema
    reader = keyed.SnapshotChanges(spark, os.path.join(scratch, "l"), os.path.join(scratch, "s"), like, ["id", "part"], shards=3)
    far = 1 << 53  # beyond what a double holds
    first = [(far + i, p, i) for i in range(300) for p in ("a", None)]
    second = [(i, p, v + (i % 3 == 0)) for i, p, v in first if i % 5] + [(7, "new", 1)]
    frames = [spark.createDataFrame(x, like) for x in (first, second)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for day, (frame, step) in enumerate(zip(frames, (reader.prime, reader.consume))):
            feeds.land(frame.unionByName(frame.limit(3)).withColumn(  # a repeated row is no change
                keyed.SNAPSHOT_AT, F.lit(f"2001-01-0{day + 1} 00:00:00").cast("timestamp")), reader.landing_dir)
            step()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = [*[(i, p, v, "DELETE", False) for i, p, v in first if i % 5 == 0], (7, "new", 1, "INSERT", False)]
    for i, p, v in first:
        if i % 5 and i % 3 == 0:
            want += [(i, p, v, "DELETE", True), (i, p, v + 1, "INSERT", True)]
    got = [tuple(r) for r in reader.consumed().drop(changes.ROW_ID).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert _state_rows(spark, reader.checkpoint) == 3


def test_periods_are_refreshed_in_partitions_by_their_lines(spark, scratch, monkeypatch):
    asked = []
    monkeypatch.setattr(medallion, "by_rows", lambda df, rows, *keys: asked.append(rows) or df)
    s, pipe = _pipe(spark, scratch)
    bronze = medallion.bronze_events(s.fact_order().filter("order_id % 40 = 1"), s.fact_order_item(), s.dim_menu_item())
    bronze.write.parquet(os.path.join(scratch, "bronze"))
    pipe.start(os.path.join(scratch, "bronze"), bronze.schema, os.path.join(scratch, "ckpt")).awaitTermination()
    assert asked == [pipe.silver_items().count()] and asked[0] > 0


def test_refresh_processes_what_has_landed(spark, scratch):
    s, pipe = _pipe(spark, scratch)
    bronze = medallion.bronze_events(s.fact_order().filter("order_id % 40 = 1"), s.fact_order_item(), s.dim_menu_item())
    landing = os.path.join(scratch, "bronze")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    bronze.filter(half).write.parquet(landing)
    pipe.start(landing, bronze.schema, os.path.join(scratch, "ckpt")).awaitTermination()
    bronze.filter(~half).write.mode("append").parquet(landing)
    pipe.refresh("gold_hourly_sales")
    assert _same(pipe.table("gold_hourly_sales"), medallion.gold_hourly_sales(medallion.silver_orders(bronze), s.dim_location()))


def test_kept_anomalies_follow_corrections_and_replays(spark, scratch):
    import datetime as dt
    from decimal import Decimal

    from ovenbird.plans.analytics import sales_anomalies
    from ovenbird.streaming.incremental import IncrementalAnomalies
    schema = "sales_date date, location_id bigint, total_revenue decimal(12,2)"
    start = dt.date(2001, 1, 1)
    day = lambda i, x, loc=1: (start + dt.timedelta(days=7 * i), loc, None if x is None else Decimal(x))
    rows = [day(i, 100 + i % 2) for i in range(12)] + [day(12, 900), day(13, None), day(0, 5, 2)]
    frame = lambda r: spark.createDataFrame(r, schema)
    locations = spark.createDataFrame([(1, "a"), (2, "b")], "location_id bigint, location_name string")
    kept = IncrementalAnomalies(spark, scratch, locations)
    assert kept.anomalies().collect() == []
    kept.land(frame(rows[:6] + [day(20, 7000)]))
    kept.consume()
    kept.consume()  # nothing new
    kept.land(frame([day(20, 7000)]), "DELETE")
    kept.land(frame(rows[6:]))
    kept.consume()
    want = sales_anomalies(frame(rows), locations, start, None).collect()
    got = kept.anomalies().collect()
    assert len(want) == 1 and sorted(map(tuple, got)) == sorted(map(tuple, want))
    # A batch that is replayed writes its own partition again.
    last = kept.kept.table.rows().filter("batch_id = 1").drop("batch_id")
    kept.kept.write(last, 1)
    assert sorted(map(tuple, kept.anomalies().collect())) == sorted(map(tuple, want))
