import datetime as dt

from pyspark.sql import functions as F

from ovenbird.operators import changes
from ovenbird.operators.upsert import keyed_update, merge_upsert, purge

SCHEMA = "id bigint, name string, pts int"


def _apply(before, feed, keys):
    """Apply a change feed to a snapshot (delete images, then inserts)."""
    deletes = feed.filter(F.col("_action") == "DELETE").select(*keys)
    inserts = feed.filter(F.col("_action") == "INSERT").select(*before.columns)
    return before.join(deletes, keys, "left_anti").unionByName(inserts)


def test_snapshot_diff_semantics(spark):
    before = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3), (4, "d", 4)], SCHEMA)
    after = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, None, 3), (5, "e", 5), (4, None, 4)], SCHEMA)
    feed = changes.snapshot_diff(before, after, ["id"])
    rows = sorted((r.id, r._action, r._is_update, r.pts) for r in feed.collect())
    assert rows == [(2, "DELETE", True, 2), (2, "INSERT", True, 5), (4, "DELETE", True, 4),
                    (4, "INSERT", True, 4), (5, "INSERT", False, 5)]
    applied = _apply(before, feed, ["id"])
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, after.collect()))


def test_snapshot_diff_append_only_and_row_id(spark):
    before = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    after = spark.createDataFrame([(1, "z", 1), (2, "b", 2)], SCHEMA)
    feed = changes.snapshot_diff(before, after, ["id"], append_only=True).collect()
    assert [(r.id, r._action) for r in feed] == [(2, "INSERT")]
    assert len(feed[0]._row_id) == 32


def test_as_of_replay(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    before = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    after = spark.createDataFrame([(1, "a", 9), (3, "c", 3)], SCHEMA)
    hist = (changes.insert_feed(before).withColumn("ts", F.lit(t0).cast("timestamp_ntz"))
            .unionByName(changes.snapshot_diff(before, after, ["id"]).drop("_row_id")
                         .withColumn("ts", F.lit(t1).cast("timestamp_ntz"))))
    at0 = changes.as_of(hist, ["id"], "ts", F.lit(t0).cast("timestamp_ntz"))
    at1 = changes.as_of(hist, ["id"], "ts", F.lit(t1).cast("timestamp_ntz"))
    assert sorted(map(tuple, at0.collect())) == [(1, "a", 1), (2, "b", 2)]
    assert sorted(map(tuple, at1.collect())) == [(1, "a", 9), (3, "c", 3)]


def test_merge_upsert(spark):
    target = spark.createDataFrame([(1, "keep", 10, "x"), (2, "old", 20, "y")], "k bigint, a string, b int, c string")
    source = spark.createDataFrame([(2, "new", 21, "ignored"), (3, "ins", 30, "ins_c")], "k bigint, a string, b int, c string")
    out = merge_upsert(target, source, ["k"], update_cols=["a", "b"], insert_cols=["k", "a"])
    rows = sorted(map(tuple, out.collect()))
    assert rows == [(1, "keep", 10, "x"), (2, "new", 21, "y"), (3, "ins", None, None)]
    empty = source.limit(0)
    same = merge_upsert(target, empty, ["k"], ["a", "b"], ["k", "a", "b", "c"])
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, target.collect()))


def test_merge_rejects_duplicate_source_keys(spark):
    import pytest
    target = spark.createDataFrame([(1, "a")], "k bigint, a string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k bigint, a string")
    with pytest.raises(Exception, match="duplicate key"):
        merge_upsert(target, source, ["k"], ["a"], ["k", "a"]).collect()


def test_purge_keeps_null_predicate_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, age int")
    kept = purge(df, F.col("age") > 30)
    assert sorted(r.id for r in kept.collect()) == [1, 2]


def test_keyed_update_sets_null_too(spark):
    t = spark.createDataFrame([(1, 5), (2, 6)], "id bigint, pts int")
    ch = spark.createDataFrame([(2, None)], "id bigint, pts int")
    assert sorted(map(tuple, keyed_update(t, ch, ["id"], ["pts"]).collect())) == [(1, 5), (2, None)]


def test_surrogate_ids_continue_after_existing(spark):
    from ovenbird.operators.ranking import surrogate_ids
    existing = spark.createDataFrame([(1,), (7,)], "log_id bigint")
    new = spark.createDataFrame([(30,), (10,), (20,)], "order_id bigint")
    out = sorted((r.order_id, r.log_id) for r in surrogate_ids(new, ["order_id"], "log_id", existing).collect())
    assert out == [(10, 8), (20, 9), (30, 10)]


def test_table_writes(spark, scratch):
    from ovenbird.sources import tables
    t1 = spark.createDataFrame([(1,)], "a int")
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "a int, p string")
    path = f"{scratch}/t"
    tables.append_rows(rows, path, ["p"])
    tables.append_rows(rows.filter("a = 1"), path, ["p"])
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 1, 2, 3]
    tables.replace_partitions(spark.createDataFrame([(9, "y")], "a int, p string"), path, ["p"])
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 1, 9]
    tables.replace_table(t1, path)
    assert [r.a for r in spark.read.parquet(path).collect()] == [1]
    d = tables.apply_defaults(t1, {"flag": F.lit(False), "a": F.lit(99)})
    assert d.first().a == 1 and d.first().flag is False


def test_snapshot_diff_property(spark):
    """Applying the diff of any two snapshots to the first gives the second."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.integers(0, 12), st.sampled_from(["a", "b", None]), st.integers(0, 3))

    @settings(max_examples=8, deadline=None)
    @given(st.lists(row, max_size=10), st.lists(row, max_size=10))
    def check(b_rows, a_rows):
        b = {r[0]: r for r in b_rows}
        a = {r[0]: r for r in a_rows}
        before = spark.createDataFrame(list(b.values()), SCHEMA)
        after = spark.createDataFrame(list(a.values()), SCHEMA)
        feed = changes.snapshot_diff(before, after, ["id"])
        got = sorted(map(tuple, _apply(before, feed, ["id"]).collect()), key=str)
        assert got == sorted(a.values(), key=str)

    check()


def test_row_ids_of_different_keys_differ(spark):
    from ovenbird.operators.changes import row_id
    keys = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("", "x"), ("1:a;", ""), ("1:a", ";"), (None, None), ("-;", None)]
    df = spark.createDataFrame(keys, "p string, q string").select(row_id(["p", "q"]).alias("r"))
    assert df.distinct().count() == len(keys)


def test_as_of_tie_rule(spark):
    from ovenbird.operators.changes import as_of
    rows = [(1, "old", "INSERT", 5, 1), (1, "new", "INSERT", 5, 2), (2, "gone", "INSERT", 5, 1), (2, "gone", "DELETE", 5, 2),
            (3, "b", "INSERT", 5, None), (3, "a", "INSERT", 5, None)]
    h = spark.createDataFrame(rows, "k int, v string, _action string, at int, seq int")
    for parts in (1, 4):
        got = as_of(h.repartition(parts), ["k"], "at", 5, "seq").orderBy("k").collect()
        assert [tuple(r) for r in got] == [(1, "new"), (3, "b")]


def test_one_decimal_equals_python(spark):
    from ovenbird.plans.analytics import one_decimal
    import random
    rng = random.Random(1)
    values = [x / 100 for x in range(0, 1001)] + [rng.random() * 5 for _ in range(2000)] + [x / 8 for x in range(60)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for r in df.select("v", one_decimal(F.col("v")).alias("t")).collect():
        assert r.t == (None if r.v is None else f"{r.v:.1f}"), r


def test_checkpoint_folder_is_required_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from ovenbird.session import ensure_checkpoint_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(cluster)


def test_dashboards_put_null_first_on_descending_order(spark):
    from ovenbird.plans import medallion
    gold = spark.createDataFrame([("a", "e", 6, 5.0, "x", "HIGH"), ("b", "e", 7, None, "x", "HIGH"), ("c", "e", 9, 9.0, "x", "HIGH")],
                                 "customer_name string, email string, recent_orders int, recent_spend double, "
                                 "preferred_order_type string, activity_level string")
    assert [r.customer_name for r in medallion.dash_vip(gold).collect()] == ["b", "c", "a"]


def test_quality_checks_find_each_fault(spark):
    from ovenbird.plans.quality import run_quality_checks
    orders = spark.createDataFrame([(1, None, 5.0), (2, 1, -5.0), (3, 1, 5.0)], "order_id int, customer_id int, total_amount double")
    items = spark.createDataFrame([(1,), (9,), (8,)], "order_id int")
    reviews = spark.createDataFrame([(0,), (5,), (6,), (None,)], "overall_rating int")
    customers = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "email string")
    got = {r.check_name: (r.status, r.issue_count) for r in run_quality_checks(orders, items, reviews, customers).collect()}
    assert got == {"Null Customer ID": ("FAIL", 1), "Negative Totals": ("FAIL", 1), "Orphaned Order Items": ("FAIL", 2),
                   "Invalid Ratings": ("FAIL", 2), "Duplicate Emails": ("WARN", 2)}


def test_versions_and_join_valid(spark):
    day = lambda k: dt.datetime(2000, 1, 1) + dt.timedelta(days=k)
    rows = [(1, "a", "INSERT", day(0)), (1, "a", "DELETE", day(10)), (1, "b", "INSERT", day(10)), (1, "b", "DELETE", day(20)),
            (2, "x", "INSERT", day(5)), (1, "c", "INSERT", day(30)), (3, None, "INSERT", day(0))]
    h = spark.createDataFrame(rows, "id long, name string, _action string, at timestamp_ntz")
    got = changes.versions(h, ["id"], "at")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (1, "a", day(0), day(10)), (1, "b", day(10), day(20)), (1, "c", day(30), None), (2, "x", day(5), None), (3, None, day(0), None)]))
    facts = [(k, 1 + k % 4 if k % 9 else None, day(k) + dt.timedelta(hours=k % 3)) for k in range(-40, 400)] + [(900, 1, None)]
    f = spark.createDataFrame(facts, "n long, id long, ts timestamp_ntz")
    valid = got.collect()

    def name(i, t):
        fit = [v.name for v in valid if v.id == i and t is not None and v.valid_from <= t and (v.valid_to is None or t < v.valid_to)]
        return fit[0] if fit else None
    for days in (1, 7, 365):
        out = {r.n: r.name for r in changes.join_valid(f, got, ["id"], "ts", days).collect()}
        assert out == {n: name(i, t) for n, i, t in facts}
    assert changes.join_valid(f.limit(0), got, ["id"], "ts").count() == 0
