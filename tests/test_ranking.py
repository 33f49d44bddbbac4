import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ovenbird.operators.ranking import global_rank, quintile_bounds, quintile_of_rank, surrogate_ids
from ovenbird.operators.selection import dense_numbers, rows_at, values_at


def _data(spark, n, hot_share=0.34, seed=7):
    rnd = random.Random(seed)
    rows = [(i, 42 if rnd.random() < hot_share else rnd.randint(0, 60)) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, v bigint"), rows


def test_global_rank_matches_row_number(spark):
    df, _ = _data(spark, 3000)
    got = global_rank(df, ["v", "id"], "r", "n", partitions=7)
    ref = df.withColumn("r2", F.row_number().over(Window.orderBy("v", "id")))
    j = got.join(ref, ["id", "v"])
    assert j.filter(F.col("r") != F.col("r2")).count() == 0
    assert got.select(F.max("n")).first()[0] == 3000


def test_quintile_of_rank_matches_pandas_qcut(spark):
    for n in (1, 2, 5, 7, 13, 100):
        df = spark.range(1, n + 1).withColumnRenamed("id", "r").withColumn("n", F.lit(n))
        got = [r.q for r in df.select(quintile_of_rank(F.col("r"), F.col("n")).alias("q")).orderBy("r").collect()]
        if n == 1:
            assert got == [1]
            continue
        ref = pd.qcut(pd.Series(range(1, n + 1)).rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert got == list(ref), n


def test_quintile_bounds_match_pandas(spark):
    for n, hot in ((1, 0.0), (6, 0.0), (123, 0.7)):
        df, rows = _data(spark, n, hot_share=hot)
        at = rows_at(df.withColumn("g", F.lit("x")), "g", "v", "id", 5, next_too=True)
        got = {r.k: r for r in quintile_bounds(at, "g", "v", "id").collect()}
        vals = pd.Series([v for _, v in rows])
        for k in (1, 2, 3, 4):
            e = got[k].edge
            assert abs(e.lo + e.m / 5 * (e.hi - e.lo) - vals.quantile(k / 5)) < 1e-9, (n, hot, k)
        if n > 1:
            order = sorted((v, i) for i, v in rows)
            ref = pd.qcut(pd.Series(range(1, n + 1)), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
            assert [1 + sum(o > tuple(got[k].cut) for k in got) for o in order] == list(ref)


def test_selected_rows_are_those_of_the_sorted_rows(spark):
    rnd = random.Random(3)
    for n, spread in ((3, 5), (400, 3), (400, 2**62)):
        rows = [(i * 7919 % 100003, f"g{i % 2}", None if rnd.random() < 0.05 else rnd.randint(-spread, spread)) for i in range(n)]
        df = spark.createDataFrame(rows, "id bigint, g string, v bigint")
        for parts in (2, 9):
            got = {(r.g, r.before): (r.v, r.id) for r in rows_at(df, "g", "v", "id", parts).collect()}
            at = [(r.g, r.v, r.before, r["count"], r.n) for r in values_at(df, "g", "v", parts, next_too=True).collect()]
            for g in {r[1] for r in rows}:
                own = sorted(((v is not None, v or 0), i, v) for i, x, v in rows if x == g)
                ranks = {k * (len(own) - 1) // parts for k in range(1, parts)}
                assert {b for x, b in got if x == g} == ranks
                assert all(got[g, b] == (own[b][2], own[b][1]) for b in ranks)
                vals = [o[2] for o in own]
                want = {vals[b] for b in ranks | {b + 1 for b in ranks} if b < len(own)}
                assert {v for x, v, *_ in at if x == g} == want
                assert all(vals[b:b + c] == [v] * c and vals.count(v) == c and m == len(own)
                           for x, v, b, c, m in at if x == g)


def test_dense_numbers(spark):
    keys = [None, 5, 5, 5, -2**62, 2**62, 0] + [i * i * 31 for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for parts in (2, 7, 64):
        got = sorted((r.num, r.k) for r in dense_numbers(df, "k", "num", parts).collect())
        assert [g[0] for g in got] == list(range(1, len(keys) + 1))
        assert [g[1] for g in got] == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert dense_numbers(df.limit(0), "k", "num").collect() == []


def test_ids_and_quintiles_run_no_job_while_built(spark):
    from ovenbird.plans.analytics import rfm_segments
    from ovenbird.sources.star import AS_OF_ORDERS, Star
    s = Star(spark, "/root/testdata/sf0.001")
    spark.sparkContext.setJobGroup("building", "building")
    try:
        ids = surrogate_ids(s.fact_order(), ["order_id"], "log_id")
        rfm = rfm_segments(s.dim_customer(), s.fact_order(), AS_OF_ORDERS)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []
    for df in (ids, rfm):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "ExistingRDD" not in plan
