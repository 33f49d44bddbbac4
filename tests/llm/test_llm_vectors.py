"""Centroid clustering and hard-negative mining: against brute force."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ovenbird.llm import centroids, negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string, row int, score double"


def _table(spark, rows, parts=4):
    return spark.createDataFrame([(i, e, l, 7, "x", 1, 0.5) for i, e, l in rows], SCHEMA).repartition(parts)


def _whole(e, dims=None):
    return e is not None and all(x is not None and math.isfinite(x) for x in e) and (dims is None or len(e) == dims)


BAD = [(9001, None, 1), (9002, [None] + [0.5] * 5, 1), (9003, [float("nan")] * 6, 2), (9004, [float("inf")] + [0.0] * 5, 2),
       (9005, [0.1] * 5, 1), (9006, [], 1)]


def _vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.6, (5, dims))
    rows = []
    for i in range(n):
        x = centres[rng.integers(5)] + rng.normal(0, 0.3, dims)
        rows.append((i, np.float32(x).tolist(), int(rng.integers(4)) if i % 17 else None))
    if n > 10:  # a third of all rows hold one vector, some rows repeat
        hot = np.float32(centres[0]).tolist()
        rows = [(i, hot if i % 3 == 0 else e, l) for i, e, l in rows] + [rows[5], rows[5], rows[10]]
    return rows


# ------------------------------------------------------------------ clustering

def _lloyd(rows, dims, k, rounds, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e, _ in rows if _whole(e, dims)]
    key = lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[0], r[1]) if r[0] is not None else ("~", 0, r[1])
    centre = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centre))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centre)):
            part = [v for (_, v), c in zip(kept, own) if c == j]
            if part:
                centre[j] = [sum(x) // len(part) for x in zip(*part)]
    done = [(i, *nearest(v)) for i, v in kept]
    inertia = {j: sum(d for _, d, c in done if c == j) for j in range(len(centre))}
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centre[c])).encode()).hexdigest())
            for i, d, c in done]


@pytest.mark.parametrize("n,dims,k", [(300, 6, 8), (120, 1, 5), (3, 6, 8)])
def test_clusters_equal_plain_rounds(spark, n, dims, k):
    rows = _vectors(n, dims, n) + (BAD if dims == 6 else []) + [(None, [0.25] * dims, 1)]
    got = centroids.cluster(_table(spark, rows), dims=dims, k=k, rounds=4)
    want = _lloyd(rows, dims, k, 4, 1024, 3)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_clusters_of_empty_and_bad_tables(spark):
    assert centroids.cluster(_table(spark, [(1, [0.5] * 6, 1)]).limit(0), dims=6).count() == 0
    got = centroids.cluster(_table(spark, BAD), dims=6)
    assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(1)
    c = rng.integers(-1000, 1000, (200, 3))
    c[50:60] = c[0]  # equal centroids: the smallest number wins
    x = np.concatenate([rng.integers(-1000, 1000, (500, 3)), c[:70]])
    number, best, exact = centroids.SortedLists(c).nearest(x)
    d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact < len(x) * len(c) / 2


def test_huge_components_stay_exact():
    v = vectors.quantise(pa.array([[3.4e38, -3.4e38], [0.5, -0.0005]]), 2, 1024)
    top = vectors.largest(2)
    assert v.tolist() == [[top, -top], [512, -1]]
    assert centroids.SortedLists(v).nearest(v)[0].tolist() == [0, 1]


# -------------------------------------------------------------- hard negatives

def _mined(rows, scale=256, every=50):
    dims = max((len(e) for _, e, l in rows if l is not None and _whole(e)), default=0)
    kept = [(i, l, [math.floor(scale * x) for x in e] + [0] * (dims - len(e))) for i, e, l in rows if l is not None and _whole(e)]
    big = 1 << 62
    out = []
    for a, (i, l, v) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), big if j is None else j, m) for b, (j, m, w) in enumerate(kept) if b != a]
        for ps, p, m in sorted(s for s in scored if s[2] == l)[:5]:
            fit = sorted((s, j) for s, j, m in scored if m != l and 50 * -ps <= 100 * -s <= 95 * -ps)[:3]
            for rank, (s, j) in enumerate(fit, 1):
                out.append((i, None if p == big else p, rank, None if j == big else j, -ps, -s))
    return out


@pytest.mark.parametrize("dims,chunk", [(16, 1000), (64, 4), (3, 1000), (1, 1000)])
def test_negatives_equal_brute_force(spark, monkeypatch, dims, chunk):
    monkeypatch.setattr(negatives, "ROWS", 64)
    monkeypatch.setattr(negatives, "ANCHORS", 8)
    rows = _vectors(500, dims, dims) + [(None, [0.9] * dims, 1), (50, [0.3] * dims, 2)] + [(i, e, l) for i, e, l in BAD if i != 9006]
    got = negatives.mine(_table(spark, rows), chunk=chunk)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, _mined(rows)))


def test_negatives_of_edge_tables(spark):
    t = _table(spark, [(50, [1.0, 2.0], 1), (51, [1.0, 1.0], 1), (52, [0.5, 1.0], 2)])
    assert [tuple(r) for r in negatives.mine(t).collect()] == _mined([(50, [1.0, 2.0], 1), (51, [1.0, 1.0], 1), (52, [0.5, 1.0], 2)])
    for empty in (t.limit(0), t.filter("label = 2"), t.withColumn("label", F.lit(None).cast("int")), t.filter("vec_id = 50"),
                  _table(spark, [(50, [], 1), (100, [], 2)])):
        assert negatives.mine(empty).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(5)
    for dims in (8, 33, 64):
        a, r = (rng.integers(-500, 500, (40, dims)) + rng.integers(-300, 300, (40, 1)) for _ in range(2))
        exact = a @ r.T
        for s in negatives.levels(dims):
            low, high = negatives.bounds(negatives.summaries(a, s), negatives.summaries(r, s))
            assert (low <= exact).all() and (high >= exact).all()


def test_best_keeps_ties_by_id():
    rng = random.Random(3)
    best, rows = negatives.Best(4, 3), []
    for _ in range(30):
        part = [(rng.randrange(4), rng.randrange(-3, 3), rng.randrange(50)) for _ in range(9)]
        rows += part
        g, s, i = (np.array(x) for x in zip(*part))
        best.add(g, s, i, i)
    g, s, i, _ = best.rows()
    want = [(k, *x) for k in range(4) for x in sorted((-b, c) for a, b, c in rows if a == k)[:3]]
    assert list(zip(g, -s, i)) == want
