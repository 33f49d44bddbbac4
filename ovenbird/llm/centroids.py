"""Centroid clustering (k-means in exact integers) by the threshold algorithm.

The nearest centroid of a vector is found from one list of the centroids per
dimension, sorted by their values there.  Every list is walked outward from the
vector's own value, one entry a step in all lists; a centroid that shows up for
the first time gets its exact squared distance.  A centroid not seen yet is at
least as far away in each dimension as the entry last read there, so the walk
stops when the sum of these squared frontier distances is strictly more than
the best exact distance (strictly: at the same distance a smaller number wins).

A round is one pass over the vectors: each task assigns its rows and sums them
per centroid and dimension, Spark adds the sums, and the new centroids (k x
dims numbers, whatever the number of vectors) go to the next pass with its task
closures.  Nothing is kept on executors between rounds.

Defined results: rows whose vector is null, has another number of components
than ``dims`` or a null or non-finite one take no part; repeated rows count
each; a vector with a null id is clustered, but starts a centroid only after
all others; with fewer vectors than ``k`` each starts one; an empty table gives no
rows; ties go to the smaller centroid number; columns besides the id and the
vector are not read; an inertia beyond a bigint is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .vectors import packed, unpack, whole_vectors

#: Vectors that are walked at once, and pairs whose distances are computed at once.
ROWS, PAIRS = 2048, 1 << 15


class SortedLists:
    """One list of the centroids per dimension, sorted by value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid, and how
        many exact distances that took."""
        (k, dims), n = self.centroids.shape, len(x)
        dim = np.arange(dims)
        high = np.empty((n, dims), np.int64)  # next entry to read upward, downward
        for j in dim:
            high[:, j] = np.searchsorted(self.values[:, j], x[:, j])
        low = high - 1
        seen = np.zeros((n, k), bool)
        number, best = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
        active, exact, far = np.arange(n), 0, np.iinfo(np.int64).max
        while len(active):
            xs, lo, hi = x[active], low[active], high[active]
            down = np.where(lo >= 0, xs - self.values[np.maximum(lo, 0), dim], far)
            up = np.where(hi < k, self.values[np.minimum(hi, k - 1), dim] - xs, far)
            below = down <= up
            frontier = np.where(below, down, up)
            entry = self.order[np.where(below, lo, np.minimum(hi, k - 1)), dim]
            low[active], high[active] = lo - below, hi + ~below
            new = np.zeros((len(active), k), bool)
            new[np.arange(len(active))[:, None], entry] = True
            new &= ~seen[active]
            seen[active] |= new
            at, c = np.nonzero(new)
            exact += len(at)
            for i in range(0, len(at), PAIRS):
                self._better(x, active[at[i:i + PAIRS]], c[i:i + PAIRS], number, best)
            left = ~seen[active].all(axis=1)
            active = active[left]
            # every list of these has entries left, so the frontier is finite
            active = active[~((frontier[left] ** 2).sum(axis=1) > best[active])]
        return number, best, exact

    def _better(self, x, rows, c, number, best) -> None:
        d = ((x[rows] - self.centroids[c]) ** 2).sum(axis=1)
        first = np.lexsort((c, d, rows))
        rows, c, d = rows[first], c[first], d[first]
        lead = np.flatnonzero(np.diff(rows, prepend=-1))
        rows, c, d = rows[lead], c[lead], d[lead]
        won = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
        number[rows[won]], best[rows[won]] = c[won], d[won]


def _assigned(it: Iterator[pa.RecordBatch], lists: SortedLists):
    """(batch, first row, vectors, their centroids and distances), block by block."""
    dims = lists.centroids.shape[1]
    for b in it:
        v = unpack(b.column(b.schema.get_field_index("v")), dims, np.int32)
        for i in range(0, len(v), ROWS):
            x = v[i:i + ROWS].astype(np.int64)
            number, best, _ = lists.nearest(x)
            yield b, i, x, number, best


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list:
    """Rows (cluster, dim, n, total): per cluster its vectors' sums."""
    k, dims = centroids.shape

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, total, n = SortedLists(centroids), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, _, x, number, _ in _assigned(it, lists):
            np.add.at(total, number, x)
            n += np.bincount(number, minlength=k)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, dims)), pa.array(np.tile(np.arange(dims), len(own))),
             pa.array(np.repeat(n[own], dims)), pa.array(total[own].ravel())], names=["cluster", "dim", "n", "total"])
    return (vectors.select("v").mapInArrow(run, "cluster bigint, dim bigint, n bigint, total bigint")
            .groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .collect())  # k x dims rows at most


def first_centroids(vectors: DataFrame, dims: int, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest lower-case hex SHA-256 of ``seed:id``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "id", "v").orderBy(F.asc_nulls_last("key"), "id", "v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], np.int32) for r in rows], np.int64).reshape(len(rows), dims)


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 8,
            rounds: int = 10, scale: int = 1024, seed: int = 3) -> DataFrame:
    """One row per vector that takes part: the id, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256 (of the final centroid's
    components, decimal, joined by commas)."""
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "centroids")
    rows = whole_vectors(df, {"id": id_col}, vector_col, dims)
    vectors = scratch.put(packed(rows, dims, scale), "vectors")
    centroids = first_centroids(vectors, dims, k, seed)
    out_schema = f"`{id_col}` {dict(vectors.dtypes)['id']}, cluster int, distance bigint"
    if not len(centroids):
        return spark.createDataFrame([], out_schema + ", cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for _ in range(rounds):
        new = centroids.copy()
        for r in _sums(vectors, centroids):
            new[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]  # exact, rounded down
        if (new == centroids).all():
            break  # every later round would find the same
        centroids = new

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, x, number, best in _assigned(it, SortedLists(centroids)):
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, len(x)), pa.array(number.astype(np.int32)), pa.array(best)],
                                             names=[id_col, "cluster", "distance"])
    done = scratch.put(vectors.select("id", "v").mapInArrow(run, out_schema), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = done.groupBy("cluster").agg(total.alias("d")).collect()  # k rows
    long = lambda d: int(d) if d < 1 << 63 else None
    whole = long(sum(r["d"] for r in own))
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(r["cluster"], long(r["d"]), whole, names[r["cluster"]]) for r in own],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return done.join(F.broadcast(facts), "cluster").select(f"`{id_col}`", "cluster", "distance", "cluster_inertia",
                                                           "inertia", "centroid_sha256")
