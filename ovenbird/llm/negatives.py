"""Hard-negative mining with segment summaries.

An anchor's positives are the rows of its label with the highest inner products;
a positive's hard negatives are the best rows of other labels whose score lies
in a window below the positive's.  Scores are exact integers.

Every vector is stored with the mean and the deviation (population) of its
segments, at some levels of ever shorter segments.  With L components in a segment,

    L * (mean_x * mean_y - dev_x * dev_y) <= x . y <= L * (mean_x * mean_y + dev_x * dev_y)

and the sums over the segments bound a score.  A pair that can't be among an
anchor's best, or whose bounds miss the windows of all its positives, is left
out at the first level that shows it; rows and anchors with pairs left are refined
with the next level's summaries, and what is left after the last gets its exact
score (one matrix product where many pairs of a tile are left).

Anchors are taken in chunks of ``CHUNK`` rows, which are broadcast (a bound that
doesn't grow with the table); each chunk is matched with all rows in blocks
where they lie, once for the positives and once for the negatives.  A task
keeps the best few per anchor, Spark ranks them over the tasks.  The work is
anchors times rows, as the definition has it; no row is left out unscored
unless its bounds prove that it can't matter.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; a shorter vector ends in zeros; a row is never its own
positive, but another row of the same id may be; every row with an anchor's id
is an anchor of its own; rows without an id are positives and negatives (after
all others on ties), never anchors; an anchor without rows of its label or a
positive without rows in its window has no rows; ties go to the smaller id; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, column
from .vectors import pack, quantise, unpack, whole_vectors

#: Anchors of a chunk, anchors and rows of a tile, pairs scored at once.
CHUNK, ANCHORS, ROWS, PAIRS = 16384, 512, 1024, 1 << 15
#: Bytes of a chunk's vectors and summaries, if it takes fewer rows than ``CHUNK``.
CHUNK_BYTES = 32 << 20
#: Segments of the summary levels.
LEVELS = (4, 16)
NO_ID = np.iinfo(np.int64).max
LOWEST = np.iinfo(np.int64).min


# ------------------------------------------------------------------ summaries

def levels(dims: int) -> list[int]:
    """Numbers of segments that are less than half of the components."""
    return [s for s in LEVELS if 2 * s <= dims]


def summaries(v: np.ndarray, segments: int) -> np.ndarray:
    """Per row its segments' sqrt(L) * mean, then their sqrt(L) * deviation."""
    cuts = np.arange(segments) * v.shape[1] // segments
    length = np.diff(cuts, append=v.shape[1])
    x = v.astype(np.float64)
    mean = np.add.reduceat(x, cuts, axis=1) / length
    square = np.add.reduceat((x - np.repeat(mean, length, axis=1)) ** 2, cuts, axis=1)
    return np.concatenate([mean * np.sqrt(length), np.sqrt(square)], axis=1)


class Block:
    """Vectors of some rows with their summaries."""

    def __init__(self, ids, rows, labels, v, sums):
        self.ids, self.rows, self.labels, self.v, self.sums = ids, rows, labels, v, sums

    def take(self, at) -> Block:
        return Block(self.ids[at], self.rows[at], self.labels[at], self.v[at], [s[at] for s in self.sums])

    def __len__(self) -> int:
        return len(self.ids)


def stored(df: DataFrame, dims: int, scale: int) -> DataFrame:
    """id, label, row (a number of its own), v and one summary binary per level."""
    widths = levels(dims)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            v = quantise(b.column(3), dims, scale)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pack(v.astype(np.int32)),
                                              *[pack(summaries(v, s)) for s in widths]],
                                             names=["id", "label", "row", "v", *[f"s{s}" for s in widths]])
    more = "".join(f", s{s} binary" for s in widths)
    return df.select("id", "label", F.monotonically_increasing_id().alias("row"), "embedding").mapInArrow(
        run, f"id bigint, label bigint, row bigint, v binary{more}")


def block_of(b: pa.RecordBatch | pa.Table, dims: int) -> Block:
    widths, get = levels(dims), lambda n: b.column(b.schema.get_field_index(n))
    whole = lambda n: get(n).to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch) else get(n).to_numpy()
    ids = (get("id").fill_null(NO_ID) if get("id").null_count else get("id"))
    ids = ids.to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch) else ids.to_numpy()
    return Block(ids, whole("row"), whole("label"), unpack(get("v"), dims, np.int32).astype(np.int64),
                 [unpack(get(f"s{s}"), 2 * s, np.float64) for s in widths])


# --------------------------------------------------------------------- bounds

def _slack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """More than rounding can take from a bound, given sums of squares."""
    return 1e-9 * np.sqrt(a * b) + 1e-6


def bounds(a: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the scores of all anchors with all rows."""
    s = a.shape[1] // 2
    middle, spread = a[:, :s] @ r[:, :s].T, a[:, s:] @ r[:, s:].T
    spread += _slack((a ** 2).sum(1)[:, None], (r ** 2).sum(1)[None, :])
    return middle - spread, middle + spread


def pair_scores(a: Block, r: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs (anchor i, row j) of a tile."""
    size = int(max(np.abs(a.v).max(initial=0), np.abs(r.v).max(initial=0)))
    if size * size * a.v.shape[1] < 1 << 53 and 32 * len(i) > len(a) * len(r):
        # Every partial sum is a whole number that a double holds.
        return (a.v.astype(np.float64) @ r.v.astype(np.float64).T)[i, j].astype(np.int64)
    return np.concatenate([np.zeros(0, np.int64), *[(a.v[i[k:k + PAIRS]] * r.v[j[k:k + PAIRS]]).sum(axis=1)
                                                    for k in range(0, len(i), PAIRS)]])


def surviving(anchors: Block, rows: Block, possible, least, most) -> tuple:
    """(anchor, row, exact score) of the pairs of a tile that no level rules out
    and that can matter.  ``possible``: pairs to look at; ``least`` and ``most``: per
    anchor, the scores that can matter."""
    for a, r in zip(anchors.sums, rows.sums, strict=True):
        at = np.flatnonzero(possible.any(axis=1))
        to = np.flatnonzero(possible.any(axis=0))  # whoever is ruled out everywhere is not refined
        low, high = bounds(a[at], r[to])
        left = (high >= least[at, None]) & (low <= most[at, None])
        if left.shape == possible.shape:
            possible &= left
        else:
            possible[np.ix_(at, to)] &= left
    i, j = np.nonzero(possible)
    score = pair_scores(anchors, rows, i, j)
    good = (score >= least[i]) & (score <= most[i])
    return i[good], j[good], score[good]


# ---------------------------------------------------------- best few per group

class Best:
    """The ``n`` best (score, then smaller id) of each of some groups."""

    def __init__(self, groups: int, n: int):
        self.n = n
        self.score = np.full((groups, n), LOWEST)
        self.id = np.full((groups, n), NO_ID)
        self.row = np.full((groups, n), -1)

    def worst(self, groups) -> np.ndarray:
        """What a score must reach to come in."""
        return self.score[groups, self.n - 1]

    def add(self, group, score, ids, rows) -> None:
        if not len(group):
            return
        touched, group = np.unique(group, return_inverse=True)
        g = np.concatenate([group, np.repeat(np.arange(len(touched)), self.n)])
        s = np.concatenate([score, self.score[touched].ravel()])
        i = np.concatenate([ids, self.id[touched].ravel()])
        r = np.concatenate([rows, self.row[touched].ravel()])
        order = np.lexsort((i, ~s, g))  # ~s: descending scores without overflow
        g, s, i, r = g[order], s[order], i[order], r[order]
        first = np.flatnonzero(np.diff(g, prepend=-1))
        take = (first[:, None] + np.arange(self.n)).ravel()  # every group has n entries at least
        shape = (len(touched), self.n)
        self.score[touched], self.id[touched], self.row[touched] = (x[take].reshape(shape) for x in (s, i, r))

    def rows(self) -> tuple:
        group, place = np.nonzero(self.row >= 0)
        return group, self.score[group, place], self.id[group, place], self.row[group, place]


def _tiles(block: Block, anchors: Block, same: bool) -> Iterator[tuple]:
    """(anchor numbers, rows) that are to be scored: anchors of one label with the
    rows of that label, or of all others."""
    for label in np.unique(anchors.labels):
        own = np.flatnonzero(anchors.labels == label)
        rows = np.flatnonzero((block.labels == label) == same)
        for i in range(0, len(own), ANCHORS):
            for j in range(0, len(rows), ROWS):
                yield own[i:i + ANCHORS], rows[j:j + ROWS]


def best_of_label(blocks, anchors: Block, n: int) -> Best:
    """Per anchor the ``n`` best other rows of its label."""
    best = Best(len(anchors), n)
    for block in blocks:
        for own, at in _tiles(block, anchors, True):
            a, r = anchors.take(own), block.take(at)
            possible = a.rows[:, None] != r.rows[None, :]
            least = best.worst(own).astype(np.float64)
            if a.sums and len(r) > n:  # n other rows of the tile score at least this much
                low, _ = bounds(a.sums[0], r.sums[0])
                low[~possible] = -np.inf
                least = np.maximum(least, np.partition(low, len(r) - n, axis=1)[:, len(r) - n])
            i, j, score = surviving(a, r, possible, least, np.full(len(a), np.inf))
            best.add(own[i], score, r.ids[j], r.rows[j])
    return best


def best_in_windows(blocks, anchors: Block, low: np.ndarray, high: np.ndarray, n: int) -> Best:
    """Per anchor and window (low to high, anchors x windows; empty ones have
    low > high) the ``n`` best rows of other labels with a score in it."""
    windows = low.shape[1]
    best = Best(len(anchors) * windows, n)
    most = np.where(low <= high, high, LOWEST).max(axis=1).astype(np.float64)
    for block in blocks:
        for own, at in _tiles(block, anchors, False):
            need = np.maximum(low[own], best.worst(own[:, None] * windows + np.arange(windows)))
            least = np.where(low[own] <= high[own], need.astype(np.float64), np.inf).min(axis=1)
            a, r = anchors.take(own), block.take(at)
            i, j, score = surviving(a, r, np.ones((len(a), len(r)), bool), least, most[own])
            for w in range(windows):
                fits = (score >= need[i, w]) & (score <= high[own[i], w])
                best.add(own[i[fits]] * windows + w, score[fits], r.ids[j[fits]], r.rows[j[fits]])
    return best


# ------------------------------------------------------------------------ jobs

def _first(df: DataFrame, group: list[str], n: int) -> DataFrame:
    """The ``n`` best rows per group, ranked from 1 (Spark cuts each task's groups
    to n rows before they are shuffled)."""
    w = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def _search(rows: DataFrame, dims: int, shared, find) -> DataFrame:
    """The best rows that each task finds: group, score, id (null: none), row."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, score, ids, row = find((block_of(b, dims) for b in it if b.num_rows), shared.value).rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(group), pa.array(score), pa.array(ids, mask=ids == NO_ID), pa.array(row)],
            names=["group", "score", "id", "row"])
    return rows.mapInArrow(run, "group bigint, score bigint, id bigint, row bigint")


def mine(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         anchor: Column | None = None, scale: int = 256, positives: int = 5, negatives: int = 3,
         low_pct: int = 50, high_pct: int = 95, chunk: int = CHUNK) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score.  ``anchor``: which ids (column ``id``) are anchors; the default
    is every id divisible by 50."""
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "negatives")
    rows = whole_vectors(df.filter(column(df, label_col).isNotNull()), {"id": id_col, "label": label_col}, vector_col)
    rows = rows.withColumns({"id": F.col("id").cast("bigint"), "label": F.col("label").cast("bigint")})
    dims = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    table = scratch.put(stored(rows, dims, scale), "rows")
    chunk = max(1, min(chunk, CHUNK_BYTES // max(1, 16 * dims + 24)))
    chosen = (F.col("id") % 50 == 0) if anchor is None else anchor
    # Anchors in the order of their rows, so that a chunk is a range of numbers.
    anchors = scratch.put(table.filter(chosen & F.col("id").isNotNull()), "anchors")
    per_part = anchors.groupBy(F.shiftright("row", 33).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first"), F.max("row").alias("last")).orderBy("part").collect()
    out = None
    for part in _ranges([(r["first"], r["last"], r["n"]) for r in per_part], anchors, chunk):
        found = _mine_chunk(spark, scratch, table, anchors.filter(F.col("row").between(*part)), dims, positives,
                            negatives, low_pct, high_pct, part[0])
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    return out


def _ranges(parts: list[tuple], anchors: DataFrame, chunk: int) -> Iterator[tuple]:
    """Ranges of row numbers with at most ``chunk`` anchors each: whole partitions
    together, a larger one cut."""
    start = end = None
    held = 0
    for first, last, n in parts:
        if held and held + n > chunk:
            yield start, end
            held = 0
        if n > chunk:
            cut = F.floor((F.row_number().over(Window.partitionBy(F.shiftright("row", 33)).orderBy("row")) - 1) / chunk)
            for r in anchors.filter(F.col("row").between(first, last)).select("row", cut.alias("c")).groupBy("c").agg(
                    F.min("row").alias("a"), F.max("row").alias("b")).orderBy("c").collect():
                yield r["a"], r["b"]
            continue
        start = start if held else first
        end, held = last, held + n
    if held:
        yield start, end


def _mine_chunk(spark, scratch: Scratch, table: DataFrame, chosen: DataFrame, dims: int, n_pos: int, n_neg: int,
                low_pct: int, high_pct: int, name: int) -> DataFrame:
    anchors = block_of(chosen.toArrow().combine_chunks(), dims)
    shared = spark.sparkContext.broadcast(anchors)
    near = _first(_search(table, dims, shared, lambda blocks, a: best_of_label(blocks, a, n_pos)), ["group"], n_pos)
    pos = scratch.put(near, f"positives-{name}", len(anchors) * n_pos)
    p = pos.toArrow()  # at most n_pos rows per anchor of the chunk
    group, place, score = (p.column(c).to_numpy() for c in ("group", "rank", "score"))
    low, high = np.ones((len(anchors), n_pos), np.int64), np.zeros((len(anchors), n_pos), np.int64)
    low[group, place - 1] = -((-low_pct * score) // 100)
    high[group, place - 1] = high_pct * score // 100
    shared.destroy()
    both = spark.sparkContext.broadcast((anchors, low, high))
    hard = _first(_search(table, dims, both, lambda blocks, a: best_in_windows(blocks, *a, n_neg)), ["group"], n_neg)
    neg = scratch.put(hard, f"negatives-{name}", len(anchors) * n_pos * n_neg)
    both.destroy()
    names = chosen.sparkSession.createDataFrame(
        pa.table({"group": pa.array(np.arange(len(anchors))), "anchor_id": pa.array(anchors.ids)}))
    own = pos.select((F.col("group") * n_pos + F.col("rank") - 1).alias("pair"), "group", F.col("id").alias("positive_id"),
                     F.col("score").alias("positive_score"))
    return (neg.withColumnRenamed("group", "pair").join(own, "pair").join(names, "group").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")))
