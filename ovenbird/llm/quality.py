"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Fit: the labelled texts (a bounded sample, ``sample`` rows of smallest id hash)
become term counts; terms are trigrams of character classes, hashed words and
adjacent repeats of words.  Weighted by log frequency and idf, a truncated SVD
on the driver gives the latent space (size: sample x terms, both bounded).

Score: the labelled vectors and the projection are broadcast (their size is
``sample`` and ``RANK`` numbers a term).  Every document is projected, its
cosines with all labelled vectors are computed exactly, block by block as
matrix products, and its ``neighbours`` nearest (at most the square root of the
sample) vote with their label, weighted by similarity.

Defined results: a null or empty text, or one without a positive cosine, gets
the share of label 1 among the sample; a doc_id labelled twice counts once with
its smallest label; null labels or ids teach nothing; without any labelled text
every score is 1; an empty table gives no rows.  Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import batches, column, flat_bytes, free_name, id_text

SAMPLE = 3000
RANK = 64
NEIGHBOURS = 15
BLOCK = 256
FOLDS = 5
#: Bytes of a text that are counted at once.
LONG = 1 << 20

SHAPES, WORDS, REPEATS = 4096, 2048, 6
TERMS = SHAPES + WORDS + REPEATS
#: What each group of terms weighs in a document's vector.
WEIGHTS = (1.0, 0.4, 0.8)


def _classes() -> np.ndarray:
    c = np.full(256, 15, np.uint8)
    c[97:123], c[65:91], c[48:58], c[128:192], c[192:] = 0, 1, 2, 12, 13
    c[32], c[9], c[10], c[13] = 3, 3, 4, 4
    for k, chars in ((5, ".;:"), (6, ","), (7, "|"), (8, "!?"), (9, "#$%&*@^~"), (10, "()[]{}<>"), (11, "-_/\\=+"), (14, "'\"`")):
        for x in chars:
            c[ord(x)] = k
    return c


_CLASS = _classes()


def term_counts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of all terms, a row for each text.  Texts are counted in pieces of
    ``LONG`` bytes at most, each with its row."""
    size = np.diff(off)
    if not len(size) or size.max() <= LONG:
        return _piece_counts(raw, off)
    out = np.zeros((len(size), TERMS), np.float32)
    for i in range(len(size)):
        for at in range(int(off[i]), int(off[i + 1]), LONG):
            part = raw[at:min(at + LONG, int(off[i + 1]))]
            out[i] += _piece_counts(part, np.array([0, len(part)]))[0]
    return out


def _piece_counts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    out = np.zeros((n, TERMS), np.float32)
    if not len(raw):
        return out
    k = _CLASS[raw].astype(np.int64)
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    if len(raw) > 2:
        whole = row[:-2] == row[2:]
        code = (k[:-2] << 8 | k[1:-1] << 4 | k[2:]) + row[:-2] * SHAPES
        out[:, :SHAPES] = np.bincount(code[whole], minlength=n * SHAPES).reshape(n, SHAPES)
    low = words.LOWER[raw]
    starts, ends, of = words.spans(low, off)
    if len(starts):
        h = words.hashes(low, starts, ends)
        place = (h >> np.uint64(20)).astype(np.int64) % WORDS + of * WORDS
        out[:, SHAPES:SHAPES + WORDS] = np.bincount(place, minlength=n * WORDS).reshape(n, WORDS)
        for lag in range(1, REPEATS // 2 + 1):
            same_text = of[lag:] == of[:-lag]
            equal = h[lag:] == h[:-lag]
            at = SHAPES + WORDS + 2 * (lag - 1)
            out[:, at] = np.bincount(of[lag:][same_text & equal], minlength=n)
            out[:, at + 1] = np.bincount(of[lag:][same_text & ~equal], minlength=n)
    return out


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    for cut, weight in zip((slice(0, SHAPES), slice(SHAPES, SHAPES + WORDS), slice(SHAPES + WORDS, TERMS)), WEIGHTS,
                           strict=True):
        norm = np.linalg.norm(x[:, cut], axis=1, keepdims=True)
        x[:, cut] *= weight / np.where(norm > 0, norm, 1)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 1e-9, norm, np.inf)


@dataclass
class Model:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def scores(self, counts: np.ndarray) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 1.0
        if not len(self.labels) or not len(counts):
            return np.full(len(counts), prior)
        cosine = _unit(_weighted(counts, self.idf) @ self.projection) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        return np.where(total > 0, (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1), prior)


def held_out(doc_id: Column) -> Column:
    """Whether a document is of the held-out fold (one without an id is not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE,
        neighbours: int = NEIGHBOURS) -> Model:
    """Learn from the labelled rows outside the held-out fold."""
    known = (labels.select(column(labels, "doc_id").alias("doc_id"), column(labels, label).alias("label"))
             .dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = id_text(docs)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 2 << 20):
            counts = term_counts(*flat_bytes(b.column(b.schema.get_field_index("text"))))
            terms = [np.flatnonzero(x) for x in counts]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("order")), b.column(b.schema.get_field_index("label")),
                 pa.array([t.astype(np.int32) for t in terms], pa.list_(pa.int32())),
                 pa.array([x[t] for x, t in zip(counts, terms, strict=True)], pa.list_(pa.float32()))],
                names=["order", "label", "terms", "counts"])

    # ``chosen`` has at most ``sample`` rows of an id and a label.
    rows = (texts.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id").alias("order"),
                                                             F.col("label").cast("int").alias("label"), "text")
            .mapInArrow(run, "order bigint, label int, terms array<int>, counts array<float>")
            .toArrow().sort_by([("order", "ascending"), ("label", "ascending")]))
    sample = _Sample(rows)
    idf = (np.log((1 + sample.n) / (1 + sample.texts_with_term())) + 1).astype(np.float32)
    projection = _top_directions(sample, idf, RANK)
    vectors = np.concatenate([np.zeros((0, RANK), np.float32), *[_unit(x @ projection) for x in sample.blocks(idf)]])
    y = rows["label"].to_numpy().astype(np.float64)
    # A small sample has few rows of each kind to vote.
    votes = min(neighbours, max(1, round(sample.n ** 0.5)))
    return Model(idf, projection, vectors, (y > 0).astype(np.float64), votes)


class _Sample:
    """The term counts of the sample, of which a block of rows is dense at a time."""

    def __init__(self, rows: pa.Table):
        terms, counts = (rows[c].combine_chunks() for c in ("terms", "counts"))
        self.n = rows.num_rows
        self.terms, self.counts = terms.flatten().to_numpy(), counts.flatten().to_numpy()
        self.ends = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())]) if self.n else np.zeros(1, np.int64)

    def texts_with_term(self) -> np.ndarray:
        return np.bincount(self.terms, minlength=TERMS)

    def blocks(self, idf: np.ndarray) -> Iterator[np.ndarray]:
        """Rows x TERMS weighted counts."""
        for i in range(0, self.n, BLOCK):
            ends = self.ends[i:i + BLOCK + 1]
            x = np.zeros((len(ends) - 1, TERMS), np.float32)
            own = slice(ends[0], ends[-1])
            x[np.repeat(np.arange(len(x)), np.diff(ends)), self.terms[own]] = self.counts[own]
            yield _weighted(x, idf)


def _top_directions(sample: _Sample, idf: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors (randomised subspace iteration), from
    blocks of rows."""
    if not sample.n:
        return np.zeros((TERMS, rank), np.float32)
    rng = np.random.default_rng(7)
    q = rng.standard_normal((TERMS, rank + 16)).astype(np.float32)
    for _ in range(4):
        total = np.zeros_like(q)
        for x in sample.blocks(idf):
            total += x.T @ (x @ q)
        q, _ = np.linalg.qr(total)
    _, _, v = np.linalg.svd(np.concatenate([x @ q for x in sample.blocks(idf)]), full_matrices=False)
    out = np.zeros((TERMS, rank), np.float32)
    found = (q @ v.T)[:, :rank]
    out[:, :found.shape[1]] = found
    return out


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The documents with a column ``name`` (one of that name must not exist)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 4 << 20):
            at = b.schema.get_field_index("text")
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                text = part.column(at)
                got = shared.value.scores(term_counts(*flat_bytes(text.cast(pa.string()))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())],
                                                 names=[*part.schema.names, name])
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **how) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on)."""
    texts = id_text(docs)
    scored = score(texts, fit(docs, labels, **how))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns."""
    name = free_name(docs, "quality_score")
    scored = score(docs.withColumn("text", column(docs, "text").cast("string")), fit(docs, labels), name)
    return scored.filter(F.col(name) >= threshold).select(*[f"`{c}`" for c in docs.columns])
