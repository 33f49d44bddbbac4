"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Every document becomes a 64-bit fingerprint of its normalised text (white
   space ``[\\x20\\x09-\\x0D]`` deleted).
2. Senders (chunks of documents) sort their distinct fingerprints, cut them by
   hash range and send each range Golomb-Rice coded to its owner: a few bytes
   per distinct fingerprint, and a hot text once per sender.
3. Owners answer with bitmaps: which fingerprints another sender has as well.
4. Fingerprints that a bitmap or the sender itself marks go into a Bloom filter
   of bounded size; the texts that pass it are the suspects.  Only they are
   shuffled and compared byte by byte (grouped by the text itself, partially
   aggregated first, so a hot text does not gather in one task).

All classes come from the byte comparison; the fingerprints only choose what is
compared.  Equal texts have equal fingerprints, so none is missed.

Defined results: a null text is empty, and empty texts equal each other; of
equal texts the row with the most code points in its original text stays, then
the smallest doc_id (null before all others), then any: exactly one row of a
class is kept, also of rows that repeat a doc_id and its text; an empty table
gives no rows; a very long text is normalised and compared whole; other
columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import SPACES, Scratch, batches, column, id_text, sha

#: Distinct fingerprints of one message at most (bounds a sender's memory).
CHUNK = 500_000
#: Documents per owner at most on average: hash ranges are even, so this bounds an
#: owner's distinct fingerprints, and one fingerprint comes once from a sender.
OWNER_ROWS = 2_000_000


def owner_count(rows: int, partitions: int) -> int:
    """Owners for a table of ``rows`` documents: the session's partitions, and more
    of them where an owner would get more than ``OWNER_ROWS``."""
    return max(1, partitions, -(-rows // OWNER_ROWS))


def normalise(text: str) -> bytes:
    return text.encode("utf-8").translate(None, SPACES)


def fingerprint(norm: bytes) -> int:
    """A signed 64-bit hash."""
    h = xxhash.xxh64_intdigest(norm, seed=42)
    return h - (1 << 64) if h >> 63 else h


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 numbers: count, width of the remainders and first
    number, then the gaps' quotients in unary and their remainders."""
    n = len(values)
    if not n:
        return np.array([0, 0, 0], np.uint64).tobytes()
    gaps = np.diff(values) - np.uint64(1)
    mean = float(gaps.astype(np.float64).mean()) if n > 1 else 0.0
    width = max(0, int(np.log2(mean * 0.6931 + 1)))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    # A quotient q: q ones, then a zero.
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]) if n > 1 else 0, np.uint8)
    unary[ends - 1] = 0
    rest = gaps & np.uint64((1 << width) - 1)
    bits = ((rest[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    head = np.array([n, width, values[0]], np.uint64).tobytes()
    return head + np.uint64(len(unary)).tobytes() + np.packbits(unary).tobytes() + np.packbits(bits.ravel()).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    n, width, first = (int(x) for x in np.frombuffer(data, np.uint64, 3))
    if not n:
        return np.zeros(0, np.uint64)
    size = int(np.frombuffer(data, np.uint64, 1, 24)[0])
    at = 32 + (size + 7) // 8
    unary = np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, 32), count=size)
    quotients = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(data, np.uint8, -1, at), count=(n - 1) * width).reshape(n - 1, width)
    rest = (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    out = np.empty(n, np.uint64)
    out[0] = first
    out[1:] = (quotients.astype(np.uint64) << np.uint64(width)) + rest + np.uint64(1)
    return np.cumsum(out, dtype=np.uint64)


def _fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, h, sha (hex of the normalised text) and raw (``text_hash``)."""
    kind = docs.select(column(docs, "doc_id").alias("doc_id")).dtypes[0][1]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            texts = [x or "" for x in b.column(1).to_pylist()]
            norms = [normalise(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(x) for x in norms], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in norms]),
                 pa.array([sha(x) for x in texts], pa.binary()), pa.array([len(x) for x in texts], pa.int64())],
                names=["doc_id", "h", "sha", "raw", "points"])
    return id_text(docs).mapInArrow(run, f"doc_id {kind}, h bigint, sha string, raw binary, points bigint").withColumn(
        "place", F.monotonically_increasing_id())


def _messages(hashes: DataFrame, owners: int) -> DataFrame:
    """One row per sender and owner: its coded fingerprints and, as a bitmap,
    which of them the sender itself holds more than once."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send():
            if not held:
                return
            values, times = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            held.clear()
            owner = ((values >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
            cuts = np.flatnonzero(np.diff(owner)) + 1
            rows = list(zip(np.split(values, cuts), np.split(times > 1, cuts), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(owner[c]) for c in [0, *cuts]], pa.int32()),
                 pa.array([golomb_encode(v) for v, _ in rows], pa.binary()),
                 pa.array([np.packbits(t).tobytes() for _, t in rows], pa.binary())], names=["owner", "coded", "own"])
        for b in it:
            if b.num_rows:
                held.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            if sum(map(len, held)) >= CHUNK:
                yield from send()
        yield from send()
    return hashes.mapInArrow(run, "owner int, coded binary, own binary").withColumn(
        "message", F.monotonically_increasing_id())


def _answer(key, messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: which numbers of a message another one has too."""
    lists = [golomb_decode(x) for x in messages["coded"]]
    values = np.concatenate(lists)
    _, place, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    ends = np.cumsum([len(x) for x in lists])
    return pd.DataFrame({"message": messages["message"],
                         "bitmap": [np.packbits(x).tobytes() for x in np.split(shared, ends[:-1])]})


def _marked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for coded, own, bitmap in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            values = golomb_decode(coded)
            bits = np.frombuffer(own, np.uint8) | np.frombuffer(bitmap, np.uint8)
            found = values[np.unpackbits(bits, count=len(values)).astype(bool)]
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["h"])


def duplicate_classes(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _classes(docs, owners).drop("raw", "stays")


def _classes(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """``duplicate_classes`` with raw (``text_hash``) and stays: whether the row has
    the id and the text of the one that is kept."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    kind = docs.select(column(docs, "doc_id").alias("doc_id")).dtypes[0][1]
    prints = scratch.put(_fingerprints(docs), "fingerprints")
    owners = owners or owner_count(prints.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = scratch.put(_messages(prints.select("h"), owners), "messages")
    bitmaps = sent.select("owner", "message", "coded").groupBy("owner").applyInPandas(
        _answer, "message bigint, bitmap binary")
    marked = sent.join(bitmaps, "message").select("coded", "own", "bitmap").mapInArrow(_marked, "h bigint")
    suspects = scratch.put(marked.distinct(), "marked")
    shared = spark.sparkContext.broadcast(bloom.build(suspects))
    scratch.drop("messages")
    scratch.drop("marked")

    def suspect_texts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            norms = [normalise(x or "") for x in b.column(1).to_pylist()]
            rows = np.flatnonzero(shared.value.contains(np.array([fingerprint(x) for x in norms], np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(norms[i]).hexdigest() for i in rows], pa.string()),
                 pa.array([norms[i] for i in rows], pa.binary())], names=["sha", "norm"])

    texts = id_text(docs).mapInArrow(suspect_texts, "sha string, norm binary")
    # Grouping by the bytes themselves is the comparison.
    verified = texts.groupBy("sha", "norm").agg(
        F.count(F.lit(1)).alias("size"))
    one = scratch.put(verified.groupBy("sha").agg(
        F.count(F.lit(1)).alias("texts"), F.max("size").alias("size")), "classes")
    if one.filter("texts > 1").limit(1).count():
        raise RuntimeError("two different texts share a SHA-256")
    hit = bloom.test(shared)(F.col("h"))
    # Of the row's own place, so that one of several equal rows of an id is kept.
    best = prints.filter(hit).groupBy("sha").agg(
        F.min(F.struct((-F.col("points")).alias("p"), "doc_id", "raw", "place")).alias("best"))
    # Stored, so that the join below has a plain side and Spark can split a hot class.
    facts = scratch.put(one.join(best, "sha"), "facts")
    alone = prints.filter(~hit).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), "raw", F.lit(True).alias("stays"))
    same = F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
    grouped = prints.filter(hit).join(facts, "sha").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("place") == F.col("best.place")).alias("kept"), F.col("sha").alias("text_sha256"), "raw", (same & (F.col("raw") == F.col("best.raw"))).alias("stays"))
    return alone.unionByName(grouped)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return bloom.drop_documents(docs, _classes(docs).select("doc_id", "raw", "stays"))
