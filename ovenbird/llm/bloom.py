"""A Bloom filter of bounded size, broadcast to keep rows from a shuffle.

It only decides which rows go through an exact step, so a false positive costs
work and never changes a result; beyond ``MAX_BITS`` its rate of false
positives rises and more rows are shuffled, all still handled exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, free_name, text_hash

MAX_BITS = 1 << 27  # 16 MB: the bound of what is collected and broadcast
BITS_PER_KEY = 16
PROBES = 4


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """keys: 64-bit hashes, as signed or unsigned numbers."""
        h = keys.astype(np.int64, copy=False).view(np.uint64)
        step = (h >> np.uint64(32)) | np.uint64(1)
        hit = np.ones(len(h), bool)
        for i in range(PROBES):
            at = (h + np.uint64(i) * step) & self.mask
            hit &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return hit


def build(keys: DataFrame, count: int | None = None) -> Bloom:
    """keys: a column ``h`` of 64-bit hashes.  The words of the filter are
    or-ed on the executors; at most ``MAX_BITS / 64`` of them come back."""
    count = keys.count() if count is None else count
    bits = 1 << 10
    while bits < MAX_BITS and bits < count * BITS_PER_KEY:
        bits <<= 1
    step = F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1).cast("bigint"))
    low = F.col("h").bitwiseAND(F.lit(bits - 1).cast("bigint"))
    narrow = step.bitwiseAND(F.lit(bits - 1).cast("bigint"))  # only the low bits of the sum count
    at = F.explode(F.array(*[(low + narrow * i).bitwiseAND(F.lit(bits - 1).cast("bigint")) for i in range(PROBES)]))
    words = (keys.select(at.alias("at"))
             .groupBy(F.shiftrightunsigned("at", 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                           F.col("at").bitwiseAND(F.lit(63).cast("bigint")).cast("int"))).alias("bits"))
             ).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return Bloom(out)


def test(shared) -> "callable":
    """The membership test of a broadcast filter, as a column function."""
    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value.contains(h.to_numpy(np.int64)))
    return hit


def drop_documents(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.  decided: doc_id, raw
    (``text_hash`` of the text) and stays, for all rows that go and any others.  Rows
    of the same id or without one are told apart by their texts; of rows that have
    the same id (or none) and the same text and stay, one is left."""
    scratch = Scratch(docs.sparkSession, "dropped")
    out = scratch.put(decided.groupBy("doc_id", "raw", "stays").agg(F.count(F.lit(1)).alias("n"))
                      .filter(~F.col("stays") | (F.col("n") > 1)), "documents")
    shared = docs.sparkSession.sparkContext.broadcast(build(out.select(F.xxhash64("doc_id", "raw").alias("h"))))
    raw = free_name(docs, "text_sha")
    known = docs.withColumn(raw, text_hash(column(docs, "text")))
    hit = test(shared)(F.xxhash64(column(known, "doc_id"), F.col(raw)))
    suspects = known.filter(hit)
    gone = out.filter(~F.col("stays")).select(F.col("doc_id").alias("__id"), F.col("raw").alias("__gone"))
    kept = suspects.join(gone, column(suspects, "doc_id").eqNullSafe(gone["__id"]) & (suspects[raw] == gone["__gone"]),
                         "left_anti")
    if not out.filter("stays").isEmpty():
        kept = kept.dropDuplicates(["doc_id", raw])
    return known.filter(~hit).unionByName(kept).drop(raw)
