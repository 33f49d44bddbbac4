"""Token ids as Re-Pair compressed shards with random access.

Documents are range-sorted by doc_id, tokenised and cut into shards of about
``SHARD_TOKENS`` ids.  In every shard the frequent pairs of adjacent symbols are
replaced by nonterminals, again and again: a round counts all pairs, makes rules
of the most frequent ones and rewrites the sequence, until a round saves less
than ``LEAST_GAIN`` or no symbol number is left (symbols are 16-bit numbers).
No pair crosses a document border, so each document is a slice of the shard's
symbols.

File format: a Parquet table, one row for each shard, in ascending doc_id order
(``part``, ``shard``):

* ``rules``: two symbols (unsigned 16-bit, little-endian) of each nonterminal;
  number k has the symbol ``base + k`` and refers to earlier ones only;
* ``lengths``: the number of ids it expands to (unsigned 32-bit);
* ``symbols``: the rewritten sequence (unsigned 16-bit);
* ``doc_ids``, ``doc_symbols``, ``doc_tokens``: of each document its id, the
  number of its symbols and of its ids (with the end id);
* ``part_start``: ids of the part in front of the shard.

Spark writes the rows (a lost task is run again, a failed job leaves no table);
``decode_range`` reads any range of a document's ids by skipping over symbols
with their expansion lengths.

Defined results: a null or empty text is the end id alone; rows that repeat a
doc_id are stored each, in order of their text's hash; a null doc_id comes
first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_ids import byte_ids
from .common import Scratch, batches, id_text

END_ID = 0
BASE = 50257
SHARD_TOKENS = 1 << 20
#: A pair becomes a rule if it occurs so often; a round goes on if it saves this share.
LEAST_COUNT = 8
LEAST_GAIN = 0.03
#: Slots of the hash table of a round's rules.
SLOTS = 1 << 18


@dataclass
class Grammar:
    rules: np.ndarray    # (n, 2) uint16
    lengths: np.ndarray  # uint32
    symbols: np.ndarray  # uint16
    sizes: np.ndarray    # symbols of each document


def _slot(pair: np.ndarray) -> np.ndarray:
    return (pair * np.uint32(2654435761)) >> np.uint32(14)


def compress(ids: np.ndarray, sizes: np.ndarray, base: int = BASE) -> Grammar:
    """ids: all documents' ids (uint16), sizes: how many each has (at least 1)."""
    seq = ids.astype(np.uint16)
    doc_end = np.zeros(len(seq), bool)
    if len(sizes):
        doc_end[np.cumsum(sizes) - 1] = True
    rules = np.zeros((0, 2), np.uint16)
    lengths = np.ones(base, np.int64)
    while len(seq) > 1:
        free = (1 << 16) - base - len(rules)
        pair = seq[:-1].astype(np.uint32) << np.uint32(16) | seq[1:]
        ordered = np.sort(pair[~doc_end[:-1]])
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        counts = np.diff(starts, append=len(ordered))
        often = np.flatnonzero(counts >= LEAST_COUNT)
        # Later rounds need numbers too: each takes at most half of what is free.
        most = -(-free // 2)
        if len(often) > most:
            often = np.sort(often[np.argsort(-counts[often], kind="stable")[:most]])
        chosen = ordered[starts[often]]
        if not len(chosen):
            break
        # Hash table of the chosen pairs; of two in one slot the more frequent
        # one stays, the other may come in a later round.
        table = np.full(SLOTS, -1, np.int32)
        table[_slot(chosen[np.argsort(counts[often], kind="stable")])] = np.argsort(counts[often], kind="stable")
        place = table[_slot(pair)]
        at = np.flatnonzero((chosen[place] == pair) & (place >= 0) & ~doc_end[:-1])
        # Of adjacent hits every second one, from the left.
        index = np.arange(len(at))
        fresh = np.diff(at, prepend=-2) != 1
        at = at[(index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0]
        used = np.bincount(place[at], minlength=len(chosen))
        kept = used >= LEAST_COUNT // 2
        at = at[kept[place[at]]]
        if len(at) < LEAST_GAIN * len(seq):
            break
        number = np.cumsum(kept) - 1 + base + len(rules)
        new = np.stack([chosen[kept] >> np.uint32(16), chosen[kept] & np.uint32(0xFFFF)], axis=1).astype(np.uint16)
        lengths = np.concatenate([lengths, lengths[new[:, 0]] + lengths[new[:, 1]]])
        rules = np.concatenate([rules, new])
        seq[at] = number[place[at]]
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        doc_end[at] = doc_end[at + 1]
        seq, doc_end = seq[stays], doc_end[stays]
    return Grammar(rules, lengths[base:].astype(np.uint32), seq, np.diff(np.flatnonzero(doc_end), prepend=-1))


def _expansions(rules: np.ndarray, lengths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every symbol's ids as a slice of one array: (first, length, ids)."""
    size = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    ids = np.empty(int(size.sum()), np.uint16)
    ids[:base] = np.arange(base)
    for k, (a, b) in enumerate(rules.tolist()):
        at = first[base + k]
        ids[at:at + size[a]] = ids[first[a]:first[a] + size[a]]
        ids[at + size[a]:at + size[base + k]] = ids[first[b]:first[b] + size[b]]
    return first, size, ids


def expand(rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, base: int = BASE) -> np.ndarray:
    first, size, ids = _expansions(rules, lengths, base)
    n = size[symbols]
    ends = np.cumsum(n)
    shift = first[symbols] - (ends - n)
    return ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(shift, n)]


def decode_range(shard, doc: int, start: int, count: int, base: int = BASE) -> np.ndarray:
    """Ids ``start`` to ``start + count`` of the shard's document number
    ``doc``; only symbols that overlap the range are expanded."""
    rules = np.frombuffer(shard["rules"], np.uint16).reshape(-1, 2)
    size = np.concatenate([np.ones(base, np.int64), np.frombuffer(shard["lengths"], np.uint32).astype(np.int64)])
    begin = int(sum(shard["doc_symbols"][:doc]))
    symbols = np.frombuffer(shard["symbols"], np.uint16)[begin:begin + shard["doc_symbols"][doc]]
    ends = np.cumsum(size[symbols])
    stop = min(start + count, int(ends[-1]))
    out: list[int] = []
    if start >= stop:
        return np.zeros(0, np.uint16)
    i, j = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop - 1, side="right")
    skip = start - int(ends[i] - size[symbols[i]])
    stack = symbols[i:j + 1][::-1].tolist()
    while stack and len(out) < stop - start:
        s = stack.pop()
        if skip >= size[s]:
            skip -= int(size[s])
        elif s < base:
            out.append(s)
        else:
            stack += [int(rules[s - base][1]), int(rules[s - base][0])]
    return np.array(out, np.uint16)


def write_shards(docs: DataFrame, path: str, end_id: int = END_ID, base: int = BASE) -> None:
    """Tokenise ``docs`` and write the shard table to ``path``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_text(docs)
    kind = rows.dtypes[0][1]
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_ids().packed
        end = np.array([end_id], np.uint16).tobytes()
        doc_ids: list[pa.Array] = []
        held: list[bytes] = []
        number = before = 0

        def close():
            ids = np.frombuffer(b"".join(held), np.uint16)
            tokens = np.array([len(x) // 2 for x in held], np.int64)
            g = compress(ids, tokens, base)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([g.rules.tobytes()], pa.binary()), pa.array([g.lengths.tobytes()], pa.binary()),
                 pa.array([g.symbols.tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), pa.concat_arrays(doc_ids)),
                 pa.array([g.sizes.tolist()], pa.list_(pa.int64())), pa.array([tokens.tolist()], pa.list_(pa.int64()))],
                names=["shard", "part_start", "n_tokens", "rules", "lengths", "symbols", "doc_ids", "doc_symbols", "doc_tokens"])

        size = 0
        for b in batches(it, 1 << 20):
            doc_ids.append(b.column(0))
            new = [encode(x or "") + end for x in b.column(1).to_pylist()]
            held += new
            size += sum(map(len, new)) // 2
            if size >= SHARD_TOKENS:
                yield close()
                number, before, size = number + 1, before + size, 0
                held.clear()
                doc_ids.clear()
        if held:
            yield close()

    ordered.mapInArrow(run, "shard int, part_start bigint, n_tokens bigint, rules binary, lengths binary, symbols binary, "
                            f"doc_ids array<{kind}>, doc_symbols array<bigint>, doc_tokens array<bigint>").withColumn(
        "part", F.spark_partition_id()).write.mode("error").parquet(path)


def read_shards(spark: SparkSession, path: str, base: int = BASE) -> DataFrame:
    """Read a shard table back.  Per document: doc_id, start (ids of all
    documents before it), n_tokens, ids (little-endian unsigned 16-bit) and
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers)."""
    shards = spark.read.parquet(path)
    kind = dict(shards.dtypes)["doc_ids"][len("array<"):-1]
    # One row a partition of the writing job.
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, total = {}, 0
    for r in sizes:
        before[r["part"]] = total
        total += r["n"]
    shared = spark.sparkContext.broadcast(before)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(b.num_rows):
                part, start, rules, lengths, symbols, tokens = (b.column(k)[i].as_py() for k in range(6))
                ids = expand(np.frombuffer(rules, np.uint16).reshape(-1, 2), np.frombuffer(lengths, np.uint32),
                             np.frombuffer(symbols, np.uint16), base)
                ends = np.cumsum(tokens)
                wide, packed = ids.astype("<u4").tobytes(), ids.tobytes()
                cuts = list(zip((ends - tokens).tolist(), ends.tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column(6)[i].values, pa.array(ends - tokens + start + shared.value[part]),
                     pa.array(tokens, pa.int64()), pa.array([packed[2 * s:2 * e] for s, e in cuts], pa.binary()),
                     pa.array([zlib.crc32(wide[4 * s:4 * e]) for s, e in cuts], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"])
    return shards.select("part", "part_start", "rules", "lengths", "symbols", "doc_tokens", "doc_ids").mapInArrow(
        run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint")


def round_trip(docs: DataFrame) -> DataFrame:
    """Write the documents as a shard table in the shared folder, read it back."""
    path = f"{Scratch(docs.sparkSession, 'repair').base}/shards"
    write_shards(docs, path)
    return read_shards(docs.sparkSession, path)
