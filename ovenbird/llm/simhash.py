"""SimHash near-dedup by the general pigeonhole principle.

Fingerprints: lower-case A-Z, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words with repeats, XXH64 (seed 42); a bit is 1 if it is set in more
than half of the hashes.  Equal fingerprints are one node from then on.

Search for all pairs that differ in at most ``distance`` bits:

1. Bit statistics over all fingerprints give the correlation of the 64 bits.
   Correlated bits are grouped into m partitions.
2. If the thresholds t_i of the partitions sum to ``distance - m + 1``, two
   fingerprints within ``distance`` differ in at most t_i bits of some
   partition i.  Dynamic programming picks m and the (unequal) t_i of the
   smallest estimated cost: values to probe plus candidates to verify.
3. Every fingerprint probes the index of partition i with all values within
   t_i, and candidates are verified on all 64 bits.

A large group of near copies shares its index buckets.  In a bucket of more
than ``SMALL`` members, those within ``distance`` of its most copied member (its
centre) are linked to the centre.  A fingerprint that probes the bucket and is
within ``distance`` of the centre is linked to it as well, and so to all of
them; only one that is farther away is compared with them one by one.  So no
link between components is lost and the pairs inside a group are not listed.

Defined results: a null text is empty and has fingerprint 0; equal rows are
members of one node; a null doc_id is a member but never the smallest id, and
a component of null ids only has a null id; ``keep_one`` tells rows of the same
doc_id, or without one, apart by their texts and leaves one of rows that repeat
both; an empty table gives no rows; other columns, whatever their names, are
neither read nor changed.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import Scratch, batches, few, id_text, sha
from .components import components

BITS = 64
#: Members of an index bucket that are compared pair by pair.
SMALL = 256
#: Cost of verifying a candidate against that of a probed value.
VERIFY_COST = 0.05
#: Bytes of a text that are cut into words at once.
LONG = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LANES = np.uint64(0x0101010101010101)


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words, space-joined."""
    joined = b" ".join(words)
    at, starts = 0, []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[size:]]
    ends.append(len(joined))
    return [joined[s:e] for s, e in zip(starts, ends)]  # noqa: B905 (the last size-1 starts have no end)


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in blocks, cut at white space."""
    at = 0
    while at < len(data):
        cut = SPACE.search(data, at + LONG)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()  # bytes: ASCII white space only
        at = end


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes (uint64) have each bit set."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[:len(hashes)] = hashes
    rows = padded.reshape(-1, 255)  # eight byte counters fit into a sum of 255 lanes
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):
        sums = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.ravel()


def fingerprint(text: str | None, size: int = 4) -> int:
    """The bits set in more than half of the shingles' hashes; a long text is
    hashed block by block."""
    digest = xxhash.xxh64_intdigest
    total, counts, tail = 0, np.zeros(BITS, np.int64), []
    for block in _word_blocks((text or "").encode("utf-8").lower()):  # bytes: A-Z only
        words = tail + block
        if len(words) >= size:
            parts = shingles(words, size)
            counts += bit_counts(np.fromiter((digest(x, 42) for x in parts), np.uint64, len(parts)))
            total += len(parts)
        tail = words[max(0, len(words) - size + 1):]
    if not total and tail:  # fewer words than a shingle: the whole sequence
        total, counts = 1, bit_counts(np.array([digest(b" ".join(tail), 42)], np.uint64))
    ones = (counts * 2 > total).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed number) and raw (``text_hash``)."""
    rows = id_text(docs)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            texts = b.column(1).to_pylist()
            got = np.array([fingerprint(x, shingle) for x in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got.view(np.int64)), pa.array([sha(x) for x in texts], pa.binary())],
                                             names=["doc_id", "fp", "raw"])
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, fp bigint, raw binary")


# ------------------------------------------------------------- partitioning

def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j set (64 x 64)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in it:
            h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(h), 65536):
                x = h[i:i + 65536]
                bits = ((x[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += bits.T @ bits
                n += len(x)
        if n:
            i, j = np.triu_indices(BITS)
            yield pa.RecordBatch.from_arrays([pa.array([*(i * BITS + j), BITS * BITS], pa.int32()),
                                              pa.array([*total[i, j].astype(np.int64), n], pa.int64())],
                                             names=["cell", "n"])
    cells = {r["cell"]: r["n"] for r in nodes.select("fp").mapInArrow(run, "cell int, n bigint")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # 2081 rows at most
    both = np.zeros((BITS, BITS))
    for cell, n in cells.items():
        if cell < BITS * BITS:
            both[cell // BITS, cell % BITS] = both[cell % BITS, cell // BITS] = n
    return cells.get(BITS * BITS, 0), both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups, correlated bits together."""
    p = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(1, n) - np.outer(p, p)) / np.outer(spread, spread))
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(sorted(free), key=lambda b: sum(corr[b, c] for c in free if c != b))]
        free.remove(group[0])
        while len(group) < size:
            b = max(sorted(free), key=lambda b: sum(corr[b, c] for c in group))
            group.append(b)
            free.remove(b)
        out.append(sorted(group))
    return out


def within(n: int, both: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated fingerprints within 0..most bits of one in this group of bits."""
    p = np.diag(both)[group] / max(1, n)
    dist = np.zeros(most + 1)
    dist[0] = 1
    for x in 2 * p * (1 - p):
        dist[1:] = dist[1:] * (1 - x) + dist[:-1] * x
        dist[0] *= 1 - x
    return list(np.cumsum(dist) * n)


def allocate(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds (-1: not probed), of the smallest
    estimated cost over all numbers of partitions and all allocations."""
    best = None
    for parts in range(1, distance + 2):
        groups, budget = group_bits(n, both, parts), distance - parts + 1
        # reach[s]: (cost, thresholds) of the groups so far with threshold sum s
        reach = {0: (0.0, ())}
        for group in groups:
            near = within(n, both, group, max(budget + parts - 1, 0))
            nxt: dict = {}
            for s, (cost, chosen) in reach.items():
                for t in range(-1, min(budget + parts - 1, len(group)) + 1):
                    probes = sum(_choose(len(group), d) for d in range(t + 1))
                    total = cost + (probes + VERIFY_COST * near[t] if t >= 0 else 0)
                    if s + t not in nxt or total < nxt[s + t][0]:
                        nxt[s + t] = (total, (*chosen, t))
            reach = nxt
        cost, chosen = reach[budget]
        if best is None or cost < best[0]:
            best = (cost, list(zip(groups, chosen, strict=True)))
    return best[1]


def _choose(n: int, k: int) -> int:
    return len(list(itertools.combinations(range(n), k))) if k < 3 else int(np.prod([(n - i) / (i + 1) for i in range(k)]) + 0.5)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def ball(group: list[int], radius: int) -> list[int]:
    """Masks that flip up to ``radius`` bits of a group."""
    return [_mask(c) for d in range(radius + 1) for c in itertools.combinations(group, d)]


# ------------------------------------------------------------------- search

def _value(mask: int):
    return F.col("fp").bitwiseAND(F.lit(mask).cast("bigint"))


def _near(a: str, b: str, distance: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def near_links(nodes: DataFrame, scratch: Scratch, distance: int) -> DataFrame:
    """nodes: fp (distinct) and size.  Links (a, b) that connect exactly the
    fingerprints that chains of at most ``distance`` differing bits connect."""
    n, both = bit_statistics(nodes)
    plan = [(i, g, t) for i, (g, t) in enumerate(allocate(n, both, distance)) if t >= 0]
    keyed = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), _value(_mask(g)).alias("value")) for i, g, _ in plan]))
    index = scratch.put(nodes.select("fp", "size", keyed.alias("k")).select("fp", "size", "k.*"), "index", n * len(plan))
    large = scratch.put(index.groupBy("part", "value").agg(
        F.count(F.lit(1)).alias("members"), F.max_by("fp", "size").alias("centre")).filter(F.col("members") > SMALL),
        "large", n * len(plan))
    probes = None
    for i, group, radius in plan:
        flip = F.explode(F.array(*[F.lit(x).cast("bigint") for x in ball(group, radius)]))
        one = nodes.select("fp", flip.alias("flip")).select(
            F.lit(i).alias("part"), _value(_mask(group)).bitwiseXOR(F.col("flip")).alias("value"), F.col("fp").alias("a"))
        probes = one if probes is None else probes.unionByName(one)
    # Whoever finds a pair from either side finds it from the smaller one too.
    found = (F.col("a") < F.col("b")) & _near("a", "b", distance)
    members = index.select("part", "value", F.col("fp").alias("b"))
    if large.isEmpty():
        return probes.join(members, ["part", "value"]).filter(found).select("a", "b")
    # Large buckets: whoever is near the centre is linked to it, and through it
    # to the others near it.  Only the rest is compared with members.
    inside = scratch.put(index.join(large, ["part", "value"]).filter(_near("fp", "centre", distance)).select(
        "part", "value", F.col("fp").alias("b"), "centre"), "inside")
    stars = inside.filter("b <> centre").select(F.col("b").alias("a"), F.col("centre").alias("b"))
    outside = members.join(inside.drop("centre"), ["part", "value", "b"], "left_anti")
    plain = probes.join(outside, ["part", "value"]).filter(found).select("a", "b")
    at_large = scratch.put(probes.join(large.select("part", "value", "centre"), ["part", "value"]), "at-large")
    to_centre = at_large.filter((F.col("a") != F.col("centre")) & _near("a", "centre", distance)).select(
        "a", F.col("centre").alias("b"))
    across = at_large.filter(~_near("a", "centre", distance)).drop("centre").join(
        inside.drop("centre"), ["part", "value"]).filter(found).select("a", "b")
    return plain.unionByName(across).unionByName(stars).unionByName(to_centre)


def near_components(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links."""
    return _members(docs, shingle, distance).drop("raw", "stays")


def _members(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """``near_components`` with raw (``text_hash``) and whether the row stays: it
    has the smallest doc_id (null after all others), then hash, of its component."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.put(fingerprints(docs, shingle), "prints")
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "raw")
    nodes = scratch.put(prints.groupBy("fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("size")), "nodes")
    links = near_links(nodes.select("fp", "size"), scratch, distance)
    roots = scratch.put(components(links, scratch, "link"), "roots")
    in_links = roots.count()
    firsts = scratch.put(roots.join(nodes, roots["node"] == nodes["fp"]).groupBy("root").agg(
        F.min("first").alias("least")), "firsts", in_links)
    linked = few(roots.join(firsts, "root").select(F.col("node").alias("fp"), "least"), in_links)
    named = scratch.put(nodes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("least")), "named")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("raw") == F.col("least.raw"))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"),
        "raw", stays.alias("stays"))


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The document with the smallest id of every component, all columns."""
    return bloom.drop_documents(docs, _members(docs, shingle, distance).select("doc_id", "raw", "stays"))
