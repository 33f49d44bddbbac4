"""Document fingerprints: weighted SimHash, searched with permuted block tables.

Terms are pairs of adjacent words (letters and digits, ASCII lower-cased; the word
itself in a text of one word).  Every distinct term of a text has a 256-bit
hash and votes on each bit with its weight, ``16 * (1 + log2(occurrences))``
rounded: for the bit if its hash has it set, against it if not.  The fingerprint
has the bits with a positive sum.  It depends on the text alone, so fingerprints
of different runs can be compared.  The likeness of two fingerprints is the cosine
that their Hamming distance h estimates, ``cos(pi * h / 256)``, 0 where negative.

Search for all fingerprints within ``radius`` bits: the bits are cut into
``radius + e`` blocks.  Two fingerprints within the radius agree on at least e
blocks, so with one table for every choice of e blocks, permuted to the front
and grouped by them, each near pair meets in some table; candidates are
verified on all bits.  e grows with the table, so that buckets stay small.

A large group of near copies fills whole buckets.  In a bucket of more than
``SMALL`` members, those within the radius of its most copied member are linked
to it, and so to one another; the rest is compared with all members in cells of
bounded size (``CELL`` of either), which report links that connect what they
find connected.  So classes lose no link, and no group lists all its pairs.

Defined results: a null text is empty; an empty text or one without terms has
no bit set; equal texts have equal fingerprints; repeated rows count each; a null
doc_id stands after all others and names no class (a class without any other id has
none); documents of one doc_id are ordered by a hash of their texts; an empty
table gives no rows; very long texts are read whole, their terms summed in
steps; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import Scratch, flat_bytes, id_text
from .components import components

BITS = 256
WORDS = BITS // 64
#: Members of a bucket that are compared pair by pair; members of a cell's sides.
SMALL, CELL = 128, 2048
#: Terms that vote at once, characters that are hashed at once.
STEP, SLICE = 1 << 13, 1 << 21
_SEEDS = np.array([0x9E3779B97F4A7C15 * (k + 1) % (1 << 64) for k in range(WORDS)], np.uint64)


# ---------------------------------------------------------------- fingerprints

def _term_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of some texts and the numbers of their texts."""
    starts, ends, text = words.spans(words.LOWER[raw], off, letters=True)
    h = words.hashes(words.LOWER[raw], starts, ends)
    alone = np.bincount(text, minlength=len(off) - 1)[text] == 1
    pair = np.flatnonzero(text[1:] == text[:-1])
    out = words.mix(h[pair] * np.uint64(0x9E3779B97F4A7C15) + h[pair + 1])
    return np.concatenate([out, h[alone]]), np.concatenate([text[pair], text[alone]])


def fingerprints(texts: list[str]) -> np.ndarray:
    """Texts x WORDS numbers (uint64), bit i in word i // 64."""
    out = np.zeros((len(texts), WORDS), np.uint64)
    raw, off = flat_bytes(pa.array(texts, pa.large_string()))
    h, text = _term_hashes(raw, off)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    first = np.flatnonzero((np.diff(h, prepend=h[:1]) != 0) | (np.diff(text, prepend=-1) != 0))
    count = np.diff(first, append=len(h))
    h, text = h[first], text[first]
    weight = np.rint(16 * (1 + np.log2(count))).astype(np.float32)
    ends = np.searchsorted(text, np.arange(len(texts)), side="right")
    begin = 0
    for i, end in enumerate(ends.tolist()):
        votes, total = np.zeros(BITS), 0.0  # sums of whole numbers: exact in any order
        for lo in range(begin, end, STEP):
            hi = min(end, lo + STEP)
            own = words.mix(h[lo:hi, None] ^ _SEEDS)
            bits = np.unpackbits(own.view(np.uint8), axis=1, bitorder="little").astype(np.float32)
            votes += weight[lo:hi] @ bits
            total += float(weight[lo:hi].sum(dtype=np.float64))
        out[i] = np.packbits(votes * 2 > total, bitorder="little").view(np.uint64)
        begin = end
    return out


def _sliced(texts: list[str]) -> np.ndarray:
    """``fingerprints`` of any number of texts, some at a time."""
    parts, at, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > SLICE:
            parts.append(fingerprints(texts[at:i + 1]))
            at, size = i + 1, 0
    parts.append(fingerprints(texts[at:]))
    return np.concatenate(parts)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The likeness of the fingerprints in the rows of ``a`` and ``b``."""
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.maximum(0.0, np.cos(np.pi * apart / BITS))


def _binary(fp: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in fp.astype(">u8")]


# --------------------------------------------------------------------- editing

def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the
    following text (all, if it has fewer)."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


_ROW = "n_chars bigint, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double"


def _judged(texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> list[pa.Array]:
    """The columns ``_ROW`` of some documents, given their fingerprints and those
    of the documents that follow them."""
    new = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    changed = _sliced(new)
    return [pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in new], pa.string()),
            pa.array(_binary(own), pa.binary()), pa.array(_binary(changed), pa.binary()),
            pa.array(likeness(own, changed)), pa.array(likeness(own, after))]


def _squeezed(docs: DataFrame) -> DataFrame:
    """doc_id, key (a hash of the text) and its compressed UTF-8."""
    rows = id_text(docs)
    rows = rows.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in it:
            z = pa.array([pack.compress((t or "").encode("utf-8")) for t in b.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), z], names=["doc_id", "key", "z"])
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, key bigint, z binary")


def _text(z: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(z).decode("utf-8")


def edited_neighbours(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id and ``_ROW`` per document; it is followed by the one with the next
    smaller doc_id, the last by the first.

    The documents are range-sorted by descending id; a task reads its range in
    order and holds a few documents at a time.  Only the first and the last
    document of each range are matched over the borders."""
    rows = _squeezed(docs)
    kind = rows.dtypes[0][1]
    order = [F.desc_nulls_last("doc_id"), F.asc("key"), F.asc("place")]
    ranged = (rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order)
              .sortWithinPartitions(*order).select("doc_id", "z", F.spark_partition_id().alias("part")))
    names = ["part", "edge", "doc_id", "z", *[c.split()[0] for c in _ROW.split(", ")]]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, raws, part, first, size = [], [], [], None, True, 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, texts, raws, first, size
            fp = _sliced(texts)
            done = len(texts) - 1
            if first:  # the range's first document, for the range before
                yield edge("first", 0, fp)
                first = False
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * done, pa.int32()), pa.array([None] * done, pa.string()),
                     pa.array(ids[:-1], id_type), pa.nulls(done, pa.binary()), *_judged(texts[:-1], texts[1:], fp[:-1], fp[1:])],
                    names=names)
            if last:
                yield edge("last", done, fp)
            ids, texts, raws, size = ids[-1:], texts[-1:], raws[-1:], 0

        def edge(name: str, at: int, fp: np.ndarray) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string())]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array(ids[at:at + 1], id_type),
                 pa.array(raws[at:at + 1], pa.binary()), *empty, pa.array(_binary(fp[at:at + 1]), pa.binary()),
                 pa.nulls(1, pa.binary()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64())], names=names)
        id_type = None
        for b in it:
            id_type = b.column(0).type
            for i, z, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                part = p
                ids.append(i), texts.append(_text(z)), raws.append(z)
                size += len(texts[-1])
                if size > SLICE and len(texts) > 1:
                    yield from flush(False)
        if texts:
            yield from flush(True)
    schema = f"part int, edge string, doc_id {kind}, z binary, {_ROW}"
    pieces = scratch.put(ranged.mapInArrow(run, schema), "edited")
    parts = sorted(r["part"] for r in pieces.filter("edge = 'first'").select("part").collect())  # one number per range
    cols = ["doc_id", *names[4:]]
    inner = pieces.filter("edge IS NULL").select(cols)
    if not parts:
        return inner
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, after int")
    follow = pieces.filter("edge = 'first'").select(F.col("part").alias("after"), F.col("z").alias("after_z"),
                                                    F.col("fp").alias("after_fp"))
    pairs = pieces.filter("edge = 'last'").select("part", "doc_id", "z", "fp").join(after, "part").join(follow, "after").select(
        "doc_id", "z", "fp", "after_z", "after_fp")

    def border(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            _, z, fp, after_z, after_fp = (c.to_pylist() for c in b.columns)
            number = lambda x: np.frombuffer(b"".join(x), ">u8").astype(np.uint64).reshape(-1, WORDS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *_judged(list(map(_text, z)), list(map(_text, after_z)), number(fp), number(after_fp))], names=cols)
    return inner.unionByName(pairs.mapInArrow(border, f"doc_id {kind}, {_ROW}"))


# ---------------------------------------------------------------------- search

def blocks_of(count: int) -> list[tuple[int, int]]:
    """The first bit and the end of each of ``count`` blocks."""
    cuts = [BITS * k // count for k in range(count + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def tables(n: int, radius: int) -> list[tuple[tuple[int, int], ...]]:
    """The choices of blocks to group by, for n fingerprints: of the numbers e of
    blocks the one with the least rows plus expected candidates."""
    best = None
    for e in range(1, 4):
        blocks = blocks_of(radius + e)
        chosen = list(itertools.combinations(blocks, e))
        cost = len(chosen) * n * (1 + 0.1 * n / 2 ** (BITS * e / (radius + e)))
        if best is None or cost < best[0]:
            best = (cost, chosen)
    return best[1]


def _key(number: int, chosen) -> Column:
    """The bits of the chosen blocks, hashed (unlike ones may share a bucket)."""
    parts = [F.lit(number)]
    for w in range(WORDS):
        mask = 0
        for a, b in chosen:
            for bit in range(max(a, 64 * w), min(b, 64 * w + 64)):
                mask |= 1 << (bit - 64 * w)
        if mask:
            parts.append(F.col(f"w{w}").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")))
    return F.xxhash64(*parts)


def _word(fp: str, w: int) -> Column:
    """Word w of a binary fingerprint as a bigint."""
    return F.conv(F.hex(F.substring(fp, 8 * w + 1, 8)), 16, -10).cast("bigint")


def _apart(a: str, b: str) -> Column:
    out = F.lit(0)
    for w in range(WORDS):
        out = out + F.bit_count(F.col(f"{a}.w{w}").bitwiseXOR(F.col(f"{b}.w{w}")))
    return out


def _connect(outside: np.ndarray, members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (row of ``outside``, row of ``members``) that connect all rows which
    near pairs between the two connect."""
    near = np.zeros((len(outside), len(members)), bool)
    for i in range(0, len(outside), 64):
        near[i:i + 64] = np.bitwise_count(outside[i:i + 64, None] ^ members[None]).sum(axis=2, dtype=np.int32) <= radius
    free, links = near.any(axis=1), []
    while free.any():
        wave = [int(np.flatnonzero(free)[0])]
        free[wave[0]] = False
        reached = np.zeros(len(members), bool)
        while wave:
            o = wave.pop()
            new = np.flatnonzero(near[o] & ~reached)
            links += [(o, int(m)) for m in new]
            reached[new] = True
            for other in np.flatnonzero(free & near[:, new].any(axis=1)) if len(new) else ():
                free[other] = False
                links.append((int(other), int(np.flatnonzero(near[other] & reached)[0])))
                wave.append(int(other))
    out = np.array(links, np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def near_links(nodes: DataFrame, scratch: Scratch, radius: int) -> DataFrame:
    """nodes: fp (binary, distinct), size and its words w0, w1, ...  Links (a, b)
    between fingerprints within ``radius`` bits that connect exactly those which
    chains of such pairs connect."""
    chosen = tables(nodes.count(), radius)
    whole = F.struct("fp", *[f"w{w}" for w in range(WORDS)])
    keys = F.explode(F.array(*[_key(k, c) for k, c in enumerate(chosen)]))
    index = nodes.select(keys.alias("key"), whole.alias("x"), "size")
    shared = scratch.put(index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max_by("x", "size").alias("centre"))
                         .filter("n > 1"), "shared")
    met = scratch.put(index.drop("size").join(
        shared.select("key", "n", F.when(F.col("n") > SMALL, F.col("centre")).alias("centre")), "key"), "met")
    few_ = met.filter(F.col("n") <= SMALL)
    a, b = few_.select("key", F.col("x").alias("a")), few_.select("key", F.col("x").alias("b"))
    links = (a.join(b, "key").filter((F.col("a.fp") < F.col("b.fp")) & (_apart("a", "b") <= radius))
             .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
    large = met.filter(F.col("n") > SMALL).withColumn("inside", _apart("x", "centre") <= radius)
    links = links.unionByName(large.filter(F.col("inside") & (F.col("x.fp") != F.col("centre.fp"))).select(
        F.col("x.fp").alias("a"), F.col("centre.fp").alias("b")))
    rest = large.filter(~F.col("inside")).groupBy("key").agg(F.count(F.lit(1)).alias("n_out"))
    rest = scratch.put(rest, "rest")
    if rest.isEmpty():
        return links
    # Cells (bucket, i, j): part i of the rest with part j of all members.
    cells = lambda n: F.ceil(F.col(n) / CELL).cast("int")
    part = lambda n: F.pmod(F.xxhash64("x.fp", F.lit(n)), cells(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), cells(n) - 1))
    large = large.join(rest, "key")
    left = large.filter(~F.col("inside")).select(
        F.col("key").alias("bucket"), part("n_out").alias("i"), every("n").alias("j"), F.col("x.fp").alias("fp"))
    right = large.select(F.col("key").alias("at"), every("n_out").alias("k"), part("n").alias("l"), F.col("x.fp").alias("other"))

    def cell(o: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        if not len(o) or not len(m):
            return pd.DataFrame({"a": [], "b": []}, dtype=object)
        number = lambda x: np.frombuffer(b"".join(map(bytes, x)), ">u8").astype(np.uint64).reshape(-1, WORDS)
        i, j = _connect(number(o["fp"]), number(m["other"]), radius)
        got = pd.DataFrame({"a": o["fp"].to_numpy()[i], "b": m["other"].to_numpy()[j]})
        return got[got["a"].map(bytes) != got["b"].map(bytes)]
    more = left.groupBy("bucket", "i", "j").cogroup(right.groupBy("at", "k", "l")).applyInPandas(cell, "a binary, b binary")
    return links.unionByName(more)


def classes(prints: DataFrame, scratch: Scratch, radius: int) -> DataFrame:
    """prints: doc_id and fp.  One row per fingerprint with class_id, the smallest
    doc_id that chains of near fingerprints reach."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    nodes = scratch.put(nodes.select("*", *[_word("fp", w).alias(f"w{w}") for w in range(WORDS)]), "nodes")
    roots = scratch.put(components(near_links(nodes, scratch, radius), scratch, "link"), "roots")
    least = roots.join(nodes, roots["node"] == nodes["fp"]).groupBy("root").agg(F.min("least").alias("class_id"))
    named = roots.join(least, "root").select(F.col("node").alias("fp"), "class_id", F.lit(True).alias("linked"))
    return scratch.put(nodes.select("fp", "least").join(named, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("class_id")).otherwise(F.col("least")).alias("class_id")), "classes")


def fingerprint_documents(docs: DataFrame, radius: int = 12) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint and
    edited_fingerprint (64 hex digits), near_edited, near_next, and class_id: the
    smallest doc_id among the documents that chains of fingerprints within
    ``radius`` bits of each other connect."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    prints = scratch.put(edited_neighbours(docs, scratch), "prints")
    scratch.drop("edited")
    found = classes(prints.select("doc_id", "fp"), scratch, radius)
    text = lambda c: F.lower(F.hex(c))
    return prints.join(found, "fp").select(
        "doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"),
        "near_edited", "near_next", "class_id")
