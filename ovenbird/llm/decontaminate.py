"""Benchmark decontamination: BM25 with block-max WAND, then overlap checks.

The test items are the indexed side.  Their terms form an inverted index of
BM25 impacts, each divided by the score its item must reach (``min_score`` of
the item's score with itself, or the least score of a passage that passes the
checks below, if that is lower), so that every item is retrieved from 1 on and
the retrieval loses none that the checks would report.  The index comes in shards
of at most ``SHARD_ITEMS`` items and ``SHARD_CELLS`` block maxima.  What is broadcast
for one scan of the corpus holds about ``SHARDS`` x ``SHARD_ITEMS`` items or ``SCAN_WORDS``
words of items at most (or one longer item); more of them take more scans.

Every document is cut into overlapping passages, long enough that each item
lies within one of them.  A passage is a query: the sum of its terms' highest
impacts, then the sums of their block maxima, rule most passages out (numpy,
all passages of a batch at once); block-max WAND retrieves all items from 1 on
for the others.  A retrieved item is reported if

* at least ``overlap`` of the five-word shingles of its question and
* at least ``overlap`` of the words of its answer

occur in the passage.  Items with columns ``question`` and ``answer`` are
checked on those.  Of an item with a ``text`` only, the question is the whole
text and there is no answer to check (answer overlap 1).

Defined results: null or empty texts hold no words and match nothing, as
document or as item; items of fewer than five words match as one shingle; an
item id that repeats is matched for each of its rows and reported once per
document with the best row; empty tables give no rows; other columns are not
read.  Repeated document rows are each reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom, words
from .common import batches, column, flat_bytes, id_text, sha

K1, B = 1.2, 0.75
SHARD_ITEMS = 1024
SHARD_CELLS = 1 << 21
SHARDS = 16
SCAN_WORDS = 1 << 18
#: Items that share a block maximum, and (passage, term) pairs summed at once.
BLOCK = 4
PAIRS = 200_000
SHINGLE = 5
#: For rounding: bounds are compared a little below the threshold.
SLACK = 1e-4


def word_hashes(text: str) -> np.ndarray:
    raw = words.LOWER[np.frombuffer(text.encode("utf-8"), np.uint8)]
    starts, ends, _ = words.spans(raw, np.array([0, len(raw)]), letters=True)
    return words.hashes(raw, starts, ends)


def grams(h: np.ndarray) -> np.ndarray:
    """Distinct shingles; a shorter sequence is one shingle."""
    return np.unique(words.shingle_hashes(h, min(SHINGLE, len(h)))) if len(h) else np.zeros(0, np.uint64)


def spare(n: int, overlap: float) -> int:
    """How many of n may be missing."""
    return n - int(np.ceil(overlap * n - 1e-9))


def lacking(q: np.ndarray, answer: np.ndarray, terms: np.ndarray, weight: np.ndarray, overlap: float) -> float:
    """An upper bound of the weight of the terms that are not in a passage that
    passes the checks.  q: the question's words; answer: distinct words.  A term
    of the question is missing only with all shingles that hold it, so its
    weight is shared out among them and the heaviest shingles count."""
    lost = 0.0
    if len(q):
        size = min(SHINGLE, len(q))
        distinct, of = np.unique(words.shingle_hashes(q, size), return_inverse=True)
        at = np.lib.stride_tricks.sliding_window_view(np.searchsorted(terms, q), size)
        shingle, term = np.divmod(np.unique(of.reshape(-1, 1) * len(terms) + at), len(terms))
        share = weight / np.maximum(np.bincount(term, minlength=len(terms)), 1)
        value = np.sort(np.bincount(shingle, weights=share[term]))
        lost += value[len(value) - spare(len(distinct), overlap):].sum()
    told = np.sort(weight[np.searchsorted(terms, answer[~np.isin(answer, q)])])
    return lost + told[max(0, len(told) - spare(len(answer), overlap)):].sum()


@dataclass
class Item:
    item_id: object
    question: np.ndarray  # shingles
    short: int            # words of a shingle (fewer than five in short items)
    answer: np.ndarray    # distinct words


@dataclass
class Shard:
    """Inverted index of some items: the postings of term k are at
    ``first[k]:first[k + 1]`` (item numbers ascending)."""
    terms: np.ndarray
    first: np.ndarray
    items: np.ndarray
    impacts: np.ndarray
    highest: np.ndarray      # of each term
    block_max: np.ndarray    # terms x blocks of BLOCK items
    info: list[Item]


def shard_cuts(sizes: list[int]) -> list[int]:
    """Where shards begin: a shard of n items with w words in all has at most
    ``SHARD_ITEMS`` items and w x n / ``BLOCK`` block maxima within ``SHARD_CELLS``, or is
    one item (whose block maxima are one a word)."""
    cuts, n, total = [0] if sizes else [], 0, 0
    for at, size in enumerate(sizes):
        if n and (n == SHARD_ITEMS or (total + size) * -(-(n + 1) // BLOCK) > SHARD_CELLS):
            cuts.append(at)
            n = total = 0
        n, total = n + 1, total + size
    return cuts


def build_shards(rows: list[tuple], df: dict[int, int], n_items: int, mean_words: float,
                 min_score: float, overlap: float = 0.8) -> tuple[list[Shard], int]:
    """rows: (item_id, question, answer, all words' hashes).  Also the words of
    the longest item."""
    shards, longest = [], 1
    cuts = shard_cuts([len(r[3]) for r in rows])
    for at, end in zip(cuts, [*cuts[1:], len(rows)], strict=False):
        post: list[tuple[int, int, float]] = []
        info = []
        for item_id, question, answer, h in rows[at:end]:
            longest = max(longest, len(h))
            q = word_hashes(question)
            info.append(Item(item_id, grams(q), min(SHINGLE, len(q)), np.unique(word_hashes(answer))))
            terms, tf = np.unique(h, return_counts=True)
            seen = np.array([df[int(t)] for t in terms], np.float64)
            idf = np.log(1 + (n_items - seen + 0.5) / (seen + 0.5))
            weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(h) / mean_words))
            least = weight.sum() - lacking(q, info[-1].answer, terms, weight, overlap)
            weight /= max(min(min_score * weight.sum(), least), 1e-9) if len(weight) else 1
            post += zip(terms.tolist(), [len(info) - 1] * len(terms), weight.tolist(), strict=True)
        post.sort()
        term = np.array([p[0] for p in post], np.uint64)
        item = np.array([p[1] for p in post], np.int64)
        impact = np.array([p[2] for p in post])
        terms, first = np.unique(term, return_index=True)
        first = np.append(first, len(term))
        which = np.repeat(np.arange(len(terms)), np.diff(first))
        block_max = np.zeros((len(terms), -(-len(info) // BLOCK)), np.float32)
        np.maximum.at(block_max, (which, item // BLOCK), np.nextafter(impact.astype(np.float32), np.float32(np.inf)))
        shards.append(Shard(terms, first, item, impact, block_max.max(axis=1, initial=0), block_max, info))
    return shards, longest


def block_max_wand(shard: Shard, terms: np.ndarray, least: float = 1.0) -> list[tuple[int, float]]:
    """All items whose summed impacts over ``terms`` (numbers of index terms)
    reach ``least``: document-at-a-time with pivots and block maxima."""
    slack = least - SLACK
    # A cursor: [item it stands on, place in the postings, end, term]
    cursors = [[int(shard.items[shard.first[t]]), int(shard.first[t]), int(shard.first[t + 1]), int(t)] for t in terms]
    found = []

    def advance(c: list, item: int) -> None:
        c[1] += int(np.searchsorted(shard.items[c[1]:c[2]], item))
        c[0] = int(shard.items[c[1]]) if c[1] < c[2] else -1

    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, None
        for k, c in enumerate(cursors):
            bound += shard.highest[c[3]]
            if bound >= slack:
                pivot = k
                break
        if pivot is None:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        head = cursors[:pivot + 1]
        block = item // BLOCK
        if sum(shard.block_max[c[3], block] for c in head) >= slack:
            if head[0][0] == item:
                total = float(sum(shard.impacts[c[1]] for c in head))
                if total >= slack:
                    found.append((item, total))
                for c in head:
                    advance(c, item + 1)
            else:
                for c in head:
                    if c[0] < item:
                        advance(c, item)
        else:  # no item of this block before the next cursor can reach it
            nxt = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                nxt = min(nxt, cursors[pivot + 1][0])
            for c in head:
                advance(c, max(nxt, item + 1))
        cursors = [c for c in cursors if c[0] >= 0]
    return found


@dataclass
class Passages:
    """The passages of a batch: text, first and end word of each."""
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def cut(of: np.ndarray, n_texts: int, step: int) -> tuple[Passages, np.ndarray, np.ndarray]:
    """Passages of 2 * step words, step apart; of: text of each word.  Also each
    word's passages: the one that it starts or continues, and the one before
    (-1: none)."""
    size = np.bincount(of, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    many = np.where(size > 0, np.maximum(1, -(-size // step) - 1), 0)
    base = np.concatenate([[0], np.cumsum(many)])[:-1]
    text = np.repeat(np.arange(n_texts), many)
    k = np.arange(len(text)) - base[text]
    begin = first[text] + k * step
    end = np.minimum(begin + 2 * step, first[text] + size[text])
    tile = (np.arange(len(of)) - first[of]) // step
    own = np.where(tile < many[of], base[of] + tile, -1)
    before = np.where(tile > 0, base[of] + tile - 1, -1)
    return Passages(text, begin, end), own, before


def _possible(shard: Shard, term: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """The passages (ranges of ``term``) whose block maxima sum to 1 in some
    block; many passages are summed at once."""
    start = 0
    while start < len(cuts) - 1:
        stop = max(start + 1, int(np.searchsorted(cuts, cuts[start] + PAIRS, side="right")) - 1)
        lo, hi = cuts[start], cuts[stop]
        sums = np.add.reduceat(shard.block_max[term[lo:hi]], cuts[start:stop] - lo, axis=0)
        for k in np.flatnonzero(sums.max(axis=1) >= 1 - SLACK):
            yield int(cuts[start + k]), int(cuts[start + k + 1])
        start = stop


def search(raw: np.ndarray, off: np.ndarray, shards: list[Shard], step: int,
           overlap: float) -> list[tuple[int, object, int, float, float, float]]:
    """(text, item_id, first word, score, question overlap, answer overlap) of
    the items that the texts hold; the best passage of each text and item."""
    low = words.LOWER[raw]
    starts, ends, of = words.spans(low, off, letters=True)
    if not len(starts):
        return []
    h = words.hashes(low, starts, ends)
    passages, own, before = cut(of, len(off) - 1, step)
    first_word = np.searchsorted(of, np.arange(len(off) - 1))
    best: dict = {}
    for shard in shards:
        n_terms = len(shard.terms)
        if not n_terms:
            continue
        at = np.minimum(np.searchsorted(shard.terms, h), n_terms - 1)
        known = np.flatnonzero(shard.terms[at] == h)
        pairs = np.concatenate([own[known] * n_terms + at[known], before[known] * n_terms + at[known]])
        pairs = np.sort(pairs[np.concatenate([own[known], before[known]]) >= 0])
        pairs = pairs[np.diff(pairs, prepend=-1) != 0]
        passage, term = pairs // n_terms, pairs % n_terms
        bound = np.bincount(passage, weights=shard.highest[term], minlength=len(passages.text))
        open_ = bound[passage] >= 1 - SLACK
        passage, term = passage[open_], term[open_]
        cuts = np.flatnonzero(np.diff(passage, prepend=-1))
        for lo, hi in _possible(shard, term, np.append(cuts, len(passage))):
            mine = term[lo:hi]
            p = int(passage[lo])
            said = h[passages.begin[p]:passages.end[p]]
            sets: dict = {}
            for number, score in block_max_wand(shard, mine):
                item = shard.info[number]
                if item.short not in sets:
                    sets[item.short] = np.unique(words.shingle_hashes(said, item.short))
                asked = float(np.isin(item.question, sets[item.short], assume_unique=True).mean())
                told = float(np.isin(item.answer, said).mean()) if len(item.answer) else 1.0
                if asked < overlap or told < overlap:
                    continue
                text = int(passages.text[p])
                row = (score, asked, told, -int(passages.begin[p] - first_word[text]))
                best[text, item.item_id] = max(best.get((text, item.item_id), row), row)
    return [(text, item_id, -b[3], b[0], b[1], b[2]) for (text, item_id), b in sorted(best.items(), key=str)]


def _items(items: DataFrame) -> DataFrame:
    names = set(items.columns)
    if {"question", "answer"} <= names:
        q, a = column(items, "question"), column(items, "answer")
        return items.select(column(items, "item_id").alias("item_id"), F.coalesce(q, F.lit("")).alias("question"),
                            F.coalesce(a, F.lit("")).alias("answer"), F.lit(False).alias("whole"))
    return items.select(column(items, "item_id").alias("item_id"), F.coalesce(column(items, "text"), F.lit("")).alias("question"),
                        F.lit("").alias("answer"), F.lit(True).alias("whole"))


def _item_words(rows: DataFrame) -> DataFrame:
    """The items with all their words' hashes."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for question, answer, whole in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                full = question if whole else question + "\n" + answer
                out.append((question, answer, word_hashes(full).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                 pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["item_id", "question", "answer", "h"])
    return rows.mapInArrow(run, f"item_id {rows.dtypes[0][1]}, question string, answer string, h array<bigint>").filter(
        F.size("h") > 0)


def find_leaks(docs: DataFrame, items: DataFrame, min_score: float = 0.6, overlap: float = 0.8) -> DataFrame:
    """Rows (doc_id, item_id, passage_word, score, question_overlap,
    answer_overlap): every item that a document holds, with the best passage's
    first word and its BM25 score as a share of what the item must reach."""
    return _leaks(docs, items, min_score, overlap).drop("raw")


def _leaks(docs: DataFrame, items: DataFrame, min_score: float = 0.6, overlap: float = 0.8) -> DataFrame:
    """``find_leaks`` with raw, the ``text_hash`` of the document."""
    spark = docs.sparkSession
    known = _item_words(_items(items))
    size = known.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("h")).alias("mean")).first()
    words_in_all = round((size["mean"] or 0) * size["n"])
    groups = max(1, -(-size["n"] // (SHARD_ITEMS * SHARDS)), -(-words_in_all // SCAN_WORDS))
    df = known.select(F.explode(F.array_distinct("h")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    placed = known.withColumn("part", F.pmod(F.xxhash64("item_id", "question"), F.lit(groups)))
    kind, item_kind = (x.select(column(x, c).alias(c)).dtypes[0][1] for x, c in ((docs, "doc_id"), (items, "item_id")))
    texts = id_text(docs)
    out = None
    for group in range(groups):
        rows = placed.filter(F.col("part") == group)
        seen = df.join(rows.select(F.explode("h").alias("t")).distinct(), "t")
        shards, longest = build_shards(
            [(r["item_id"], r["question"], r["answer"], np.array(r["h"], np.int64).view(np.uint64))
             for r in rows.orderBy("item_id", "question", "answer").collect()],
            {r["t"] % (1 << 64): r["df"] for r in seen.collect()}, size["n"], size["mean"] or 1.0, min_score, overlap)
        shared = spark.sparkContext.broadcast((shards, -(-longest * 5 // 4)))
        one = texts.mapInArrow(_searcher(shared, overlap),
                               f"doc_id {kind}, item_id {item_kind}, passage_word bigint, score double, "
                               "question_overlap double, answer_overlap double, raw binary")
        out = one if out is None else out.unionByName(one)
    return out


def _searcher(shared, overlap: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, step = shared.value
        for b in batches(it, 2 << 20):
            raw, off = flat_bytes(b.column(1))
            hits = search(raw, off, shards, step, overlap)
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([x[0] for x in hits])), *(pa.array([x[i] for x in hits]) for i in range(1, 6)),
                     pa.array([sha(raw[off[x[0]]:off[x[0] + 1]].tobytes()) for x in hits], pa.binary())],
                    names=["doc_id", "item_id", "passage_word", "score", "question_overlap", "answer_overlap", "raw"])
    return run


def drop_leaks(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    leaks = _leaks(docs, items, **how).select("doc_id", "raw", F.lit(False).alias("stays"))
    return bloom.drop_documents(docs, leaks)
