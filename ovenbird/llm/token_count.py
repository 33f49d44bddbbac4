"""Token counts by byte-pair merging with a heap and a linked list.

A text starts as a list of symbols (its characters; a character that the
vocabulary lacks costs as many tokens as it has UTF-8 bytes).  The adjacent
pair of the lowest rank is popped from a heap, its two symbols are joined in
the linked list and the two new neighbour pairs are pushed.  The count is the
initial cost minus what the merges saved; no identifiers are made.

Spaces become U+2581 and one is put before the text.  No piece of the
vocabulary holds U+2581 after another character (checked when it is loaded),
so no merge crosses that border: the text is counted word by word, and a
worker remembers the counts of words it has met.  The memory is bounded
(``MEMO_WORDS`` short words, then it starts anew).

Defined results: a null text is empty and has no tokens; very long words are
counted whole; repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches, id_text

SPACE = "▁"
MEMO_WORDS = 400_000
MEMO_CHARS = 48
#: Characters from which on the words of a text are not listed at once.
LONG = 1 << 20
#: A run of spaces and what follows up to the next space.
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class MergeCounter:
    """Counts tokens by merging pairs in order of rank, then of place."""

    def __init__(self, ranks: dict[str, float]):
        """ranks: piece -> rank; a lower rank merges first."""
        if any(SPACE in piece.lstrip(SPACE) for piece in ranks):
            raise ValueError("a piece crosses a word border; words can't be counted apart")
        self.ranks = ranks
        self.memo: dict[str, int] = {}

    def merge_count(self, word: str) -> int:
        ranks = self.ranks
        symbols = list(word)
        size = len(symbols)
        cost = [1 if c in ranks else len(c.encode()) for c in symbols]
        total = sum(cost)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            pair = symbols[i] + symbols[i + 1]
            rank = ranks.get(pair)
            if rank is not None:
                heap.append((rank, i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = symbols[i]
            j = after[i]
            if left is None or j >= size or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
                continue  # one of the two has merged meanwhile
            total -= cost[i] + cost[j] - 1
            symbols[i], symbols[j], cost[i] = pair, None, 1
            nxt = after[i] = after[j]
            if nxt < size:
                before[nxt] = i
                joined = pair + symbols[nxt]
                rank = ranks.get(joined)
                if rank is not None:
                    heapq.heappush(heap, (rank, i, joined))
            prev = before[i]
            if prev >= 0:
                joined = symbols[prev] + pair
                rank = ranks.get(joined)
                if rank is not None:
                    heapq.heappush(heap, (rank, prev, joined))
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        memo, total = self.memo, 0
        marked = SPACE + text.replace(" ", SPACE)
        words = WORD.findall(marked) if len(marked) < LONG else (m[0] for m in WORD.finditer(marked))
        for word in words:
            n = memo.get(word)
            if n is None:
                n = self.merge_count(word)
                if len(word) <= MEMO_CHARS:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = n
            total += n
        return total


@lru_cache(maxsize=2)
def counter_of(path: str) -> MergeCounter:
    """The counter of a sentencepiece byte-pair model file, one per worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return MergeCounter({model.id_to_piece(i): -model.get_score(i) for i in plain})


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens and whether it has more
    than ``limit`` tokens.  ``model_path``: a byte-pair sentencepiece model
    with identity normalisation, to be found under that path on every node
    (unset: the public 32k model of the node)."""
    rows = id_text(docs)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        counter = counter_of(model_path or public_tokenizers.path("piece_bpe_32k.model"))
        for b in batches(it):
            texts = [x or "" for x in b.column(1).to_pylist()]
            counts = [counter.count(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, n_bytes bigint, n_tokens bigint, over_limit boolean")
