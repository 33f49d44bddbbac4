"""Decontamination by items that have a text only: no answer is made up."""

import random

import pytest
from test_llm_dedup import _docs, _leaks

from ovenbird.llm import decontaminate


def test_short_changed_and_omitted_last_sentences(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 16)
    rng = random.Random(21)
    common = [f"c{k}" for k in range(25)]
    word = lambda: rng.choice(common) if rng.random() < 0.6 else f"w{rng.randrange(4000)}"
    items, docs = [], []
    for k in range(60):
        # Of every third item only the last sentence has rare words: most of the BM25 score.
        first = [rng.choice(common) if k % 3 == 0 else word() for _ in range(rng.randrange(25, 45))]
        last = [f"r{k}x{i}" if k % 3 == 0 else word() for i in range(1 + k % 4)]
        items.append((k, " ".join(first) + ". " + " ".join(last) + "."))
        fill = lambda: " ".join(rng.choice(common) + "y" for _ in range(rng.randrange(80)))
        forms = [first, first[:-1] + ["changed"] + last] + [
            first + last[:i] + ["changed"] + last[i + 1:] for i in range(len(last))]
        docs += [(100 * k + n, f"{fill()} {' '.join(x)} {fill()}") for n, x in enumerate(forms)]
    want = _leaks(docs, items)
    assert sum((100 * k, k) in want for k in range(60)) > 50  # the last sentence omitted
    df, benchmark = _docs(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find_leaks(df, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want and len(rows) == len(want)
    assert all(r["answer_overlap"] == 1 for r in rows)
    clean = decontaminate.drop_leaks(df, benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}


@pytest.mark.parametrize("sizes", [[], [5], [10**7], [40] * 3000, [10**7, 1, 1, 3000, 10**6] + [7] * 2500])
def test_shards_are_bounded(sizes):
    cuts = decontaminate.shard_cuts(sizes)
    assert cuts == sorted(set(cuts)) and cuts[:1] == [0] * bool(sizes)
    for at, end in zip(cuts, [*cuts[1:], len(sizes)]):
        n, words = end - at, sum(sizes[at:end])
        assert n == 1 or n <= decontaminate.SHARD_ITEMS and words * -(-n // decontaminate.BLOCK) <= decontaminate.SHARD_CELLS


def test_long_items_take_more_scans_and_shards(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_CELLS", 900)
    monkeypatch.setattr(decontaminate, "SCAN_WORDS", 1500)
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    items = [(k, text(2500 if k == 7 else rng.randrange(5, 120))) for k in range(40)]
    docs = [(k, f"{text(60)} {t} {text(60)}" if k % 2 else text(200)) for k, t in items]
    rows = decontaminate.find_leaks(_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(k, k) for k in range(1, 40, 2)]
