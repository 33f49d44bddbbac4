"""The filtering stages decide and act per row: several rows without an id, or with one id and several texts."""

import random

from test_llm_dedup import _docs

from ovenbird.llm import decontaminate, exact_dedup, quality, simhash


def _kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_exact_dedup_of_rows_without_an_id(spark):
    # Of equal texts the longest row stays, then the one without an id.
    rows = [(None, "clean one"), (None, "clean two"), (None, "a copy"), (1, "a  copy"), (None, "twice"), (None, "twice"), (None, "twice"),
            (2, "a copy too"), (2, "another text"), (3, "a copy  too"), (None, None), (None, "")]
    docs = _docs(spark, rows)
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns
    assert [(i, t or "") for i, t in _kept(got)] == sorted(
        [(None, "clean one"), (None, "clean two"), (1, "a  copy"), (None, "twice"), (2, "another text"), (3, "a copy  too"), (None, "")],
        key=str)


def test_simhash_of_rows_without_an_id(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(500)}" for _ in range(3000))
    a, b, c, d, e = (text() for _ in range(5))
    near = [c + " tail", c + " tail two"]
    rows = [(None, a), (None, b), (None, c), (9, near[0]), (None, d), (None, d), (4, e), (4, near[1])]
    prints = [simhash.fingerprint(x) for x in (c, *near)]
    assert all((prints[0] ^ x).bit_count() <= 4 for x in prints)
    got = simhash.keep_one(_docs(spark, rows))
    assert _kept(got) == sorted([(None, a), (None, b), (4, near[1]), (None, d), (4, e)], key=str)
    only_null = [(None, c), (None, near[0]), (None, a)]
    kept = _kept(simhash.keep_one(_docs(spark, only_null)))
    assert len(kept) == 2 and (None, a) in kept


def test_leaks_in_rows_without_an_id(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, "clean text of its own"), (None, f"before {item} after"), (None, "another clean text"), (None, None),
            (5, f"{item} again"), (5, "the clean text of five"), (6, "six is clean")]
    got = decontaminate.drop_leaks(_docs(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert _kept(got) == sorted([rows[0], rows[2], rows[3], rows[5], rows[6]], key=str)


def test_repeated_rows_and_clashing_columns(spark):
    """One of equal rows stays; helper columns don't meet the user's."""
    text = "a text that is there twice " * 20
    rows = [(1, text), (1, text), (2, "other words here"), (2, "a second text of two"), (1, "a third one")]
    docs = _docs(spark, rows)
    for name in ("__raw", "text_sha", "Text_SHA_", "__id", "__quality_score", "quality_score", "raw", "stays", "place"):
        docs = docs.withColumn(name, docs["doc_id"] + 7)
    want = sorted(set(rows), key=str)
    for got in (exact_dedup.drop_duplicates(docs), simhash.keep_one(docs)):
        assert got.columns == docs.columns and _kept(got) == want
        assert all(r["__raw"] == r["text_sha"] == r["__id"] == r["doc_id"] + 7 for r in got.collect())
    item = spark.createDataFrame([(1, "none of these words occurs")], "item_id long, text string")
    clean = decontaminate.drop_leaks(docs, item)
    assert clean.columns == docs.columns and _kept(clean) == sorted(rows, key=str)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 9)], "doc_id long, quality int")
    good = quality.keep_good(docs, labels, threshold=0.0)
    assert good.columns == docs.columns and _kept(good) == sorted(rows, key=str)
    assert {r["held_out"] for r in quality.classify(_docs(spark, [(None, "x")]), labels).collect()} == {False}
