"""Quality classifier, packing, Re-Pair shards and the pipeline."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ovenbird.llm import decontaminate, exact_dedup, packing, quality, repair, simhash
from ovenbird.llm import byte_ids as ids_module
from ovenbird.llm.byte_ids import byte_ids
from ovenbird.llm.common import Scratch

SF = "/root/testdata/sf0.001"
TEXTS = ["", "hello world", "  two  spaces\n\n x", "<|endoftext|> inside", "漢字 and é", "\u0085\u001c ", "a\r\n\tb", "it's we'll 12 !!"]


def test_byte_ids_equal_library(monkeypatch):
    encoder, rng = byte_ids(), random.Random(1)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "the", "'s", "'ll", " ing", "É", "漢", "!", "$$$", "1", "12",
             "<|endoftext|>", "ſ", "\x85", "\x1c", " ", "é", "🙂"]
    texts = TEXTS + ["".join(rng.choice(parts if k % 2 else parts[:12]) for _ in range(rng.randint(0, 14))) for k in range(4000)]
    for long in (1 << 20, 1, 5):
        monkeypatch.setattr(ids_module, "LONG", long)
        for t in texts[:300 if long < 9 else None]:
            assert encoder.ids(t).tolist() == encoder.exact.encode(t, add_special_tokens=False).ids, repr(t)


# ------------------------------------------------------------------ quality

def _quality_docs(spark, n=400):
    rng = random.Random(3)
    docs, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        good = k % 4 != 0
        text = " ".join(words) if good else " ".join(w + rng.choice(["$$$", "###"]) for w in words) if k % 8 else " ".join(
            w for w in words[:6] for _ in range(10))
        docs.append((k, text, "x", 7))
        labels.append((k, int(good), 0))
    return (spark.createDataFrame(docs, "doc_id long, text string, label string, score int").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_held_out_accuracy(spark):
    docs, labels = _quality_docs(spark)
    got = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 400 and 40 < len(held) < 130
    assert (held.predicted == held.quality).mean() > 0.95
    for r in got.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_quality_reads_no_held_out_label(spark):
    docs, labels = _quality_docs(spark, 120)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.classify(docs, labels).orderBy("doc_id").collect()
    assert a == quality.classify(docs, turned).orderBy("doc_id").collect()


def test_quality_votes_equal_brute_force(spark):
    docs, labels = _quality_docs(spark, 80)
    model = quality.fit(docs, labels, neighbours=5)
    from ovenbird.llm.common import flat_bytes
    import pyarrow as pa
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    counts = quality.term_counts(*flat_bytes(pa.array(texts)))
    for i in range(0, 80, 9):
        v = quality._weighted(counts[i:i + 1].copy(), model.idf)[0] @ model.projection
        v = v / np.linalg.norm(v)
        cosine = sorted(((float(v @ x), y) for x, y in zip(model.vectors, model.labels, strict=True)), key=lambda c: -c[0])[:5]
        want = sum(max(c, 0) * y for c, y in cosine) / sum(max(c, 0) for c, _ in cosine)
        assert abs(want - model.scores(counts[i:i + 1])[0]) < 1e-3


def test_quality_edges(spark):
    docs, labels = _quality_docs(spark, 60)
    odd = docs.limit(0).unionByName(spark.createDataFrame(
        [(900, None, "", 1), (901, "", "", 1), (None, "x", "", 1), (902, "er on " * 100_000, "", 1), (902, "z", "", 1)],
        "doc_id long, text string, label string, score int"))
    model = quality.fit(docs, labels)
    got = [r["s"] for r in quality.score(odd, model, "s").collect()]
    assert len(got) == 5 and all(0 <= x <= 1 for x in got)
    assert got[0] == got[1] == pytest.approx(model.labels.mean())
    nothing = quality.classify(docs, labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {1.0}
    assert quality.classify(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs, labels.unionByName(labels.withColumn("quality", F.lit(None).cast("int"))))
    assert kept.columns == docs.columns and 0 < kept.count() < 60


# ------------------------------------------------------------------ packing

def _sequential_best_fit(sizes, capacity):
    import bisect
    gaps, n = [], 0
    for s in sorted(sizes, reverse=True):
        k = bisect.bisect_left(gaps, s)
        if k < len(gaps):
            bisect.insort(gaps, gaps.pop(k) - s)
        else:
            n += 1
            bisect.insort(gaps, capacity - s)
    return n


@pytest.mark.parametrize("partitions,range_rows", [(4, 100_000), (211, 100_000), (64, 400), (4, 150)])
@pytest.mark.parametrize("kind", ["spread", "tiny", "equal"])
def test_best_fit(spark, monkeypatch, kind, partitions, range_rows):
    """The session's partitions don't matter; many small ranges cost little."""
    monkeypatch.setattr(packing, "RANGE_ROWS", range_rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        _check_best_fit(spark, kind, 1.01 if range_rows > 1500 else 1.03, 1 if range_rows > 1500 else 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _check_best_fit(spark, kind, factor, more):
    rng = np.random.default_rng(4)
    sizes = {"spread": rng.integers(1, 1024, 1500), "tiny": rng.integers(1, 30, 1500), "equal": np.full(600, 300)}[kind]
    items = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(sizes)) * 7, "size": sizes.astype(np.int32)}), "id long, size int")
    got = packing.best_fit(items, Scratch(spark, "test"), 1024).toPandas()
    assert sorted(got.id) == sorted(np.arange(len(sizes)) * 7)
    size = dict(zip(np.arange(len(sizes)) * 7, sizes, strict=True))
    for _, rows in got.groupby("seq"):
        at = 0
        for r in rows.sort_values("offset").itertuples():
            assert r.offset == at
            at += size[r.id]
        assert at <= 1024
    best = _sequential_best_fit(sizes.tolist(), 1024)
    assert got.seq.nunique() <= best * factor + more


def test_brackets_give_every_rank_one_fitting_gap():
    rng = random.Random(2)
    for _ in range(200):
        value, counts, pieces, gaps = 1000, [], {}, {}
        for part in range(rng.randrange(1, 7)):
            top, value = value, max(1, value - rng.randrange(1, 300))
            waits = [rng.randint(value, top) for _ in range(rng.randrange(6))]
            free = [rng.randint(top, 1000) for _ in range(rng.randrange(6))]
            pieces[part], gaps[part] = sorted(waits, reverse=True), sorted(free)
            counts.append((part, len(waits), len(free), max(waits, default=None), min(free, default=None)))
        matches, found, lost = packing._brackets(counts)
        room = {(p, k): g for p, x in gaps.items() for k, g in enumerate(x)}
        met = {p: 0 for p in pieces}
        for part, first, end, gap_part, gap_first, each in matches:
            assert gap_part < part and first == met[part]
            for k in range(first, end):
                room[gap_part, gap_first + (k - first) // each] -= pieces[part][k]
            met[part] = end
        assert all(g >= 0 for g in room.values())
        assert {p: t for p, (t, _) in found.items()} == met and lost == sum(len(x) - met[p] for p, x in pieces.items())


def test_pack_documents(spark):
    rng = random.Random(5)
    rows = [(k, " ".join("word" + str(rng.randrange(50)) for _ in range(rng.choice([1, 9, 90])))) for k in range(60)]
    rows += [(100 + k, t) for k, t in enumerate(TEXTS)] + [(200, None), (201, "long text " * 4000), (202, "x"), (202, "x"), (None, "null id")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, id long, size int").repartition(3)
    out = packing.pack(docs, capacity=64, end_id=2).cache()
    got = out.toPandas()
    exact = byte_ids().exact
    want = sorted(str((i, exact.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in rows if i not in (202,))
    have = []
    for i, x in got[got.doc_id != 202].groupby("doc_id", dropna=False):
        x = x.sort_values("piece")
        assert x.piece.tolist() == list(range(len(x))) and x.start.tolist() == [0, *np.cumsum(x.length)[:-1]]
        assert all(n == 64 for n in x.length[1:])
        ids = [int(v) for p in x.ids for v in np.frombuffer(p, np.uint16)]
        for r in x.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.frombuffer(r.ids, np.uint16).astype("<u4").tobytes())
        have.append(str((None if pd.isna(i) else int(i), ids)))
    assert sorted(have) == want and len(got[got.doc_id == 202]) == 2
    total = 0
    for r in packing.sequences(out).collect():
        at = 0
        for p in r["pieces"]:
            assert p["offset"] == at
            at += p["length"]
        assert at <= 64 and len(r["ids"]) == 2 * at
        total += at
    assert total == got.length.sum()
    assert packing.pack(docs.limit(0)).count() == 0


# ------------------------------------------------------------------- re-pair

def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 50257, rng.integers(1, 6)).astype(np.uint16) for _ in range(40)]
    docs = [np.concatenate([*[words[k] for k in rng.integers(0, 40, rng.integers(0, 300))], np.zeros(1, np.uint16)]) for _ in range(60)]
    docs += [np.zeros(1, np.uint16), np.append(np.full(999, 7, np.uint16), 0).astype(np.uint16)]
    sizes = np.array([len(d) for d in docs])
    ids = np.concatenate(docs).astype(np.uint16)
    g = repair.compress(ids, sizes)
    assert len(g.rules) and len(g.symbols) < 0.6 * len(ids) and g.sizes.sum() == len(g.symbols)
    assert (repair.expand(g.rules, g.lengths, g.symbols) == ids).all()
    shard = {"rules": g.rules.tobytes(), "lengths": g.lengths.tobytes(), "symbols": g.symbols.tobytes(),
             "doc_symbols": g.sizes.tolist()}
    for k in (0, 5, 60, 61):
        for start, count in ((0, 10**6), (3, 20), (len(docs[k]) - 1, 5), (len(docs[k]), 1), (100, 1)):
            assert repair.decode_range(shard, k, start, count).tolist() == docs[k][start:start + count].tolist()


def test_shards_round_trip(spark, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_TOKENS", 500)
    rng = random.Random(8)
    rows = [(k * 3, " ".join(rng.choice(["alpha", "beta", "gamma delta"]) for _ in range(rng.randrange(80)))) for k in range(120)]
    rows += [(1, None), (2, ""), (4, "long text " * 3000)] + [(1000 + k, t) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, part int, ids string").repartition(4)
    got = {r["doc_id"]: r for r in repair.round_trip(docs).collect()}
    start, exact = 0, byte_ids().exact
    for i, t in sorted(rows):
        ids = exact.encode(t or "", add_special_tokens=False).ids + [0]
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert np.frombuffer(r["ids"], np.uint16).tolist() == ids
        start += len(ids)
    assert len(got) == len(rows)
    assert repair.round_trip(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "b"), (7, "x"), (7, "y"), (7, "x")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in repair.round_trip(odd).collect()) == ["7", "7", "7", "None"]


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    """Every stage against its operator's decisions, from the stage before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch = Scratch(spark, "test")
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(scratch.put(stage(spark, tables[-1], SF), str(k)))
        if k < 4:
            assert tables[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in tables]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r["doc_id"] for r in quality.classify(docs, labels).filter("predicted = 0").collect()}
    assert ids[1] == ids[0] - rejected
    assert ids[2] == {r["doc_id"] for r in exact_dedup.duplicate_classes(tables[1]).filter("kept").collect()}
    assert ids[3] == {r["component_id"] for r in simhash.near_components(tables[2]).collect()}
    leaks = decontaminate.find_leaks(tables[3], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids[4] == ids[3] - {r["doc_id"] for r in leaks.collect()}
    assert ids[5] == ids[4]
    packed = tables[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert packed[0] <= 1024
    assert packed[1] == sum(len(byte_ids().ids(r["text"])) + 1 for r in tables[4].collect())


def test_registered_queries_against_sql(spark):
    import duckdb

    import __spark_entry__ as entry
    from ovenbird.llm.queries import ORACLE
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for key, sql in ORACLE.items():
        got = entry.queries()[key](spark, SF)
        cols = sorted(got.columns)
        rows = sorted((tuple(r) for r in got.select(cols).collect()), key=str)
        con.execute(f"CREATE OR REPLACE TEMP TABLE want AS {sql}")
        assert rows == sorted(con.execute(f"SELECT {', '.join(cols)} FROM want").fetchall(), key=str), key
    assert {k.split("_")[0] for k in entry.queries() if k.startswith("op")} >= {f"op{n}" for n in range(1, 14)}
