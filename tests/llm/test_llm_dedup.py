"""Exact dedup, SimHash near-dedup, decontamination: against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ovenbird.llm import decontaminate, exact_dedup, simhash
from ovenbird.llm.common import Scratch
from ovenbird.llm.components import components

SCHEMA = "doc_id long, text string, h long, score double, part int, size int, fp string"


def _docs(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, 0.5, 2, 3, "q") for r in rows], SCHEMA).repartition(parts)


def test_golomb_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 50, 3000):
        for top in (n + 1, 1 << 20, 1 << 63):
            x = np.unique(rng.integers(0, top, n).astype(np.uint64))
            assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(x)) == x).all()
    x = np.array([0, (1 << 64) - 1], np.uint64)
    assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(x)) == x).all()


@pytest.fixture(scope="module")
def exact_rows():
    rng = random.Random(2)
    rows = []
    for k in range(600):
        base = f"text {rng.randrange(150)} body" if k % 3 else "the hot text"
        rows.append((k, "".join(c + rng.choice(["", " ", "\n", "\t\x0b"]) for c in base)))
    return rows + [(700, None), (701, ""), (702, " \r\n"), (703, "a b"), (704, "ab"), (705, "x" * 300_000), (706, "x" * 300_000 + " "),
                   (None, "only null id"), (710, "same"), (710, "same"), (711, "two of one id"), (711, "two of  one id"),
                   (711, "another text")]


def _exact(rows):
    norm = {}
    for i, t in rows:
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), -1 if i is None else i, i))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(norm[key])[2]
        # Of several rows of the class with that id one is kept: the longest, of equal ones any.
        first = rows.index(max((r for r in rows if r[0] == keep and re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") == key),
                               key=lambda r: len(r[1] or "")))
        out.append((i, keep, len(norm[key]), (i, t) == rows[first] and (i, t) not in rows[:len(out)],
                    hashlib.sha256(key.encode()).hexdigest()))
    return out


def test_exact_dedup(spark, exact_rows):
    df = _docs(spark, exact_rows)
    got = [tuple(r) for r in exact_dedup.duplicate_classes(df, owners=3).collect()]
    assert sorted(got, key=str) == sorted(_exact(exact_rows), key=str)
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((x[0] for x in _exact(exact_rows) if x[3]), key=str)


def test_owners_grow_with_the_rows():
    assert exact_dedup.owner_count(0, 0) == 1 and exact_dedup.owner_count(1000, 200) == 200
    assert exact_dedup.owner_count(10**10, 200) == 5000  # not 50 million fingerprints for each of 200


def test_exact_dedup_empty(spark):
    assert exact_dedup.duplicate_classes(_docs(spark, [(1, "x")]).limit(0)).count() == 0


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(1, 60)] + [(1000, 1000 + k) for k in range(1, 40)] + [
        (rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(-5, -9), (7, 7)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"),
                                                   Scratch(spark, "test"), "c").collect()}
    assert got == _components(nodes, [x for x in links if x[0] != x[1]])


def _fingerprint(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def test_fingerprint_of_texts(spark, monkeypatch):
    rng = random.Random(6)
    texts = ["", " ", "One", "a b c d", "ÄÖ Ünd A b", "a b c d e f g"] + [
        " ".join(rng.choice(["The", "of", "x\ny", "word", "é", "zz"]) for _ in range(rng.randrange(700))) for _ in range(60)]
    for size in (1, 4):
        want = [_fingerprint(t, size) for t in texts]
        assert [simhash.fingerprint(t, size) for t in texts] == want
        for long in (1, 7, 300):
            monkeypatch.setattr(simhash, "LONG", long)
            assert [simhash.fingerprint(t, size) for t in texts] == want
        monkeypatch.undo()
    df = _docs(spark, [(1, texts[-1])])
    spark_hash = df.select(F.xxhash64(F.lit("a b c d")).alias("x")).first()["x"] % (1 << 64)
    assert spark_hash == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_allocation_satisfies_the_principle():
    rng = np.random.default_rng(1)
    for n in (10, 10_000, 10_000_000):
        bits = rng.random((2000, 64)) < rng.random(64)
        both = bits.T.astype(float) @ bits * (n / 2000)
        for distance in (0, 1, 4, 6):
            plan = simhash.allocate(n, both, distance)
            assert sorted(b for g, _ in plan for b in g) == list(range(64))
            assert sum(t for _, t in plan) == distance - len(plan) + 1


@pytest.mark.parametrize("small", [256, 2])
def test_near_links_against_all_pairs(spark, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(8)
    fps = {rng.getrandbits(64) for _ in range(300)}
    hot = rng.getrandbits(64)
    for _ in range(150):  # a dense group and a chain
        x = hot
        for b in rng.sample(range(64), rng.randrange(5)):
            x ^= 1 << b
        fps.add(x)
    x = rng.getrandbits(64)
    for _ in range(20):
        for b in rng.sample(range(64), 4):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    nodes = spark.createDataFrame([(f, 1 + k % 3) for k, f in enumerate(fps)], "fp long, size long")
    scratch = Scratch(spark, "test")
    links = scratch.put(simhash.near_links(nodes, scratch, 4), "links")
    got = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in links.collect()}
    assert got <= set(pairs)
    if small == 256:
        assert got == set(pairs)
    assert _components(fps, got) == _components(fps, pairs)


def test_simhash_documents(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    rng = random.Random(1)
    long = " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(3000))
    rows = [(5, None), (3, ""), (4, " \n"), (9, long), (8, long + " tail"), (8, long + " tail"), (2, "short one"), (7, "SHORT  one"),
            (None, "lonely null id")]
    got = {(r["doc_id"], r["component_id"]): r["fingerprint"] for r in simhash.near_components(_docs(spark, rows)).collect()}
    assert set(got) == {(5, 3), (3, 3), (4, 3), (9, 8), (8, 8), (2, 2), (7, 2), (None, None)}
    assert got[5, 3] == "0" * 16 and got[9, 8] == f"{_fingerprint(long, 4):016x}"
    kept = simhash.keep_one(_docs(spark, rows))
    assert kept.columns == _docs(spark, rows).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, 8, None]
    assert simhash.near_components(_docs(spark, rows).limit(0)).count() == 0


def _words(text):
    return [w.lower() for w in re.findall(rb"[0-9a-zA-Z\x80-\xff]+", (text or "").encode())]


def _leaks(docs, items):
    """Brute force over whole documents (their passages are at most the whole)."""
    out = set()
    for i, t in items:
        w = _words(t)
        if not w:
            continue
        size = min(5, len(w))
        want = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
        for d, text in docs:
            x = _words(text)
            if len(want & {tuple(x[k:k + size]) for k in range(len(x) - size + 1)}) >= 0.8 * len(want):
                out.add((d, i))
    return out


def test_block_max_wand_against_all_scores():
    rng = random.Random(3)
    vocabulary = [f"t{k}" for k in range(80)]
    texts = [" ".join(rng.choice(vocabulary[:rng.choice([10, 80])]) for _ in range(rng.randrange(3, 30))) for _ in range(150)]
    hashes = [decontaminate.word_hashes(t) for t in texts]
    df = {}
    for h in hashes:
        for t in set(h.tolist()):
            df[t] = df.get(t, 0) + 1
    (shard,), _ = decontaminate.build_shards([(k, t, "", h) for k, (t, h) in enumerate(zip(texts, hashes, strict=True))],
                                             df, len(texts), 15.0, 0.6)
    for _ in range(150):
        terms = np.unique(rng.sample(range(len(shard.terms)), rng.randrange(1, 50)))
        full = np.zeros(len(texts))
        for t in terms:
            s = slice(shard.first[t], shard.first[t + 1])
            np.add.at(full, shard.items[s], shard.impacts[s])
        got = dict(decontaminate.block_max_wand(shard, terms))
        assert set(got) == {int(i) for i in np.flatnonzero(full >= 1 - decontaminate.SLACK)}
        assert all(abs(full[i] - s) < 1e-9 for i, s in got.items())


def test_decontamination(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 7)
    monkeypatch.setattr(decontaminate, "SHARDS", 2)
    rng = random.Random(12)
    common = [f"c{k}" for k in range(30)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(5000)}"
    items = [(k, ". ".join(" ".join(word() for _ in range(rng.randrange(8, 25))) for _ in range(rng.randrange(1, 3)))) for k in range(40)]
    items += [(90, None), (91, ""), (92, "Tiny one")]
    docs = []
    for k in range(150):
        body = [word() for _ in range(rng.randrange(400))]
        if k % 4 == 0:
            w = items[k % 40][1].upper().split()
            if k % 8 == 0:
                w[rng.randrange(len(w))] = "changed"
            body[len(body) // 2:len(body) // 2] = w
        docs.append((k, " ".join(body)))
    docs += [(500, None), (501, ""), (502, "a tiny ONE b"), (503, items[3][1] + "\n" + items[3][1]), (503, items[3][1]), (None, items[4][1])]
    df = _docs(spark, docs)
    rows = decontaminate.find_leaks(df, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, h long")).collect()
    want = {x for x in _leaks(docs, items)}
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want and len(rows) == len(want) + 1  # 503 is there twice
    clean = decontaminate.drop_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.find_leaks(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontaminate.find_leaks(df, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_decontamination_checks_the_answer(spark):
    items = spark.createDataFrame([(1, "what is the capital city of the land of oz called today", "emerald city")],
                                  "item_id long, question string, answer string")
    docs = _docs(spark, [(1, "what is the capital city of the land of oz called today it is the emerald city of course"),
                         (2, "what is the capital city of the land of oz called today nobody knows"), (3, "emerald city")])
    assert [r["doc_id"] for r in decontaminate.find_leaks(docs, items).collect()] == [1]
