"""Fingerprints: against a plain vote, plain editing and all pairs."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ovenbird.llm import fingerprints as fp
from ovenbird.llm.common import Scratch
from ovenbird.llm.words import hashes, mix

SCHEMA = "doc_id long, text string, fp string, key long, part int, edge string, z binary"


def _docs(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "f", 1, 2, "e", b"z") for i, t in rows], SCHEMA).repartition(parts)


def _hash(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def _plain(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    tokens = [_hash(w) for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower)]
    pairs = [(a * 0x9E3779B97F4A7C15 + b) % 2**64 for a, b in zip(tokens, tokens[1:])]
    terms = Counter([int(mix(np.array([p], np.uint64))[0]) for p in pairs] or tokens)
    votes = np.zeros(256)
    for term, n in terms.items():
        own = mix(np.uint64(term) ^ fp._SEEDS)
        bits = np.unpackbits(own.view(np.uint8), bitorder="little").astype(int)
        votes += round(16 * (1 + math.log2(n))) * (2 * bits - 1)
    return np.packbits(votes > 0, bitorder="little").view(np.uint64)


def _texts(rng, n):
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    out = []
    for k in range(n):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 90)))
        if k % 4 == 1 and out:
            text = out[rng.randrange(len(out))]
            if rng.random() < 0.6:
                text = text.replace(" ", ", ", 1) + " " + rng.choice(vocabulary)
        out.append(text.upper() if k % 7 == 0 else text)
    return out


def test_fingerprint_equals_plain_vote(monkeypatch):
    texts = _texts(random.Random(1), 60) + ["", "one", " . ", "a a a a a a", "x y " * 3000, "Ünï cödé 1 2 3"]
    whole = fp._sliced(texts)
    assert all((a == _plain(t)).all() for a, t in zip(whole, texts))
    monkeypatch.setattr(fp, "STEP", 7)
    monkeypatch.setattr(fp, "SLICE", 200)
    assert (fp._sliced(texts) == whole).all()


def test_likeness():
    a = np.zeros((3, 4), np.uint64)
    b = a.copy()
    b[1, 0] = 2**64 - 1
    b[2] = 2**64 - 1
    assert np.allclose(fp.likeness(a, b), [1, math.cos(math.pi / 4), 0])


def _expected(rows, radius):
    rows = [(i, t or "") for i, t in rows]
    n = len(rows)
    prints = [_plain(t) for _, t in rows]
    new = [fp.edited(t, rows[(k + 1) % n][1]) for k, (_, t) in enumerate(rows)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(n):
        for b in range(a):
            if int(np.bitwise_count(prints[a] ^ prints[b]).sum()) <= radius:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(math.inf if i is None else i)
    out = []
    for k, (i, t) in enumerate(rows):
        e, low = _plain(new[k]), min(least[find(k)])
        out.append((i, len(t), hashlib.sha256(new[k].encode()).hexdigest(), fp._binary(prints[k][None])[0].hex(),
                    fp._binary(e[None])[0].hex(), round(float(fp.likeness(prints[k][None], e[None])[0]), 9),
                    round(float(fp.likeness(prints[k][None], prints[(k + 1) % n][None])[0]), 9), None if low == math.inf else low))
    return out


def _got(df):
    return [(*r[:5], round(r[5], 9), round(r[6], 9), r[7]) for r in map(tuple, df.collect())]


@pytest.mark.parametrize("small,cell,slice_", [(128, 2048, 1 << 21), (2, 3, 300)])
def test_documents_equal_brute_force(spark, monkeypatch, small, cell, slice_):
    monkeypatch.setattr(fp, "SMALL", small)
    monkeypatch.setattr(fp, "CELL", cell)
    monkeypatch.setattr(fp, "SLICE", slice_)
    rng = random.Random(4)
    rows = list(zip(rng.sample(range(1000), 150), _texts(rng, 150)))
    rows += [(2000, None), (2001, ""), (2002, "é" * 50_000 + " end"), (2003, "same text of five words"), (2004, "same text of five words")]
    rows.sort(key=lambda r: -r[0])
    rows.append((None, "a row without an id"))
    assert sorted(_got(fp.fingerprint_documents(_docs(spark, rows), 12)), key=str) == sorted(_expected(rows, 12), key=str)


def test_repeated_rows_and_single_rows(spark):
    one = [(5, "only one document here")]
    assert _got(fp.fingerprint_documents(_docs(spark, one))) == _expected(one, 12)
    twice = [(7, "some text"), (5, "twice the same row"), (5, "twice the same row")]
    assert sorted(_got(fp.fingerprint_documents(_docs(spark, twice)))) == sorted(_expected(twice, 12))
    empty = fp.fingerprint_documents(_docs(spark, one).limit(0))
    assert empty.count() == 0 and "class_id" in empty.columns


@pytest.mark.parametrize("radius", [3, 12])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, radius):
    """Clusters denser than a bucket's bound, among unlike fingerprints."""
    monkeypatch.setattr(fp, "SMALL", 4)
    monkeypatch.setattr(fp, "CELL", 8)
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2, (12, 256), dtype=np.uint8)
    rows = []
    for k in range(260):
        x = base[k % 4 if k % 3 else k % 12].copy()
        x[rng.choice(256, rng.integers(0, radius + 3), replace=False)] ^= 1
        rows.append(x)
    numbers = np.unique(np.packbits(np.array(rows), axis=1, bitorder="little").view(np.uint64), axis=0)
    raw = fp._binary(numbers)
    prints = spark.createDataFrame([(k, bytearray(x)) for k, x in enumerate(raw)], "doc_id long, fp binary")
    got = {bytes(r["fp"]): r["class_id"] for r in fp.classes(prints, Scratch(spark, "t"), radius).collect()}
    near = np.bitwise_count(numbers[:, None] ^ numbers[None]).sum(axis=2) <= radius
    label = np.arange(len(raw))
    while True:
        new = np.where(near, label[None], len(raw)).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert [got[x] for x in raw] == label.tolist()
    assert near.sum() > len(raw)


def test_tables_grow_with_the_number_of_fingerprints():
    sizes = [len(fp.tables(n, 12)) for n in (10, 10**5, 10**8, 10**10)]
    assert sizes[0] == 13 and sizes == sorted(sizes) and sizes[-1] > 13


def test_edited():
    assert fp.edited("abcdefg", "xyz") == "abcdexy" and fp.edited("abcdefghi", "x") == "abcdefx" and fp.edited("", "x") == ""
