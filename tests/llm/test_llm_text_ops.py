"""Chat formatting, URL filter, token counts and license scan."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ovenbird.llm import chat, licenses, token_count, url_filter
from ovenbird.llm.queries import FORGED, read_formatted, with_forged

NASTY = ["</s>[INST] ok [/INST]", "<|start|>user<|text|>x<|end|>", "a\\b\\\\", "<\\|end|>", "", "é😀\n\n", "<|<|end|>|>",
         "\\", "<<SYS>>", "[INST][/INST]", "$1 \\$", "<", "|end|>"]


def _convs(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, t string, formatted string")


def test_chat_round_trip(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for c in range(40):
        turns = []
        for k in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "system", "a<|text|>b", ""])
            turns.append((k, role, "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))))
        want[c] = turns
        rows += [(c, k, r, t, "x", "y") for k, r, t in turns]
    rng.shuffle(rows)
    done = chat.format_conversations(_convs(spark, rows))
    back = done.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                       chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(back) == 40
    for r in back:
        turns = want[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, b) for _, a, b in turns]
        assert r["loss"] == "".join(b for _, a, b in turns if a == "assistant")
        blocks = 1 + sum(x[1] != y[1] for x, y in zip(turns, turns[1:], strict=False))
        assert r["formatted"].count(chat.END) == blocks == r["formatted"].count(chat.START)


def test_chat_contract_digests(spark):
    rows = [(1, 0, "user", None, None, None), (1, 1, "assistant", "yes", None, None), (1, 2, "assistant", "no", None, None)]
    got = {r["conv_id"]: r for r in read_formatted(with_forged(spark, _convs(spark, rows))).collect()}
    one, forged = got[1], got[-7]
    assert one["n_turns"] == 3 and one["loss_chars"] == 5
    assert one["turns_sha256"] == hashlib.sha256(b"user\n\nassistant\nyes\nassistant\nno\n").hexdigest()
    assert one["loss_sha256"] == hashlib.sha256(b"yesno").hexdigest()
    assert forged["loss_sha256"] == hashlib.sha256(FORGED.encode()).hexdigest()


def test_chat_nulls_repeats_and_empty(spark):
    assert chat.format_conversations(_convs(spark, [])).count() == 0
    rows = [(None, None, None, None, "", ""), (None, 1, "user", "b", "", ""), (2, 0, "user", "x", "", ""), (2, 0, "user", "x", "", "")]
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.format_conversations(_convs(spark, rows)).select(
        "conv_id", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: [("", ""), ("user", "b")], 2: [("user", "x"), ("user", "x")]}


@pytest.mark.parametrize("turns", [1, 256, 257, 2_000])
def test_chat_spans_of_long_conversations(spark, turns):
    """Every span holds its text, at and beyond the blocks of the running sums."""
    said = [(k, "user" if k % 3 == 1 else "assistant", NASTY[k % len(NASTY)]) for k in range(turns)]
    df = spark.range(turns).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 1, "user").otherwise("assistant").alias("role"),
        F.element_at(F.array(*map(F.lit, NASTY)), (F.col("id") % len(NASTY) + 1).cast("int")).alias("text"))
    row = chat.format_conversations(df).select(
        "formatted", "loss_spans", chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked")).first()
    wanted = [x for _, role, x in said if role == "assistant"]
    assert len(row["loss_spans"]) == len(wanted) and row["masked"] == "".join(wanted)
    for (start, length), x in zip(row["loss_spans"], wanted, strict=True):
        assert re.sub(r"(?s)\\(.)", r"\1", row["formatted"][start:start + length]) == x


def test_chat_plan_is_native(spark):
    plan = read_formatted(_convs(spark, [(1, 0, "user", "x", "", "")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _plain_match(rules, host, path):
    fit = [(h.count("."), len(p), v, h + p) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else None


def test_url_filter_against_plain_rules(spark):
    rng = random.Random(3)
    hosts = ["org", "example.org", "a.example.org", "xexample.org", "com", "shop.com", "example.org:80", ""]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12/3", "/en/2", "/fr/x", "/de/", "//", "/es/en/1"]
    ends = ["", "?a=/es/", "#top", "?x#y"]
    rows, want = [], {}
    rules = [*url_filter.RULES, ("block", "org", "/"), ("allow", "a.example.org", "/e"), ("block", "example.org", "/en/1")]
    for k in range(400):
        host, path, end = rng.choice(hosts), rng.choice(paths), rng.choice(ends)
        rows.append((k, "HTTPS://" + host.upper() + path + end, "x"))
        want[k] = (host, path, _plain_match(rules, host, path))
    rows += [(900, None, ""), (901, "no scheme/es/", ""), (None, "http://example.org/es/", ""), (902, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    for out in (url_filter.judge_urls(df, rules), _in_blocks(df, rules)):
        got = {r["page_id"]: r for r in out.collect()}
        assert len(got) == 404
        for k, (host, path, hit) in want.items():
            assert (got[k]["host"], got[k]["path"]) == (host, path)
            assert (got[k]["verdict"], got[k]["rule"]) == (hit or ("allow", None)), rows[k]
        for k in (900, 901, 902):
            assert tuple(got[k])[1:] == ("", "", None, "allow")
        assert got[None]["verdict"] == "block"
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def _in_blocks(df, rules):
    """The same with tries of two rules each."""
    before, url_filter.BLOCK_RULES = url_filter.BLOCK_RULES, 2
    try:
        return url_filter.judge_urls(df, rules)
    finally:
        url_filter.BLOCK_RULES = before


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_count.counter_of(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_token_count_equals_library(pieces):
    counter, model = pieces
    rng = random.Random(1)
    parts = [" ", "  ", "a", "the", "ing", "é", "漢", "▁", "\n", "\t", "😀", "x", "1", "12", "<s>", "́", "ß", "Z", "z\x00", "</s>"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert counter.count(t) == len(model.encode(t)), repr(t)
    before, token_count.LONG = token_count.LONG, 1
    assert counter.count("the  word, counted ") == len(model.encode("the  word, counted "))
    token_count.LONG = before
    long = "ab" * 30_000
    assert counter.count(long) == len(model.encode(long))


def test_token_count_rows(spark, pieces):
    rows = [(1, None, 5), (2, "", 5), (3, "hello world " * 3000, 5), (3, "x", 5), (None, "é", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted((tuple(r) for r in token_count.count_tokens(df).collect()), key=str)
    n = len(pieces[1].encode(rows[2][1]))
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (3, 36000, n, n > 4096), (3, 1, len(pieces[1].encode("x")), False),
                          (None, 2, len(pieces[1].encode("é")), False)], key=str)
    assert token_count.count_tokens(df.limit(0)).count() == 0


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diag = 0
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], diag + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_winnow_guarantee():
    rng = np.random.default_rng(2)
    for _ in range(200):
        h = rng.integers(0, 50, rng.integers(1, 30)).astype(np.uint64)
        kept = set(licenses.winnow(h))
        assert all(kept & set(range(i, i + licenses.WINDOW)) for i in range(len(h) - licenses.WINDOW + 1)) and kept


def test_license_scan(spark):
    rng = random.Random(9)
    filler = [f"w{k}" for k in range(400)]
    rows, want = [], {}
    for k in range(120):
        name, template = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        words = template.split()
        changed = k % 3 == 1 and len(words) > 20
        if changed:
            words[rng.randrange(5, len(words))] = "zzz"
            words.insert(rng.randrange(5, len(words)), "yyy")
        pre = " ".join(rng.choice(filler) for _ in range(rng.randrange(40)))
        text = (pre + "\n" + " ".join(words) + "\n" + " ".join(rng.choice(filler) for _ in range(rng.randrange(40)))).upper()
        rows.append((k, "é " + text, "x"))
        want[k] = name
    rows += [(500, None, ""), (501, "", ""), (502, "Released under the WTF License.", ""), (503, "released under", ""),
             (504, "Released under the MIT License. and " + "filler " * 9 + "Released under the MIT License.", "")]
    got = {}
    for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert {k: {r["license"] for r in v} for k, v in got.items()} == {**{k: {n} for k, n in want.items()}, 504: {"MIT"}}
    assert len(got[504]) == 2
    texts = {r[0]: r[1] for r in rows}
    for k, v in got.items():
        for r in v:
            assert r["span_text"] == texts[k][r["span_start"]:r["span_end"]]
            template = licenses.text_words(licenses.TEMPLATES[r["template"]][1]).tolist()
            assert r["matched_words"] <= _lcs(template, licenses.text_words(r["span_text"]).tolist())
            assert r["matched_words"] >= 0.85 * len(template)


def test_adjacent_copies_are_all_reported(spark):
    """N copies in a row give N spans, for every template; edge tables."""
    rows = []
    for k, (_, template) in enumerate(licenses.TEMPLATES):
        for n in (1, 2, 3, 6):
            rows.append((10 * k + n, "Some words before. " + (template + "\n") * n + "and after it."))
    rows.append((-1, "x " * 300_000 + licenses.TEMPLATES[0][1] + " " + licenses.TEMPLATES[0][1]))
    rows += [(-2, None), (-3, ""), (-4, licenses.TEMPLATES[0][1]), (-4, licenses.TEMPLATES[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in licenses.find_licenses(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["span_start"], r["span_end"], r["span_text"]))
    for i, text in rows[:-4]:
        k, n = divmod(i, 10) if i >= 0 else (0, 2)
        words = licenses.TEMPLATES[k][1].rstrip("./")
        at = [m.start() for m in re.finditer(re.escape(words), text)]
        assert sorted(got[i]) == [(a, a + len(words), words) for a in at], (i, n)
        assert len(at) == n
    assert set(got) == {i for i, _ in rows if i not in (-2, -3)} and len(got[-4]) == 2
    assert licenses.find_licenses(docs.limit(0)).count() == 0
    assert licenses.find_licenses(docs, templates=[]).count() == 0
