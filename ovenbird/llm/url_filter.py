"""URL filters: longest match of allow and block rules.

Rules live in a trie: first the labels of the host from the last to the first,
then the segments of the path.  A rule's last path segment may be the beginning
of a url's segment (its path is a prefix of the url's path), so it is kept at
its node as a prefix.  A url walks down the trie once; the deepest host wins,
below it the longest path; of one (host, path) given twice, block wins.

The trie is broadcast.  Rule lists are cut into blocks of ``BLOCK_RULES``
rules, each a trie of bounded size, and the longest match over all blocks is
taken, so any number of rules is applied whole.

Defined results: a null url, or one without ``://``, has an empty host and
path, which no rule fits; an empty table gives no rows; repeated rows are
judged each; other columns are not read.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column

BLOCK_RULES = 200_000
#: A host or path longer than this cannot be a rule (bounds a block's bytes).
RULE_CHARS = 512
HOST = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: (verdict, host, path)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

RESULT = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()),
    T.StructField("depth", T.IntegerType()), T.StructField("length", T.IntegerType())])


def split_url(url: str | None) -> tuple[str, str]:
    m = HOST.search(url) if url is not None else None
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def build_trie(rules) -> dict:
    """Node of the host trie: label -> node; ``None`` -> root of a path trie.
    Node of a path trie: segment -> node; ``None`` -> {prefix: (verdict, rule)}."""
    root: dict = {}
    for verdict, host, path in rules:
        if len(host) > RULE_CHARS or len(path) > RULE_CHARS:
            raise ValueError(f"rule too long: {host[:40]}...")
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(None, {})
        *full, last = path.split("/")
        for segment in full:
            node = node.setdefault(segment, {})
        kept = node.setdefault(None, {})
        if kept.get(last, ("",))[0] != "block":
            kept[last] = (verdict, host + path)
    return root


def _path_match(node: dict, path: str):
    found = None
    for segment in path.split("/"):
        ends = node.get(None)
        if ends:
            for k in range(min(len(segment), RULE_CHARS), -1, -1):
                hit = ends.get(segment[:k])
                if hit:
                    found = hit
                    break
        node = node.get(segment)
        if node is None:
            break
    return found


def longest_match(trie: dict, host: str, path: str):
    """(host labels, verdict, rule) of the rule that wins, or None."""
    found, node = None, trie
    for depth, label in enumerate(reversed(host.split(".")), 1):
        node = node.get(label)
        if node is None:
            break
        hit = _path_match(node[None], path) if None in node else None
        if hit:
            found = (depth, *hit)
    return found


def _judge(shared):
    """The lookup in one broadcast trie, as a column function of the url."""
    @F.pandas_udf(RESULT)
    def judge(urls: pd.Series) -> pd.DataFrame:
        trie, rows = shared.value, []
        for u in urls:
            host, path = split_url(u)
            hit = longest_match(trie, host, path)
            rows.append((host, path, hit[2], hit[1], hit[0], len(hit[2])) if hit else
                        (host, path, None, None, 0, 0))
        return pd.DataFrame(rows, columns=RESULT.names)
    return judge


def judge_urls(pages: DataFrame, rules=None, default: str = "allow", key: str = "page_id",
               url: str = "url") -> DataFrame:
    """Host, path, winning rule (null if none) and verdict of every url."""
    rules = RULES if rules is None else list(rules)
    sc = pages.sparkSession.sparkContext
    blocks = [rules[i:i + BLOCK_RULES] for i in range(0, len(rules), BLOCK_RULES)] or [[]]
    out = pages.select(column(pages, key).alias(key), column(pages, url).alias("url"))
    best = None
    for block in blocks:
        shared = sc.broadcast(build_trie(block))

        one = _judge(shared)("url")
        # Deeper host first, then the longer rule, then block before allow.
        best = one if best is None else F.when(
            F.struct(one["depth"], one["length"], one["verdict"])
            > F.struct(best["depth"], best["length"], best["verdict"]), one).otherwise(best)
    judged = out.select(key, best.alias("r"))
    return judged.select(key, "r.host", "r.path", "r.rule",
                         F.coalesce("r.verdict", F.lit(default)).alias("verdict"))
