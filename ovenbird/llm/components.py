"""Connected components of links between numbered nodes, on the executors.

Alternating large-star and small-star steps: every node hangs its neighbours on
the smallest node it knows, until the links are stars.  Neighbour lists are
never collected; a node with very many links is a join on a key whose large
side Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, few


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """links: columns a, b (any order, no nulls).  Rows (node, root): every
    node that has a link and the smallest node of its component."""
    now = scratch.put(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), f"{name}-0")
    state, turn = _state(now), 0
    while state[0]:
        turn += 1
        rows = 2 * state[0]  # no step makes more
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.put(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), f"{name}-l{turn}", rows)
        hung = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.put(few(hung, rows).distinct(), f"{name}-h{turn}", rows)
        lower = scratch.put(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-s{turn}", rows)
        hung = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        hung = few(hung, rows).unionByName(lower.select("a", F.col("m").alias("b")))
        new = scratch.put(hung.distinct(), f"{name}-{turn}", rows)
        before, state = state, _state(new)
        for x in (f"{name}-{turn - 1}", f"{name}-l{turn}", f"{name}-h{turn}", f"{name}-s{turn}"):
            scratch.drop(x)
        now = new
        if state == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
