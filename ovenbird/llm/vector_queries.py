"""Registered queries over ``embeddings`` and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import centroids, negatives
from .common import read

_WHOLE = """embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _integers(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


def _op11_sql(k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3, dims: int = 64) -> str:
    """Rounds as one CTE each: all distances, the nearest centroid, new means."""
    apart = "list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [f"""q AS MATERIALIZED (SELECT vec_id, {_integers(scale)} AS v FROM embeddings WHERE len(embedding) = {dims} AND {_WHOLE})""",
             f"""c0 AS MATERIALIZED (SELECT c, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c
  FROM q) WHERE c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, v, c, distance FROM (
  SELECT vec_id, v, c, distance, row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) AS place
  FROM (SELECT q.vec_id, q.v, c.c, CAST({apart} AS BIGINT) AS distance FROM q CROSS JOIN c{i} c)) WHERE place = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM (
    SELECT c, place, sum(x) AS s, count(*) AS n
    FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY c, place) GROUP BY c) m ON m.c = c{i}.c)""")
    return f"""WITH {', '.join(steps)}
SELECT a.vec_id, CAST(a.c AS INT) AS cluster, a.distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""


def op11_centroids(spark, sf_dir):
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


OP13_SQL = f"""
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_integers(256)} AS v
  FROM embeddings WHERE label IS NOT NULL AND {_WHOLE}
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INT) AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""


def op13_hard_negatives(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved))


REGISTRY = {"op11_centroids": op11_centroids, "op13_hard_negatives": op13_hard_negatives}
ORACLE = {"op11_centroids": _op11_sql(), "op13_hard_negatives": OP13_SQL}
