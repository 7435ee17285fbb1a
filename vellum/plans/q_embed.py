"""Embedding-collection queries over ``embeddings`` (label = collection)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.operators import embeddings as E
from vellum.operators.reshape import template_fill
from vellum.plans.registry import query

CONSTRAINTS = {"collection": {"in": ["c1", "c3", "c5"]},
               "dim0": {"range": {"gte": -0.05, "lte": 0.2}},
               "unknown_field": {"in": ["ignored"]}}
SETS = [{"collection": {"in": "c2"}}, {"dim0": {"range": {"gte": 0.1}}}]


def unified(t):
    """P5: unified layout (collection, key, label, model, properties, vector)."""
    e = t.embeddings
    return e.select(F.concat(F.lit("c"), F.col("label").cast("string")).alias("collection"),
                    F.col("vec_id").alias("key"), F.lit("hash-64").alias("model"),
                    F.col("embedding")[0].cast("double").alias("dim0"), "embedding")


@query("embedding_filter", oracle="""
SELECT vec_id AS key, 'c' || label AS collection, 'hash-64' AS model, round(CAST(embedding[1] AS DOUBLE), 6) AS dim0
FROM embeddings WHERE label IN (1, 3, 5) AND CAST(embedding[1] AS DOUBLE) >= -0.05
  AND CAST(embedding[1] AS DOUBLE) <= 0.2""")
def embedding_filter(t):
    """B1 + B3 + P6: metadata filter (in / range, unknown keys ignored), no vector."""
    out = E.query(unified(t), CONSTRAINTS, "key")
    return out.withColumn("dim0", F.round("dim0", 6))


@query("embedding_count", oracle="""
SELECT count(*) AS n FROM embeddings WHERE label = 2 OR CAST(embedding[1] AS DOUBLE) >= 0.1""")
def embedding_count(t):
    """B4 + B6: count of the union of two constraint sets (scalar in = equality)."""
    return E.union_of(unified(t), SETS, "key").agg(F.count(F.lit(1)).alias("n"))


@query("unified_stats", oracle="""
SELECT 'c' || label AS collection, 'hash-64' AS model, count(*) AS n FROM embeddings GROUP BY ALL""")
def unified_stats(t):
    """D1 + P9: rows per (collection, model)."""
    return unified(t).groupBy("collection", "model").agg(F.count(F.lit(1)).alias("n"))


_KNN_SQL = """
ev AS (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
q AS (SELECT i, sum(CAST(v AS DOUBLE)) / count(*) AS m FROM ev GROUP BY i),
dots AS (SELECT e.vec_id, e.label, sum(CAST(e.v AS DOUBLE) * q.m) AS dot,
                sqrt(sum(CAST(e.v AS DOUBLE) * CAST(e.v AS DOUBLE))) AS na, sqrt(sum(q.m * q.m)) AS nb
         FROM ev e JOIN q USING (i) GROUP BY ALL),
d AS (SELECT vec_id, label, 1.0 - dot / (na * nb) AS dist FROM dots)
"""


@query("knn_all", oracle=f"""WITH {_KNN_SQL}
SELECT key, collection, dist, rank FROM (
  SELECT vec_id AS key, 'c' || label AS collection, round(dist, 6) AS dist,
         row_number() OVER (ORDER BY dist, vec_id) AS rank FROM d) WHERE rank <= 10""")
def knn_all(t):
    """F2 + P7 + H20: exact 10 nearest vectors to the collection centroid."""
    u = unified(t)
    top = E.knn(u, E.centroid(u), 10, "key")
    return top.select("key", "collection", F.round("dist", 6).alias("dist"),
                      F.row_number().over(Window.orderBy("dist", "key")).alias("rank"))


@query("knn_per_collection", oracle=f"""WITH {_KNN_SQL}
SELECT key, collection, dist, rank FROM (
  SELECT vec_id AS key, 'c' || label AS collection, round(dist, 6) AS dist,
         row_number() OVER (PARTITION BY label ORDER BY dist, vec_id) AS rank FROM d) WHERE rank <= 3""")
def knn_per_collection(t):
    """E9 + P8: the 3 nearest per collection (salted two-phase top-k)."""
    u = unified(t)
    top = E.best_per(u, E.centroid(u), "collection", 3, "key")
    return top.select("key", "collection", F.round("dist", 6).alias("dist"), "rank")


@query("prefilter_knn", oracle=f"""WITH {_KNN_SQL}
SELECT key, collection, dist, rank FROM (
  SELECT d.vec_id AS key, 'c' || d.label AS collection, round(dist, 6) AS dist,
         row_number() OVER (ORDER BY dist, d.vec_id) AS rank
  FROM d JOIN embeddings e USING (vec_id)
  WHERE e.label IN (1, 3, 5) AND CAST(e.embedding[1] AS DOUBLE) BETWEEN -0.05 AND 0.2) WHERE rank <= 10""")
def prefilter_knn(t):
    """P10: constraints shrink the vector set before the exact k-NN
    (centroid of the whole collection as the query vector)."""
    u = unified(t)
    q = E.centroid(u)
    f = u.filter(E.constraint_predicate(u, CONSTRAINTS))
    top = E.knn(f, q, 10, "key")
    return top.select("key", "collection", F.round("dist", 6).alias("dist"),
                      F.row_number().over(Window.orderBy("dist", "key")).alias("rank"))


@query("embedding_text", oracle="""
SELECT p_partkey AS key, p_name || ' (' || p_brand || ') size ' || CAST(p_size AS VARCHAR) || ', ' ||
       lower(p_type) AS text FROM part""")
def embedding_text(t):
    """P3 + B14: render each row's embedding text from the collection template."""
    p = t.part
    txt = template_fill("{{ p_name }} ({{p_brand}}) size {{ p_size }}, {{ kind }}",
                        {"p_name": F.col("p_name"), "p_brand": F.col("p_brand"), "p_size": F.col("p_size"),
                         "kind": F.lower("p_type")})
    return p.select(F.col("p_partkey").alias("key"), txt.alias("text"))


@query("embed_populate", oracle="""
SELECT p_partkey AS key, 64 AS dim, CAST(len(list_filter(string_split(lower(p_name || ' (' || p_brand || ') size ' || p_size), ' '), lambda w: w <> '')) AS BIGINT) % 2 AS parity
FROM part""")
def embed_populate(t):
    """Rendered text to hashed word vectors. Every word adds or takes one, so the components' sum has the parity of the word count."""
    txt = template_fill("{{ p_name }} ({{p_brand}}) size {{ p_size }}",
                        {"p_name": F.col("p_name"), "p_brand": F.col("p_brand"), "p_size": F.col("p_size")})
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.abs(x))
    return E.hashed_vectors(t.part, "p_partkey", txt).select("key", F.size("embedding").alias("dim"), (total.cast("long") % 2).alias("parity"))
