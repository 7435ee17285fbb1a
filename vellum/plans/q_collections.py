"""Declared embedding collections over ``embeddings``: two of them, with typed properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import collections as C
from vellum.plans.registry import query

REGISTRY = C.Registry([
    C.Collection("even", "vec_id", "title", "embedding", "hash-64", {"vec_id": "Integer", "title": "String(80)", "grade": "Integer", "weight": "Float"}),
    C.Collection("odd", "vec_id", "vec_id", "embedding", "hash-64", {"vec_id": "Text", "grade": "Integer"})])


def imported(t):
    """P5 + G2: both collections in the unified layout."""
    e = t.embeddings.withColumn("title", F.concat(F.lit("Group "), F.col("label").cast("string")))
    e = e.withColumn("grade", F.when(F.col("label") % 5 == 0, "none").otherwise(F.col("label").cast("string"))).withColumn("weight", F.col("vec_id") / 4)
    return C.union_collections([C.unify(e.filter("vec_id % 2 = 0"), REGISTRY.get("even")), C.unify(e.filter("vec_id % 2 = 1"), REGISTRY.get("odd"))])


@query("unified_import", oracle="""
SELECT CASE WHEN vec_id % 2 = 0 THEN 'even' ELSE 'odd' END AS collection, CAST(vec_id AS VARCHAR) AS key,
       CASE WHEN vec_id % 2 = 0 THEN 'Group ' || label ELSE CAST(vec_id AS VARCHAR) END AS label, 'hash-64' AS model,
       CASE WHEN label % 5 <> 0 THEN CAST(label AS VARCHAR) END AS grade, CASE WHEN vec_id % 2 = 0 THEN vec_id / 4 END AS weight, len(embedding) AS dim
FROM embeddings""")
def unified_import(t):
    """P1 + P2 + P5 + B16 + B17 + G2: rows cast to their collection's schema; what does not cast is left out."""
    return imported(t).select("collection", "key", "label", "model", F.col("properties")["grade"].alias("grade"),
                              F.col("properties")["weight"].cast("double").alias("weight"), F.size("vector").cast("long").alias("dim"))


FORMS = ({"grade": {"in": 3}}, {"grade": {"range": 7}}, {"grade": {"contains": ["1", "4"]}, "weight": {"range": {"gt": 1, "lte": 300}}}, {"weight": {"in": 2.5}}, {"grade": {"in": []}, "weight": {"range": {"lt": 20}}})


@query("constraint_forms", oracle="""
WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS key, vec_id / 4 AS weight, CASE WHEN label % 5 <> 0 THEN label END AS grade FROM embeddings WHERE vec_id % 2 = 0)
SELECT 0 AS form, key FROM e WHERE grade = 3 UNION ALL SELECT 1, key FROM e WHERE grade = 7
UNION ALL SELECT 2, key FROM e WHERE (contains(grade::VARCHAR, '1') OR contains(grade::VARCHAR, '4')) AND weight > 1 AND weight <= 300
UNION ALL SELECT 3, key FROM e WHERE weight = 2.5 UNION ALL SELECT 4, key FROM e WHERE weight < 20""")
def constraint_forms(t):
    """B2 + B5: scalar and list forms of every rule; an empty list is no rule."""
    c = REGISTRY.get("even")
    rows = imported(t).filter(F.col("collection") == c.name)
    fits = F.array(*[F.when(C.property_predicate(c, f), F.lit(i)) for i, f in enumerate(FORMS)])
    return rows.select(F.explode(F.array_compact(fits)).alias("form"), "key")


@query("property_filter", oracle="""
SELECT CAST(vec_id AS VARCHAR) AS key FROM embeddings
WHERE vec_id % 2 = 0 AND label IN (1, 2, 3) AND vec_id / 4 >= 2.5 AND vec_id / 4 < 900""")
def property_filter(t):
    """B1 + B2 + B5: constraints by the declared types; an undeclared name is ignored."""
    c = REGISTRY.get("even")
    rules = {"grade": {"in": [1, 2, 3]}, "weight": {"range": {"gte": 2.5, "lt": 900}}, "colour": {"in": ["red"]}}
    return imported(t).filter((F.col("collection") == c.name) & C.property_predicate(c, rules)).select("key")
