"""Embedding collections: metadata filters, counts, exact k-NN, populate.

* Constraints ``{column: {"in": [...]} | {"range": {"gte":, "lte":}} |
  {"contains": [...]}}`` fold into one ``Column`` predicate that Catalyst
  pushes into the Parquet scan; unknown columns are ignored; a scalar ``in``
  means equality; a scalar ``range`` means equality.
* k-NN is exact: cosine distance per row (JVM higher-order functions), then
  ``orderBy(dist).limit(k)`` which plans as a per-partition top-k merged on
  the driver side of the exchange (TakeOrderedAndProject) — no global sort.
* Per-collection best uses the salted two-phase top-k, so a collection
  holding a third of all vectors is still ranked by many tasks.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators.fingerprint import top_k


def one_of(v) -> list:
    return list(v) if isinstance(v, (list, tuple, set)) else [v]


def column_constraint(c: Column, spec: dict, *, ignore_case: bool = False) -> Column:
    """B1 / B2: one column's rule, all of whose parts must hold; null values never fit one.

    ``in``: one of a list, or equal to a scalar; an empty list is no rule.
    ``range``: ``gte``, ``gt``, ``lte``, ``lt`` (null bounds are none), or a
    scalar for equality. ``contains``: a text that holds any of a list, or a
    scalar.
    """
    preds = []
    if "in" in spec and (values := one_of(spec["in"])):
        preds.append(c.isin(values))
    if "range" in spec:
        bounds = spec["range"] if isinstance(spec["range"], dict) else {"gte": spec["range"], "lte": spec["range"]}
        ops = {"gte": Column.__ge__, "gt": Column.__gt__, "lte": Column.__le__, "lt": Column.__lt__}
        preds += [op(c, F.lit(bounds[k])) for k, op in ops.items() if bounds.get(k) is not None]
    if "contains" in spec and (values := one_of(spec["contains"])):
        text = F.lower(c.cast("string")) if ignore_case else c.cast("string")
        preds.append(reduce(lambda a, b: a | b, [F.contains(text, F.lit(str(v).lower() if ignore_case else str(v))) for v in values]))
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def constraint_predicate(df: DataFrame, constraints: dict) -> Column:
    """AND across fields, OR within a field's values; columns that aren't there are ignored."""
    return reduce(lambda a, b: a & b, [column_constraint(F.col(c), spec) for c, spec in constraints.items()
                                       if c in df.columns and isinstance(spec, dict)], F.lit(True))


#: What an intent names, and the column and form of constraint that it becomes.
INTENT_FIELDS = {"perils": ("peril", "in"), "countries": ("country", "in"), "regions": ("path", "contains"), "date_from": ("date", "gte"), "date_to": ("date", "lte")}


def intent_constraints(intent: dict, fields: dict[str, tuple[str, str]] = INTENT_FIELDS) -> dict:
    """An intent's entries as constraints; empty and unknown ones constrain nothing."""
    out: dict[str, dict] = {}
    for name, (column, form) in fields.items():
        value = intent.get(name)
        if value is None or value == "" or value == []:
            continue
        if form in ("gte", "gt", "lte", "lt"):
            out.setdefault(column, {}).setdefault("range", {})[form] = value
        else:
            out.setdefault(column, {})[form] = one_of(value)
    return out


def query(df: DataFrame, constraints: dict, key: str, vector: str = "embedding",
          limit: int | None = None) -> DataFrame:
    """B1 + B3: filtered rows without the vector column; limit only if set."""
    out = df.filter(constraint_predicate(df, constraints)).drop(vector)
    return out.limit(limit) if limit else out


def union_of(df: DataFrame, constraint_sets: list[dict], key: str) -> DataFrame:
    """OR across constraint sets = distinct union of their results."""
    parts = [df.filter(constraint_predicate(df, c)) for c in constraint_sets]
    return reduce(lambda a, b: a.unionByName(b), parts).dropDuplicates([key])


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos(a, b) over double arrays (JVM higher-order functions); null for a zero vector."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    na = F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    nb = F.sqrt(F.aggregate(F.transform(b, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    return F.lit(1.0) - F.try_divide(dot, na * nb)


def centroid(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Mean vector (one row, bounded by the dimension)."""
    d = df.select(F.posexplode(F.col(vector).cast("array<double>")).alias("i", "v"))
    g = d.groupBy("i").agg((F.sum("v") / F.count(F.lit(1))).alias("m"))
    return g.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("q"))


def with_distance(df: DataFrame, qvec: DataFrame, vector: str = "embedding") -> DataFrame:
    """Attach ``dist`` to a single query vector (``qvec`` has exactly one row,
    column ``q``); the one-row side is broadcast, its size is fixed."""
    j = df.join(F.broadcast(qvec), how="inner", on=F.lit(True))
    return j.withColumn("dist", cosine_distance(F.col(vector).cast("array<double>"), F.col("q"))).drop("q")


def knn(df: DataFrame, qvec: DataFrame, k: int, key: str, vector: str = "embedding") -> DataFrame:
    """Exact k nearest (ties by key)."""
    d = with_distance(df, qvec, vector).drop(vector)
    return d.orderBy("dist", key).limit(k)


def best_per(df: DataFrame, qvec: DataFrame, group: str, k: int, key: str,
             vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest per collection (the signature's ``limit_per``)."""
    d = with_distance(df, qvec, vector).drop(vector)
    return top_k(d, group, [F.col("dist"), F.col(key)], k, salt_on=key)


def hashed_vectors(df: DataFrame, key: str, text: Column, dim: int = 64) -> DataFrame:
    """P4, without a model: signed word counts in ``dim`` hashed places, ``(key, embedding)``.

    A word's place is its crc32 modulo ``dim``, its sign a bit of the crc32;
    a null or empty text has the zero vector. The places of a batch of rows
    are counted at once, so the work is by word, not by word and place.
    """

    @F.arrow_udf("array<double>")
    def counted(crcs: pa.Array) -> pa.Array:
        flat = crcs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(crcs)), pc.list_value_length(crcs).to_numpy(zero_copy_only=False))
        sums = np.bincount(row * dim + flat % dim, np.where(flat >> 16 & 1, 1.0, -1.0), len(crcs) * dim)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(crcs) + 1) * dim, pa.int32()), pa.array(sums, pa.float64()))

    crcs = F.transform(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != ""), lambda w: F.crc32(w.cast("binary")))
    return df.select(F.col(key).alias("key"), counted(crcs).alias("embedding"))
