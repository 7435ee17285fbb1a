"""Embedding collections: declared schemas, import into the unified layout, typed property filters."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.embeddings import column_constraint

#: Declared type names; a name that isn't here is text.
TYPES = {"String": T.StringType(), "Text": T.StringType(), "Integer": T.IntegerType(), "Float": T.DoubleType(),
         "REAL[]": T.ArrayType(T.FloatType())}


@dataclass(frozen=True)
class Collection:
    """A collection as declared: where its key, label and vector are, and its columns' types."""
    name: str
    key: str
    label: str
    vector: str
    model: str
    columns: dict[str, str] = field(default_factory=dict)


class Registry:
    """Collections by name; a later one of the same name replaces the earlier."""

    def __init__(self, collections: Iterable[Collection] = ()):
        self.by_name: dict[str, Collection] = {}
        for c in collections:
            self.register(c)

    def register(self, c: Collection) -> None:
        self.by_name[c.name] = c

    def get(self, name: str) -> Collection:
        if name not in self.by_name:
            raise KeyError(f"unknown collection {name!r}; available: {', '.join(sorted(self.by_name))}")
        return self.by_name[name]


def column_type(spec: str) -> T.DataType:
    """``String(200)``, ``Integer``, ... -> Spark type."""
    return TYPES.get(spec.split("(", 1)[0].strip(), T.StringType())


def collection_schema(c: Collection) -> T.StructType:
    """Key, label if it is another column, the other declared columns, the vector last."""
    names = list(dict.fromkeys([c.key, c.label, *(x for x in c.columns if x != c.vector)]))
    out = [T.StructField(n, column_type(c.columns.get(n, "Text")), n != c.key) for n in names]
    return T.StructType([*out, T.StructField(c.vector, T.ArrayType(T.FloatType()))])


def check_columns(df: DataFrame, c: Collection) -> None:
    """Fail with the names of the declared columns that the source lacks."""
    missing = [f.name for f in collection_schema(c) if f.name not in df.columns]
    if missing:
        raise ValueError(f"collection {c.name!r}: source lacks {', '.join(missing)}")


def unify(df: DataFrame, c: Collection) -> DataFrame:
    """P5: ``(collection, key, label, model, properties, vector)``; null properties are left out."""
    check_columns(df, c)
    schema = collection_schema(c)
    typed = df.select(*[F.col(f.name).try_cast(f.dataType) if not isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast(f.dataType).alias(f.name)
                        for f in schema])
    own = [f.name for f in schema if f.name not in (c.key, c.label, c.vector)]
    props = F.create_map(*[x for n in own for x in (F.lit(n), F.col(n).cast("string"))]) if own else F.create_map().cast("map<string,string>")
    return typed.select(F.lit(c.name).alias("collection"), F.col(c.key).cast("string").alias("key"), F.col(c.label).cast("string").alias("label"),
                        F.lit(c.model).alias("model"), F.map_filter(props, lambda _k, v: v.isNotNull()).alias("properties"), F.col(c.vector).alias("vector"))


def union_collections(parts: Iterable[DataFrame]) -> DataFrame:
    """All collections as one table, by column name."""
    first, *rest = parts
    for p in rest:
        first = first.unionByName(p)
    return first


def property_predicate(c: Collection, constraints: dict[str, dict]) -> Column:
    """B1 + B2 + B5: a predicate over ``properties``, by each column's declared type.

    Forms as in :func:`vellum.operators.embeddings.column_constraint`,
    ``contains`` without case; columns that the collection does not declare
    are ignored.
    """
    p = F.lit(True)
    for name, rule in constraints.items():
        if name in c.columns:
            p = p & column_constraint(F.col("properties")[name].try_cast(column_type(c.columns[name])), rule, ignore_case=True)
    return p


def replace_partitions(df: DataFrame, path: str) -> None:
    """Write the ``(collection, model)`` partitions of ``df`` in place of what they held; others stay.

    Running it again with the same rows leaves the same table.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("collection", "model").parquet(path)
