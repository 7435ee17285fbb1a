"""Path steps over JSON held as VARIANT: each step is a row of a plan, applied to all rows at once.

A plan is a list of steps, not a text, so nothing is parsed. A value that a
step doesn't fit (a field of an array, the values of a number), and null, yield
no row, as a projection skips them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """The value under a name."""

    name: str


@dataclass(frozen=True)
class Index:
    """An element by place, from 0."""

    at: int


@dataclass(frozen=True)
class Values:
    """Wildcard: every value of an object, in the order of its names."""


@dataclass(frozen=True)
class Flatten:
    """Every element of an array; of elements that are arrays, theirs."""


@dataclass(frozen=True)
class Where:
    """Rows whose value under ``name`` compares so with a number or text: ``==``, ``!=``, ``<``, ``<=``, ``>`` or ``>=``."""

    name: str
    op: str
    value: object


@dataclass(frozen=True)
class Pick:
    """Multi-select: an object of the values under ``names[alias]``, null where there is none. Last step only."""

    names: Mapping[str, str]


OPS = {"==": Column.__eq__, "!=": Column.__ne__, "<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def name_path(name: str) -> str:
    """The path of a field; names that no form of path can say (both quotes, or ``?``, with a dot or bracket) are an error."""
    for quote in "'\"":
        if name and quote not in name and "?" not in name:
            return f"$[{quote}{name}{quote}]"
    if name and "." not in name and "[" not in name:
        return f"$.{name}"
    raise ValueError(f"no path says the name {name!r}")


def apply_steps(df: DataFrame, value: str, steps: Sequence, out: str = "value") -> DataFrame:
    """``df`` without ``value``, with ``out`` (variant, or a struct of texts after ``Pick``) and ``place``, the way to it in order.

    ``value`` is JSON text or a variant; null and text that isn't JSON yield
    no rows. Rows of one input row are in the order of ``place``, an array.

    A text is parsed once: its value comes out of a generator, below which no
    filter is pushed. Fields and indexes only lengthen the path that the next
    other step reads, so nothing between is built.
    """
    text = dict(df.dtypes)[value] == "string"
    names = [c for c in df.columns if c != value]
    parsed = F.try_parse_json(F.col(value)) if text else F.col(value)
    own = df.select(*names, F.array().cast("array<int>").alias("_vl_place"), F.explode(F.array(parsed)).alias("_vl_v"))
    path = "$"
    at = lambda kind, more="": F.try_variant_get("_vl_v", path + more, kind)
    picked = None
    for step in steps:
        if picked is not None:
            raise ValueError("Pick is the last step")
        if isinstance(step, Field):
            path += name_path(step.name)[1:]
        elif isinstance(step, Index):
            path += f"[{step.at}]"
        elif isinstance(step, Values):
            rows = own.select(*names, "_vl_place", F.posexplode(at("map<string,variant>")).alias("_vl_at", "_vl_key", "_vl_v"))
            own, path = rows.select(*names, F.array_append("_vl_place", F.col("_vl_at")).alias("_vl_place"), "_vl_v"), "$"
        elif isinstance(step, Flatten):
            rows, path = own.select(*names, "_vl_place", F.posexplode(at("array<variant>")).alias("_vl_at", "_vl_v")), "$"
            listed = at("array<variant>")
            rows = rows.select(*names, F.array_append("_vl_place", F.col("_vl_at")).alias("_vl_place"), listed.isNotNull().alias("_vl_list"),
                               F.posexplode(F.coalesce(listed, F.array("_vl_v"))).alias("_vl_at", "_vl_v"))
            own = rows.select(*names, F.when(F.col("_vl_list"), F.array_append("_vl_place", F.col("_vl_at"))).otherwise(F.col("_vl_place")).alias("_vl_place"), "_vl_v")
        elif isinstance(step, Where):
            kind = "string" if isinstance(step.value, str) else "double"
            own = own.filter(F.coalesce(OPS[step.op](at(kind, name_path(step.name)[1:]), F.lit(step.value)), F.lit(False)))
        else:
            picked = F.struct(*[at("string", name_path(name)[1:]).alias(alias) for alias, name in step.names.items()])
    whole = F.col("_vl_v") if path == "$" else at("variant")
    own = own.filter(whole.isNotNull() & ~F.is_variant_null(whole))
    return own.select(*names, (picked if picked is not None else whole).alias(out), F.col("_vl_place").alias("place"))
