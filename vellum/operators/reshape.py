"""Adapter-driven reshaping of landed JSON responses into common fact tables.

An adapter is a row of configuration; its column mapping is a small table
``(adapter, target_col, json_path, cast, const)``.  Mappings are turned into
``select`` lists at plan time (they are bounded configuration, never data),
and the per-adapter projections are combined with ``unionByName`` — one scan
of the response table per adapter, all JVM-side.

Two response shapes are supported, matching the two reshaping styles:

* ``records``  — ``row_path`` names an array of objects; each element is a row
  and ``json_path`` is relative to the element (``$.field``);
* ``columnar`` — ``row_path`` names an object of parallel arrays; each
  ``json_path`` names one array, the arrays are zipped (NULL-padded) and each
  position becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.jsonx import ARR


@dataclass(frozen=True)
class Mapping:
    target_col: str
    json_path: str | None = None
    cast: str | None = None
    const: str | None = None


@dataclass(frozen=True)
class Adapter:
    name: str
    shape: str            # "records" | "columnar"
    row_path: str
    columns: tuple[Mapping, ...]


def _value(elem_json, m: Mapping):
    if m.const is not None:
        v = F.lit(m.const)
    else:
        v = F.get_json_object(elem_json, m.json_path)
    return v.try_cast(m.cast) if m.cast else v


def reshape(responses: DataFrame, adapter: Adapter, keep: Iterable[str] = (),
            body: str = "body") -> DataFrame:
    """Apply one adapter to the responses it owns (``responses.adapter``)."""
    keep = list(keep)
    r = responses.filter(F.col("adapter") == adapter.name)
    if adapter.shape == "records":
        rows = r.select(*keep, F.posexplode(F.from_json(F.get_json_object(F.col(body), adapter.row_path), ARR))
                        .alias("_vl_pos", "_vl_elem"))
        out = rows.select(*keep, (F.col("_vl_pos") + 1).alias("row_num"),
                          *[_value(F.col("_vl_elem"), m).alias(m.target_col) for m in adapter.columns])
    elif adapter.shape == "columnar":
        arrays = [m for m in adapter.columns if m.const is None]
        block = F.get_json_object(F.col(body), adapter.row_path)
        zipped = F.arrays_zip(*[F.from_json(F.get_json_object(block, m.json_path), ARR).alias(f"c{i}")
                                for i, m in enumerate(arrays)])
        rows = r.select(*keep, F.posexplode(zipped).alias("_vl_pos", "_vl_z"))
        cols = []
        idx = {m.target_col: i for i, m in enumerate(arrays)}
        for m in adapter.columns:
            if m.const is not None:
                v = F.lit(m.const)
            else:
                # element texts are JSON scalars; strings keep their quotes
                e = F.col("_vl_z")[f"c{idx[m.target_col]}"]
                v = F.when(e.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), e, F.lit("}")), "$.v")) \
                     .otherwise(e)
            cols.append((v.try_cast(m.cast) if m.cast else v).alias(m.target_col))
        out = rows.select(*keep, (F.col("_vl_pos") + 1).alias("row_num"), *cols)
    else:
        raise ValueError(f"unknown shape {adapter.shape!r}")
    return out.withColumn("adapter", F.lit(adapter.name))


def reshape_all(responses: DataFrame, adapters: Iterable[Adapter], keep: Iterable[str] = (),
                body: str = "body") -> DataFrame:
    """B15 + G6: union of every adapter's projection into the common schema."""
    parts = [reshape(responses, a, keep, body) for a in adapters]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def object_rows(body, value_schema: str) -> "F.Column":
    """Object of objects -> rows via ``explode(map<string, struct>)``."""
    return F.explode(F.from_json(body, f"map<string,{value_schema}>"))


def template_fill(template: str, values: dict) -> "F.Column":
    """Fill ``{{ name }}`` placeholders with column values at plan time.

    ``values`` maps placeholder name -> Column; missing values become ''.
    The template is split once on the driver, so each row costs one
    ``concat`` of literals and columns.
    """
    import re

    parts = re.split(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}", template)
    cols = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                cols.append(F.lit(p))
        else:
            v = values.get(p)
            cols.append(F.coalesce(v.cast("string"), F.lit("")) if v is not None else F.lit(""))
    return F.concat(*cols) if cols else F.lit("")


def prompts(params: DataFrame, adapters: DataFrame, on: str = "adapter", template: str = "template", defaults: str = "defaults", values: str = "params") -> DataFrame:
    """Q1 + B13: a prompt per row of ``params``: its adapter's template, filled with the adapter's defaults under the row's own values.

    ``{{ name }}`` (blanks are free) stands for a value; null values and names
    that nobody gives are empty. Rows whose adapter isn't known are left out.
    """
    none = F.create_map().cast("map<string,string>")
    j = params.join(adapters.select(on, template, defaults), on)
    own = F.map_filter(F.coalesce(F.col(values), none), lambda _k, v: v.isNotNull())
    base = F.map_filter(F.coalesce(F.col(defaults), none), lambda k, _v: ~F.map_contains_key(own, k))
    parts = F.split(F.regexp_replace(F.col(template), r"\{\{\s*(\w+)\s*\}\}", "\u0001$1\u0002"), "[\u0001\u0002]")
    filled = lambda m: F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.coalesce(m[p], F.lit(""))).otherwise(p)), "")
    return j.withColumn("used", F.map_concat(base, own)).withColumn("prompt", filled(F.col("used"))).drop(template, defaults)
