"""Shredding nested API specifications into six relational tables (K1–K7).

Input: a table of spec versions with ``provider, api_name, sys_from, sys_to``
and the document as JSON text.  Every level is an ``explode`` of an ordered
``map<string,string>`` (document order kept, nested values stay JSON text),
so the work is row-local: no shuffle, no driver round trip, and parent keys
are carried as natural keys instead of being looked up (J1).

Rules kept:
* path keys starting with ``x-`` and non-object path items are skipped;
* the eight HTTP methods only, object values only; ``deprecated`` defaults to
  false; tags stay JSON text;
* parameters: path-level first, then operation-level; the first
  ``(name, in)`` pair wins (so path-level wins); missing name -> ``''``,
  missing ``in`` -> ``query``, missing ``required`` -> false;
* responses: status as text; the first media type in document order gives
  ``media_type`` and the schema, else the Swagger-2 ``schema``;
* component schemas: ``components.schemas`` when non-empty, else
  ``definitions``; objects only;
* paths longer than 500 characters are exposed truncated in ``path_trunc``
  while keys use the full path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.jsonx import ARR, OBJ, is_object
from vellum.operators.sequence import neighbours
from vellum.operators.temporal import dedupe_last

HTTP_METHODS = ["get", "put", "post", "delete", "options", "head", "patch", "trace"]
SPEC_KEY = ["provider", "api_name", "sys_from"]


def specs(docs: DataFrame, doc: str = "doc", source_url: str | None = None) -> DataFrame:
    """K1: one row per parsable spec version."""
    d = docs.filter(is_object(doc))
    info = F.get_json_object(F.col(doc), "$.info")
    out = d.select(*SPEC_KEY, "sys_to",
                   F.get_json_object(info, "$.title").alias("title"),
                   F.get_json_object(info, "$.version").alias("spec_version"),
                   F.get_json_object(info, "$.description").alias("description"),
                   F.coalesce(F.get_json_object(F.col(doc), "$.openapi"),
                              F.get_json_object(F.col(doc), "$.swagger")).alias("openapi_version"),
                   *([F.col(source_url).alias("source_url")] if source_url else []))
    return out


def paths(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """K2 + K7: path rows; keeps the path item JSON for the next level."""
    d = docs.filter(is_object(doc)).select(
        *SPEC_KEY, F.explode(F.from_json(F.get_json_object(F.col(doc), "$.paths"), OBJ)).alias("path", "item"))
    d = d.filter(~F.col("path").startswith("x-") & is_object("item"))
    return d.select(*SPEC_KEY, "path", F.substring("path", 1, 500).alias("path_trunc"),
                    F.get_json_object("item", "$.summary").alias("summary"),
                    F.get_json_object("item", "$.description").alias("description"),
                    "item")


def operations(path_rows: DataFrame) -> DataFrame:
    """K3: operation rows (method in the eight HTTP methods, object value)."""
    ops = path_rows.select(*SPEC_KEY, "path", "item",
                           F.explode(F.from_json("item", OBJ)).alias("method", "op"))
    ops = ops.filter(F.col("method").isin(HTTP_METHODS) & is_object("op"))
    return ops.select(*SPEC_KEY, "path", "method",
                      F.get_json_object("op", "$.operationId").alias("operation_name"),
                      F.get_json_object("op", "$.summary").alias("summary"),
                      F.get_json_object("op", "$.description").alias("description"),
                      F.coalesce(F.get_json_object("op", "$.deprecated").try_cast("boolean"),
                                 F.lit(False)).alias("deprecated"),
                      F.get_json_object("op", "$.tags").alias("tags"),
                      "item", "op")


def parameters(op_rows: DataFrame) -> DataFrame:
    """K4: parameters with first-(name, in)-wins de-duplication done inside the
    row (array functions), so no shuffle is needed."""
    allp = F.concat(F.coalesce(F.from_json(F.get_json_object("item", "$.parameters"), ARR), F.array().cast(ARR)),
                    F.coalesce(F.from_json(F.get_json_object("op", "$.parameters"), ARR), F.array().cast(ARR)))
    tagged = F.transform(
        F.filter(allp, lambda p: F.ltrim(p).startswith("{")),
        lambda p: F.struct(F.get_json_object(p, "$.name").alias("n"),
                           F.get_json_object(p, "$.in").alias("l"), p.alias("j")))
    # made once, as a column; what a place's key is first found at comes from one list of keys
    op_rows = op_rows.withColumn("_vl_tagged", tagged).withColumn("_vl_keys", F.transform("_vl_tagged", lambda p: F.struct(p["n"], p["l"])))
    first_only = F.filter("_vl_tagged", lambda p, i: F.array_position("_vl_keys", F.struct(p["n"], p["l"])) == i + 1)
    r = op_rows.select(*SPEC_KEY, "path", "method", F.posexplode(first_only).alias("ordinal", "p"))
    j = F.col("p")["j"]
    return r.select(*SPEC_KEY, "path", "method", "ordinal",
                    F.coalesce(F.col("p")["n"], F.lit("")).alias("name"),
                    F.coalesce(F.col("p")["l"], F.lit("query")).alias("location"),
                    F.coalesce(F.get_json_object(j, "$.required").try_cast("boolean"), F.lit(False)).alias("required"),
                    F.get_json_object(j, "$.schema").alias("schema_json"),
                    F.get_json_object(j, "$.description").alias("description"))


def responses(op_rows: DataFrame) -> DataFrame:
    """K5: one row per status code; first media type in document order."""
    r = op_rows.select(*SPEC_KEY, "path", "method",
                       F.explode(F.from_json(F.get_json_object("op", "$.responses"), OBJ)).alias("status_code", "resp"))
    r = r.filter(is_object("resp"))
    first_mt = F.element_at(F.map_entries(F.from_json(F.get_json_object("resp", "$.content"), OBJ)), 1)
    mt_schema = F.when(is_object(first_mt["value"]), F.get_json_object(first_mt["value"], "$.schema"))
    return r.select(*SPEC_KEY, "path", "method", "status_code",
                    F.get_json_object("resp", "$.description").alias("description"),
                    first_mt["key"].alias("media_type"),
                    F.coalesce(mt_schema, F.get_json_object("resp", "$.schema")).alias("schema_json"))


def schemas(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """K6: component schemas, falling back to Swagger-2 definitions."""
    comp = F.from_json(F.get_json_object(F.col(doc), "$.components.schemas"), OBJ)
    defs = F.from_json(F.get_json_object(F.col(doc), "$.definitions"), OBJ)
    chosen = F.when(F.size(comp) > 0, comp).otherwise(defs)
    d = docs.filter(is_object(doc)).select(*SPEC_KEY, F.explode(chosen).alias("schema_name", "schema_json"))
    d = d.filter(is_object("schema_json"))
    return d.select(*SPEC_KEY, "schema_name", "schema_json",
                    F.get_json_object("schema_json", "$.description").alias("description"))


def version_chain(events: DataFrame) -> DataFrame:
    """Spec events ``(provider, api_name, commit_ts, file_path, ...)`` with ``sys_to``, the time of the next one.

    Of several files of one spec at one time the last by its path counts, so
    no version has zero length. Only events are exchanged, not documents.
    """
    key = ["provider", "api_name"]
    last = dedupe_last(events, [*key, "commit_ts"], ["file_path"])
    return neighbours(last, key, ["commit_ts"], ["commit_ts"], prev=False).withColumnRenamed("next_commit_ts", "sys_to")


def path_identity(file_path) -> tuple:
    """A2: ``APIs/p/v/spec`` -> (p, p); ``APIs/p/s/v/spec`` -> (p, s); else NULLs."""
    parts = F.split(file_path, "/")
    n = F.size(parts)
    ok = parts[0] == "APIs"
    provider = F.when(ok & n.isin(4, 5), parts[1])
    api = F.when(ok & (n == 4), parts[1]).when(ok & (n == 5), parts[2])
    return provider, api


def metadata_regex(text) -> list:
    """Title / version / openapi-or-swagger from raw text (no parse)."""
    from vellum.functions.text import strip_outer_quotes

    def grab(p):
        v = F.trim(F.regexp_extract(text, p, 1))
        return F.when(v != "", strip_outer_quotes(v))

    return [grab(r"(?m)^\s+title:\s*(.+)").alias("title"),
            grab(r"(?m)^\s+version:\s*(.+)").alias("spec_version"),
            F.coalesce(grab(r"(?m)^openapi:\s*(.+)"), grab(r"(?m)^swagger:\s*(.+)")).alias("openapi_version")]
