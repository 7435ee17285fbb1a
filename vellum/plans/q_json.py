"""JSON reshaping and spec-shredding queries.

Nested inputs are derived per row from the driver tables (no grouping), so
their size grows with the tables and whole texts are processed:

* ``events.props`` is a JSON object per event;
* every ``documents`` row becomes (a) two landed API responses with the same
  facts in record and columnar shape and (b) an API specification whose
  paths are the document's lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import jsonx as J
from vellum.operators import reshape as R
from vellum.operators import shred as S
from vellum.plans.registry import query

NL = "\n"


# ---------------------------------------------------------------- events.props
@query("json_props_shred", oracle="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props_shred(t):
    """Nested path lookup, null when missing."""
    return t.events.select("event_id", J.path("props", "$.k").cast("long").alias("k"))


@query("map_entries_rows", oracle="""
SELECT event_id, key, json_extract_string(props, '$."' || key || '"') AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def map_entries_rows(t):
    """A11/§1.1: object with dynamic keys -> (key, value) rows."""
    return t.events.select("event_id", F.explode(J.obj("props")).alias("key", "value"))


@query("entries_roundtrip", oracle="""
SELECT event_id, '{"k":' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '}' AS json FROM events""")
def entries_roundtrip(t):
    """H12 to_entries / from_entries round trip re-serialised compactly."""
    m = F.from_json("props", "map<string,bigint>")
    return t.events.select("event_id", F.to_json(J.from_entries(J.to_entries(m))).alias("json"))


# ------------------------------------------------------------ documents lines
_LINES_SQL = """
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no
  FROM documents)
"""


@query("zip_arrays_rows", oracle=f"""WITH {_LINES_SQL}
SELECT doc_id, line_no, length(line) AS line_chars FROM lines""")
def zip_arrays_rows(t):
    """H12 zip_arrays + inline: parallel arrays -> rows."""
    lines = F.split("text", NL)
    nums = F.sequence(F.lit(1), F.size(lines))
    lens = F.transform(lines, lambda s: F.length(s))
    z = J.zip_arrays(nums.alias("line_no"), lens.alias("line_chars"))
    return t.documents.select("doc_id", F.inline(z))


@query("unzip_arrays", oracle=f"""WITH {_LINES_SQL}
SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS total_chars,
       max(length(line)) AS max_chars
FROM lines GROUP BY doc_id""")
def unzip_arrays(t):
    """H12 unzip_arrays + D17 whole-array aggregates (size, sum, max)."""
    lines = F.split("text", NL)
    recs = F.transform(lines, lambda s, i: F.struct((i + 1).alias("line_no"), F.length(s).alias("chars")))
    d = t.documents.select("doc_id", recs.alias("recs"))
    nums, chars = J.unzip_arrays("recs", ["line_no", "chars"])
    d = d.select("doc_id", nums, chars)
    return d.select("doc_id", F.size("line_no").cast("long").alias("n_lines"),
                    F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x).alias("total_chars"),
                    F.array_max("chars").alias("max_chars"))


def doc_responses(t):
    """Two landed responses per document carrying (line_no, line_chars, words)."""
    lines = F.split("text", NL)
    recs = F.transform(lines, lambda s, i: F.struct(
        (i + 1).alias("n"), F.length(s).alias("chars"), F.size(F.split(s, " ")).alias("words")))
    d = t.documents.select("doc_id", lines.alias("lines"), recs.alias("recs"))
    a = d.select("doc_id", F.lit("rec_api").alias("adapter"),
                 F.to_json(F.struct(F.col("recs").alias("items"))).alias("body"))
    b = d.select("doc_id", F.lit("col_api").alias("adapter"),
                 F.to_json(F.struct(F.struct(
                     F.transform("recs", lambda r: r["n"]).alias("seq"),
                     F.transform("recs", lambda r: r["chars"]).alias("size"),
                     F.transform("recs", lambda r: r["words"]).alias("tokens")).alias("block"))).alias("body"))
    return a.unionByName(b)


ADAPTERS = [
    R.Adapter("rec_api", "records", "$.items", (
        R.Mapping("line_no", "$.n", "int"), R.Mapping("line_chars", "$.chars", "int"),
        R.Mapping("words", "$.words", "int"), R.Mapping("unit", const="chars"))),
    R.Adapter("col_api", "columnar", "$.block", (
        R.Mapping("line_no", "$.seq", "int"), R.Mapping("line_chars", "$.size", "int"),
        R.Mapping("words", "$.tokens", "int"), R.Mapping("unit", const="chars"))),
]


@query("reshape_common_fact", oracle=f"""WITH {_LINES_SQL},
f AS (SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(length(line) AS INTEGER) AS line_chars,
             CAST(len(string_split(line, ' ')) AS INTEGER) AS words, 'chars' AS unit FROM lines)
SELECT doc_id, line_no AS row_num, line_no, line_chars, words, unit, 'rec_api' AS adapter FROM f
UNION ALL
SELECT doc_id, line_no AS row_num, line_no, line_chars, words, unit, 'col_api' AS adapter FROM f""")
def reshape_common_fact(t):
    """Two response shapes mapped to one fact schema and unioned."""
    return R.reshape_all(doc_responses(t), ADAPTERS, keep=["doc_id"])


@query("object_of_objects", oracle=f"""WITH {_LINES_SQL}
SELECT doc_id, CAST(line_no AS VARCHAR) AS key, length(line) AS chars FROM lines WHERE line <> ''""")
def object_of_objects(t):
    """Object of objects -> rows (explode map<string, struct>)."""
    lines = F.split("text", NL)
    kv = F.filter(F.transform(lines, lambda s, i: F.struct((i + 1).cast("string").alias("k"),
                                                           F.struct(F.length(s).alias("chars")).alias("v"))),
                  lambda e: e["v"]["chars"] > 0)
    body = F.to_json(F.map_from_entries(kv))
    d = t.documents.select("doc_id", body.alias("body"))
    return d.select("doc_id", R.object_rows(F.col("body"), "struct<chars:int>").alias("key", "v")) \
            .select("doc_id", "key", F.col("v")["chars"].alias("chars"))


@query("bindings_rows", oracle="""
SELECT p_name AS label, array_to_string(list_sort(string_split(p_brand || '|' || p_type, '|')), ',') AS alt_labels,
       'urn:part:' || p_partkey AS item_uri
FROM part""")
def bindings_rows(t):
    """A13 + A14: result bindings -> (label, alt_labels[], item) rows;
    pipe-split aliases, empty -> []."""
    p = t.part
    b = F.to_json(F.struct(F.struct(F.array(F.struct(
        F.struct(F.col("p_name").alias("value")).alias("label"),
        F.struct(F.concat_ws("|", "p_brand", "p_type").alias("value")).alias("altLabel"),
        F.struct(F.concat(F.lit("urn:part:"), F.col("p_partkey").cast("string")).alias("value")).alias("item")
    )).alias("bindings")).alias("results")))
    schema = ("struct<results:struct<bindings:array<struct<label:struct<value:string>,"
              "altLabel:struct<value:string>,item:struct<value:string>>>>>")
    rows = p.select(F.inline(F.from_json(b, schema)["results"]["bindings"]))
    alias = F.col("altLabel")["value"]
    alts = F.when(alias != "", F.split(alias, r"\|")).otherwise(F.array().cast("array<string>"))
    return rows.filter(F.col("label")["value"].isNotNull()).select(
        F.col("label")["value"].alias("label"), F.array_join(F.array_sort(alts), ",").alias("alt_labels"),
        F.col("item")["value"].alias("item_uri"))


# -------------------------------------------------------------- spec shredding
def with_event(d):
    """``d`` with the spec change event of its row: ``file_path, commit_ts, provider, api_name``; other paths are dropped."""
    fp = (F.when(F.col("lang") == "en", F.concat_ws("/", F.lit("APIs"), "source", F.col("doc_id").cast("string"),
                                                   F.lit("openapi.yaml")))
           .when(F.col("lang") == "de", F.concat_ws("/", F.lit("APIs"), "source", "lang", F.lit("x"),
                                                    F.col("doc_id").cast("string"), F.lit("openapi.yaml")))
           .otherwise(F.concat_ws("/", F.lit("APIs"), "source", "lang", F.col("doc_id").cast("string"),
                                  F.lit("swagger.yaml"))))
    # wall-clock arithmetic on TIMESTAMP_NTZ: independent of the session time zone
    ts = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id AS INT), 0)")
    provider, api = S.path_identity(F.col("file_path"))
    return d.withColumns({"file_path": fp, "commit_ts": ts}).withColumns({"provider": provider, "api_name": api}).filter(F.col("provider").isNotNull())


EVENT = ("doc_id", "file_path", "commit_ts", "provider", "api_name")


def spec_events(t):
    """A1/A2/A3: spec change events derived from documents."""
    return with_event(t.documents).select(*EVENT)


def spec_docs(t):
    """Spec JSON per document: paths from lines, methods/params/responses by rule."""
    return spec_json(with_event(t.documents))


def spec_json(d):
    """``doc``, a specification, of each row of documents with their events."""
    lines = F.split("text", NL)

    def item(s, i):
        w1 = F.try_element_at(F.split(s, " "), F.lit(1))
        w2 = F.try_element_at(F.split(s, " "), F.lit(2))
        resp = "map<string,struct<description:string,content:map<string,struct<schema:struct<type:string>>>,schema:struct<type:string>>>"
        get_resp = F.create_map(
            F.lit("200"), F.struct(F.lit("ok").alias("description"),
                                   F.create_map(F.lit("application/json"), F.struct(F.struct(F.lit("array").alias("type")).alias("schema")),
                                                F.lit("text/plain"), F.struct(F.struct(F.lit("string").alias("type")).alias("schema"))).alias("content"),
                                   F.lit(None).cast("struct<type:string>").alias("schema")),
            F.lit("404"), F.struct(F.lit("missing").alias("description"),
                                   F.lit(None).cast("map<string,struct<schema:struct<type:string>>>").alias("content"),
                                   F.lit(None).cast("struct<type:string>").alias("schema"))).cast(resp)
        post_resp = F.create_map(
            F.lit("201"), F.struct(F.lit("created").alias("description"),
                                   F.lit(None).cast("map<string,struct<schema:struct<type:string>>>").alias("content"),
                                   F.struct(F.lit("object").alias("type")).alias("schema"))).cast(resp)
        get = F.struct(F.concat(F.lit("get_"), (i + 1).cast("string")).alias("operationId"),
                       F.array("_lang").alias("tags"),
                       F.array(F.struct(w1.alias("name"), F.lit("query").alias("in"), F.lit(True).alias("required")),
                               F.struct(w2.alias("name"), F.lit("path").alias("in"), F.lit(True).alias("required"))
                               ).alias("parameters"),
                       get_resp.alias("responses"))
        post = F.when(s.contains(","), F.struct(F.concat(F.lit("post_"), (i + 1).cast("string")).alias("operationId"),
                                                 F.lit(True).alias("deprecated"), post_resp.alias("responses")))
        body = F.to_json(F.struct(w1.alias("summary"),
                                  F.array(F.struct(w1.alias("name"), F.lit("query").alias("in"))).alias("parameters"),
                                  get.alias("get"), post.alias("post"), (i + 1).alias("x-line")))
        return F.when(s == "", F.concat(F.lit('"/e/'), (i + 1).cast("string"), F.lit('":""'))) \
                .otherwise(F.concat(F.lit('"/l/'), (i + 1).cast("string"), F.lit('":'), body))

    items = F.transform(lines, item)
    paths = F.concat(F.lit('{"x-doc":{"id":'), F.col("doc_id").cast("string"), F.lit("}"),
                     F.array_join(F.transform(items, lambda x: F.concat(F.lit(","), x)), ""), F.lit("}"))
    swagger = F.col("lang") == "es"
    head = F.when(swagger, F.lit('"swagger":"2.0"')).otherwise(F.lit('"openapi":"3.0.1"'))
    info = F.to_json(F.struct(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
                              F.col("source").alias("version"), F.col("lang").alias("description")))
    schema_obj = F.to_json(F.struct(F.lit("object").alias("type"), F.col("source").alias("description")))
    comps = F.when(swagger, F.lit('{"schemas":{}}')) \
             .otherwise(F.concat(F.lit('{"schemas":{"Line":'), schema_obj, F.lit("}}")))
    defs = F.when(swagger, F.concat(F.lit('{"Doc":'), schema_obj, F.lit(',"Bad":"x"}'))) \
            .otherwise(F.lit('{"Old":{"type":"object"}}'))
    doc = F.concat(F.lit("{"), head, F.lit(',"info":'), info, F.lit(',"paths":'), paths,
                   F.lit(',"components":'), comps, F.lit(',"definitions":'), defs, F.lit("}"))
    return d.withColumn("_lang", F.col("lang")).select(*EVENT, *[c for c in ("sys_to",) if c in d.columns], doc.alias("doc"))


def spec_versions(t):
    """Version chain per (provider, api_name) by commit time, from events alone; texts are read for its versions only."""
    chain = S.version_chain(spec_events(t)).select("doc_id", "sys_to")
    return spec_json(with_event(t.documents.join(chain, "doc_id"))).withColumnRenamed("commit_ts", "sys_from")


_SPEC_SQL = """
ev AS (
  SELECT doc_id, text, lang, source,
         CASE WHEN lang = 'en' THEN 'APIs/' || source || '/' || doc_id || '/openapi.yaml'
              WHEN lang = 'de' THEN 'APIs/' || source || '/' || lang || '/x/' || doc_id || '/openapi.yaml'
              ELSE 'APIs/' || source || '/' || lang || '/' || doc_id || '/swagger.yaml' END AS file_path,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) AS commit_ts
  FROM documents),
idn AS (
  SELECT *, string_split(file_path, '/') AS parts FROM ev),
specs AS (
  SELECT doc_id, text, lang, source, file_path, commit_ts AS sys_from,
         parts[2] AS provider,
         CASE WHEN len(parts) = 4 THEN parts[2] ELSE parts[3] END AS api_name
  FROM idn WHERE parts[1] = 'APIs' AND len(parts) IN (4, 5)),
chain AS (
  SELECT *, lead(sys_from) OVER (PARTITION BY provider, api_name ORDER BY sys_from, file_path) AS sys_to
  FROM specs),
slines AS (
  SELECT provider, api_name, sys_from, lang, source,
         unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
  FROM specs),
pl AS (
  SELECT *, '/l/' || i AS path, string_split(line, ' ')[1] AS w1, string_split(line, ' ')[2] AS w2
  FROM slines WHERE line <> ''),
ops AS (
  SELECT provider, api_name, sys_from, path, 'get' AS method, 'get_' || i AS operation_name,
         false AS deprecated, w1, w2, line FROM pl
  UNION ALL
  SELECT provider, api_name, sys_from, path, 'post', 'post_' || i, true, w1, w2, line FROM pl
  WHERE contains(line, ','))
"""


@query("spec_events_identity", oracle=f"""WITH {_SPEC_SQL}
SELECT doc_id, file_path, sys_from AS commit_ts, provider, api_name FROM specs""")
def spec_events_identity(t):
    """A1/A2/A3: path identity of spec files; other depths dropped."""
    return spec_events(t)


@query("spec_chain", oracle=f"""WITH {_SPEC_SQL}
SELECT provider, api_name, sys_from, sys_to, 'doc ' || doc_id AS title, source AS spec_version,
       lang AS description, CASE WHEN lang = 'es' THEN '2.0' ELSE '3.0.1' END AS openapi_version
FROM chain""")
def spec_chain(t):
    """K1 + E1/T4: spec rows with their version interval."""
    return S.specs(spec_versions(t))


@query("shred_paths", oracle=f"""WITH {_SPEC_SQL}
SELECT provider, api_name, sys_from, path, path AS path_trunc, w1 AS summary FROM pl""")
def shred_paths(t):
    """K2/K7: path rows (x- keys and non-object items skipped)."""
    return S.paths(spec_versions(t)).select("provider", "api_name", "sys_from", "path", "path_trunc", "summary")


@query("shred_operations", oracle=f"""WITH {_SPEC_SQL}
SELECT provider, api_name, sys_from, path, method, operation_name, deprecated FROM ops""")
def shred_operations(t):
    """K3: operations for the eight HTTP methods only."""
    return S.operations(S.paths(spec_versions(t))).select(
        "provider", "api_name", "sys_from", "path", "method", "operation_name", "deprecated")


@query("shred_parameters", oracle=f"""WITH {_SPEC_SQL}
SELECT provider, api_name, sys_from, path, method, 0 AS ordinal, w1 AS name, 'query' AS location, false AS required
FROM ops
UNION ALL
SELECT provider, api_name, sys_from, path, method, 1, coalesce(w2, ''), 'path', true
FROM ops WHERE method = 'get'""")
def shred_parameters(t):
    """K4: path-level then operation-level parameters, first (name, in) wins."""
    return S.parameters(S.operations(S.paths(spec_versions(t)))).select(
        "provider", "api_name", "sys_from", "path", "method", "ordinal", "name", "location", "required")


@query("shred_responses", oracle=f"""WITH {_SPEC_SQL}
SELECT provider, api_name, sys_from, path, method, '200' AS status_code, 'ok' AS description,
       'application/json' AS media_type, '{{"type":"array"}}' AS schema_json FROM ops WHERE method = 'get'
UNION ALL
SELECT provider, api_name, sys_from, path, method, '404', 'missing', NULL, NULL FROM ops WHERE method = 'get'
UNION ALL
SELECT provider, api_name, sys_from, path, method, '201', 'created', NULL, '{{"type":"object"}}'
FROM ops WHERE method = 'post'""")
def shred_responses(t):
    """K5: responses; first media type in document order, else Swagger-2 schema."""
    return S.responses(S.operations(S.paths(spec_versions(t))))


@query("shred_schemas", oracle=f"""WITH {_SPEC_SQL}
SELECT provider, api_name, sys_from, CASE WHEN lang = 'es' THEN 'Doc' ELSE 'Line' END AS schema_name,
       source AS description
FROM specs""")
def shred_schemas(t):
    """K6: component schemas, else definitions; non-objects skipped."""
    return S.schemas(spec_versions(t)).select("provider", "api_name", "sys_from", "schema_name", "description")


@query("spec_catalog", oracle=f"""WITH {_SPEC_SQL}
SELECT provider, method, count(*) AS n_operations, count(*) FILTER (WHERE deprecated) AS n_deprecated
FROM ops GROUP BY provider, method HAVING count(*) > 100""")
def spec_catalog(t):
    """Endpoints by provider and method, GROUP BY + HAVING."""
    ops = S.operations(S.paths(spec_versions(t)))
    g = ops.groupBy("provider", "method").agg(F.count(F.lit(1)).alias("n_operations"),
                                              F.count_if("deprecated").alias("n_deprecated"))
    return g.filter(F.col("n_operations") > 100)


@query("spec_metadata_regex", oracle="""
SELECT doc_id, 'doc ' || doc_id AS title, source AS spec_version,
       CASE WHEN lang = 'es' THEN '2.0' ELSE '3.0.1' END AS openapi_version
FROM documents""")
def spec_metadata_regex(t):
    """Title / version / openapi-or-swagger from raw text by regex."""
    d = t.documents
    raw = F.concat(F.when(F.col("lang") == "es", F.lit("swagger: '2.0'")).otherwise(F.lit("openapi: 3.0.1")),
                   F.lit('\ninfo:\n  title: "doc '), F.col("doc_id").cast("string"), F.lit('"\n  version: '),
                   F.col("source"), F.lit("\npaths: {}\n"))
    return d.select("doc_id", *S.metadata_regex(raw))
