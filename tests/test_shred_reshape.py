import datetime as dt
import json

from vellum.operators import reshape as R
from vellum.operators import shred as S

SPEC = {
    "openapi": "3.0.0",
    "info": {"title": "T", "version": "1"},
    "paths": {
        "x-ignored": {"get": {}},
        "/bad": "not an object",
        "/a": {
            "parameters": [{"name": "q", "in": "query", "required": False}],
            "get": {"operationId": "g", "tags": ["t"],
                    "parameters": [{"name": "q", "in": "query", "required": True},
                                   {"$ref": "#/p1"}, {"$ref": "#/p2"}],
                    "responses": {"200": {"description": "ok", "content": {
                        "text/csv": {"schema": {"type": "string"}},
                        "application/json": {"schema": {"type": "array"}}}},
                        "400": {"description": "bad", "schema": {"type": "object"}}}},
            "fetch": {"operationId": "not a method"},
        },
    },
    "components": {"schemas": {}},
    "definitions": {"Old": {"type": "object"}, "Bad": 1},
}


def spec_df(spark, doc):
    return spark.createDataFrame([("p", "a", dt.datetime(2024, 1, 1), None, json.dumps(doc))],
                                 "provider string, api_name string, sys_from timestamp_ntz, sys_to timestamp_ntz, doc string")


def test_shred_rules(spark):
    d = spec_df(spark, SPEC)
    paths = S.paths(d)
    assert [r.path for r in paths.collect()] == ["/a"]
    ops = S.operations(paths)
    assert [(r.method, r.deprecated) for r in ops.collect()] == [("get", False)]
    params = S.parameters(ops).orderBy("ordinal").collect()
    assert [(r.name, r.location, r.required) for r in params] == [("q", "query", False), ("", "query", False)]
    resp = {r.status_code: r for r in S.responses(ops).collect()}
    assert resp["200"].media_type == "text/csv" and resp["200"].schema_json == '{"type":"string"}'
    assert resp["400"].media_type is None and resp["400"].schema_json == '{"type":"object"}'
    assert [r.schema_name for r in S.schemas(d).collect()] == ["Old"]
    spec = S.specs(d).first()
    assert (spec.title, spec.openapi_version) == ("T", "3.0.0")


def test_path_identity(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("APIs/p/v/openapi.yaml",), ("APIs/p/s/v/openapi.yaml",), ("APIs/p/a/b/c/x.yaml",)],
                               "f string")
    p, a = S.path_identity(F.col("f"))
    got = [tuple(r) for r in df.select(p, a).collect()]
    assert got == [("p", "p"), ("p", "s"), (None, None)]


def test_weather_pair_reshape(spark):
    a = '{"days":[{"datetime":"2024-01-01","temp":5.2},{"datetime":"2024-01-02","temp":6.1}]}'
    b = '{"daily":{"time":["2024-01-01","2024-01-02"],"temperature_2m_mean":[5.0,6.3]}}'
    resp = spark.createDataFrame([("A", a), ("B", b)], "adapter string, body string")
    adapters = [
        R.Adapter("A", "records", "$.days", (R.Mapping("date", "$.datetime"), R.Mapping("temperature", "$.temp", "double"),
                                             R.Mapping("unit_of_measure", const="C"))),
        R.Adapter("B", "columnar", "$.daily", (R.Mapping("date", "$.time"),
                                               R.Mapping("temperature", "$.temperature_2m_mean", "double"),
                                               R.Mapping("unit_of_measure", const="C"))),
    ]
    rows = sorted((r.adapter, r.date, r.temperature, r.unit_of_measure)
                  for r in R.reshape_all(resp, adapters).collect())
    assert rows == [("A", "2024-01-01", 5.2, "C"), ("A", "2024-01-02", 6.1, "C"),
                    ("B", "2024-01-01", 5.0, "C"), ("B", "2024-01-02", 6.3, "C")]


def test_template_fill(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("x", None)], "a string, b string")
    got = df.select(R.template_fill("u/{{ a }}/{{b}}/{{ c }}!", {"a": F.col("a"), "b": F.col("b")}).alias("r")).first().r
    assert got == "u/x//!"


def test_two_files_at_one_time_are_one_version(spark):
    import datetime

    day = lambda d: datetime.datetime(2024, 1, d)
    rows = [("p", "a", day(1), "x/1"), ("p", "a", day(1), "x/2"), ("p", "a", day(3), "x/0"), ("p", "b", day(1), "y"), (None, None, day(2), "z"), (None, None, day(4), "z")]
    got = S.version_chain(spark.createDataFrame(rows, "provider string, api_name string, commit_ts timestamp_ntz, file_path string"))
    assert sorted(((r.provider, r.commit_ts, r.file_path, r.sys_to) for r in got.collect()), key=repr) == sorted(
        [("p", day(1), "x/2", day(3)), ("p", day(3), "x/0", None), ("p", day(1), "y", None), (None, day(2), "z", day(4)), (None, day(4), "z", None)], key=repr)


def test_many_parameters_first_of_a_name_and_place_wins(spark):
    import json

    params = [{"name": f"p{i % 300}", "in": "query" if i % 7 else None, "required": i < 300} for i in range(800)] + ["odd", {"in": "path"}, {}]
    row = ("p", "a", "t", "/x", "get", json.dumps({"parameters": params[:5]}), json.dumps({"parameters": params}))
    got = S.parameters(spark.createDataFrame([row], "provider string, api_name string, sys_from string, path string, method string, item string, op string")).collect()
    seen, want = set(), []
    for p in params[:5] + params:
        if isinstance(p, dict) and (p.get("name"), p.get("in")) not in seen:
            seen.add((p.get("name"), p.get("in")))
            want.append((p.get("name") or "", p.get("in") or "query", p.get("required", False)))
    assert [(r.name, r.location, r.required) for r in sorted(got, key=lambda r: r.ordinal)] == want
