"""Listings, adapters, company rows, schema columns, profiles, collections, payload prices on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from vellum.operators import collections as C
from vellum.operators import pricing, profile
from vellum.operators import registry as R


def test_listing_and_change_state(spark):
    v = lambda u, **x: {"updated": u, **x}
    body = {"a:b:c": {"preferred": "2", "versions": {"1": v("t1", swaggerUrl="s1"), "2": v("t2", swaggerUrl="", openapiUrl="o2")}},
            "d": {"preferred": "9", "versions": {"1": v("t1", swaggerUrl="s")}}, "e": {"versions": {}}, "f": {"versions": {"1": v("t1")}}}
    rows = R.listing_rows(spark.createDataFrame([(json.dumps(body),), (None,), ("no json",)], "body string"))
    seen = spark.createDataFrame([("d", "t1"), ("a:b:c", "t1"), ("gone", "t0")], "api_key string, seen string")
    got = {r.api_key: r for r in R.change_status(rows, seen).collect()}
    assert {k: r.status for k, r in got.items()} == {"a:b:c": "updated", "d": "unchanged", "f": "skipped"}
    assert (got["a:b:c"].provider, got["a:b:c"].api_name, got["a:b:c"].spec_url) == ("a", "b:c", "o2")
    assert {r.api_key: r.status for r in R.change_status(rows, seen, force=True).collect()}["d"] == "updated"
    state = {r.api_key: r.seen for r in R.next_state(R.change_status(rows, seen), seen).collect()}
    assert state == {"a:b:c": "t2", "d": "t1", "gone": "t0"}


def test_adapters_route_and_join_current_version(spark):
    entries = [{"name": "n", "provider": "p", "api": "a", "path": "/", "call_jmespath": "x"}, {"name": "m", "provider": "p", "api": "a", "path": "/", "call_jmespath": "x", "prompt_template": "t"}]
    conf = spark.createDataFrame([(json.dumps(entries), None), (json.dumps(entries), "2024")], "body string, sys_to string")
    rows = R.adapter_rows(conf, keep=["sys_to"])
    assert sorted((r.name, r.method, r.kind) for r in rows.distinct().collect()) == [("m", "get", "llm")] * 2 + [("n", "get", "http")] * 2
    r = spark.createDataFrame([(1, "p", "a", "/", "get"), (2, "p", "a", "/", "post")], "id int, provider string, api string, path string, method string")
    assert [(x.id, x.adapter) for x in R.adapter_join(r, rows).collect()] == [(1, "n")]


def test_needed_blobs_once_without_undecodable(spark):
    blobs = spark.createDataFrame([("x", "1"), ("x", "1"), ("y", None), ("z", "3")], "blob_sha string, content string")
    events = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "blob_sha string")
    assert [tuple(r) for r in R.needed_blobs(blobs, events).collect()] == [("x", "1")]


def test_company_ids_are_padded_never_cut(spark):
    rows = [{"cik": "12", "name": "n" * 600, "tickers": [], "sic": "1"}, {"cik": "123456789012", "sic": "2", "tickers": ["LONGTICKERNAME"]}, {"cik": "1", "sic": "0000"}, {"cik": "1"}]
    got = R.company_rows(spark.createDataFrame([(json.dumps(r),) for r in rows], "body string")).orderBy("sic").collect()
    assert [(r.cik, len(r.name), r.ticker, r.state) for r in got] == [("0000000012", 500, "", ""), ("123456789012", 0, "LONGTICKER", "")]


def test_schema_columns_of_odd_schemas(spark):
    s = [json.dumps(x) for x in ({"type": "array", "items": {"properties": {"b": {"$ref": "#/x/B"}, "a": 3}}}, {"type": "array", "items": 1}, {"properties": []}, 5)] + ["", None]
    got = profile.schema_columns(spark.createDataFrame([(x,) for x in s], "schema string")).orderBy("pos").collect()
    assert [(r.name, r.type, r.ref_name, r.enum_values) for r in got] == [("b", "unknown", "B", []), ("a", "unknown", "", [])]


def test_profile_dependency_and_triage_with_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 1.0, None), (3, None, None), (4, 2.5, None)], "k int, v double, e int")
    c = profile.value_counts(df, ["k", "v", "e"])
    got = {r.column: r for r in profile.profile(c).collect()}
    assert (got["k"].cardinality, got["k"].density, got["k"].discreteness) == (1.0, 1.0, 1.0)
    assert (got["v"].n_rows, got["v"].n_values, got["v"].n_distinct) == (4, 3, 2) and got["e"].cardinality is None
    assert {r.column: r.role for r in profile.key_triage(c).collect()} == {"k": "key", "v": "measure", "e": "measure"}
    d = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (2, "a"), (3, None)], "x int, y string")
    r = profile.dependency(d, "x", "y").first()
    assert r.n_determinants == 3 and abs(r.confidence - 2 / 3) < 1e-12


def test_collections_register_check_and_replace(spark, tmp_path):
    c = C.Collection("c", "id", "name", "vec", "m", {"id": "Integer", "name": "String(9)", "rank": "Float", "vec": "REAL[]", "x": "Odd(3)"})
    assert [f"{f.name}:{f.dataType.simpleString()}" for f in C.collection_schema(c)] == ["id:int", "name:string", "rank:double", "x:string", "vec:array<float>"]
    with pytest.raises(KeyError, match="available: c"):
        C.Registry([c]).get("d")
    rows = spark.createDataFrame([(1, "One", "1.5", "q", [0.5]), (2, None, "bad", None, None)], "id int, name string, rank string, x string, vec array<double>")
    with pytest.raises(ValueError, match="lacks rank"):
        C.unify(rows.drop("rank"), c)
    got = C.unify(rows, c).orderBy("key").collect()
    assert [r.properties for r in got] == [{"rank": "1.5", "x": "q"}, {}]
    hit = lambda rule: [r.key for r in C.unify(rows, c).filter(C.property_predicate(c, rule)).collect()]
    assert hit({"rank": {"range": {"gt": 1}}, "x": {"contains": "Q"}}) == ["1"] and hit({"unknown": {"in": [1]}}) == ["1", "2"]
    path = str(tmp_path / "unified")
    for _ in range(2):
        C.replace_partitions(C.unify(rows, c), path)
    C.replace_partitions(C.unify(rows.limit(1), C.Collection("other", "id", "name", "vec", "m")), path)
    assert {tuple(r) for r in spark.read.parquet(path).groupBy("collection").count().collect()} == {("c", 2), ("other", 1)}


def test_payload_prices_shapes(spark):
    def html(*texts):
        return "".join(f'<script>self.__next_f.push([1,"{x.replace(chr(34), chr(92) + chr(34))}"])</script>' for x in texts) + '<script>"modelName":"no"</script>'

    plain = '{"modelName":"A B","inputPrice":1,"outputPrice":2}\\n'
    listed = '{"api":"m","price":[{"value":"Input","price_dollar":"$$1"},{"value":"Output","price_dollar":"$2"}]}'
    half = '{"api":"h","price":[{"value":"Input","price_dollar":"$$1"}]}'
    pages = spark.createDataFrame([(1, html(plain, plain)), (2, html(half, listed, listed)), (3, None), (4, "")], "id int, html string").select("id", pricing.page_payload(F.col("html")).alias("p"))
    got = lambda shape: sorted(tuple(r) for r in pricing.payload_prices(pages, "p", "v", shape, keep=["id"]).collect())
    assert got("plain") == [(1, "v/a-b", 1.0, 2.0)] * 2 and got("list") == [(2, "v/m", 1.0, 2.0)] and got("scaled") == []


def test_profile_keeps_large_keys_apart(spark):
    from decimal import Decimal

    rows = [(2**53, 1.0, Decimal("1.50")), (2**53 + 1, 2.0, Decimal("2.00")), (5, 2.5, None)]
    df = spark.createDataFrame(rows, "k long, d double, m decimal(10,2)")
    counts = profile.value_counts(df, ["k", "d", "m"]).unionByName(profile.value_counts(spark.createDataFrame([(2**53 + 1,), (5,), (5,)], "f long"), ["f"]))
    got = {r.column: r for r in profile.profile(counts).collect()}
    assert got["k"].n_distinct == 3 and got["k"].discreteness == 1.0 and got["d"].discreteness == 2 / 3 and got["m"].discreteness == 0.5
    assert {r.column: (r.role, r.refers_to) for r in profile.key_triage(counts).collect()} == {
        "k": ("key", None), "f": ("foreign key", "k"), "d": ("measure", None), "m": ("measure", None)}


def test_constraint_forms(spark):
    from vellum.operators import embeddings as E

    df = spark.createDataFrame([("ab", 7), ("alpha", 8), ("beta", None), (None, 9)], "s string, n int")
    fits = lambda rules: sorted((r.s or "") for r in df.filter(E.constraint_predicate(df, rules)).collect())
    assert fits({"s": {"in": "ab"}}) == ["ab"] and fits({"n": {"in": 7}}) == ["ab"] and fits({"n": {"range": 8}}) == ["alpha"]
    assert fits({"s": {"contains": ["alp", "bet"]}}) == ["alpha", "beta"] and fits({"s": {"contains": "et"}}) == ["beta"]
    assert fits({"n": {"range": {"gt": 7, "lte": 9}}}) == ["", "alpha"] and len(fits({"x": {"in": 1}, "s": {"in": []}})) == 4
    assert E.intent_constraints({"perils": "flood", "countries": ["FR"], "regions": [], "date_from": "2020", "date_to": "2021", "mood": 1}) == {
        "peril": {"in": ["flood"]}, "country": {"in": ["FR"]}, "date": {"range": {"gte": "2020", "lte": "2021"}}}


def test_repeated_styles(spark):
    from vellum.operators import sieve

    boxes = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 6.0, 10.0, "a")], "doc_id long, page_id int, style_id int, x double, y double, w double, h double, text string")
    styles = spark.createDataFrame([(1, 1, "bold"), (1, 1, "thin"), (1, 1, "thin"), (1, None, "x")], "doc_id long, style_id int, weight string")
    assert [r.boxes[0].weight for r in sieve.lines(boxes, styles).collect()] == ["thin"]
