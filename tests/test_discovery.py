"""Discovery loop, requested domains, sketches, declared schemas, path steps and late boxes on small inputs."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from vellum.functions import steps as ST
from vellum.operators import domains as D
from vellum.operators import sieve, validate
from vellum.streaming import late_boxes as late


def test_discovery_is_the_plain_loop(spark, tmp_path):
    rng = random.Random(1)
    catalog = {(f"d{d}", f"k{rng.randrange(40)}") for d in range(6) for _ in range(8)}
    values = [(c, f"k{rng.randrange(60)}") for c in "abcde" for _ in range(12)] + [("none", "zz"), ("a", None)]

    def put(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    known, log = D.discover(spark.createDataFrame(values, "column_name string, key string"), spark.createDataFrame([m for m in catalog if m[0] == "d0"], "domain_name string, key string"),
                            spark.createDataFrame(sorted(catalog), "domain_name string, key string"), put, covered=0.7)
    of = {d: {k for n, k in catalog if n == d} for d in {n for n, _ in catalog}}
    sets = {c: {k for n, k in values if n == c and k} for c, _ in values}
    have, gone, want, n = {"d0"}, set(), [], 0
    while True:
        n += 1
        held = set().union(*[of[d] for d in have])
        suggested = set()
        for c, s in sets.items():
            if c in gone or len(s & held) >= 0.7 * len(s):
                continue
            best = min(((-len((s - held) & of[d]), d) for d in of if d not in have and (s - held) & of[d]), default=None)
            want.append((n, c, len(s), len(s & held), best[1] if best else None, -best[0] if best else 0, "accepted" if best else "no_match"))
            suggested |= {best[1]} if best else set()
            gone |= set() if best else {c}
        if not suggested:
            break
        have |= suggested
    assert sorted(map(tuple, log.collect()), key=repr) == sorted(want, key=repr)
    assert {r.domain_name for r in known.collect()} == have and n > 2


def test_requests_prune_the_stored_domains(spark, tmp_path):
    mem = spark.createDataFrame([(f"d{i % 5}", f"k{i}", f"K{i}") for i in range(50)], "domain_name string, key string, label string")
    D.store_members(mem, str(tmp_path / "m"))
    spark.createDataFrame([("t", "d1"), ("t", "d1"), ("t", None), ("t", "dx"), ("u", "d2")], "who string, domain_name string").write.parquet(str(tmp_path / "r"))
    asked = spark.read.parquet(str(tmp_path / "r")).filter("who = 't'")
    got = D.requested_members(spark.read.parquet(str(tmp_path / "m")), asked)
    assert {r.domain_name for r in got.collect()} == {"d1"} and got.count() == 10
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert D.requested_members(spark.read.parquet(str(tmp_path / "m")), asked.limit(0)).count() == 0


def test_sketches_are_near_the_exact_sets(spark):
    df = spark.range(60_000).select(F.lit("col").alias("c"), F.concat(F.lit("k"), "id").alias("key")).unionByName(spark.createDataFrame([("col", None), ("tiny", "k5"), ("tiny", "k5")], "c string, key string"))
    dom = spark.range(40_000, 100_000).select(F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("d"), F.concat(F.lit("k"), "id").alias("key"))
    pairs = D.sampled_pairs(df.filter("key IS NOT NULL"), dom, ["c"], ["d"])
    assert {(r.c, r.d) for r in pairs.collect()} == {("col", "even"), ("col", "odd")}
    got = {r.d: r for r in D.compare_sketches(D.sketches(df, ["c"], log_size=12), D.sketches(dom, ["d"], log_size=12), pairs, ["c"], ["d"], log_size=12).collect()}
    for d in ("even", "odd"):
        assert abs(got[d].n_left - 60_000) < 3_000 and abs(got[d].n_right - 30_000) < 1_500 and abs(got[d].n_both - 10_000) < 1_500
        assert abs(got[d].jaccard - 10_000 / 80_000) < 0.02 and abs(got[d].containment - 1 / 6) < 0.03
    assert {r.c: r.sketch is not None for r in D.sketches(df, ["c"]).collect()} == {"col": True, "tiny": True}


def test_materialised_counts_before_it_hints(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    small, large = spark.range(10).toDF("k"), spark.range(50).toDF("k")
    assert "broadcast" in plan(large.join(D.materialised(small, 20), "k")) and "broadcast" not in plan(small.join(D.materialised(large, 20), "k"))


RULES = (validate.Rule("id", "string", True, pattern="^[a-z]"), validate.Rule("n", "integer", minimum=1, maximum=5), validate.Rule("k", enum=("a", "b")), validate.Rule("o'x", "boolean"))


@pytest.mark.parametrize("record,want", [
    ('{"id": "ab", "n": 5.0, "k": "a", "o\'x": true}', []), ('{"id": "Ab", "n": 6}', ["id: unlike the pattern", "n: above 5"]),
    ('{"n": 1.5, "k": "c"}', ["id: missing", "n: no integer", "k: not one of the values"]), ('{"id": null, "n": "3"}', ["id: no string", "n: no integer"]),
    ('{"id": "a", "n": NaN}', ["not an object"]), ('{"id": "a", "z": 1, "b": 2}', ["b: not declared", "z: not declared"]), ("[1]", ["not an object"]), (None, ["not an object"]),
    ("", ["not an object"]), ('{"id": ["a"], "o\'x": 0}', ["id: no string", "o'x: no boolean"]), ('{"id": "a", "n": 0}', ["n: below 1"])])
def test_violations(spark, record, want):
    assert spark.createDataFrame([(record,)], "r string").select(validate.violations("r", RULES).alias("v")).first().v == want


def test_declared_rules_and_retries(spark):
    rows = spark.createDataFrame([("n", "number", True, None, None, 0.0, None)], "field string, kind string, required boolean, enum array<string>, pattern string, minimum double, maximum double")
    rules = validate.rules_of(rows)
    assert rules == (validate.Rule("n", "number", True, minimum=0.0),)
    replies = spark.createDataFrame([(1, 1, '[{"n": 1}, {"n": -1}]'), (2, 3, "no list"), (3, 1, "[]"), (4, 2, '{"data": [{"n": "1", "x": 1}]}'), (5, 1, None)], "k int, attempt int, content string")
    got = validate.validate_replies(replies, rules)
    assert sorted((r.k, r.item, r.violations) for r in got.collect() if r.item is not None) == [(1, 0, []), (1, 1, ["n: below 0"]), (4, 0, ["n: no number", "x: not declared"])]
    queue = {r.k: (r.next_attempt, r.status, r.errors) for r in validate.retry_queue(got, ["k"], "attempt", most=3).collect()}
    assert queue == {1: (2, "retry", "item 1: n: below 0"), 2: (None, "quarantine", "no list of records"), 4: (3, "retry", "item 0: n: no number, x: not declared"), 5: (2, "retry", "no list of records")}


def test_retries_parse_a_record_once(spark):
    replies = spark.createDataFrame([(1, 1, '[{"id": "a"}, {"id": "B", "n": 9}]')], "k int, attempt int, content string")
    queue = validate.retry_queue(validate.validate_replies(replies, RULES), ["k"], "attempt")
    plan = queue._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 2 and plan.count("json_object_keys") + plan.count("jsonObjectKeys") == 1  # a reply, and a record
    assert [tuple(r) for r in queue.collect()] == [(1, 2, "retry", "item 1: id: unlike the pattern, n: above 5")]


def jmes(v, steps):
    """The same steps over parsed JSON."""
    rows = [v]
    for s in steps:
        rows = [r for r in rows if r is not None]
        if isinstance(s, ST.Field):
            rows = [r.get(s.name) for r in rows if isinstance(r, dict)]
        elif isinstance(s, ST.Index):
            rows = [r[s.at] for r in rows if isinstance(r, list) and s.at < len(r)]
        elif isinstance(s, ST.Values):
            rows = [r[k] for r in rows if isinstance(r, dict) for k in sorted(r)]
        elif isinstance(s, ST.Flatten):
            rows = [y for r in rows if isinstance(r, list) for x in r for y in (x if isinstance(x, list) else [x])]
        elif isinstance(s, ST.Where):
            fits = {"==": lambda a, b: a == b, ">": lambda a, b: a > b, "!=": lambda a, b: a != b}[s.op]
            rows = [r for r in rows if isinstance(r, dict) and isinstance(r.get(s.name), type(s.value)) and fits(r[s.name], s.value)]
    return [r for r in rows if r is not None]


@pytest.mark.parametrize("steps", [
    [ST.Field("a"), ST.Flatten()], [ST.Field("a"), ST.Flatten(), ST.Flatten()], [ST.Values(), ST.Field("x")], [ST.Field("b"), ST.Values(), ST.Flatten(), ST.Where("n", ">", 1)],
    [ST.Field("a"), ST.Index(1)], [ST.Field("o'd \"k"), ST.Field("x")], [ST.Field("b"), ST.Values(), ST.Flatten(), ST.Where("s", "==", "t"), ST.Field("n")], []])
def test_steps(spark, steps):
    docs = [{"a": [1, [2, [3]], None, "x"], "b": {"q": [{"n": 1, "s": "t"}, {"n": 2}], "p": [{"n": 3, "s": "t"}, 5]}, "o'd \"k": {"x": 4}}, {"a": {"x": 7}, "b": {"x": 8, "y": []}}, {}, [1, 2], None]
    df = spark.createDataFrame([(i, json.dumps(d), "kept") for i, d in enumerate(docs)] + [(8, "{", ""), (9, None, "")], "id int, doc string, value2 string")
    got = ST.apply_steps(df, "doc", steps).select("id", "place", F.to_json("value").alias("v")).collect()
    for i, d in enumerate(docs):
        mine = [json.loads(r.v) for r in sorted((r for r in got if r.id == i), key=lambda r: r.place)]
        assert mine == jmes(d, steps)
    assert not [r for r in got if r.id > 7]


def test_pick_is_the_last_step(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": "x"}}',), ('{"b": 2}',)], "doc string")
    assert [tuple(r.value) for r in ST.apply_steps(df, "doc", [ST.Pick({"one": "a", "two": "z"})]).collect()] == [("1", None), (None, None)]
    with pytest.raises(ValueError):
        ST.apply_steps(df, "doc", [ST.Pick({"one": "a"}), ST.Field("a")])


def test_steps_parse_a_text_once(spark):
    df = spark.createDataFrame([(1, '{"a": {"x": {"b": [{"n": "1", "in": "q"}, [{"n": "2", "in": "q"}]]}, "y": 3}}')], "id int, doc string")
    got = ST.apply_steps(df, "doc", [ST.Field("a"), ST.Values(), ST.Field("b"), ST.Flatten(), ST.Where("in", "==", "q"), ST.Pick({"n": "n"})])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "Union" not in plan
    assert sorted((r.value.n, r.place) for r in got.collect()) == [("1", [0, 0]), ("2", [0, 1, 0])]


@pytest.mark.parametrize("seed", [1, 2])
def test_late_boxes_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    words = ["Name", "12", "3.5", "red", "2020-01-01", "x", "blue"]
    boxes = [(d, 1, rng.choice([1, 2]), "", 40.0 * x, 12.0 * y, 20.0, 10.0, rng.choice(words)) for d in (1, 2, 3, None) for y in range(4) for x in range(rng.randint(1, 4))]
    boxes = [(d, p, s, {1: "bold", 2: "thin"}[s], *rest) for d, p, s, _, *rest in boxes]
    order = boxes + rng.sample(boxes, 5)
    rng.shuffle(order)
    members = spark.createDataFrame([("colour", "blue")], "domain_name string, key string")
    for i in range(0, len(order), 9):
        spark.createDataFrame(order[i:i + 9], late.BOXES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        late.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), members, files_per_batch=2).awaitTermination()
    tables = late.create(spark, str(tmp_path / "out"))
    late.apply_batch(tables, spark.createDataFrame(boxes, late.BOXES), 0, members)  # a batch that was applied before
    df = spark.createDataFrame([b for b in boxes if b[0]], late.BOXES).distinct()
    want = sieve.run(df.drop("weight"), df.select("doc_id", "style_id", "weight").distinct(), members)
    assert sorted(map(tuple, tables.read("cells").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
