import random

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from vellum.functions import text as X
from vellum.operators import pricing as P


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first().r


def test_model_id_normalise_cases(spark):
    cases = {"anthropic/claude-opus-4.6": "anthropic/claude-opus-4-6",
             "anthropic/claude-haiku-3.5": "anthropic/claude-haiku-3-5",
             "anthropic/claude-opus-4-6": "anthropic/claude-opus-4-6",
             "  P/M-4.6.1 ": "p/m-4-6.1"}
    for raw, want in cases.items():
        assert one(spark, X.model_id_normalise("x"), raw) == want


def test_prefix_match(spark):
    ids = spark.createDataFrame([("p/m-4-6",), ("p/x",), ("q/a",)], "model_id string")
    canon = spark.createDataFrame([("p/m-4-6-20250514",), ("p/m-4-6-x",), ("q/a",), ("q/ab",)], "canonical_id string")
    got = {r.model_id: r.matched_id for r in P.prefix_match(ids, canon).collect()}
    assert got == {"p/m-4-6": "p/m-4-6-x", "p/x": "p/x", "q/a": "q/a"}


def test_prefix_match_single_candidate(spark):
    ids = spark.createDataFrame([("p/m-4-6",)], "model_id string")
    canon = spark.createDataFrame([("p/m-4-6-20250514",)], "canonical_id string")
    assert P.prefix_match(ids, canon).first().matched_id == "p/m-4-6-20250514"


def test_per_million_and_provider(spark):
    assert one(spark, X.per_million("x"), "0.000003") == 3.0
    assert one(spark, X.provider_of("x"), "anthropic/claude") == "anthropic"
    assert one(spark, X.provider_of("x"), "claude") == "unknown"


def test_usage_cost(spark):
    usage = spark.createDataFrame([("m", 1000, 500), ("z", 1, 1)], "model string, prompt_tokens long, completion_tokens long")
    prices = spark.createDataFrame([("m", 3.0, 15.0)], "model string, input_per_mtok double, output_per_mtok double")
    got = {r.model: r.cost for r in P.usage_cost(usage, prices).collect()}
    assert abs(got["m"] - 0.0105) < 1e-12 and got["z"] is None


def test_tiers_provider_scoped(spark):
    p = spark.createDataFrame([("a/x", "a", 3.0, 15.0), ("b/y", "b", 0.0625, 1.0)],
                              "model string, provider string, input_per_mtok double, output_per_mtok double")
    rows = {r.model: r for r in P.with_tiers(p, ["a"]).collect()}
    assert rows["a/x"].cache_write_5m_per_mtok == 3.75 and rows["a/x"].batch_output_per_mtok == 7.5
    assert rows["b/y"].cache_read_per_mtok is None
    allp = {r.model: r for r in P.with_tiers(p, None).collect()}
    assert allp["b/y"].cache_read_per_mtok == 0.0062  # half-even at 4 decimals


def test_reply_shapes(spark):
    rec = '[{"model_id": "m1", "input_per_mtok": 1.0, "output_per_mtok": 2.0, "cache_read_per_mtok": 0.1}, {"model_id": "m2", "input_per_mtok": 1.0}]'
    replies = spark.createDataFrame([
        (1, rec), (2, "```json\n" + rec + "\n```"), (3, "```\n" + rec + "\n```"), (4, "Sure:\n" + rec),
        (5, '{"models": 1, "data": ' + rec + "}"), (6, rec + "\nsee [docs]"), (7, "no json here")], "k int, content string")
    got = P.reply_records(replies).collect()
    assert sorted({r.k for r in got}) == [1, 2, 3, 4, 5]
    assert all(r.model == "m1" and r.cache_read_per_mtok == 0.1 for r in got)  # record lacking a price dropped
    assert sorted((r.k, r.item) for r in P.reply_rejects(replies).collect() if r.item is None) == [(6, None), (7, None)]


def test_text_helpers(spark):
    assert one(spark, X.strip_outer_quotes("x"), '"hello"') == "hello"
    assert one(spark, X.strip_outer_quotes("x"), "'a\"") == "'a\""
    assert one(spark, X.unescape_payload("x"), 'a\\\\"b\\"c\\nd\\/e') == 'a"b"c\nd/e'
    assert one(spark, X.fold_label("x"), "Réunion Ça") == "reunion ca"
    assert one(spark, X.fold_label("x"), "Hà Nội e\u0301 ΆΩ й") == "ha noi e αω и"
    for raw, want in {"Straße STRASSE ẞ": "strasse strasse ss", "ﬁn Ⅷ": "fin viii", "ＡＢｃ１": "abc1", "ΟΔΟΣ οδός": "οδοσ οδοσ", "Ǆ ŉ": "dz ʼn", "I\u0307": "i", "": ""}.items():
        assert one(spark, X.fold_label("x"), raw) == want, raw
    assert one(spark, X.fold_label("x"), "कुल") != one(spark, X.fold_label("x"), "कल") and one(spark, X.fold_label("x"), None) is None
    assert one(spark, X.per_million("x"), "no price") is None
    assert one(spark, X.to_number("x"), "$1,234.5") == 1234.5
    assert one(spark, X.name_key("x"), "__Customer_ID_") == "customer_id"
    assert one(spark, X.ref_tail("x"), "#/components/schemas/Currency") == "Currency"
    assert one(spark, X.host_prefix("x"), "https://a.b.com/x?y") == "https://a.b.com"
    assert one(spark, X.parse_iso_ts("x"), "2024-01-02T03:04:05.123456789Z") is not None


def test_zip_pads_uneven(spark):
    from vellum.functions.jsonx import zip_arrays
    df = spark.createDataFrame([([1, 2, 3], ["a"])], "a array<int>, b array<string>")
    rows = df.select(F.inline(zip_arrays("a", "b"))).collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None), (3, None)]


def test_prices_that_are_none(spark):
    recs = [('[{"model_id": "m", "input_per_mtok": NaN, "output_per_mtok": 1}]', "no list of records"), ('[{"model_id": "m", "input_per_mtok": -2, "output_per_mtok": 1}]', "record without id or price"),
            ('[{"model_id": "m", "input_per_mtok": "1.5", "output_per_mtok": 1}]', "record without id or price"), ('[{"model_id": "m", "input_per_mtok": 0, "output_per_mtok": 1e0}]', None),
            ('{"data": [], "models": {"a": 1}, "pricing": [1]}', None), ("[[1]]", "record without id or price"), ('["x"], [1]', "no list of records")]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(recs)], "k int, content string")
    got = {r.k: r.reason for r in P.reply_rejects(df).collect()}
    assert [got.get(i) for i in range(len(recs))] == [w for _, w in recs]
    assert [(r.k, r.input_per_mtok) for r in P.reply_records(df).collect()] == [(3, 0.0)]


def test_numbers_are_the_texts_that_cast(spark):
    rng = random.Random(1)
    told = ["1", "1.", ".5", ".", "-.5e3", "1e", "1e5f", "1d", "1L", "0x1p3", "0x.8P-2d", "0x1", "NaN", "-NaN", "nan", "-nan", "inf", "-iNf", "+Infinity", "INFINITY", "NaNf", "1 2", "--1", "1_0", "\u0661",
            "1\u00a0", "1\n", "\x1f1", "", " ", "1e400", "$1,000.50", "5 $", "1\u2028"]
    told += ["".join(rng.choice("01.eE+-dfxXpPAaNnIity, \t") for _ in range(rng.randint(1, 6))) for _ in range(20_000)]
    df = spark.createDataFrame([(t,) for t in told], "t string")
    rows = df.select("t", F.translate("t", ",$", "").try_cast("double").alias("cast"), X.to_number("t").alias("number")).collect()
    assert all(repr(r["cast"]) == repr(r["number"]) for r in rows)
    plain = pc.replace_substring_regex(pa.array([r["t"] for r in rows]), "[,$]", "")
    assert pc.match_substring_regex(plain, X.NUMBER).to_pylist() == [r["cast"] is not None for r in rows]
