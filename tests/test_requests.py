"""Costs at call time, prompts and provider selection on small inputs."""

from __future__ import annotations

import datetime as dt

from vellum.operators import pricing as P
from vellum.operators import reshape as R


def test_cost_is_by_the_price_of_the_time_and_the_mode(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    history = spark.createDataFrame([("m", day(1), 1.0, 2.0), ("m", day(10), 10.0, 20.0), (None, day(1), 3.0, 3.0)], "model string, sys_from timestamp_ntz, input_per_mtok double, output_per_mtok double")
    calls = [(1, "m", day(5), "standard"), (2, "m", day(10), None), (3, "m", day(11), "batch"), (4, "m", day(2), "cache_read"), (5, "z", day(5), None), (6, "m", dt.datetime(2023, 1, 1), None),
             (7, "m", day(5), "odd"), (8, None, day(5), None)]
    df = spark.createDataFrame([(*c, 1_000_000, 100_000) for c in calls], "k int, model string, at timestamp_ntz, mode string, prompt_tokens long, completion_tokens long")
    got = {r.k: r.cost for r in P.cost_at_call(df, history, "model", "at").collect()}
    want = {1: 1.2, 2: 12.0, 3: 6.0, 4: 0.3, 5: None, 6: None, 7: None, 8: 3.3}
    assert got.keys() == want.keys() and all(got[k] is None if v is None else abs(got[k] - v) < 1e-9 for k, v in want.items())
    assert P.cost_at_call(df.limit(0), history, "model", "at").collect() == []


def test_prompts_from_rows(spark):
    adapters = spark.createDataFrame([("a", "{{x}} and {{ y }}{{ z }}.", {"x": "dx", "y": "dy"}), ("b", "plain", None), ("c", "{{ a b }} {{x}}", {})], "adapter string, template string, defaults map<string,string>")
    params = spark.createDataFrame([(1, "a", {"y": "$1 {{x}}", "z": None, "w": "unused"}), (2, "a", None), (3, "b", {"x": "1"}), (4, "c", {"x": "{{x}}"}), (5, "none", {}), (6, None, {})], "k int, adapter string, params map<string,string>")
    got = {r.k: r.prompt for r in R.prompts(params, adapters).collect()}
    assert got == {1: "dx and $1 {{x}}.", 2: "dx and dy.", 3: "plain", 4: "{{ a b }} {{x}}"}


def test_selected_providers(spark):
    rows = [("a", {"pricing": "u"}, None, True), ("b", {"pricing": ""}, None, None), ("c", {}, None, None), ("d", None, None, None), ("e", {"pricing": "v"}, dt.datetime(2024, 1, 1), None), ("f", {"pricing": "w"}, None, None)]
    df = spark.createDataFrame(rows, "provider string, urls map<string,string>, sys_to timestamp_ntz, needs_browser boolean")
    assert {(r.provider, r.fetch, r.pricing_url) for r in P.selected_providers(df).collect()} == {("a", "browser", "u"), ("f", "reader", "w")}
    assert [r.provider for r in P.selected_providers(df, ["f", "e"]).collect()] == ["f"]
    models = spark.createDataFrame([("a/m",), ("ab/m",), ("a",), (None,)], "model string")
    assert [r.model for r in P.models_of(models, "a").collect()] == ["a/m"]
