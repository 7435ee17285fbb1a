"""Table candidates, schema matching and page runs on small layouts, against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.operators import regions as R
from vellum.operators import sequence

BOXES = "doc_id long, page_id long, style_id int, x double, y double, w double, h double, text string"


def laid(spark, lines, doc=1, page=1, high=10.0):
    """Words at ``x = 6 * offset`` of each line of text; a line's y is its number times 12."""
    rows = []
    for i, line in enumerate(lines):
        at = 0
        for word in line.split(" "):
            if word:
                rows.append((doc, page, 1, at * 6.0, 12.0 * i, len(word) * 6.0, high, word))
            at += len(word) + 1
    return rows


TABLE = ["Report of the year", "", "Name           Unit price   Sold", "red ring             1.50", "blue bolt           12.00   2020-01-01", "blue               1,000    2020-01-02", "",
         "some words that follow", "Sum   12.5", "Mean   7.5"]


def test_candidates_of_one_page(spark):
    odd = [(1, 1, 1, None, 1.0, 5.0, 5.0, "lost"), (1, 1, 1, 600.0, 24.0, 12.0, 10.0, None), (None, None, 1, 0.0, 0.0, 6.0, 10.0, "a"), (None, None, 1, 60.0, 0.0, 6.0, 10.0, "b")]
    df = spark.createDataFrame(laid(spark, TABLE) + odd, BOXES)
    rows = R.table_rows(df)
    got = [(r.is_header, r["values"]) for r in rows.orderBy("run", "top").collect()]
    assert got == [(True, ["Name", "Unit price", "Sold", ""]), (False, ["red ring", "1.50", None, None]), (False, ["blue bolt", "12.00", "2020-01-01", None]),
                   (False, ["blue", "1,000", "2020-01-02", None]), (False, ["Sum", "12.5"]), (False, ["Mean", "7.5"])]
    a, b = R.table_regions(rows).orderBy("y").collect()
    assert (a.x, a.y, a.h, a.n_columns, a.n_rows, a.headers, a.kinds) == (0.0, 24.0, 46.0, 4, 3, ["Name", "Unit price", "Sold", ""], ["text", "number", "date", "number"])
    assert a.confidence == round(8 / 12 * (3 / 4) * (11 + 1) / 12, 4)
    assert (b.x, b.y, b.w, b.h, b.n_rows, b.kinds, b.confidence) == (0.0, 96.0, 60.0, 22.0, 2, ["text", "number"], 1.0)


def scattered(n_pages, seed):
    """Boxes of odd heights, places and texts, many of them in one place, on pages of which some lie in no document."""
    rng, rows = random.Random(seed), []
    for page in range(n_pages):
        columns = [rng.choice([0, 30, 60, 100, 160, 200]) for _ in range(4)]
        for _ in range(rng.randint(1, 50)):
            y = rng.choice([12.0 * rng.randint(0, 8), 12.0 * rng.randint(0, 8), 5.0 * rng.randint(0, 20)])
            text = rng.choice(["a", "b", "1", "2.5", "$3", "1,000", "", "x y", "é", "2020-01-01", "nan", "Infinity", "1d", " 7 ", None])
            rows.append((page % 7 if page % 11 else None, page, 1, rng.choice(columns) + rng.choice([0.0, 0.0, 0.3, 2.5]), y, rng.choice([6.0, 12.0, 30.0, 0.0, None]), rng.choice([10.0, 10.0, 12.0, 0.5]), text))
    return rows


def as_text(rows):
    return sorted(map(repr, rows.select(sorted(rows.columns)).collect()))


@pytest.mark.parametrize("options", [{}, {"spill": 0.3, "max_gap": 0.2}, {"min_gutter": 2.0, "min_lines": 3}])
def test_pages_at_once_and_pages_by_several_tasks_have_the_same_rows(spark, monkeypatch, options):
    df = spark.createDataFrame(scattered(150, 6), BOXES).repartition(3).cache()
    all_options = {"min_lines": 2, "max_gap": 1.5, "min_gutter": 8.0, "spill": 0.0, **options}
    want = as_text(R.long_page_rows(df, **all_options))
    assert len(want) > 50 and as_text(R.page_rows(df, **all_options)) == want
    monkeypatch.setattr(R, "LONG_KEY", 25)  # some pages are long
    assert as_text(R.table_rows(df, **options)) == want
    assert as_text(R.table_rows(df, **options, sizes=df.groupBy("doc_id", "page_id").agg((F.count("*") * 5).alias("n")))) == want


def test_pages_over_several_batches_are_whole(spark, monkeypatch):
    monkeypatch.setattr(R, "AT_ONCE", 7)
    df = spark.createDataFrame(scattered(60, 7), BOXES).coalesce(1).cache()
    want = as_text(R.table_rows(df))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        assert as_text(R.table_rows(df)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_only_orders_and_lines_are_exchanged_for_boxes(spark):
    from vellum.plans import QUERIES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["table_values"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 4


def test_what_concerns_hints_alone_is_constant(spark):
    df = spark.createDataFrame([("unit price",), ("price of it",), ("",), ("a b a",)], "h string").withColumn("w", R.header_words(F.col("h")))
    scored = df.select("h", R.header_score(F.col("h"), F.col("w"), ("Price", "unit  PRICE", "--")).alias("s"))
    assert "lambdafunction" not in scored._jdf.queryExecution().optimizedPlan().toString()
    assert {r.h: round(r.s, 4) for r in scored.collect()} == {"unit price": 1.0, "price of it": 0.3333, "": 0.0, "a b a": 0.0}


def test_gaps_between_lines_end_a_candidate(spark):
    lines = ["a   1", "b   2", "", "", "c   3", "d   4"]
    rows = R.table_rows(spark.createDataFrame(laid(spark, lines), BOXES))
    assert [len(list(g)) for _, g in itertools.groupby(sorted(r.run for r in rows.collect()))] == [2, 2]
    assert R.table_rows(spark.createDataFrame([], BOXES)).collect() == []
    assert R.table_regions(R.table_rows(spark.createDataFrame(laid(spark, ["a   1"]), BOXES))).collect() == []


@pytest.mark.parametrize("band", [10_000.0, 30.0, 7.0])
def test_high_pages_are_numbered_in_parts(spark, monkeypatch, band):
    rng = random.Random(2)
    lines = [rng.choice(["x   1", "y   22", "one cell", "", "", "z   3   4"]) for _ in range(120)]
    monkeypatch.setattr(R, "BAND", band)
    got = sorted((r.top, r.run) for r in R.line_runs(R.page_lines(spark.createDataFrame(laid(spark, lines), BOXES))).collect())
    want, run, before = [], 0, None
    for i, line in enumerate(lines):
        if not line:
            continue
        here = ("   " in line, 12.0 * i)
        if before is None or here[0] != before[0] or here[1] - (before[1] + 10) > 15:
            run += 1
        before = here
        if here[0]:
            want.append((here[1], run))
    assert got == want


def test_runs_of_numbers_with_null_keys_and_ties(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2]), rng.randint(0, 40), i, rng.choice([0, 0, 1])) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, at int, i int, v int")
    for width in (1, 7, 100):
        got = sequence.number_runs(df, ["k"], ["at", "i"], ["v"], lambda a, b: a["v"] != b["v"], band=F.floor(F.col("at") / width))
        got = {r.i: r.run for r in got.collect()}
        for k in (None, 1, 2):
            mine = sorted((at, i, v) for key, at, i, v in rows if key == k)
            run, want = 1, {}
            for a, b in zip([mine[0], *mine], mine):
                run += a[2] != b[2]
                want[b[1]] = run
            assert {i: got[i] for i in want} == want


def test_assignment_is_the_best_of_all(spark):
    rng = random.Random(4)
    cases = []
    for n in range(60):
        m = rng.randint(0, 5)
        cases.append((n, [(j, [rng.choice([0, 100, 300, 500, 500, 700, 1000]) for _ in range(3)]) for j in range(m)]))
    df = spark.createDataFrame(cases, "n int, columns array<struct<col: int, scores: array<int>>>")
    got = {r.n: (r.b.score, r.b.picks) for r in df.select("n", R.assign(F.col("columns"), 3, 300).alias("b")).collect()}
    for n, columns in cases:
        options = []
        for picks in itertools.product([None, *range(len(columns))], repeat=3):
            used = [p for p in picks if p is not None]
            if len(set(used)) == len(used) and all(columns[p][1][i] >= 300 for i, p in enumerate(picks) if p is not None):
                score = sum(columns[p][1][i] for i, p in enumerate(picks) if p is not None)
                options.append((-score, [99 if p is None else p for p in picks]))
        score, picks = min(options)
        assert got[n] == (-score, [None if p == 99 else p for p in picks])


def test_schema_match_uses_what_is_known(spark):
    df = spark.createDataFrame(laid(spark, TABLE), BOXES)
    members = spark.createDataFrame([("things", "red ring"), ("things", "blue"), ("things", "blue bolt"), ("other", "blue")], "domain_name string, key string")
    wanted = [R.Wanted("thing", domain="things"), R.Wanted("price", ("Unit Price", "cost"), "number", r"^\d+\.\d\d$", minimum=1, maximum=20), R.Wanted("when", kind="date"), R.Wanted("none", ("absent",))]
    a, b = R.schema_match(R.table_rows(df), wanted, members).orderBy("run").collect()
    assert a.picks == [0, 1, 2, None]
    price = round((1 + 1 + 2 / 3 + 2 / 3) / 4 * 1000)
    assert a.score == round((1000 + price + 1000) / 4000, 4) and b.picks == [None, 1, None, None] and b.score == 0.125
    best = R.best_candidates(R.schema_match(R.table_rows(df), wanted, members)).collect()
    assert [(r.doc_id, r.run) for r in best] == [(1, a.run)]


def test_assignment_of_wide_candidates_in_python_numbers():
    score = np.zeros((2, 99, 10), np.int32)
    score[:, 98, 0] = score[:, 5, 0] = 700
    score[0, 7, 9] = score[1, 7, 9] = 299
    score[1, 97:, 3] = 400
    total, picks = R.best_picks(score, 300)  # 100 ** 10 picks times the sums are beyond 64 bits
    assert total.tolist() == [700, 1100]
    assert picks.tolist() == [[5] + [-1] * 9, [5, -1, -1, 97] + [-1] * 6]


def test_boxes_and_assignment_are_not_interpreted_per_row(spark):
    from vellum.plans import QUERIES

    boxes = QUERIES["price_like_boxes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in boxes and "aggregate(" not in boxes
    found = spark.createDataFrame([(1, [(0, [500])])], "n int, columns array<struct<col: int, scores: array<int>>>").select(R.assign(F.col("columns"), 1, 300).alias("b"))
    assert "lambdafunction" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_page_runs(spark):
    rng = random.Random(5)
    pages = [(d, p, sorted(rng.sample("abc", rng.randint(0, 3)))) for d in (1, 2, None) for p in range(0, 80, rng.randint(1, 3))]
    df = spark.createDataFrame(pages, "doc_id long, page_id long, domains array<string>")
    for size in (512, 5):
        got = sorted((repr(r.doc_id), r.run, r.first_page, r.last_page, r.n_pages, r.domains) for r in R.page_runs(df, pages_per_band=size).collect())
        want = []
        for d in (1, 2, None):
            mine = sorted((p, s) for doc, p, s in pages if doc == d)
            runs = [[mine[0]]]
            for (_, s), here in zip(mine, mine[1:]):
                both, either = len(set(s) & set(here[1])), len(set(s) | set(here[1]))
                if either and both / either < 0.5:
                    runs.append([])
                runs[-1].append(here)
            want += [(repr(d), i + 1, r[0][0], r[-1][0], len(r), sorted({x for _, s in r for x in s})) for i, r in enumerate(runs)]
        assert got == sorted(want)


def test_signatures_and_price_like_boxes(spark):
    rows = [(1, 1, 1, 0.0, 0.0, 6.0, 10.0, t) for t in ("Apple", "apple", "pear", "stone", None)] + [(1, 2, 1, 0.0, 0.0, 6.0, 24.0, "Large"), (1, 2, 1, 0.0, 0.0, 6.0, 10.0, "€ 5")]
    df = spark.createDataFrame(rows, BOXES)
    members = spark.createDataFrame([("fruit", "apple"), ("fruit", "pear"), ("rock", "stone")], "domain_name string, key string")
    assert {r.page_id: r.domains for r in R.page_signatures(df, members, min_share=0.5).collect()} == {1: ["fruit"], 2: []}
    assert {r.text for r in R.price_like(df).collect()} == {"Large", "€ 5"}
