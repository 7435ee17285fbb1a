import datetime as dt
import os
import tempfile
import zlib

from pyspark.sql import functions as F

from vellum.operators import domains as D
from vellum.operators import embeddings as E
from vellum.operators import sequence as Q
from vellum.operators import sieve as S
from vellum.operators import temporal as T
from vellum.streaming import history_feed as H


def test_stream_feed_rebuilds_chain(spark):
    base = tempfile.mkdtemp(prefix="vl-stream-")
    src, hist, ck = (os.path.join(base, x) for x in ("src", "hist", "ck"))
    schema = "k string, t timestamp_ntz, v string"
    t0 = dt.datetime(2024, 1, 1)
    rows1 = [("a", t0, "x"), ("a", t0 + dt.timedelta(hours=2), "y"), ("b", t0, "p")]
    spark.createDataFrame(rows1, schema).write.parquet(os.path.join(src, "1"))
    q = H.start(spark, src + "/*", schema, hist, ck, ["k"], "t", ["v"])
    q.awaitTermination(120)
    # late observation for 'a' between the two versions, and a duplicate
    rows2 = [("a", t0 + dt.timedelta(hours=1), "y"), ("b", t0, "p")]
    spark.createDataFrame(rows2, schema).write.parquet(os.path.join(src, "2"))
    q = H.start(spark, src + "/*", schema, hist, ck, ["k"], "t", ["v"])
    q.awaitTermination(120)
    h = H.latest_history(spark, hist)
    got = sorted((r.k, r.v, r.sys_from, r.sys_to) for r in h.collect())
    assert got == [("a", "x", t0, t0 + dt.timedelta(hours=1)), ("a", "y", t0 + dt.timedelta(hours=1), None),
                   ("b", "p", t0, None)]
    assert T.integrity(h, ["k"]).count() == 0


def test_late_observations_split_merged_versions(spark):
    hist = os.path.join(tempfile.mkdtemp(prefix="vl-late-"), "h")
    schema, t = "k string, t timestamp_ntz, v string", [dt.datetime(2024, 1, d) for d in (1, 20, 25, 28)]
    batches = [[("a", t[0], "x"), ("a", t[2], "x"), (None, t[0], "n")], [("a", t[1], "y"), ("a", t[1], "w")], [(None, t[3], "n"), ("b", t[3], None)], []]
    for i, rows in enumerate(batches):
        for _ in range(2):  # a retried batch changes nothing
            H.apply_batch(spark, spark.createDataFrame(rows, schema), i, hist, ["k"], "t", ["v"])
    got = sorted(((r.k, r.v, r.sys_from, r.sys_to) for r in H.latest_history(spark, hist).collect()), key=repr)
    want = [("a", "x", t[0], t[1]), ("a", "y", t[1], t[2]), ("a", "x", t[2], None), ("b", None, t[3], None), (None, "n", t[0], None)]
    assert got == sorted(want, key=repr)


def test_null_keys_and_values_in_sequences(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(None, t, 5), (None, t + dt.timedelta(days=30), 7), ("a", t, 5), ("a", t + dt.timedelta(days=30), None), ("a", t + dt.timedelta(days=60), 2), ("b", t, None)]
    out = Q.running_sum(spark.createDataFrame(rows, "k string, t timestamp_ntz, v int"), ["k"], ["t"], "v")
    assert sorted(((r.k, r.t, r.prev_v, r.running_v) for r in out.collect()), key=repr) == sorted(
        [(None, rows[0][1], None, 5), (None, rows[1][1], 5, 12), ("a", t, None, 5), ("a", rows[3][1], 5, 5), ("a", rows[4][1], None, 7), ("b", t, None, None)], key=repr)
    h = T.chain(spark.createDataFrame([(None, t, 1)], "k string, t timestamp_ntz, v int"), ["k"], "t", ["v"])
    _, actions = T.upsert(h, spark.createDataFrame([(None, 1)], "k string, v int"), ["k"], ["v"], t + dt.timedelta(days=1))
    assert [r.action for r in actions.collect()] == ["unchanged"]


def _boxes(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, page_id int, style_id int, x double, y double, w double, h double, text string")


def test_sieve_gap_rule_and_roles(spark):
    styles = spark.createDataFrame([(1, 1, "bold"), (1, 2, "normal"), (2, 1, "bold")],
                                   "doc_id long, style_id int, weight string")
    rows = [
        (1, 1, 1, 0.0, 0.0, 40.0, 10.0, "Title"),                     # line 1 -> header
        (1, 1, 2, 0.0, 12.0, 30.0, 10.0, "Apples"), (1, 1, 2, 39.0, 12.0, 30.0, 10.0, "1,234"),  # gap 9 > 8 -> split
        (1, 1, 2, 0.0, 24.0, 30.0, 10.0, "Pears"), (1, 1, 2, 37.9, 24.0, 30.0, 10.0, "green"),  # gap 7.9 -> merge
        (1, 1, 2, 80.0, 24.0, 40.0, 10.0, "2024-01-31"),
        (1, 1, 2, 0.0, 36.0, 20.0, 10.0, "USD"), (1, 1, 2, 40.0, 36.0, 30.0, 10.0, "$12.5"),
        (2, 1, 1, 1.0, 0.0, 1.0, 10.0, "a"), (2, 1, 1, 2.0, 0.0, 1.0, 10.0, "b"),  # grid doc
    ]
    members = D.members(spark.createDataFrame([("fruit", "pears green", [])], "domain_name string, label string, alt_labels array<string>"))
    cls = S.run(_boxes(spark, rows), styles, members)
    roles = {(r.doc_id, r.text): r.role for r in cls.collect()}
    assert roles[(1, "Title")] == "header"
    assert roles[(1, "1,234")] == "number" and roles[(1, "Apples")] == "text"
    assert roles[(1, "2024-01-31")] == "iso_date" and roles[(1, "USD")] == "code"
    assert roles[(1, "$12.5")] == "numeric"
    assert roles[(1, "Pears green")] == "domain:fruit"  # a label of two words matches as a whole
    grid = sorted((r.cid, r.text) for r in S.cells(S.lines(_boxes(spark, rows), styles)).filter("doc_id = 2").collect())
    assert grid == [(1, "a"), (2, "b")]
    summ = {r.doc_id: (r.total_cells, r.resolved_cells) for r in S.summary(cls).collect()}
    assert summ[2] == (2, 2)  # no numeric row -> body starts at line 1, short cells are codes


def test_equal_boxes_count_once_on_their_line(spark):
    schema = "doc_id long, page_id int, style_id int, weight string, x double, y double, w double, h double, text string"
    row = (1, 1, 1, "bold", 0.0, 12.0, 6.0, 10.0, "a")
    other = [(*row[:5], 12.1, *row[6:]), (*row[:3], "thin", *row[4:]), (*row[:8], None), (*row[:8], "b"), (1, 1, None, *row[3:]), (2, *row[1:])]  # each differs in one column
    boxes = spark.createDataFrame([row, *other, *other, row, row], schema).repartition(3)
    styles = boxes.select("doc_id", "style_id", "weight").distinct()
    listed = lambda lines: sorted((r.doc_id, r.rc, [tuple(b) for b in r.boxes]) for r in lines.collect())
    got = listed(S.lines(boxes, styles, once=True))
    assert got == listed(S.lines(boxes.distinct().drop("weight"), styles)) and [len(r[2]) for r in got] == [5, 1]
    assert [len(r[2]) for r in listed(S.lines(boxes.drop("weight"), styles))] == [11, 2]


def test_domain_probe_bounds(spark):
    mem = D.members(spark.createDataFrame([("c", "Réunion", ["REUNION", "Bourbon"]), ("c", "France", [])],
                                          "domain_name string, label string, alt_labels array<string>"))
    assert {r.key for r in mem.collect()} == {"reunion", "bourbon", "france"}
    vals = spark.createDataFrame([("t", "col", "reunion", 3), ("t", "col", "Spain", 1)],
                                 "table_name string, column_name string, value string, freq long")
    r = D.probe(vals, mem).first()
    assert (r.n_matches, r.containment, r.weighted_containment) == (1, 0.5, 0.75)
    assert 0 <= r.jaccard <= 1


def test_constraints_and_knn(spark):
    df = spark.createDataFrame([(i, "c%d" % (i % 3), str(i), [float(i), 1.0]) for i in range(1, 13)],
                               "key int, coll string, txt string, embedding array<float>")
    pred = E.constraint_predicate(df, {"coll": {"in": "c1"}, "txt": {"range": {"gte": "5"}}, "nope": {"in": [1]}})
    # text range is lexicographic: '10' < '5'
    assert sorted(r.key for r in df.filter(pred).collect()) == [7]
    q = spark.createDataFrame([([1.0, 1.0],)], "q array<double>")
    top = [r.key for r in E.knn(df, q, 3, "key").collect()]
    assert top == [1, 2, 3]
    best = E.best_per(df, q, "coll", 1, "key").collect()
    assert sorted(r.key for r in best) == [1, 2, 3]


def test_feed_touches_its_keys_files_only_and_compacts(spark, tmp_path, monkeypatch):
    from vellum.operators.sinks import TableSet

    schema, path, t = "k int, t timestamp_ntz, v string", str(tmp_path / "h"), dt.datetime(2024, 1, 1)
    files = lambda name: {f["path"] for f in TableSet(spark, path).manifest()["tables"][name]["files"]}
    rows = [(k, t + dt.timedelta(days=k % 3), f"v{k % 2}") for k in range(60)]
    for i in range(3):  # keys of a batch lie apart from those of the others
        H.apply_batch(spark, spark.createDataFrame(rows[20 * i:20 * i + 20], schema), i, path, ["k"], "t", ["v"])
    before = files("history")
    H.apply_batch(spark, spark.createDataFrame([(5, t + dt.timedelta(days=9), "w")], schema), 3, path, ["k"], "t", ["v"])
    assert len(before & files("history")) == len(before) - 1
    monkeypatch.setattr(H, "SMALL_FILES", 2)
    H.apply_batch(spark, spark.createDataFrame([(6, t + dt.timedelta(days=9), "w")], schema), 4, path, ["k"], "t", ["v"])
    assert len(files("observations")) == len(files("history")) == 1
    got = sorted(map(tuple, H.latest_history(spark, path).collect()), key=repr)
    want = T.chain(spark.createDataFrame([*rows, (5, t + dt.timedelta(days=9), "w"), (6, t + dt.timedelta(days=9), "w")], schema), ["k"], "t", ["v"], tiebreak=["v"])
    assert got == sorted(map(tuple, want.collect()), key=repr)


def test_words_of_long_lines_are_placed(spark):
    from vellum.plans import q_sieve

    lines = ["", " ", "a", " a  b ", "é " * 40 + "end", "x" * 9 + " yy" * 100 + "  "]
    df = spark.createDataFrame(list(enumerate(lines)), "li int, line string")
    got = sorted((r.li, r.k, r.o, r.word) for r in q_sieve.words_placed(df).collect())
    want = []
    for li, line in enumerate(lines):
        o = 0
        for k, w in enumerate(line.split(" ")):
            want.append((li, k, o, w))
            o += len(w) + 1
    assert got == sorted(want)


def test_boxes_of_lines_travel_once(spark):
    boxes = _boxes(spark, [(d, 1, 1, 10.0 * i, 12.0, 9.0, 10.0, "w") for d in (1, 2, None) for i in range(3)])
    styles = spark.createDataFrame([(1, 1, "bold"), (2, 1, "thin"), (None, 1, "bold")], "doc_id long, style_id int, weight string")
    lines = S.lines(boxes, styles)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in x and "style_id" not in x and "page_id" in x for x in plan.split("\n")) == 0
    assert plan.count("REPARTITION_BY_COL") == 1
    assert sorted((r.doc_id, r.rc, len(r.boxes)) for r in lines.collect()) == [(1, 1, 3), (2, 1, 3)]


def test_cells_of_a_line_are_made_once(spark):
    boxes = _boxes(spark, [(1, 1, 1, float(i), 12.0, 1.0, 10.0, "w%d" % i) for i in range(30)])
    cells = S.cells(S.lines(boxes, spark.createDataFrame([(1, 1, "bold")], "doc_id long, style_id int, weight string")))
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(sequence(") == 1
    assert [(r.cid, r.text) for r in cells.orderBy("cid").collect()] == [(i + 1, "w%d" % i) for i in range(30)]


def test_hashed_vectors_count_by_word(spark):
    rows = [(1, "a b  a C"), (None, None), (1, ""), (2, " x\ty z "), (3, "a " * 500)]
    df = E.hashed_vectors(spark.createDataFrame(rows, "k int, t string"), "k", F.col("t"), dim=7)
    assert "aggregate(" not in df._jdf.queryExecution().optimizedPlan().toString()  # no loop over places and words a row
    want = []
    for k, t in rows:
        v = [0.0] * 7
        for w in (t or "").lower().split():
            c = zlib.crc32(w.encode())
            v[c % 7] += 1.0 if c >> 16 & 1 else -1.0
        want.append((k, v))
    assert sorted(((r.key, list(r.embedding)) for r in df.collect()), key=repr) == sorted(want, key=repr)
