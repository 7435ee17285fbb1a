import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vellum.operators import sequence as Q
from vellum.operators import temporal as T


def ts(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


OBS_SCHEMA = "k string, t timestamp_ntz, v string, ord int"


def obs(spark, rows):
    return spark.createDataFrame(rows, OBS_SCHEMA)


def brute_chain(rows):
    """Reference implementation in plain Python."""
    last = {}
    for k, t, v, o in rows:
        if (k, t) not in last or o > last[(k, t)][1]:
            last[(k, t)] = (v, o)
    out = []
    for k in sorted({k for k, _ in last}):
        seq = sorted((t, v) for (kk, t), (v, _) in last.items() if kk == k)
        starts = [seq[0]] + [seq[i] for i in range(1, len(seq)) if seq[i][1] != seq[i - 1][1]]
        for i, (t, v) in enumerate(starts):
            out.append((k, v, t, starts[i + 1][0] if i + 1 < len(starts) else None))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_chain_collapses_and_orders(spark):
    rows = [("a", ts(3), "x", 1), ("a", ts(1), "x", 1), ("a", ts(2), "y", 1), ("a", ts(2), "z", 2),
            ("a", ts(5), "z", 1), ("b", ts(1), None, 1), ("b", ts(2), None, 1), ("b", ts(4), "q", 1)]
    got = T.chain(obs(spark, rows), ["k"], "t", ["v"], tiebreak=["ord"]).orderBy("k", "sys_from").collect()
    assert [tuple(r) for r in got] == brute_chain(rows)


def test_chain_bucket_boundaries_match_unbucketed(spark):
    rows = [("k", ts(h), "ab"[(h // 3) % 2], 0) for h in range(0, 60, 1)]
    for b in (3600, 7 * 3600, 86400 * 30):
        got = T.chain(obs(spark, rows), ["k"], "t", ["v"], bucket_seconds=b).orderBy("sys_from").collect()
        assert [tuple(r) for r in got] == brute_chain(rows)


@pytest.mark.parametrize("long", [0, 3, 1000])
def test_long_and_short_keys_give_the_same(spark, monkeypatch, long):
    monkeypatch.setattr(Q, "LONG_KEY", long)
    rng = random.Random(5)
    rows = [(k, ts(rng.randint(0, 40)) if rng.random() > 0.1 else None, rng.choice(["x", "y", None]), i) for k, n in (("a", 40), ("b", 3), (None, 9), ("c", 1)) for i in range(n)]
    rows += [("d", None, "x", 0), ("d", ts(1), "x", 1), ("d", ts(9), "y", 2)]  # one without a time is no version, and none before the next
    last = {(k, t): (v, o) for k, t, v, o in sorted(rows, key=lambda r: r[3]) if t is not None}
    want = []
    for k in ("a", "b", None, "c", "d"):
        seq = sorted(((t, v) for (kk, t), (v, _) in last.items() if kk == k), key=lambda p: p[0])
        kept = [p for i, p in enumerate(seq) if i == 0 or seq[i - 1][1] != p[1]]
        want += [(k, v, t, kept[i + 1][0] if i + 1 < len(kept) else None) for i, (t, v) in enumerate(kept)]
    chain = T.chain(obs(spark, rows), ["k"], "t", ["v"], tiebreak=["ord"], bucket_seconds=5 * 3600)
    assert sorted(map(tuple, chain.collect()), key=repr) == sorted(want, key=repr)
    timed = [r for r in rows if r[1] is not None]
    joined = T.as_of_join(obs(spark, timed), chain.select("k", "sys_from", F.col("sys_from").alias("since")), ["k"], "t", "sys_from", ["since"], bucket_seconds=5 * 3600)
    starts = [(k, t) for k, _, t, _ in want]
    assert sorted(((r.k, r.ord, r.since) for r in joined.collect()), key=repr) == sorted(((k, o, max((s for kk, s in starts if kk == k and s <= t), default=None)) for k, t, _, o in timed), key=repr)
    near = Q.neighbours(obs(spark, rows), ["k"], ["t", "ord"], ["ord", "v"], bucket_seconds=5 * 3600)
    total = Q.running_sum(obs(spark, rows), ["k"], ["t", "ord"], "ord", bucket_seconds=5 * 3600)
    got = {(r.k, r.ord): (r.prev_ord, r.prev_v, r.next_ord, r.next_v) for r in near.collect()}
    sums = {(r.k, r.ord): (r.prev_ord, r.running_ord) for r in total.collect()}
    for k in ("a", "b", None, "c", "d"):
        seq = sorted(((t is not None, t or ts(0), o, v) for kk, t, v, o in rows if kk == k), key=lambda r: r[:3])
        for i, (timed, _, o, _) in enumerate(seq):
            a, b = (seq[i - 1][2:] if i else (None, None)), (seq[i + 1][2:] if i + 1 < len(seq) and seq[i + 1][0] == timed else (None, None))
            assert got[k, o] == (*a, *b) and sums[k, o] == (a[0], sum(r[2] for r in seq[:i + 1]))


def test_short_keys_need_no_summary(spark):
    df = obs(spark, [("a", ts(i), str(i), i) for i in range(5)])
    plan = T.as_of_join(df, T.chain(df, ["k"], "t", ["v"], tiebreak=["ord"]), ["k"], "t", "sys_from", ["sys_to"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_upsert_rules_and_idempotence(spark):
    hist = spark.createDataFrame(
        [("a", "1", ts(0), None), ("b", "2", ts(0), None), ("c", "3", ts(0), ts(1)), ("c", "4", ts(1), None),
         ("n", None, ts(0), None)],
        "k string, v string, sys_from timestamp_ntz, sys_to timestamp_ntz")
    snap = spark.createDataFrame([("a", "1", 1), ("b", "9", 1), ("b", "8", 2), ("d", "5", 1), ("n", None, 1)],
                                 "k string, v string, o int")
    now = "2024-01-02 00:00:00"
    new, actions = T.upsert(hist, snap, ["k"], ["v"], now, ordinal="o")
    acts = {r.k: r.action for r in actions.collect()}
    assert acts == {"a": "unchanged", "b": "changed", "d": "new", "n": "unchanged"}
    cur = {r.k: r.v for r in T.current(new).collect()}
    assert cur == {"a": "1", "b": "8", "c": "4", "d": "5", "n": None}  # absent 'c' untouched
    assert T.integrity(new, ["k"]).count() == 0
    again, actions2 = T.upsert(new, snap, ["k"], ["v"], now, ordinal="o")
    assert {r.action for r in actions2.collect()} == {"unchanged"}
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, new.collect()), key=str)


def test_as_of_join_matches_brute_force(spark):
    versions = [("p", ts(0), 1.0), ("p", ts(5), 2.0), ("p", ts(9), 3.0), ("q", ts(4), 7.0)]
    events = [("p", ts(h), h) for h in range(0, 12)] + [("q", ts(h), 100 + h) for h in range(0, 8)]
    right = spark.createDataFrame(versions, "k string, sys_from timestamp_ntz, price double")
    left = spark.createDataFrame(events, "k string, t timestamp_ntz, id int")
    got = {r.id: r.price for r in T.as_of_join(left, right, ["k"], "t", "sys_from", ["price"],
                                                  bucket_seconds=2 * 3600).collect()}
    for k, t, i in events:
        cands = [(f, p) for kk, f, p in versions if kk == k and f <= t]
        assert got[i] == (max(cands)[1] if cands else None)


def test_snapshot_diff(spark):
    hist = spark.createDataFrame(
        [("a", "1", ts(0), ts(5)), ("a", "2", ts(5), None), ("b", "1", ts(0), ts(3)), ("c", "1", ts(4), None)],
        "k string, v string, sys_from timestamp_ntz, sys_to timestamp_ntz")
    d = {r.k: r.change for r in T.snapshot_diff(hist, ["k"], ["v"], ts(2), ts(6)).collect()}
    assert d == {"a": "changed", "b": "removed", "c": "added"}


def test_dedupe_last(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (2, 1, "z")], "k int, o int, v string")
    got = {r.k: r.v for r in T.dedupe_last(df, ["k"], ["o"]).collect()}
    assert got == {1: "y", 2: "z"}
    assert T.dedupe_last(df, ["k"], ["o"]).filter(F.col("k") == 1).count() == 1


def test_upsert_of_a_null_key_that_changes(spark):
    hist = spark.createDataFrame([(None, "a"), (1, "x"), (2, "y")], "k int, v string").selectExpr("k", "v", "timestamp_ntz'2024-01-01' AS sys_from", "CAST(NULL AS timestamp_ntz) AS sys_to")
    snap = spark.createDataFrame([(None, "b"), (1, "x"), (3, None)], "k int, v string")
    new, actions = T.upsert(hist, snap, ["k"], ["v"], "2024-02-01 00:00:00")
    assert sorted(((r.k, r.v, r.sys_to is None) for r in new.collect()), key=repr) == sorted([(None, "a", False), (None, "b", True), (1, "x", True), (2, "y", True), (3, None, True)], key=repr)
    assert T.integrity(new, ["k"]).count() == 0 and {r.action: r.n for r in T.action_counts(actions).collect()} == {"changed": 1, "unchanged": 1, "new": 1}
