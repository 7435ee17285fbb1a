"""Chat formatting: fingerprints by brute force, every layout, exact round trips, odd records."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from vellum.llm import chat
from vellum.llm.queries import chat_records

U, A = ("user", "hi <turn> there"), ("assistant", "\\### </turn>\n ok")
RECORDS = {
    "messages": {"messages": [{"role": r, "content": t} for r, t in (U, A)]},
    "message_parts": {"messages": [{"role": r, "content": [{"type": "text", "text": t[:4]}, {"type": "text", "text": t[4:]}]} for r, t in (U, A)]},
    "from_value": {"conversations": [{"from": {"user": "human", "assistant": "gpt"}[r], "value": t} for r, t in (U, A)], "id": 4},
    "nested_dialog": {"data": {"dialog": [{"speaker": r, "utterance": t} for r, t in (U, A)], "lang": "en"}},
    "prompt_completion": {"completion": A[1], "prompt": U[1]},
    "question_answer": {"question": U[1], "answer": A[1]},
    "instruction_output": {"instruction": U[1], "input": "", "output": A[1]},
}


def paths_of(v, at=""):
    """The paths of a parsed record, without arrays of several kinds."""
    if isinstance(v, dict):
        return {p for k, x in v.items() for p in paths_of(x, f"{at}.{k}" if at else k)}
    if isinstance(v, list):
        return {p for x in v if x is not None for p in paths_of(x, at + "[]")} or {at + "[]"}
    return {at}


def run(spark, records, **kw):
    rows = [(i, r if r is None or isinstance(r, str) else json.dumps(r), "x") for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "id long, record string, _variant string").withColumn("Turns", F.lit(1)).drop("Turns")
    return {r.id: r for r in chat.read_back(chat.format_chats(df, **kw)).collect()}


def test_every_layout_gives_the_same_turns(spark):
    got = run(spark, RECORDS.values())
    for i, name in enumerate(RECORDS):
        assert got[i].layout == name and got[i].fingerprint == chat.fingerprint(paths_of(list(RECORDS.values())[i]))
        assert [tuple(t) for t in got[i].turns] == [U, A] == [tuple(t) for t in got[i].read_turns]
        assert got[i].read_loss == [A[1]] and got[i]._variant == "x"


def test_fingerprints_of_odd_records(spark):
    records = [{"a b": {"c.d": 1, "`q": [[1]]}, "z": [{"x": None}, {"y": 2.5}]}, {"é": [], "1": True}, [1, 2], "s", 7, {}, {"m": [{"a": 1}, "x"]}]
    got = run(spark, records)
    want = [chat.fingerprint(paths_of(r)) for r in records[:3]] + [chat.fingerprint([""])] * 2 + [chat.fingerprint([]), chat.fingerprint(["m[]?"])]
    got_all = [got[i].fingerprint for i in range(len(records))]
    assert got_all[:3] == want[:3] and got_all[5:] == want[5:]
    assert all(got[i].layout is None and got[i].turns is None and got[i].formatted is None for i in got)


def test_empty_null_and_broken_records(spark):
    records = [None, "", "{", '{"prompt": "a", "prompt": "b"}', {"messages": []}, {"messages": None}, {"messages": [None, {"role": "user", "content": None}]},
               {"messages": [{"role": "user", "content": []}, {"role": None, "content": [{"text": "x"}, {"text": None}, {"text": "y"}]}]},
               {"question": "q", "answer": None, "system": ""}, {"instruction": "", "output": "o"}, {"prompt": 3, "completion": 4.5}]
    got = run(spark, records)
    turns = {i: None if got[i].turns is None else [tuple(t) for t in got[i].turns] for i in got}
    assert [turns[i] for i in range(4)] == [None] * 4
    assert turns[4] == turns[5] == [] and got[4].formatted == "" and got[4].read_turns == []
    assert turns[6] == [("user", "")] and turns[7] == [("user", ""), ("", "xy")]
    assert turns[8] == [("user", "q"), ("assistant", "")] and got[8].read_loss == [""]
    assert turns[9] == [("user", ""), ("assistant", "o")] and turns[10] == [("user", "3"), ("assistant", "4.5")]
    assert all([tuple(t) for t in got[i].read_turns] == turns[i] for i in got if turns[i] is not None)


def test_round_trip_of_control_strings_and_spans(spark):
    rng = random.Random(5)
    piece = ["<turn>", "</turn>", "</turn>\n", "<\\turn", "<\\\\/turn", "<", "\\", "turn", "\n", "é", "🙂", "", "</tur", "/turn>", "a"]
    texts = ["".join(rng.choice(piece) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    roles = ["user", "assistant", "to\nol <turn>", "", "système+%"]
    records = [{"messages": [{"role": rng.choice(roles), "content": t} for t in texts[i:i + 8]]} for i in range(0, 400, 8)]
    records.append({"messages": [{"role": "assistant", "content": "<turn \\" * 100_000}]})
    for i, r in run(spark, records).items():
        want = [(m["role"], m["content"]) for m in records[i]["messages"]]
        assert [tuple(t) for t in r.read_turns] == want and r.read_loss == [t for role, t in want if role == "assistant"]
        assert r.formatted.count("</turn>\n") == len(want) == r.formatted.count("<turn>")
        for m, loss in zip(r.loss_mask, r.read_loss, strict=True):
            assert r.formatted[m.start:m.stop].replace("<\\", "<", 1).count("turn") == loss.count("turn")
            assert r.formatted[:m.start].endswith("<turn>assistant\n") and r.formatted[m.stop:].startswith("</turn>\n")


def test_tables_without_rows_and_layouts_that_clash(spark):
    assert run(spark, []) == {}
    with pytest.raises(ValueError):
        chat.to_turns(spark.createDataFrame([], "record string"), [chat.Layout("a", each="m"), chat.Layout("b", each="m")])


def test_records_of_conversations(spark):
    rng = random.Random(6)
    rows = []
    for c in [*range(60), None]:
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant"] * 3, ["tool", "user"], ["assistant"], [None, "user"]])
        rows += [(c, t, role, rng.choice([None, "", "a", "</turn> b", "c\nd"])) for t, role in enumerate(roles)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat_records(df))).collect()}
    assert len(got) == 61 and len({r.layout for r in got.values()} - {None}) >= 5
    for c, r in got.items():
        want = [(role or "", text or "") for _, _, role, text in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert [tuple(t) for t in r.read_turns] == want, r.layout
    digest = hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
    assert len(digest) == 64
