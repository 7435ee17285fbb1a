"""The operators against brute force, on small tables with nulls, ties, repeats, empty and clashing columns."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import decontaminate, langid, licenses, lines, packing, simhash, suffixes, urls, vectors, warc
from vellum.llm.queries import URL_RULES, byte_bpe_paths

DOCS = "doc_id long, text string"
LAST = 2**63 - 1


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def some_docs(seed=0, n=80):
    rng = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi".split()
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        t = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((rng.choice([i, i, i, None, 7]), rng.choice([None, "", " \t\n", "one", *[" ".join(t)] * 8])))
    return rows + rows[:5]


# -- 8: SimHash ---------------------------------------------------------------

def test_fingerprint_is_majority_of_shingle_hashes():
    import xxhash

    text = "The CAT sat\ton the  mat É"
    w = text.translate({i: i + 32 for i in range(65, 91)}).split()
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]), 42) for i in range(len(w) - 3)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert simhash.fingerprint(text) == bits
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest("a b", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    whole, simhash.CHUNK = simhash.fingerprint(text * 50), 16
    try:
        assert simhash.fingerprint(text * 50) == whole
    finally:
        simhash.CHUNK = 1 << 16


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_simhash_groups(spark, blocks):
    rows = some_docs()
    df = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, blocks=blocks).collect()), key=repr)
    fps = [simhash.fingerprint(t) for _, t in rows]
    root = roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])
    first = {}
    for (d, _), r in zip(rows, root, strict=True):
        first[r] = min(first.get(r, LAST), LAST if d is None else d)
    want = [(d, f"{f:016x}", None if first[r] == LAST else first[r]) for (d, _), f, r in zip(rows, fps, root, strict=True)]
    assert got == sorted(want, key=repr)


def test_simhash_keeps_one_row_a_group(spark):
    rows = some_docs(3)
    df = spark.createDataFrame(rows, DOCS).withColumn("did", F.col("doc_id"))
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    found = simhash.near_duplicates(kept)
    assert found.count() == found.select("fingerprint").distinct().count()
    fps = [simhash.fingerprint(t) for _, t in rows]
    assert kept.count() == len(set(roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])))
    assert simhash.keep_first(df.limit(0)).count() == 0


# -- 1: lines -----------------------------------------------------------------

def test_near_is_edit_distance_one():
    rng = random.Random(2)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    for _ in range(3000):
        a, b = ("".join(rng.choice("aé") for _ in range(rng.randint(0, 5))) for _ in range(2))
        assert lines.near(a, b) == (distance(a, b) <= 1), (a, b)


def test_line_dedup(spark):
    rng = random.Random(4)
    base = ["the quick brown fox jumps", "pack my box with five dozen", "short", "ünïcode líne of some length", "a" * 300]

    def line():
        x = rng.choice(base)
        if rng.random() < 0.5:
            i, c = rng.randrange(len(x) + 1), rng.choice("abé")
            x = rng.choice([x[:i] + c + x[i:], x[:i] + x[i + 1:], x[:i] + c + x[i + 1:], "  " + x.upper()])
        return x

    rows = [(rng.choice([i, i, None]), rng.choice([None, "", "\n\n"]) if rng.random() < 0.1 else "\n".join(line() for _ in range(rng.randint(1, 6)))) for i in range(70)]
    seen_ids = set()
    rows = [(d, t) for d, t in rows if d is None or not (d in seen_ids or seen_ids.add(d))]
    df = spark.createDataFrame(rows + rows[:3], DOCS).withColumn("near", F.lit(0)).withColumn("n_near", F.lit(0))
    out = lines.dedup_lines(df, min_chars=16)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_equal + r.n_near) for r in out.collect()), key=repr)
    # brute force: every line against all earlier ones; documents ordered by id, those without one last
    th = {r.text: r.h for r in spark.createDataFrame(rows, DOCS).select("text", F.xxhash64("text").alias("h")).collect()}
    docs = sorted(set(rows), key=lambda r: (LAST if r[0] is None else r[0], th[r[1]]))
    earlier, kept = [], {}
    for d, t in docs:
        own = (t or "").split("\n")
        flags = []
        for x in own:
            n = lines.normal(x)
            flags.append(bool(n) and any(n == e or (min(len(n), len(e)) >= 16 and lines.near(n, e)) for e in earlier))
            earlier += [n] if n else []
        kept[d, t] = (None if t is None else "\n".join(x for x, f in zip(own, flags, strict=True) if not f), 0 if t is None else len(own), sum(flags))
    assert got == sorted(((d, *kept[d, t]) for d, t in rows + rows[:3]), key=repr)
    assert sum(x[3] for x in got) > 20 and out.agg(F.sum("n_near")).first()[0] > 5
    assert lines.dedup_lines(df.limit(0)).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits, few", [(0, 256), (2, 256), (2, 0), (3, 6)])
def test_line_dedup_within_more_edits(spark, monkeypatch, edits, few):
    monkeypatch.setattr(lines, "FEW", few)
    rng = random.Random(edits)
    base = ["the quick brown fox", "jumps over 12 lazy dogs", "short", "ünïcode líne of it", "a" * 18]

    def line():
        x = rng.choice(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            i, c = rng.randrange(len(x) + 1), rng.choice("abé")
            x = rng.choice([x[:i] + c + x[i:], x[:i] + x[i + 1:], x[:i] + c + x[i + 1:], x[:i] + x[i:i + 2][::-1] + x[i + 2:]])
        return x

    texts = ["\n".join(line() for _ in range(rng.randint(1, 4))) for _ in range(40)]
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3), min_chars=16, edits=edits).collect()}
    earlier, near = [], 0
    for i, t in enumerate(texts):
        kept = []
        for x in t.split("\n"):
            n = lines.normal(x)
            gone = bool(n) and (n in earlier or any(min(len(n), len(e)) >= 16 and edit_distance(n, e) <= edits for e in earlier))
            near += gone and n not in earlier
            kept += [] if gone else [x]
            earlier += [n] if n else []
        assert got[i].text == "\n".join(kept), i
    assert sum(r.n_near for r in got.values()) == near and (near > 10) == (edits > 0)


# -- 9: language --------------------------------------------------------------

def test_language_id(spark):
    rng = random.Random(5)
    parts = {"aa": ["thing", "ing", "the", "wha"], "bb": ["ção", "não", "que", "ões"], "cc": ["ßen", "über", "sch", "ung"]}
    rows = [(i, " ".join("".join(rng.choice(parts[k]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 200))), k) for i in range(240) for k in [rng.choice(list(parts))]]
    odd = [(None, None, "aa"), (1000, "", None), (1001, "12 34 !!", "bb"), (1002, rows[0][1] * 300, None), (1002, rows[0][1] * 300, None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("s"))
    got = langid.identify(df).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: k for i, _, k in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (None, 1000, 1001)} == {("und", 0.0)}
    assert {r.lang_pred for r in got if r.doc_id == 1002} == {rows[0][2]}
    assert langid.keep_known(df).columns == df.columns and langid.keep_known(df).count() >= 240
    none = langid.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"} and langid.identify(df.limit(0)).count() == 0


def test_every_label_is_a_class(spark, monkeypatch):
    rows = [(4 * i + j, f"words of label {i} and row {j} " * 3, f"l{i:03}") for i in range(230) for j in range(4)]
    trained = []
    monkeypatch.setattr(langid.Network, "train", lambda self, x, y: trained.append(y))
    for plan in (langid.Plan(), langid.Plan(sample_docs=100)):
        net = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), plan)
        assert len(net.langs) == 230 and set(trained[-1]) == set(range(230))
    assert len(trained[1]) < len(trained[0])


def test_pooling_by_lookup_is_the_convolution():
    net = langid.Network(["a", "b"], langid.Plan(window=16))
    x = np.random.default_rng(0).integers(0, 256, (5, 16)).astype(np.uint8)
    e, hidden = net.embed[x], []
    for w, b in zip(net.w, net.b, strict=True):
        r = np.stack([np.einsum("nwe,wef->nf", e[:, i:i + len(w)], w) for i in range(16 - len(w) + 1)], 1)
        hidden.append(np.maximum(r.max(axis=1) + b, 0))
    want = langid.softmax(np.concatenate(hidden, 1) @ net.out + net.out_b)
    assert np.allclose(net.probabilities(x), want, atol=1e-5)


# -- 3: packing ---------------------------------------------------------------

def check_pieces(rows, texts, size):
    """Gapless sequences, every id in one piece, the right checksums. Returns the padding."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(byte_bpe_paths()[0])
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for d, t in texts.items():
        ids, at = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing(spark):
    rng = random.Random(6)
    texts = {i: " ".join(rng.choice(["foo", "bär", "\n", "x  y", "12", "it's"]) for _ in range(rng.randint(0, 400))) for i in range(120)}
    texts |= {200: None, 201: "", 202: "a<|endoftext|>b", 203: "z" * 9000, None: "no id", 204: " lead trail ", 205: "\u00a0é\u2003x" * 40}
    df = spark.createDataFrame(list(texts.items()), DOCS).withColumn("length", F.lit(1)).repartition(3)
    rows = packing.pack(df, byte_bpe_paths, size=256).collect()
    assert check_pieces(rows, texts, 256) == 0
    assert packing.pack(df.limit(0), byte_bpe_paths).count() == 0
    twice = packing.pack(df.filter("doc_id = 3").union(df.filter("doc_id = 3")), byte_bpe_paths).collect()
    assert sum(r.start == 0 for r in twice) == 2


def test_level_choice_is_the_least_sum_of_squares():
    rng = random.Random(8)
    p = packing.Packer(64)
    for _ in range(2000):
        n = rng.randint(1, 63)
        options = {}
        for h in [0, *(h for h in range(1, 64 - n + 1) if p.count[h])]:
            c = p.count.copy()
            c[h] -= h > 0
            if h + n < 64:
                c[h + n] += 1
            options[h] = int((c[1:64] ** 2).sum())
        assert options[p.level_for(n)] == min(options.values())
        p.add((0, 0, n, None, n))


# -- 2: decontamination -------------------------------------------------------

def test_decontamination(spark):
    rng = random.Random(9)
    vocabulary = ["w%d" % i for i in range(400)] + ["the", "of", "and"] * 60
    said = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = {i: f"{said(rng.randint(6, 25))}? {said(rng.randint(2, 8))}." for i in range(40)} | {40: said(500), 41: None, 42: ""}
    docs, truth = {}, {}
    for d in range(120):
        parts, truth[d] = [said(rng.randint(0, 150))], ""
        if rng.random() < 0.4:
            i = rng.randrange(41)
            parts += [items[i].upper() if rng.random() < 0.5 else items[i], said(30)]
            truth[d] = str(i)
        docs[d] = " ".join(parts)
    rows = [*docs.items(), (None, None), (900, ""), (901, items[3]), (901, items[3])]
    df = spark.createDataFrame(rows, DOCS).withColumn("hits", F.lit(1))
    it = spark.createDataFrame([*items.items(), (3, items[3])], "item_id long, text string")
    for rules in (decontaminate.Rules(), decontaminate.Rules(slice_items=7)):
        got = decontaminate.find_leaks(df, it, rules).collect()
        assert {r.doc_id: r.item_ids for r in got if r.doc_id in truth} == truth
        assert [r.item_ids for r in got if r.doc_id == 901] == ["3", "3"]
        assert {r.n_items for r in got if r.doc_id in (None, 900)} == {0}
    clean = decontaminate.keep_clean(df, it)
    assert clean.columns == df.columns and clean.count() == sum(not v for v in truth.values()) + 2
    assert decontaminate.find_leaks(df, it.limit(0)).filter("contaminated").count() == 0


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(10)
    rules = decontaminate.Rules(threshold=0.2)
    items = [" ".join(f"t{int(rng.paretovariate(0.4)) % 60}" for _ in range(rng.randint(3, 30))) for _ in range(90)]
    pieces = [p for i, t in enumerate(items) for p in decontaminate.pieces_of(i, t, rules.item_words)]
    df = {}
    for t in items:
        for w in set(t.split()):
            df[w] = df.get(w, 0) + 1
    index = decontaminate.Index(pieces, df, len(items), 15.0, rules)
    found = 0
    for _ in range(60):
        own = [f"t{rng.randrange(60)}" for _ in range(rng.randint(1, 90))]
        got = {}
        for _, terms in index.passages(own):
            for i, s in index.search(terms):
                got[i] = max(s, got.get(i, 0))
        want, half = {}, index.width // 2
        for c in range(0, len(own), half):
            terms = {index.terms[w] for w in own[c:c + 2 * half] if w in index.terms}
            score = np.zeros(len(pieces))
            for t in terms:
                score[index.post[t][0]] += index.post[t][1]
            for i in np.flatnonzero(score >= 0.2):
                want[i] = max(want.get(i, 0), score[i])
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)
        found += len(got)
    assert found > 50


# -- 4: WARC ------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(3)
    fake = f"{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = []
    for i in range(150):
        p = rng.choice(["", "x" * rng.randint(0, 300), fake * rng.randint(1, 30), "é" * 99 + fake, warc.MAGIC, warc.MAGIC * 50 + "WARC/1.1", None, "abc" + warc.EDGE + fake[:-6], "q" * 20000])
        rows.append((rng.choice([i, i, i, 5, None]), rng.choice([None, f"http://é/{i}\r\nx"]), p))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    path, old = str(tmp_path / "a"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    warc.write_archive(df, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = warc.read_archive(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    first = {}
    for i, _, p in rows:
        b = (p or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, LAST), i)
    want = []
    for i, _, p in rows:
        b = (p or "").encode()
        again = b in first and first[b] != i
        want.append((f"<urn:page:{'none' if i is None else i}>", f"<urn:page:{first[b]}>" if again else "", hashlib.sha256(b).hexdigest(), len(b)))
    assert sorted((r.record_id, r.refers_to, r.told_digest[7:], r.told_size) for r in got) == sorted(want)
    assert all(r.content_digest == r.told_digest[7:] and r.content_size == r.told_size for r in got if r.type == "response")
    warc.write_archive(df.limit(0), str(tmp_path / "b"))
    assert warc.read_archive(spark, str(tmp_path / "b")).count() == 0


# -- 5: vectors ---------------------------------------------------------------

def test_vectors(spark):
    rng = np.random.default_rng(0)
    base, odd = rng.normal(size=(6, 5)), [None, [0.0] * 5, [None] * 5, [float("nan")] * 5, [], [1.0, 2.0]]
    rows = [(None if i % 50 == 3 else i, odd[rng.integers(6)] if rng.random() < 0.2 else (base[i % 6] + rng.normal(size=5) * rng.choice([0, 0.05, 0.3])).tolist()) for i in range(240)]
    rows += rows[:15]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("weight", F.lit(0))
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = lambda a, b: len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9
    links = [(a, b) for a in range(len(rows)) for b in range(a) if ok[a] and ok[b] and near(rows[a][1], rows[b][1])]
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    root, first = roots(len(rows), links), {}
    for (i, _), r in zip(rows, root, strict=True):
        first[r] = min(first.get(r, LAST), LAST if i is None else i)
    want = sorted(((i, int(n), None if first[r] == LAST else first[r], first[r] == (LAST if i is None else i)) for (i, _), n, r in zip(rows, degree, root, strict=True)), key=repr)
    for tile in (40, 8192):
        got = vectors.link_vectors(df, tile_rows=tile, block_dims=2).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == want
    assert vectors.link_vectors(df.limit(0)).count() == 0


# -- 6: licences --------------------------------------------------------------

def test_licenses(spark):
    rng = random.Random(12)
    prose = lambda: " ".join(rng.choice("the of license software free use copyright and river stone public work general in to is".split()) for _ in range(rng.randint(3, 40)))
    families, rows, truth = list(licenses.TEMPLATES), [], {}
    for i in range(150):
        own = [prose() for _ in range(4)]
        if rng.random() < 0.4:
            f = rng.choice(families)
            own[2] = "Note: " + rng.choice(licenses.TEMPLATES[f]) + " (2021)"
            truth[i] = f"2:{f}"
        rows.append((i, "\n".join(own)))
    odd = [(None, None), (500, ""), (501, "\n \n"), (502, "word " * 20000 + licenses.TEMPLATES["MIT"][0])]
    df = spark.createDataFrame(rows + odd + odd, DOCS).withColumn("families", F.lit(1))
    got = licenses.scan_licenses(df).collect()
    right = sum(r.spans == truth.get(r.doc_id, "") for r in got if r.doc_id is not None and r.doc_id < 500)
    assert len(got) == 158 and right >= 147
    assert {r.n_paragraphs for r in got if r.doc_id in (None, 500, 501)} == {0}
    assert [r.families for r in got if r.doc_id == 502] == ["MIT", "MIT"]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


MIT_TEXT = """Copyright (c) 2021 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"""
BSD_TEXT = """/*
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 *
 * 1. Redistributions of source code must retain the above copyright
 */"""
GPL_TEXT = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
LGPL_TEXT = """dnl This library is free software; you can redistribute it and/or
dnl modify it under the terms of the GNU Lesser General Public
dnl License as published by the Free Software Foundation; either
dnl version 2.1 of the License, or (at your option) any later version."""


def test_licenses_in_wrapped_texts(spark):
    texts = [MIT_TEXT, BSD_TEXT, GPL_TEXT, LGPL_TEXT, "river stone\n" * 30]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert [got[i].spans for i in range(5)] == ["2-4:MIT", "1-3:BSD", "0-2:GPL", "0-2:LGPL", ""]
    assert [(got[i].n_paragraphs, got[i].n_licensed) for i in range(5)] == [(2, 1), (2, 1), (1, 1), (1, 1), (1, 0)]


def test_licenses_without_line_breaks(spark):
    mit, gpl, cc = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["GPL"][1], licenses.TEMPLATES["CC-BY-SA"][1]
    one = " ".join([mit, "river stone " * 2000, gpl, "stone " * 500, cc])
    got = licenses.scan_licenses(spark.createDataFrame([(0, one), (1, cc)], DOCS)).orderBy("doc_id").collect()
    assert got[0].families == "CC-BY-SA,GPL,MIT" and got[0].spans == "0:MIT,0:GPL,0:CC-BY-SA"
    assert (got[0].n_paragraphs, got[0].n_licensed) == (1, 1) and got[1].families == "CC-BY-SA"


# -- 7: URLs ------------------------------------------------------------------

def plain_rule(host, path):
    best = None
    for text in URL_RULES:
        r = urls.Rule.parse(text)
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.name) > len(best.name)):
            best = r
    return best


def test_urls(spark):
    rng = random.Random(13)
    rows = [(i, f"http{rng.choice(['', 's'])}://{rng.choice(['', 'WWW.', 'm.'])}{rng.choice(['aa', 'bb', 'example'])}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'es', 'de', 'fr'])}/{rng.randrange(3000)}{rng.choice(['', '?x=1', '#a/b'])}") for i in range(300)]
    rows += [(None, None), (1, ""), (2, "foo"), (3, "x://org"), (3, "x://org"), (4, "a://b://c.com/fr/#é"), (5, "x://com?/fr/"), (6, "x://Y.com/de/" + "z" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(0)).withColumn("score", F.lit(0))
    rules = [urls.Rule.parse(r) for r in URL_RULES]
    got = urls.judge_urls(df, rules, order=2).collect()
    want, texts = [], {}
    for i, u in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        place = rest.split("?")[0].split("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in place.split("/")[0])
        path = place[len(host):]
        rule = plain_rule(host, path)
        want.append((i, host, path, rule and rule.name, rule and rule.verdict))
        texts.setdefault(host + rest[len(host):] if u and "://" in u else (u or ""), rule and rule.verdict)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=repr) == sorted((w[:4] for w in want), key=repr)
    assert all(r.verdict == {w[3]: w[4] for w in want}[r.rule] for r in got if r.rule)
    # the scores, by a plain model over the same training URLs
    held = {r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").filter(F.pmod(F.xxhash64("t", F.lit("held")), F.lit(5)) == 0).collect()}
    counts = {"allow": {}, "block": {}}
    for t, v in texts.items():
        if v and t not in held:
            s = urls.START * 2 + t + urls.END
            for j in range(2, len(s)):
                for k in range(3):
                    for key in ((s[j - k:j], s[j]), (s[j - k:j],)):
                        counts[v][key] = counts[v].get(key, 0) + 1

    def chance(v, ctx, c):
        p = 1 / 256
        for k in range(3):
            own = ctx[2 - k:]
            p = (counts[v].get((own, c), 0) + 2.0 * p) / (counts[v].get((own,), 0) + 2.0)
        return p

    def plain_score(t):
        s = urls.START * 2 + t + urls.END
        return sum(np.log(chance("allow", s[j - 2:j], s[j])) - np.log(chance("block", s[j - 2:j], s[j])) for j in range(2, len(s))) / (len(t) + 1)

    text_of = {}
    for i, u in rows[10:300]:  # ids that no other row has
        rest = u.split("://", 1)[1]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest.split("?")[0].split("#")[0].split("/")[0])
        text_of[i] = host + rest[len(host):]
    open_rows = [r for r in got if r.page_id in text_of and not r.rule]
    assert len(open_rows) > 80
    for r in open_rows:
        assert abs(plain_score(text_of[r.page_id]) - r.score) < 1e-6
    # the verdicts are those of a cut with the least errors on the labelled texts left out
    told = [(plain_score(t), v) for t, v in texts.items() if v and t in held]
    n = {v: sum(x == v for _, x in told) for v in ("allow", "block")}
    assert min(n.values()) > 5
    cells = sorted({int(np.floor(s / 0.005)) for s, _ in told} | {max(int(np.floor(s / 0.005)) for s, _ in told) + 1})
    errors = {c: sum(v == "allow" and np.floor(s / 0.005) < c for s, v in told) / n["allow"] + sum(v == "block" and np.floor(s / 0.005) >= c for s, v in told) / n["block"] for c in cells}
    best = [c * 0.005 for c in cells if errors[c] == min(errors.values())]
    assert any(all(r.verdict == ("allow" if r.score >= cut else "block") for r in open_rows) for cut in best)
    assert {r.verdict for r in open_rows} <= {"allow", "block"}
    assert urls.judge_urls(df.limit(0), rules).count() == 0


# -- 10: repeated strings -----------------------------------------------------

def without_repeats(rows, length=50):
    first = {}
    docs = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in docs:
        for i in range(len(b) - length + 1):
            k = b[i:i + length]
            first[k] = min(first.get(k, LAST), d)
    out = []
    for (d, b), (given, _) in zip(docs, rows, strict=True):
        gone = np.zeros(len(b) + 1, np.int8)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = 1
        kept = np.frombuffer(b, np.uint8)[gone[: len(b)] == 0].tobytes()
        out.append((given, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_difference_cover():
    for v in (1, 2, 7, 31, 50):
        cover = np.flatnonzero(suffixes.difference_cover(v))
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert suffixes.difference_cover(31).sum() == 6


@pytest.mark.parametrize("repeated, cover", [(False, "difference"), (True, "difference"), (True, "content")])
def test_repeated_strings(spark, repeated, cover):
    rng = random.Random(1)
    shared = ["".join(rng.choice("ab é") for _ in range(rng.randint(10, 130))) for _ in range(8)] + ["z" * 70, "yx" * 60]
    rows = []
    for i in range(150):
        t = "".join(rng.choice(shared + ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 60)))] * 2) for _ in range(rng.randint(1, 12)))
        rows.append((i, rng.choice([None, "", "x" * rng.randint(0, 200)]) if rng.random() < 0.1 else t))
    if repeated:
        rows += [(rng.choice([None, 3, 5]), rng.choice(rows)[1]) for _ in range(40)]
    df = spark.createDataFrame(rows, DOCS).withColumn("low", F.lit(0)).repartition(4)
    got = suffixes.remove_repeats(df, cover=cover, share_bytes=5000).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == without_repeats(rows)
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


# -- letters, headers -----------------------------------------------------------

def test_letters_are_letters():
    assert [langid.has_letter(t) for t in ("½ ² ① Ⅷ", "", "12_3", "② b", "日", "ʰ", "é")] == [False, False, False, True, True, True, True]


def test_records_have_the_mandatory_headers(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200), (None, None, None)], "page_id long, url string, html string")
    warc.write_archive(pages.withColumn("seen", F.timestamp_seconds(F.lit(86400))).withColumn("date", F.lit(1)), str(tmp_path / "a"), date_col="seen")
    heads = [r.value.split("\r\n\r\n")[0].split("\r\n") for r in spark.read.option("lineSep", "WARC/1.1\r\n").text(str(tmp_path / "a")).collect() if r.value]
    named = [dict(h.split(": ", 1) for h in head) for head in heads]
    assert len(named) == 3
    assert all({"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(h) and h["WARC-Date"] == "1970-01-02T00:00:00Z" for h in named)
    assert [h["WARC-Profile"] for h in named if h["WARC-Type"] == "revisit"] == [warc.REVISIT_PROFILE]
