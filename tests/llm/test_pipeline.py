"""The pipeline against plain Python, stage by stage, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from tests.llm.test_operators import check_pieces, roots
from vellum.llm import decontaminate, langid, lines, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
def test_run_is_the_plain_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = {r.doc_id for r in langid.identify(docs).collect() if r.lang_pred != "und" and r.score >= 0.3}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in known}
    seen, earlier = set(), {}
    for d in sorted(texts):
        kept = []
        for x in texts[d].split("\n"):
            n = lines.normal(x)
            near = [e for k in (-1, 0, 1) for e in earlier.get(len(n) + k, ()) if min(len(n), len(e)) >= 16]
            if not n or (n not in seen and not any(lines.near(n, e) for e in near)):
                kept.append(x)
            if n and n not in seen:
                seen.add(n)
                earlier.setdefault(len(n), []).append(n)
        texts[d] = "\n".join(kept)
    ids = sorted(texts)
    fps = [simhash.fingerprint(texts[d]) for d in ids]
    root = roots(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])
    texts = {min(d for d, r in zip(ids, root, strict=True) if r == k): None for k in set(root)} | {d: texts[d] for d in {min(x for x, r in zip(ids, root, strict=True) if r == k) for k in set(root)}}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    own = {i: set(zip(w, w[1:], strict=False)) for i, w in ((i, decontaminate.words(t)) for i, t in items.items())}

    def leaked(t):
        w = decontaminate.words(t)
        have = set(zip(w, w[1:], strict=False))
        return any(len(p & have) >= 0.9 * len(p) for p in own.values())

    texts = {d: t for d, t in texts.items() if not leaked(t)}
    assert check_pieces(corpus_pipeline.run(spark, SF).collect(), texts, 1024) == 0


def test_stages_take_odd_tables(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 30000, "en", None, 5), (3, "Just a line of text\nand one more line here", None, "s", None)]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS did", "2 AS fp", "3 AS hits", "4 AS near")
    for docs in (base, base.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            out.collect()
            docs = docs if name == "packing" else out
