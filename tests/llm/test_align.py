"""Alignment of two tokenizers against a plain loop over the tokens, whole and cut into ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as files
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vellum.llm import align
from vellum.llm.queries import both_tokenizers

SCHEMA = "doc_id long, text string, PAIR int, batch string"


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(str(files.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(files.path("piece_bpe_32k.model")))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}

    def groups(text):
        """``[(A ids, B ids)]``, or None without tokens."""
        if not text:
            return None
        data = b" " + text.encode()
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ta = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        tb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ib, map(b.id_to_piece, ib), strict=True)]
        if b"".join(ta) != data or b"".join(tb) != data:
            return None
        ea, eb = np.cumsum([len(t) for t in ta]).tolist(), np.cumsum([len(t) for t in tb]).tolist()
        out, start = [], 0
        for end in sorted(set(ea) & set(eb)):
            out.append(([i for i, e in zip(ia, ea, strict=True) if start < e <= end], [i for i, e in zip(ib, eb, strict=True) if start < e <= end]))
            start = end
        return out

    return groups


def brute(rows, groups):
    all_groups = [groups(t) for _, t in rows]
    links = [Counter((a, b) for ga, gb in g or [] for a in ga for b in gb) for g in all_groups]
    n = Counter(p for c in links for p in c)
    top = {}
    for (a, _), v in n.items():
        top[a] = max(top.get(a, 0), v)
    out = []
    for (doc, _), g, c in zip(rows, all_groups, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out.append((doc, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(c.values()),
                    sum(t for p, t in c.items() if n[p] == top[p[0]]), sum(t * n[p] for p, t in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr), sorted((a, b, v, v == top[a]) for (a, b), v in n.items())


def some_texts(seed=0, n=40):
    rng = random.Random(seed)
    words = ["the", "Straße", "naïve", "日本語の", "🙂🙃", "don't", "x", "supercalifragilistic", "<|endoftext|>", "</s>", "123456", "=>", "é́", "ﬁ", "a-b_c"]
    gaps = [" "] * 8 + ["  ", "\n", " \n", "\t", "　", "\x1c", ""]
    made = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return [None, "", " ", "  lead", "trail ", "\x00", "a▁b", "aGVsbG8gd29ybGQ" * 30, "ab" * 1500, " " * 3000, *made, *made[:5]]


@pytest.mark.parametrize("size", [1 << 16, 64, 17])
def test_alignment_is_that_of_the_plain_loop(spark, plain, size):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(some_texts())]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA).repartition(3)
    docs, pairs = align.align(df, both_tokenizers, range_bytes=size)
    want_docs, want_pairs = brute(rows, plain)
    got = sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in docs.collect()), key=repr)
    assert got == want_docs
    assert sorted(map(tuple, pairs.collect())) == want_pairs


def test_ranges_cover_the_text_and_end_where_asked():
    data = (" " + "some words of text, with é and 日本 here " * 40 + "x" * 500 + " and more words" * 30).encode()
    got = list(align.ranges_of(data, 64))
    assert got[0][0] == 0 and got[-1][1] == len(data) and len(got) > 15
    assert all(b[0] == a[1] for a, b in zip(got, got[1:]))
    assert all(low <= start < stop <= high and data[low:low + 1] == b" " for start, stop, low, high in got)
    assert all(stop % 64 == 0 for _, stop, _, _ in got[:-1])


def test_composing_is_associative_and_has_a_neutral_fragment():
    tokens = align.Tokens(both_tokenizers())
    data = (" " + " ".join(t for t in some_texts(3) if t and "▁" not in t and "\x00" not in t)).encode()
    parts = [align.range_fragment(tokens, data[low:high], low, start, stop) for start, stop, low, high in align.ranges_of(data, 50)]
    assert len(parts) > 20 and any(not f.closed or len(f.suffix[0]) for f in parts)

    def told(f):
        return (f.ok, f.closed, [x.tolist() for x in (*f.prefix, *f.suffix, f.pairs, f.times)], ";".join(f.groups), f.n_a, f.n_b, f.n_groups, f.n_links)

    def fold(fs, rng):
        fs = list(fs)
        while len(fs) > 1:
            i = rng.randrange(len(fs) - 1)
            fs[i:i + 2] = [align.compose(fs[i], fs[i + 1])]
        return told(fs[0])

    whole = told(align.range_fragment(tokens, data, 0, 0, len(data)))
    assert all(fold([align.Fragment(), *parts, align.Fragment()], random.Random(s)) == whole for s in range(3))


def test_large_groups_count_from_distinct_ids(monkeypatch, spark, plain):
    monkeypatch.setattr(align, "GROUP_LINKS", 2)
    rows = [(i, t) for i, t in enumerate(some_texts(5, 15))]
    tokens, batch = align.Tokens(both_tokenizers()), align.Batch()
    align.add_texts(batch, tokens, [d for d, _ in rows], [t for _, t in rows])
    want, _ = brute(rows, plain)
    assert sorted([(*d[:5], d[5]) for d in batch.docs], key=repr) == sorted([(*w[:5], w[7]) for w in want], key=repr)
    for d, (_, t) in enumerate(rows):
        c = Counter((a, b) for ga, gb in plain(t) or [] for a in ga for b in gb)
        pairs, docs, times = batch.steps[0]
        assert {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(pairs[docs == d], times[docs == d], strict=True)} == dict(c)


def test_table_without_rows(spark):
    docs, pairs = align.align(spark.createDataFrame([], SCHEMA), both_tokenizers)
    assert docs.collect() == [] == pairs.collect()
