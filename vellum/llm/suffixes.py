"""Removal of repeated byte strings by a blockwise sparse suffix sort.

A byte goes if it is covered by a string of ``length`` bytes that also starts
in a document with a smaller id. Only the suffixes at a difference cover's
places are sorted: of any two equal strings of ``length`` bytes, some shift
below ``length - seed + 1`` brings both to a place of the cover, with ``seed``
bytes of the string still to come. (``cover="content"`` takes other places to
the same end: the least hash of as many neighbouring seeds.)

1. Suffix buckets: sample suffixes go to buckets by their first ``seed`` bytes
   and are sorted a bucket at a time. Long ties are not read on: each suffix
   carries a precomputed name of all the text within reach of the strings
   through its place. Suffixes that tie in the name too are repeats of the
   smallest document among them, and their whole reach goes.
2. The smallest of each name, if its seed has other names too, may be
   a repeat in part. Its strings are named one by one, and sorted in buckets
   of their own, the same way.
3. Each document's removed runs are united and its remaining bytes hashed.

A task combines what it has before it sends it: of equal names only the
smallest document travels, so a passage in a third of all documents is one row
a task. Buckets and blocks of documents are sized by the corpus' bytes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, id_key, key_id

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes of text that are hashed at once, at most, unless one document is longer.
CHUNK = 1 << 20
SENT, KNOWN = 0, 1  # rows for a bucket; replies that are known already


def squeeze(columns: dict[str, np.ndarray]) -> bytes:
    """Integer columns as one blob: by planes of bytes, so that high zero bytes cost nothing.

    Seeds, which come sorted, are sent as steps, and ends as lengths.
    """
    n = len(next(iter(columns.values())))
    columns = dict(columns)
    if "seed" in columns:
        columns["seed"] = np.diff(columns["seed"], prepend=U(0))
    if "high" in columns:
        columns["high"] = columns["high"] - columns["low"]
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(n, 8).T.tobytes() for c in columns.values()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def expand(blobs, names: list[str]) -> dict[str, np.ndarray]:
    parts = []
    for blob in blobs:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(blob)), np.uint8)
        part = raw.reshape(len(names), 8, -1).transpose(0, 2, 1).copy().view(np.uint64)[:, :, 0]
        if "seed" in names:
            part[names.index("seed")] = np.cumsum(part[names.index("seed")], dtype=np.uint64)
        if "high" in names:
            part[names.index("high")] += part[names.index("low")]
        parts.append(part)
    whole = np.concatenate(parts, axis=1) if parts else np.zeros((len(names), 0), np.uint64)
    return {c: whole[i] if c in ("seed", "name") else whole[i].view(np.int64) for i, c in enumerate(names)}


#: Tables that a worker builds once.
_BUILT: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    """A random number for each byte."""
    if "letters" not in _BUILT:
        _BUILT["letters"] = np.random.default_rng(23).integers(1, 2**64, 256, dtype=np.uint64)
    return _BUILT["letters"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i < n."""
    if len(_BUILT.get("up", ())) < n:
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            out = np.full(max(n, CHUNK + 1), U(b))
            out[0] = 1
            _BUILT[name] = np.cumprod(out, dtype=np.uint64)
    return _BUILT["up"][:n], _BUILT["down"][:n]


def mixed(h: np.ndarray, salt) -> np.ndarray:
    h = h ^ (np.asarray(salt).astype(np.uint64) * U(0xC2B2AE3D27D4EB4F))
    h = (h ^ (h >> U(31))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(29))


class Hashed:
    """Names of any of a byte string's substrings, from its prefix sums."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters()[data] * power[:-1], out=self.sums[1:])

    def name(self, a: np.ndarray, b: np.ndarray, salt=0) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.inverse[a], salt)


def sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over each run of w neighbours."""
    done = 1
    while done < w:
        step = min(done, w - done)
        x = f(x[:-step], x[step:])
        done += step
    return x


def difference_cover(v: int) -> np.ndarray:
    """Whether i is in the cover, for i < v: any two numbers have a shift below v that brings both into it, modulo v.

    The smallest there is for v <= 31; beyond, about twice the root of v numbers.
    """
    if f"cover{v}" not in _BUILT:
        root = int(np.ceil(np.sqrt(v)))
        cover = tuple(range(root)) + tuple(range(root, v, root))
        if v <= 31:
            every = (c for k in range(v) if k * (k + 1) + 1 >= v for c in itertools.combinations(range(1, v), k))
            cover = next((0, *c) for c in every if len({(a - b) % v for a in (0, *c) for b in (0, *c)}) == v)
        _BUILT[f"cover{v}"] = np.isin(np.arange(v), cover)
    return _BUILT[f"cover{v}"]


def cover_sample(data: np.ndarray, ends: np.ndarray, length: int, seed: int, cover: str) -> dict[str, np.ndarray]:
    """The sample of documents that lie end to end in ``data``: place, seed name, name of the reach, and the reach."""
    w, n = length - seed + 1, len(data)
    empty = {c: np.zeros(0, np.int64) for c in ("doc", "at", "low", "high", "seed", "name")}
    if n < length:
        return empty
    h = Hashed(data)
    starts = np.concatenate(([0], ends[:-1]))
    if cover == "difference":
        owner = np.repeat(np.arange(len(ends)), ends - starts)
        place = np.arange(n) - starts[owner]
        at = np.flatnonzero(difference_cover(w)[place % w] & (np.arange(n) + seed <= ends[owner]) & ((ends - starts)[owner] >= length))
        return _reached(h, at, h.name(at, at + seed), starts, ends, length, w)
    place = np.arange(n - seed + 1)
    seeds = h.name(place, place + seed) | U(1)  # never 0
    least = sliding(seeds, w, np.minimum)  # by the start of a string of ``length`` bytes
    inside = np.zeros(n + 1, np.int8)  # strings must not cross into the next document
    long_ = ends - starts >= length
    np.add.at(inside, starts[long_], 1)
    np.add.at(inside, ends[long_] - length + 1, -1)
    least[np.cumsum(inside[: len(least)]) == 0] = 0
    pad = np.zeros(w - 1, U)
    most = sliding(np.concatenate((pad, least, pad)), w, np.maximum)  # of the strings over each place
    at = np.flatnonzero(most == seeds)
    return _reached(h, at, seeds[at], starts, ends, length, w) if len(at) else empty


def _reached(h: Hashed, at: np.ndarray, seeds: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, w: int) -> dict[str, np.ndarray]:
    doc = np.searchsorted(ends, at, side="right")
    low, high = np.maximum(starts[doc], at - (w - 1)), np.minimum(ends[doc], at + length)
    return {"doc": doc, "at": at - starts[doc], "low": low - starts[doc], "high": high - starts[doc], "seed": seeds,
            "name": h.name(low, high, (at - low) * 128 + (high - at))}


def smallest(key: tuple[np.ndarray, ...], did: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by key and document: the order, where a key begins, and the smallest document of each row's key."""
    order = np.lexsort((did, *key[::-1]))
    first = np.zeros(len(order), bool)
    if len(order):
        first[0] = True
        for k in key:
            first[1:] |= k[order[1:]] != k[order[:-1]]
    return order, first, did[order][first][np.cumsum(first) - 1] if len(order) else did


def blob_rows(kind: int, key: np.ndarray, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """One row per key that occurs, with a blob of its rows."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    blobs = [squeeze({c: v[order[a:b]] for c, v in columns.items()}) for a, b in zip(cuts, [*cuts[1:], len(key)], strict=False)]
    return pd.DataFrame({"kind": np.int32(kind), "key": key[cuts].astype(np.int64), "blob": blobs})


BLOBS = "kind int, key long, blob binary"
SUFFIX = ["seed", "name", "did", "u", "low", "high"]
STRING = ["name", "did", "u", "low"]
REPLY = ["did", "u", "low", "high", "open"]


def block_of(did: np.ndarray, u: np.ndarray, n: int) -> np.ndarray:
    return (mixed(did.view(np.uint64), 3) ^ mixed(u.view(np.uint64), 5)) % U(n)


def replies(did, u, low, high, open_, blocks: int, kind: int = KNOWN) -> pd.DataFrame:
    return blob_rows(kind, block_of(did, u, blocks), {"did": did, "u": u, "low": low, "high": high, "open": open_})


def sample_rows(length: int, seed: int, cover: str, buckets: int, blocks: int):
    """Step 1 in the scan: the sample suffixes, combined, for their buckets; repeats within the task at once."""

    def flush(texts: list, dids: list, us: list) -> Iterator[pd.DataFrame]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        s = cover_sample(data, np.cumsum([len(t) for t in texts]), length, seed, cover)
        doc = s.pop("doc")
        did, u = np.array(dids, np.int64)[doc], np.array(us, np.int64)[doc]
        # half of a seed's bits choose the bucket, the others travel: seeds that agree in both by chance only share open places
        bucket = (s["seed"] >> U(32)) % U(buckets)
        s["seed"] &= U(0xFFFFFFFF)
        order, _, least = smallest((bucket, s["seed"], s["name"]), did)
        again = order[did[order] > least]
        yield replies(did[again], u[again], s["low"][again], s["high"][again], np.zeros(len(again), np.int64), blocks)
        keep = order[did[order] == least]
        yield blob_rows(SENT, bucket[keep], {"seed": s["seed"][keep], "name": s["name"][keep], "did": did[keep], "u": u[keep], "low": s["low"][keep], "high": s["high"][keep]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, dids, us, size = [], [], [], 0
        for batch in batches:
            for text, did, u in zip(batch["text"], batch["did"], batch["u"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                if len(data) < length:
                    continue
                texts.append(data), dids.append(did), us.append(u)
                size += len(data)
                if size >= CHUNK:
                    yield from flush(texts, dids, us)
                    texts, dids, us, size = [], [], [], 0
        if texts:
            yield from flush(texts, dids, us)
    return run


def suffix_bucket(blocks: int):
    """Step 1, one bucket: sort by seed, name and document."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iloc[0] == KNOWN:
            return pdf[["kind", "key", "blob"]]
        s = expand(pdf["blob"], SUFFIX)
        order, _, least = smallest((s["seed"], s["name"]), s["did"])
        s = {c: v[order] for c, v in s.items()}
        again = s["did"] > least
        # smallest documents of their name, by seed: several documents under one seed may share a part
        lead = ~again
        seeds, did = s["seed"][lead], s["did"][lead]
        cut = np.flatnonzero(np.r_[True, seeds[1:] != seeds[:-1]])
        size = np.diff(np.r_[cut, len(seeds)])
        several = np.repeat(np.minimum.reduceat(did, cut) < np.maximum.reduceat(did, cut), size)
        open_ = np.zeros(len(again), np.int64)
        open_[np.flatnonzero(lead)[several]] = 1
        out = np.flatnonzero(again | (open_ == 1))
        return replies(s["did"][out], s["u"][out], s["low"][out], s["high"][out], open_[out], blocks)
    return run


def string_rows(length: int, buckets: int, blocks: int):
    """Step 2, a block of documents: names of the strings in reach of its open places, combined."""

    def run(_key, docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        r = expand(found["blob"], REPLY)
        own = r["open"] == 1
        r = {c: v[own] for c, v in r.items()}
        texts = {(d, u): z for d, u, z in zip(docs["did"], docs["u"], docs["z"], strict=True)}
        order = np.lexsort((r["u"], r["did"]))
        cut = np.flatnonzero(np.r_[True, (np.diff(r["did"][order]) != 0) | (np.diff(r["u"][order]) != 0)]) if len(order) else []
        out = {c: [] for c in STRING}
        for a, b in zip(cut, [*cut[1:], len(order)], strict=False):
            rows = order[a:b]
            did, u = int(r["did"][rows[0]]), int(r["u"][rows[0]])
            h = Hashed(np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(texts[did, u])), np.uint8))
            size = r["high"][rows] - length + 1 - r["low"][rows]
            at = np.unique(np.repeat(r["low"][rows] - np.cumsum(size) + size, size) + np.arange(size.sum()))
            out["name"].append(h.name(at, at + length)), out["low"].append(at)
            out["did"].append(np.full(len(at), did)), out["u"].append(np.full(len(at), u))
        s = {c: np.concatenate(v) if v else np.zeros(0, np.uint64 if c == "name" else np.int64) for c, v in out.items()}
        order, _, least = smallest((s["name"],), s["did"])
        again, keep = order[s["did"][order] > least], order[s["did"][order] == least]
        known = replies(*merged(s["did"][again], s["u"][again], s["low"][again], s["low"][again] + length), blocks)
        return pd.concat([known, blob_rows(SENT, s["name"][keep] % U(buckets), {c: v[keep] for c, v in s.items()})])
    return run


def merged(did, u, low, high) -> tuple[np.ndarray, ...]:
    """Overlapping and touching runs of a document united; a column of zeros for ``open``."""
    if not len(did):
        return did, u, low, high, np.zeros(0, np.int64)
    order = np.lexsort((low, u, did))
    did, u, low, high = did[order], u[order], low[order], high[order]
    # the furthest end so far within a document: ends are raised by document, so one running maximum serves all
    doc = np.cumsum(np.r_[True, (np.diff(did) != 0) | (np.diff(u) != 0)]) - 1
    lift = doc * (int(high.max()) + 1)
    reach = np.maximum.accumulate(high + lift) - lift
    new = np.r_[True, (doc[1:] != doc[:-1]) | (low[1:] > reach[:-1])]
    cut = np.flatnonzero(new)
    return did[cut], u[cut], low[cut], reach[np.r_[cut[1:] - 1, len(did) - 1]], np.zeros(len(cut), np.int64)


def string_bucket(length: int, blocks: int):
    """Step 2, one bucket: sort by name and document."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iloc[0] == KNOWN:
            return pdf[["kind", "key", "blob"]]
        s = expand(pdf["blob"], STRING)
        order, _, least = smallest((s["name"],), s["did"])
        again = order[s["did"][order] > least]
        return replies(*merged(s["did"][again], s["u"][again], s["low"][again], s["low"][again] + length), blocks)
    return run


def final_rows(_key, docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    """Step 3, a block of documents: runs united, remaining bytes hashed."""
    r = expand(found["blob"], REPLY)
    own = r["open"] == 0
    did, u, low, high, _ = merged(*(r[c][own] for c in REPLY[:4]))
    runs: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for d, v, a, b in zip(did.tolist(), u.tolist(), low.tolist(), high.tolist(), strict=True):
        runs.setdefault((d, v), []).append((a, b))
    rows = []
    for d, v, z in zip(docs["did"], docs["u"], docs["z"], strict=True):
        data = zstandard.ZstdDecompressor().decompress(bytes(z)) if z else b""
        spans, at, kept = runs.get((d, v), []), 0, hashlib.sha256()
        for a, b in spans:
            kept.update(data[at:a])
            at = b
        kept.update(data[at:])
        rows.append((d, v, len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [x for s in spans for x in s]))
    return pd.DataFrame(rows, columns=["did", "u", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


FINAL = "did long, u long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, seed: int = 20, cover: str = "difference", share_bytes: int = 8_000_000) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` per row of ``docs``.

    ``spans``: start and end of each removed run, flattened. A null text is
    empty and loses nothing, as do texts under ``length`` bytes. A null id
    comes after all others; rows of one id never repeat each other, whatever
    their texts, and equal rows get the same result; other columns are
    ignored; an empty table gives no rows. ``share_bytes``: text per bucket.
    ``cover``: ``difference`` or ``content``; the result is the same.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(id_key(F.col(id_col)).alias("did"), text.alias("text"))
    several = rows.groupBy("did").agg(F.count("*").alias("c")).filter("c > 1").take(1)
    # ids that are no key: a document is an id and a text, taken once
    own = rows.withColumn("u", F.xxhash64("text") if several else F.lit(0).cast("long"))
    once = own.dropDuplicates(["did", "u"]) if several else own
    total = once.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = blocks = max(24, -(-total // share_bytes))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            did, u = batch["did"].to_numpy(np.int64), batch["u"].to_numpy(np.int64)
            z = [zstandard.ZstdCompressor(level=1).compress(t.encode("utf-8", "surrogatepass")) for t in batch["text"]]
            yield pd.DataFrame({"key": block_of(did, u, blocks).astype(np.int64), "did": did, "u": u, "z": z})

    texts = once.mapInPandas(packed, "key long, did long, u long, z binary")
    sent = once.mapInPandas(sample_rows(length, seed, cover, buckets, blocks), BLOBS)
    first = scratch.put(sent.groupBy("kind", "key").applyInPandas(suffix_bucket(blocks), BLOBS), "suffixes")
    strings = texts.groupBy("key").cogroup(first.groupBy("key")).applyInPandas(string_rows(length, buckets, blocks), BLOBS)
    second = scratch.put(strings.groupBy("kind", "key").applyInPandas(string_bucket(length, blocks), BLOBS), "strings")
    final = texts.groupBy("key").cogroup(first.unionByName(second).groupBy("key")).applyInPandas(final_rows, FINAL)
    if several:
        final = own.select("did", "u").join(final, ["did", "u"])
    return final.select(key_id(F.col("did")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
