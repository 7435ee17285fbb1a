"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified distance.

A fingerprint has bit i set if over half of the document's shingle hashes have
it set. Fingerprints that differ in at most ``max_bits`` bits, cut into
``m > max_bits`` blocks, agree in ``m - max_bits`` of them; so each
fingerprint is filed under every choice of that many blocks, and only
fingerprints filed together are compared.

Documents with one fingerprint form one node, however many they are. Groups of
close but different fingerprints aren't expanded into all pairs either: each
block first links its members to one pivot; whoever is in one component by
then needs no further comparison, and the rest is compared across components
only, which loses no component.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, fresh, id_key, key_id
from vellum.llm.graph import components

#: Shingles that are hashed and counted at once: bounds memory on long texts.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit fingerprint of a whole text, unsigned; no words (or null): 0.

    A-Z is lower-cased; words are runs of bytes other than space and
    x09-x0D; fewer words than a shingle has make one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        to = min(n, at + CHUNK)
        hashes = np.fromiter(
            [digest(joined[a:b], seed) for a, b in zip(starts[at:to].tolist(), ends[at + k - 1:to + k - 1].tolist(), strict=True)],
            np.uint64, to - at)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprint_udf(shingle: int, seed: int):
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, shingle, seed) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))
    return of


def blocks_for(n: int, max_bits: int) -> int:
    """How many blocks: the fewest that leave a fingerprint a quarter of a chance partner among ``n``, so that what meets is mostly close."""
    for m in range(max_bits + 1, 17):
        if sum(n / 2 ** mask.bit_count() for mask in unsigned_masks(m, max_bits)) <= 0.25:
            return m
    return 16


def unsigned_masks(m: int, max_bits: int) -> list[int]:
    """A mask for each choice of ``m - max_bits`` of ``m`` blocks; the blocks' widths differ by one bit at most."""
    cuts = [64 * i // m for i in range(m + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(parts, m - max_bits)]


def block_masks(m: int, max_bits: int) -> list[int]:
    """``unsigned_masks`` as signed longs."""
    return [s - (1 << 64) if s >> 63 else s for s in unsigned_masks(m, max_bits)]


def filed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """Each row of ``fps(fp, ...)`` under each of its keys: ``key`` is the hash of a mask's number and bits.

    Two keys that are one by chance only file more rows together; distances are verified.
    """
    keys = [F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(masks)]
    return fps.select(F.explode(F.array(*keys)).alias("key"), *fps.columns)


def close(a: Column | str, b: Column | str, max_bits: int) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def link_roots(fps: DataFrame, max_bits: int, scratch: Scratch, pivot_turns: int = 4, blocks: int | None = None) -> DataFrame:
    """``fps(fp, n)``, distinct, to ``(fp, root)``: the components under distance <= ``max_bits``.

    A turn links each block's members to its pivot. Turns end when the pairs
    that are left across components are no more than twice the filed rows, or
    after ``pivot_turns``; the pairs left are then compared one by one, so the
    result doesn't depend on when that is.
    """
    masks = block_masks(blocks or blocks_for(fps.count(), max_bits), max_bits)
    links, roots = None, fps.select("fp", "n", F.col("fp").alias("root"))
    for turn in range(pivot_turns + 1):
        members = filed(roots, masks)
        # blocks that still hold several components
        open_ = members.groupBy("key").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"),
            F.max_by("fp", F.struct("n" if turn == 0 else F.lit(0), F.xxhash64(F.lit(turn), "fp"))).alias("pivot")).filter("lo <> hi")
        open_ = scratch.put(open_, f"open-{turn}")
        if turn:
            by_root = members.join(open_.select("key"), "key", "left_semi").groupBy("key", "root").agg(F.count("*").alias("c"))
            left = by_root.groupBy("key").agg(((F.sum("c") ** 2 - F.sum(F.col("c") ** 2)) / 2).alias("pairs")).agg(F.sum("pairs")).first()[0] or 0
            if turn == pivot_turns or left <= 2 * fps.count() * len(masks) ** 0.5:
                break
        star = members.join(open_, "key").filter((F.col("fp") != F.col("pivot")) & close("fp", "pivot", max_bits))
        star = star.select(F.col("fp").alias("a"), F.col("pivot").alias("b")).distinct()
        links = star if links is None else links.unionByName(star)
        links = scratch.put(links, f"star-{turn}")
        roots = _rooted(fps, components(links, scratch, f"cc-{turn}"))
    members = filed(roots, masks).join(open_.select("key"), "key", "left_semi")
    a, b = (members.select("key", F.col("fp").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab")
    rest = a.join(b, (a.key == b.key) & (a.a_root < b.b_root) & close(a.a, b.b, max_bits))
    # only what joins components matters: one link between any two
    rest = scratch.put(rest.groupBy("a_root", "b_root").agg(F.min("a").alias("a")).select(F.col("a_root").alias("a"), F.col("b_root").alias("b")), "rest")
    roots = roots.withColumnRenamed("root", "old")
    merged = components(rest, scratch, "cc-rest").withColumnRenamed("node", "old")
    return roots.join(merged, "old", "left").select("fp", F.coalesce("root", "old").alias("root"))


def _rooted(fps: DataFrame, found: DataFrame) -> DataFrame:
    return fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "n", F.coalesce("root", "fp").alias("root"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int, max_bits: int, blocks: int | None) -> DataFrame:
    """``(did, th, fp, first, first_th)`` per row: the group's first document is ``(first, first_th)``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = docs.select(id_key(F.col(id_col)).alias("did"), F.xxhash64(text_col).alias("th"), fingerprint_udf(shingle, seed)(F.col(text_col)).alias("fp"))
    marked = scratch.put(marked, "marked")
    fps = scratch.put(marked.groupBy("fp").agg(F.count("*").alias("n"), F.min(F.struct("did", "th")).alias("first")), "fps")
    roots = scratch.put(link_roots(fps.select("fp", "n"), max_bits, scratch, blocks=blocks), "roots")
    first = roots.join(fps.select("fp", "first"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    groups = roots.join(first, "root").select("fp", F.col("first.did").alias("first"), F.col("first.th").alias("first_th"))
    return marked.join(groups, "fp")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42,
                    max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``(id, fingerprint, component_id)``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` bits, the row's own included. Null and empty texts have
    fingerprint 0 and are linked like any other; a null id comes after all
    others, so a component is null only if all its ids are; repeated rows stay
    repeated; other columns are ignored; an empty table gives no rows.
    """
    return _grouped(docs, id_col, text_col, shingle, seed, max_bits, blocks).select(
        key_id(F.col("did")).alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), key_id(F.col("first")).alias("component_id"))


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42,
               max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """The whole row of the smallest id of each group of near duplicates: one row a group.

    Ids that are null come last; among rows of the smallest id one text is
    taken, and a row that is repeated as it is stays once.
    """
    stay = _grouped(docs, id_col, text_col, shingle, seed, max_bits, blocks).select(
        F.col("first").alias(own_did := fresh(docs, "did")), F.col("first_th").alias(own_th := fresh(docs, "th"))).distinct()
    key = [id_key(docs[id_col]), F.xxhash64(docs[text_col])]
    marked = docs.select("*", key[0].alias(own_did), key[1].alias(own_th))
    return marked.join(stay, [own_did, own_th], "left_semi").dropDuplicates([own_did, own_th]).select(*docs.columns)
