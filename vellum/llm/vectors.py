"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine >= c are at squared distance <= 2 - 2c. Vectors are
rotated by a fixed random orthogonal matrix and split into blocks; a block of
k of d dimensions gets k/d of the distance, and two near vectors keep to it in
one block at least. Each block is joined on its own: within the radius, two
vectors lie in one cell or in neighbouring cells of the block's first
coordinate. Cells are split into tiles of bounded size, a tile's candidates
are those within the block's budget, and candidates are verified by their
cosine in double precision. A pair counts in the first block that finds it.

Equal vectors are one node with a weight. A tile returns sums of links and a
spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, id_key, key_id
from vellum.llm.graph import components

STRIP = 512  # rows of a tile that meet all others at once
PAIRS = 1 << 15  # candidates verified at once


def valid(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(d: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, d]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def blocks_of(d: int, block_dims: int) -> list[slice]:
    n = max(1, round(d / block_dims))
    cuts = [d * i // n for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def rotated(u: np.ndarray, seed: int = 11) -> np.ndarray:
    """Row by row in a fixed order of additions: a vector's coordinates are the same in every tile."""
    return np.einsum("ij,jk->ik", u, rotation(u.shape[1], seed))


def budgets(d: int, block_dims: int, cosine: float) -> list[float]:
    total = 2 - 2 * cosine + 1e-9
    return [total * (s.stop - s.start) / d for s in blocks_of(d, block_dims)]


def cells(r: np.ndarray, block_dims: int, cosine: float) -> np.ndarray:
    """Per vector and block, the cell: as wide as the block's radius."""
    d = r.shape[1]
    return np.stack([np.floor(r[:, s.start] / np.sqrt(b)).astype(np.int64) for s, b in zip(blocks_of(d, block_dims), budgets(d, block_dims, cosine), strict=True)], axis=1)


def matrices(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and values of the batch's vectors, by dimension."""
    dims = batch["vector"].map(len).to_numpy()
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        yield rows, np.stack(batch["vector"].to_numpy()[rows]).astype(np.float64)


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of i and j in ``label``, which holds roots."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label[:] = label[label]


def tile_join(block_dims: int, cosine: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["block"].iloc[0])
        # pdf's own tile: both sides are one
        pdf = pdf.sort_values(["side", "rid"], kind="stable")
        x = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        d = x.shape[1]
        u = unit(x)
        r, parts, budget = rotated(u), blocks_of(d, block_dims), budgets(d, block_dims, cosine)
        own = r[:, parts[k]].astype(np.float32)
        half = np.einsum("ij,ij->i", own, own)[:, None] / 2
        one = np.ones_like(half)
        left, right = np.hstack([own, -half, one]), np.hstack([own, one, -half])
        n_left = int((pdf["side"] == 0).sum())
        alone = n_left == len(pdf)
        weight, n = pdf["weight"].to_numpy(np.int64), len(pdf)
        links, label, start = np.zeros(n, np.int64), np.arange(n), 0 if alone else n_left
        for at in range(0, n_left, STRIP):
            close = left[at:min(at + STRIP, n_left)] @ right[start:].T >= -(budget[k] + 1e-5) / 2
            flat = np.flatnonzero(close)
            for lo in range(0, len(flat), PAIRS):
                i, j = np.divmod(flat[lo:lo + PAIRS], close.shape[1])
                i, j = i + at, j + start
                if alone:
                    i, j = i[i < j], j[i < j]
                gap = (r[i] - r[j]) ** 2
                near = [gap[:, s].sum(axis=1) <= b for s, b in zip(parts[: k + 1], budget, strict=False)]
                ok = near[k] & ~np.any(near[:k], axis=0) if k else near[k]
                i, j = i[ok], j[ok]
                ok = np.einsum("ij,ij->i", u[i], u[j]) >= cosine
                i, j = i[ok], j[ok]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                merge(label, i, j)
        rid, hit = pdf["rid"].to_numpy(), links > 0
        return pd.DataFrame({"rid": rid[hit], "links": links[hit], "root": rid[label[hit]]})
    return run


def link_vectors(vectors: DataFrame, cosine: float = 0.9, *, id_col: str = "vec_id", vector_col: str = "embedding", block_dims: int = 16, tile_rows: int = 8192) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row of ``vectors``.

    ``n_links``: other rows at cosine >= ``cosine``; ``component_id``: the
    smallest id reachable over links, the row's own included; ``kept``: the
    row has it. Vectors that are null, zero or hold a null or non-finite
    component link with nothing, nor do vectors of different lengths. Repeated
    rows are linked to each other; null ids come after all others and are kept
    only alone with such; other columns are ignored; no rows give no rows.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    rows = vectors.select(id_key(F.col(id_col)).alias("vid"), F.when(valid(F.col(vector_col)), F.col(vector_col)).alias("vector"))
    reps = rows.filter("vector is not null").groupBy("vector").agg(F.count("*").alias("weight"), F.min("vid").alias("first"))
    reps = scratch.put(reps.withColumn("rid", F.monotonically_increasing_id()), "reps")

    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, x in matrices(batch):
                c = cells(rotated(unit(x)), block_dims, cosine)
                for k in range(c.shape[1]):
                    cell, n = np.unique(c[:, k], return_counts=True)
                    yield pd.DataFrame({"d": x.shape[1], "block": k, "cell": cell, "n": n})

    # a unit vector's coordinate lies in -1..1: there are at most 2 / radius + 2 cells a block
    count = reps.select("vector").mapInPandas(sized, "d int, block int, cell long, n long").groupBy("d", "block", "cell").agg(F.sum("n").alias("n"))
    chunks = {(r["d"], r["block"], r["cell"]): -(-r["n"] // tile_rows) for r in count.collect()}

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rid, weight, vec = (batch[c].to_numpy() for c in ("rid", "weight", "vector"))
            mix = (rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for rows_, x in matrices(batch):
                d, c = x.shape[1], cells(rotated(unit(x)), block_dims, cosine)
                for k in range(c.shape[1]):
                    for cell in np.unique(c[:, k]):
                        at = rows_[c[:, k] == cell]
                        own = chunks[d, k, cell]
                        chunk = (mix[at] % np.uint64(own)).astype(np.int64)
                        sides = [(chunk, np.full(len(at), i), cell, cell, None) for i in range(own)]
                        sides += [(chunk, np.full(len(at), i), cell, cell + 1, 0) for i in range(chunks.get((d, k, cell + 1), 0))]
                        sides += [(np.full(len(at), i), chunk, cell - 1, cell, 1) for i in range(chunks.get((d, k, cell - 1), 0))]
                        for a, b, ca, cb, side in sides:
                            low, high, s = (np.minimum(a, b), np.maximum(a, b), (a > b).astype(np.int64)) if side is None else (a, b, np.full(len(at), side))
                            yield pd.DataFrame({"d": d, "block": k, "ca": ca, "cb": cb, "a": low, "b": high, "side": s, "rid": rid[at], "weight": weight[at], "vector": vec[at]})

    kind = reps.schema["vector"].dataType.simpleString()
    tiles = reps.select("rid", "weight", "vector").mapInPandas(dealt, f"d int, block int, ca long, cb long, a long, b long, side long, rid long, weight long, vector {kind}")
    found = tiles.groupBy("d", "block", "ca", "cb", "a", "b").applyInPandas(tile_join(block_dims, cosine), "rid long, links long, root long")
    found = scratch.put(found, "found")
    roots = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")), scratch).withColumnRenamed("node", "rid")
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    nodes = reps.join(links, "rid", "left").join(roots, "rid", "left").select("vector", "weight", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rid").alias("root"))
    nodes = scratch.put(nodes, "nodes")
    first = nodes.groupBy("root").agg(F.min("first").alias("component"))
    groups = nodes.join(first, "root").select("vector", (F.col("links") + F.col("weight") - 1).alias("links"), "component")
    out = rows.join(groups, "vector", "left").select("vid", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vid").alias("component"))
    return out.select(key_id(F.col("vid")).alias(id_col), "n_links", key_id(F.col("component")).alias("component_id"), (F.col("vid") == F.col("component")).alias("kept"))
