"""Whitening of embeddings by blockwise QR and the qd solver of :mod:`vellum.llm.bidiagonal`.

Three passes over the vectors. The first sums the integer vectors exactly; the
second reduces each task's centred rows to one triangular factor, and the
factors meet in a tree, ``FAN`` at a time, so what reaches the driver is one
``d x d`` factor whatever the number of rows; the third projects each row on
the directions found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.bidiagonal import right_vectors
from vellum.llm.common import Scratch

FAN = 64
#: Larger entries stand for this.
MOST = 2**62
SAFE = 2**62


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: rows, their exact sums, and the directions with their eigenvalues (falling)."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float


def usable(vector: Column) -> Column:
    """Has entries, and all are finite numbers."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def integers(flat: np.ndarray, scale: int, offset: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * flat), -MOST, MOST).astype(np.int64) + offset


def matrices(column: pa.Array, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The batch's integer vectors by their length: ``(rows, matrix)``."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = integers(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), scale, offset)
    ends = np.cumsum(sizes)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat.reshape(-1, d) if len(rows) == len(sizes) else flat[(ends[rows] - d)[:, None] + np.arange(d)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exact: as long where that holds it, else as Python integers."""
    if n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums)) < SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(dev: np.ndarray) -> list[int | None]:
    """Each row's sum of squares, exact; null beyond a long."""
    if dev.dtype != object and float(np.abs(dev).max()) ** 2 * dev.shape[1] < SAFE:
        return (dev * dev).sum(axis=1).tolist()
    got = (dev.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in got]


def triangle(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


def fit(vectors: DataFrame, components: int = 8, *, scale: int = 1024, offset: int = 100000, id_col: str = "vec_id",
        vector_col: str = "embedding") -> Whitening | None:
    """Mean and the leading eigenvectors of the covariance (divisor ``n``) of ``floor(scale c) + offset``.

    Rows whose vector is null, empty, or holds null or non-finite entries
    are left out, and so are vectors of another length than the most common
    one (of ties the longest). None if nothing is left. Entries beyond 2^62
    stand for that. Directions without variance are left out, so there may
    be fewer than ``components``. Repeated rows count each.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = vectors.select(F.col(vector_col).cast("array<double>").alias("c")).where(usable(F.col("c")))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, x in matrices(batch.column(0), scale, offset):
                d = x.shape[1]
                small = max(abs(int(x.max())), abs(int(x.min()))) * len(x) < SAFE
                n[d] = n.get(d, 0) + len(rows)
                total[d] = total.get(d, 0) + (x if small else x.astype(object)).sum(axis=0).astype(object)
        for d in n:
            yield pa.RecordBatch.from_pydict({"d": [d] * d, "place": range(d), "n": [n[d]] * d, "total": [str(v) for v in total[d]]})

    parts = scratch.put(rows.mapInArrow(moments, "d long, place long, n long, total string"), "moments")
    common = parts.where("place = 0").groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return None
    d, n = int(common.d), int(common.n)
    exact = parts.where(F.col("d") == d).groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = [int(r.total) for r in exact.orderBy("place").collect()]  # d of them

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for _, x in matrices(batch.column(0), scale, offset):
                r = triangle(r, (deviations(x, n, sums) / n).astype(np.float64))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"at": [TaskContext.get().partitionId()], "r": [r.tobytes()]})

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        r = None
        for b in group.sort_values("at")["r"]:
            r = triangle(r, np.frombuffer(b).reshape(-1, d))
        return pd.DataFrame({"at": [int(group["at"].iloc[0]) // FAN], "r": [r.tobytes()]})

    tree = scratch.put(rows.where(F.size("c") == d).mapInArrow(factors, "at long, r binary"), "factors0")
    level = 0
    while tree.agg(F.count("at")).first()[0] > 1:
        level += 1
        tree = scratch.put(tree.groupBy(F.floor(F.col("at") / FAN)).applyInPandas(meet, "at long, r binary"), f"factors{level}")
    r = np.frombuffer(tree.first().r).reshape(-1, d)
    r = np.vstack([r, np.zeros((d - len(r), d))])
    values, directions = right_vectors(r, components)
    return Whitening(n, sums, values[:len(directions)] / n, directions, float(math.fsum(values)) / n)


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 8, *, scale: int = 1024, offset: int = 100000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row of ``vectors`` and component: the row's whitened coordinate (see ``fit`` for which rows remain).

    ``deviation`` is the sum of ``(n x - S)^2``, null beyond a long;
    ``explained`` the eigenvalue's share of the trace; ``identity_error`` the
    largest absolute entry of the whitened coordinates' covariance less the
    identity. Null ids are kept, repeated rows stay, other columns are
    ignored; an empty table, or rows without variance, give no rows.
    """
    spark = vectors.sparkSession
    model = fit(vectors, components, scale=scale, offset=offset, id_col=id_col, vector_col=vector_col)
    if model is None or not len(model.values):
        return spark.createDataFrame([], SCHEMA)
    n, sums, d, k = model.n, model.sums, len(model.sums), len(model.values)
    onto = model.directions.T / np.sqrt(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch.column(1), scale, offset):
                dev = deviations(x, n, sums)
                w = (dev / n).astype(np.float64) @ onto
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), pa.array(squares(dev), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, k), pa.int32()), pa.array(w.ravel()))],
                    names=["vec_id", "deviation", "w"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c"))
    rows = rows.where(usable(F.col("c")) & (F.size("c") == d))
    done = Scratch(spark, "whitened").put(rows.mapInArrow(project, "vec_id long, deviation long, w array<double>"), "rows")
    # The mean of n x - S is zero to the last digit, so the coordinates are centred as they are.
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    cov = done.agg(*[(F.sum(F.col("w")[i] * F.col("w")[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(cov, pairs, strict=True))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return done.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"))
