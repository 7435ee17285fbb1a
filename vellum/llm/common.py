"""Helpers that the operators share: written intermediates and row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id wherever ids are ordered: it comes after every other id.
LAST_ID = 2**63 - 1


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster session without it is an error, since executors share no disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="vellum-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Scratch:
    """Tables written under the shared folder; they go when the session ends, or earlier by ``free``."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.root = spark, f"{scratch_dir(spark)}/vellum-{tag}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(path)
        self._fs.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: cuts lineage, survives lost executors."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def free(self, *names: str) -> None:
        for n in names:
            self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(n)), True)


def id_key(col: Column) -> Column:
    """An id that can be ordered and joined on: null becomes ``LAST_ID``."""
    return F.coalesce(col.cast("long"), F.lit(LAST_ID))


def key_id(col: Column) -> Column:
    """The inverse of ``id_key``."""
    return F.when(col != LAST_ID, col)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
