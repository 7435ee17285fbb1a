"""The corpus pipeline: documents to packed training sequences, a stage at a time.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's documents. All but the
last return the columns of ``documents``. Stages use their operators'
production parameters and see nothing but their input and, for
decontamination, the ``benchmark`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellum.llm.common import Scratch
from vellum.llm.decontaminate import keep_clean
from vellum.llm.langid import keep_known
from vellum.llm.lines import stripped
from vellum.llm.packing import pack
from vellum.llm.queries import byte_bpe_paths
from vellum.llm.simhash import keep_first
from vellum.sources.tables import table

#: SQL can't express the trained language model or the tokenizer; tests/llm holds run() against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: null, empty and letterless texts, and those
    whose best class has a probability under 0.3."""
    return keep_known(docs, min_score=0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal or near to an earlier line go out of the texts; every document stays, ``n_chars`` is counted anew."""
    return stripped(docs, min_chars=16)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each SimHash group stays."""
    return keep_first(docs, shingle=4, max_bits=4, seed=42)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 ids."""
    return pack(docs, byte_bpe_paths, size=1024, end_id=0)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("simhash_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table; what is between them is written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
