"""Observation feed -> transaction-time history, continuously.

A Structured Streaming file source of observations is applied per micro-batch
with ``foreachBatch``. Observations and history are two tables of one
:class:`~vellum.operators.sinks.TableSet`: a batch adds its observations to
new files, rebuilds the history of the keys that it holds from all their
observations (T3), so an observation lands in the right place however late it
comes, and replaces these keys' rows. Files are kept in key order, so a batch
reads and rewrites only files whose range meets its keys. One manifest makes
both tables visible and notes the batch, so a lost executor or a restarted
query never applies a batch twice. Of two values of one key at one instant the
larger one holds, in whatever order they come.

Observations that say nothing new (their version begins earlier and goes on)
stay, since a later one may split it; files are compacted as they grow in
number. Paths and the checkpoint folder must be on shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators import temporal as T
from vellum.operators.sinks import TableSet, compact, files_that_may_hold, replace_rows

SMALL_FILES = 64  # so many files are compacted, those of under a quarter of the rows that a file may have


def latest_history(spark: SparkSession, history_path: str) -> DataFrame | None:
    """The history as the newest batch left it; None before the first batch."""
    tables = TableSet(spark, history_path)
    return tables.read("history") if "history" in tables.manifest()["tables"] else None


def apply_batch(spark: SparkSession, batch: DataFrame, batch_id: int, history_path: str,
                keys: Sequence[str], ts: str, tracked: Sequence[str]) -> None:
    keys, tracked = list(keys), list(tracked)
    tables = TableSet(spark, history_path)
    obs = batch.select(*keys, F.col(ts).alias(T.SYS_FROM), *tracked).distinct()
    if not tables.manifest()["tables"]:
        none = obs.limit(0)
        tables.create({"observations": (none, keys[0]), "history": (T.chain(none, keys, T.SYS_FROM, tracked, tiebreak=tracked), keys[0])})
    before = tables.manifest()
    if before["tables"]["observations"].get("batch", -1) >= batch_id:
        return
    new = tables.kept(obs, "observations")
    touched = tables.kept(new.select(keys[0]).distinct(), "touched")
    staged = tables.stage("observations", new, keys[0])
    known = before["tables"]["observations"]
    own = {**known, "files": known["files"] + staged["files"], "batch": batch_id}
    changed = {"observations": own}
    if staged["files"]:
        stored = tables.read("observations", {"tables": {"observations": own}}, files_that_may_hold(own, touched))
        mine = stored.alias("a").join(touched.alias("b"), F.col(f"a.{keys[0]}").eqNullSafe(F.col(f"b.{keys[0]}")), "left_semi")
        rebuilt = T.chain(mine, keys, T.SYS_FROM, tracked, tiebreak=tracked)
        changed["history"] = replace_rows(tables, before, "history", touched, keys[0], rebuilt)
    tables.commit(before, changed)
    for name in changed:
        if len(tables.manifest()["tables"][name]["files"]) > SMALL_FILES:
            compact(tables, name, tables.rows_per_file // 4)


def start(spark: SparkSession, source_dir: str, schema: str, history_path: str, checkpoint: str,
          keys: Sequence[str], ts: str, tracked: Sequence[str], available_now: bool = True):
    """Start the feed; returns the ``StreamingQuery``."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    w = (src.writeStream
            .foreachBatch(lambda df, bid: apply_batch(spark, df, bid, history_path, keys, ts, tracked))
            .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
