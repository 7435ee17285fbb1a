"""Transaction-time history (SCD2): chains, upserts, as-of views and joins.

A history table holds one row per version of a key with the interval
``[sys_from, sys_to)``; ``sys_to`` NULL marks the current version.

Rules kept from the behaviour being matched:

* an unchanged observation is skipped; a changed one closes the current row
  at ``now`` and inserts a new current row; a new key is inserted;
* a key missing from a snapshot is left untouched (absence never closes);
* within one snapshot the last copy of a key wins (no zero-length versions);
* change detection is null-safe over the tracked columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators.sequence import DEFAULT_BUCKET_SECONDS, carry_forward, neighbours, versions

SYS_FROM, SYS_TO = "sys_from", "sys_to"


def same(cols: Sequence[str], left: str = "a", right: str = "b") -> Column:
    """Null-safe equality of all ``cols`` between two aliased sides."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per ``keys`` by ``order``.

    Uses ``max_by`` in a hash aggregate (partial aggregation before the
    shuffle), not a per-key sort.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("_vl_row"))
    return agg.select(*keys, *[F.col("_vl_row")[c].alias(c) for c in rest])


def chain(observations: DataFrame, keys: Sequence[str], ts: str,
          tracked: Sequence[str], tiebreak: Sequence[str] = (),
          bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Rebuild a version chain from unordered observations.

    Observations at the same ``(key, ts)`` are reduced to the last by
    ``tiebreak``; consecutive observations with equal (null-safe) tracked
    values collapse into one version; ``sys_to`` is the next version's
    ``sys_from``.  Order-independent and idempotent.
    """
    obs = observations.select(*keys, F.col(ts).alias(SYS_FROM), *tracked, *[c for c in tiebreak if c not in tracked and c not in keys])
    return versions(obs, keys, SYS_FROM, tracked, tiebreak, until=SYS_TO, bucket_seconds=bucket_seconds).select(*keys, *tracked, SYS_FROM, SYS_TO)


def current(history: DataFrame) -> DataFrame:
    """Current rows."""
    return history.filter(F.col(SYS_TO).isNull())


def as_of(history: DataFrame, t) -> DataFrame:
    """Rows in effect at ``t`` (T6): ``sys_from <= t < coalesce(sys_to, +inf)``."""
    t = F.lit(t).cast("timestamp_ntz") if not isinstance(t, Column) else t
    return history.filter((F.col(SYS_FROM) <= t) & (F.col(SYS_TO).isNull() | (t < F.col(SYS_TO))))


def snapshot_diff(history: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                  t1, t2) -> DataFrame:
    """Added / removed / changed keys between two as-of views."""
    keys, tracked = list(keys), list(tracked)
    a, b = (as_of(history, t).select(*keys, *tracked, F.lit(True).alias("_vl_here")).alias(n) for n, t in (("a", t1), ("b", t2)))
    j = a.join(b, on=[F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], how="full_outer")
    a_missing, b_missing = F.col("a._vl_here").isNull(), F.col("b._vl_here").isNull()
    change = (F.when(a_missing, F.lit("added"))
               .when(b_missing, F.lit("removed"))
               .when(~same(tracked), F.lit("changed")))
    out = j.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
                   change.alias("change"),
                   *[F.col(f"a.{c}").alias(f"old_{c}") for c in tracked],
                   *[F.col(f"b.{c}").alias(f"new_{c}") for c in tracked])
    return out.filter(F.col("change").isNotNull())


def upsert(history: DataFrame, snapshot: DataFrame, keys: Sequence[str],
           tracked: Sequence[str], now, ordinal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Temporal upsert.

    Returns ``(new_history, actions)`` where ``actions`` has one row per
    snapshot key with ``action`` in ``new / changed / unchanged``.
    Only current rows are joined; closed history passes through untouched,
    so a writer can append closed rows and rewrite the current partition.
    """
    keys, tracked = list(keys), list(tracked)
    now = F.lit(now).cast("timestamp_ntz") if not isinstance(now, Column) else now
    snap = snapshot.select(*keys, *tracked, *([ordinal] if ordinal else []))
    snap = (dedupe_last(snap, keys, [ordinal]).drop(ordinal) if ordinal
            else snap.dropDuplicates(keys))
    cur = current(history).select(*keys, *tracked, SYS_FROM).alias("a")
    j = snap.alias("b").join(cur, on=[F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], how="left")
    action = (F.when(F.col(f"a.{SYS_FROM}").isNull(), F.lit("new"))
               .when(same(tracked), F.lit("unchanged"))
               .otherwise(F.lit("changed")))
    j = j.withColumn("action", action)
    actions = j.select(*[F.col(f"b.{k}").alias(k) for k in keys], "action")

    # changed: closed copy of the old row; changed/new: fresh current row
    closed = (j.filter(F.col("action") == "changed")
               .select(*[F.col(f"a.{k}").alias(k) for k in keys],
                       *[F.col(f"a.{c}").alias(c) for c in tracked],
                       F.col(f"a.{SYS_FROM}").alias(SYS_FROM), now.alias(SYS_TO)))
    fresh = (j.filter(F.col("action") != "unchanged")
              .select(*[F.col(f"b.{k}").alias(k) for k in keys],
                      *[F.col(f"b.{c}").alias(c) for c in tracked],
                      now.alias(SYS_FROM), F.lit(None).cast("timestamp_ntz").alias(SYS_TO)))
    touched = j.filter(F.col("action") == "changed").select(*[F.col(f"b.{k}").alias(k) for k in keys])
    hist = history.select(*keys, *tracked, SYS_FROM, SYS_TO)
    untouched = hist.filter(F.col(SYS_TO).isNotNull()).unionByName(
        current(hist).alias("a").join(touched.alias("b"), on=[F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], how="left_anti"))
    return untouched.unionByName(closed).unionByName(fresh), actions


def action_counts(actions: DataFrame) -> DataFrame:
    """Run counters per action."""
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def integrity_per_key(history: DataFrame, keys: Sequence[str],
                      bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """T11 counters per key: versions, current rows, overlapping neighbours
    and inverted intervals."""
    keys = list(keys)
    n = neighbours(history, keys, [SYS_FROM], [SYS_FROM], prev=False,
                   bucket_seconds=bucket_seconds)
    return n.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.count_if(F.col(SYS_TO).isNull()).alias("n_current"),
        F.count_if(F.col(f"next_{SYS_FROM}").isNotNull()
                   & (F.col(SYS_TO).isNull() | (F.col(f"next_{SYS_FROM}") < F.col(SYS_TO)))).alias("n_overlap"),
        F.count_if(F.col(SYS_TO) < F.col(SYS_FROM)).alias("n_inverted"))


def integrity(history: DataFrame, keys: Sequence[str],
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Keys that violate one current row / no overlap / no inversion."""
    per = integrity_per_key(history, keys, bucket_seconds)
    return per.filter((F.col("n_current") != 1) | (F.col("n_overlap") > 0) | (F.col("n_inverted") > 0))


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
               right_from: str, values: Sequence[str], right_to: str | None = None,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS, sizes: DataFrame | None = None) -> DataFrame:
    """As-of join (J13): every ``left`` row gets the ``right`` version in
    effect at ``left_ts`` — the latest with ``right_from <= left_ts`` (and
    ``left_ts < right_to`` when an explicit end column is given).

    Planned as union + bucketed carry-forward, never as a range join, so the
    cost is a sort of both sides and hot keys are split by time bucket.
    ``sizes``: rows by whose ``keys`` hot ones are told; without it both sides
    are counted. It decides who sorts a key, never what comes out.
    """
    keys, values = list(keys), list(values)
    lcols = [c for c in left.columns if c not in keys]
    vals = [*values, *([right_to] if right_to else [])]
    l_part = left.select(*keys, F.col(left_ts).alias("_vl_t"), F.lit(1).alias("_vl_side"),
                         F.struct(*lcols).alias("_vl_l"),
                         F.lit(None).cast(right.select(F.struct(*vals).alias("s")).schema["s"].dataType).alias("_vl_r"))
    r_part = right.select(*keys, F.col(right_from).alias("_vl_t"), F.lit(0).alias("_vl_side"),
                          F.lit(None).cast(left.select(F.struct(*lcols).alias("s")).schema["s"].dataType).alias("_vl_l"),
                          F.struct(*vals).alias("_vl_r"))
    u = l_part.unionByName(r_part)
    cf = carry_forward(u, keys, ["_vl_t", "_vl_side"], "_vl_r", F.col("_vl_side") == 0,
                       bucket_seconds=bucket_seconds, out="_vl_v", sizes=sizes)
    res = cf.filter(F.col("_vl_side") == 1)
    if right_to:
        res = res.withColumn("_vl_v", F.when(F.col("_vl_v")[right_to].isNull()
                                             | (F.col("_vl_t") < F.col("_vl_v")[right_to]), F.col("_vl_v")))
    return res.select(*keys, *[F.col("_vl_l")[c].alias(c) for c in lcols],
                      *[F.col("_vl_v")[v].alias(v) for v in values])
