"""Skew-safe ordered-sequence primitives.

Per-key ordered windows (``lag``/``lead``/last-non-null) are the backbone of
history chains and as-of joins.  A plain ``Window.partitionBy(key)`` sends
every row of a key to one task, so a key holding a third of the data would be
sorted by a single task.  These helpers partition by ``(key, time bucket)``
instead and repair the bucket boundaries from a per-``(key, bucket)``
summary whose size is bounded by the number of buckets per key, not by the
number of rows.  Results are exact: identical to the unbucketed window.

Whole rows are exchanged once, by ``(key, bucket)``: windows, summary and the
join of the two use that exchange; only summary rows are exchanged again.

Where keys are short, nearly every row is a bucket of its own and the summary
is as large as the rows. So only the buckets of long keys are by time: keys of
more than ``LONG_KEY`` rows, counted first. Without any, a plain window by key
does all, sorted once, with no summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_vl_bucket"
KEY = "_vl_key"
DEFAULT_BUCKET_SECONDS = 7 * 86400
#: A key of more rows than this is sorted by several tasks.
LONG_KEY = 500_000


def bucket_of(ts: str | Column, seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    """Integer time bucket of a timestamp (NTZ or LTZ) column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def null_safe_left(d: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on ``on`` in which null keys meet each other, as they do in a window."""
    marked = other.select(*[F.col(c).alias(f"_vl_on_{c}") if c in on else F.col(c) for c in other.columns])
    cond = [F.col(c).eqNullSafe(F.col(f"_vl_on_{c}")) for c in on]
    return d.join(marked, on=cond, how="left").drop(*[f"_vl_on_{c}" for c in on])


def long_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys of more than ``LONG_KEY`` rows; None if there are none. There is at most one such key for that many rows, so they are collected."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_vl_n")).filter(F.col("_vl_n") > LONG_KEY).select(*keys)
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def _exchanged(df: DataFrame, keys: Sequence[str], band: Column, long: DataFrame | None = None) -> DataFrame:
    """``df`` with its key as a struct (in which nulls are equal) and its bucket, exchanged by both: the one exchange of whole rows.

    With ``long``, the other keys have one bucket each, and one for rows without a time.
    """
    if long is None:
        return df.withColumn(KEY, F.struct(*keys)).withColumn(BUCKET, band).repartition(KEY, BUCKET)
    marked = null_safe_left(df, F.broadcast(long.select(*keys).withColumn("_vl_long", F.lit(True))), keys)
    return marked.withColumn(KEY, F.struct(*keys)).withColumn(BUCKET, F.when(F.col("_vl_long") | band.isNull(), band).otherwise(F.lit(0).cast("long"))).drop("_vl_long").repartition(KEY, BUCKET)


def _per_bucket(d: DataFrame, columns: Sequence[str], *aggs: Column) -> DataFrame:
    """A row per bucket. It reads all of ``columns``, so that its exchange is the one that the rows have gone through."""
    out = d.groupBy(KEY, BUCKET).agg(*aggs, F.first(F.struct(*columns)).alias("_vl_any"))
    return out.filter(F.col("_vl_any").isNotNull()).drop("_vl_any")


def _values(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(n).alias(n) for n in names])


def _in_order(order: Sequence[str]):
    return Window.partitionBy(KEY, BUCKET).orderBy(*order)


def _of_key(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def _buckets():
    return Window.partitionBy(KEY).orderBy(BUCKET)


_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               values: Sequence[str], *, prev: bool = True, nxt: bool = True,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
               prefix_prev: str = "prev_", prefix_next: str = "next_") -> DataFrame:
    """Add ``prev_<v>`` / ``next_<v>`` (lag / lead by 1 within ``keys``
    ordered by ``order``) for every column in ``values``.

    ``order[0]`` must be the timestamp used for bucketing; further order
    columns break ties so the order is total.
    """
    keys, order, values = list(keys), list(order), list(values)
    long = long_keys(df, keys)
    if long is None:
        w = _of_key(keys, order)
        timed = F.col(order[0]).isNotNull() | F.lead(order[0]).over(w).isNull()  # of rows without a time the last has no next, as it is a bucket's last
        before = [F.lag(v).over(w).alias(prefix_prev + v) for v in values] if prev else []
        after = [F.when(timed, F.lead(v).over(w)).alias(prefix_next + v) for v in values] if nxt else []
        return df.select("*", *before, *after)
    whole = _exchanged(df, keys, bucket_of(order[0], bucket_seconds), long)
    w, at = _in_order(order), _order_struct(order)
    d, edges = whole, []
    if prev:
        d = d.withColumn("_vl_prev", F.lag(_values(values)).over(w))
        edges.append(F.max_by(_values(values), at).alias("_vl_last"))
    if nxt:
        d = d.withColumn("_vl_next", F.lead(_values(values)).over(w))
        edges.append(F.min_by(_values(values), at).alias("_vl_first"))
    summ = _per_bucket(whole, df.columns, *edges)
    if prev:
        summ = summ.withColumn("_vl_bprev", F.lag("_vl_last").over(_buckets())).drop("_vl_last")
    if nxt:
        summ = summ.withColumn("_vl_bnext", F.lead("_vl_first").over(_buckets())).drop("_vl_first")
    d = d.join(summ, [KEY, BUCKET], "left")
    sides = [(prefix_prev, "prev")] * prev + [(prefix_next, "next")] * nxt
    told = {p + v: F.when(F.col(f"_vl_{s}").isNotNull(), F.col(f"_vl_{s}")[v]).otherwise(F.col(f"_vl_b{s}")[v]) for p, s in sides for v in values}
    return d.select(*df.columns, *[c.alias(n) for n, c in told.items()])


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  value: str, is_source: Column, *,
                  bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                  out: str | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """For every row, the ``value`` of the latest row at or before it (in
    ``order`` within ``keys``) for which ``is_source`` holds; null values are passed over.

    This is the as-of lookup used by :func:`vellum.operators.temporal.as_of_join`.
    ``sizes``: rows by whose keys long ones are told, when ``df`` costs much to count.
    """
    keys, order = list(keys), list(order)
    out = out or f"asof_{value}"
    here = F.when(is_source, F.col(value))
    long = long_keys(df if sizes is None else sizes, keys)
    if long is None:
        return df.withColumn(out, F.last(here, ignorenulls=True).over(_of_key(keys, order).rowsBetween(*_SO_FAR)))
    whole = _exchanged(df, keys, bucket_of(order[0], bucket_seconds), long)
    d = whole.withColumn("_vl_in", F.last(here, ignorenulls=True).over(_in_order(order).rowsBetween(*_SO_FAR)))
    last = F.max_by(_values([value]), F.when(here.isNotNull(), _order_struct(order)))
    summ = _per_bucket(whole, df.columns, last.alias("_vl_last"))
    summ = summ.withColumn("_vl_carry", F.last("_vl_last", ignorenulls=True).over(_buckets().rowsBetween(*_BEFORE))).drop("_vl_last")
    d = d.join(summ, [KEY, BUCKET], "left")
    return d.select(*df.columns, F.coalesce(F.col("_vl_in"), F.col("_vl_carry")[value]).alias(out))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, *,
                out: str | None = None, bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                with_prev: bool = True) -> DataFrame:
    """Running total of ``value`` per key in ``order`` (rows frame), plus
    ``prev_<value>`` when ``with_prev``.

    In-bucket prefix sums come from a ``(key, bucket)`` window; earlier
    buckets contribute their totals through a window over per-bucket sums.
    """
    keys, order = list(keys), list(order)
    out = out or f"running_{value}"
    long = long_keys(df, keys)
    if long is None:
        w = _of_key(keys, order)
        before = F.lag(value).over(w).alias(f"prev_{value}")
        return df.select("*", *([before] if with_prev else []), F.sum(value).over(w.rowsBetween(*_SO_FAR)).alias(out))
    whole = _exchanged(df, keys, bucket_of(order[0], bucket_seconds), long)
    w = _in_order(order)
    d = whole.withColumn("_vl_in", F.sum(value).over(w.rowsBetween(*_SO_FAR))).withColumn("_vl_prev", F.lag(_values([value])).over(w))
    summ = _per_bucket(whole, df.columns, F.sum(value).alias("_vl_bt"), F.max_by(_values([value]), _order_struct(order)).alias("_vl_last"))
    summ = summ.select(KEY, BUCKET, F.sum("_vl_bt").over(_buckets().rowsBetween(*_BEFORE)).alias("_vl_carry"), F.lag("_vl_last").over(_buckets()).alias("_vl_bprev"))
    d = d.join(summ, [KEY, BUCKET], "left")
    # like a window sum: null until the first value, then carried over nulls
    total = F.coalesce(F.col("_vl_in") + F.col("_vl_carry"), F.col("_vl_carry"), F.col("_vl_in")).alias(out)
    before = F.when(F.col("_vl_prev").isNotNull(), F.col("_vl_prev")[value]).otherwise(F.col("_vl_bprev")[value]).alias(f"prev_{value}")
    return d.select(*df.columns, *([before] if with_prev else []), total)


def versions(df: DataFrame, keys: Sequence[str], ts: str, tracked: Sequence[str], tiebreak: Sequence[str], *,
             until: str, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Rows at which a key's ``tracked`` values change (null-safe), with ``until``, the time of the key's next change.

    Rows of one key and time are one first, the last by ``tiebreak`` (any,
    without one). A bucket decides all but its first row by itself; that one,
    and the end of its last version, come from the summary of the buckets.
    Rows without a time are left out.
    """
    keys, tracked = list(keys), list(tracked)
    row = F.struct(*keys, *tracked)
    df = df.select(*keys, ts, *tracked, *[c for c in tiebreak if c not in keys and c not in tracked and c != ts]).filter(F.col(ts).isNotNull())
    long = long_keys(df, keys)
    if long is None:
        # one sort does: rows of a time stand together, the last of them by ``tiebreak`` stays
        later = F.lead(F.struct(ts)).over(_of_key(keys, [ts, *tiebreak]))
        once = df.withColumn("_vl_later", later).filter(F.col("_vl_later").isNull() | ~F.col("_vl_later")[ts].eqNullSafe(F.col(ts)))
        w = _of_key(keys, [ts])
        before = F.lag(F.struct(*tracked)).over(w)
        same = reduce(lambda a, b: a & b, [F.col("_vl_before")[c].eqNullSafe(F.col(c)) for c in tracked], F.lit(True))
        kept = once.withColumn("_vl_before", before).filter(F.col("_vl_before").isNull() | ~same)
        return kept.select(*keys, *tracked, ts, F.lead(ts).over(w).alias(until))
    whole = _exchanged(df, keys, bucket_of(ts, bucket_seconds), long)
    last = F.max_by(row, F.struct(*tiebreak)) if tiebreak else F.first(row)
    once = whole.groupBy(KEY, BUCKET, ts).agg(last.alias("_vl_row"))  # in place: rows of a time share a bucket

    def differ(a: Column, b: Column) -> Column:
        out = F.lit(False)
        for c in tracked:
            out = out | ~a[c].eqNullSafe(b[c])
        return out

    w = _in_order([ts])
    before = F.lag("_vl_row").over(w)
    kept = once.withColumn("_vl_before", before).withColumn("_vl_first", F.col("_vl_before").isNull()).filter(
        F.col("_vl_first") | differ(F.col("_vl_before"), F.col("_vl_row"))).drop("_vl_before")
    kept = kept.withColumn("_vl_next", F.lead(ts).over(w))
    summ = _per_bucket(kept, ["_vl_row", "_vl_next"], F.min_by("_vl_row", ts).alias("_vl_head"), F.min(ts).alias("_vl_head_ts"),
                       F.max_by("_vl_row", ts).alias("_vl_tail"), F.min(F.when(~F.col("_vl_first"), F.col(ts))).alias("_vl_inner"))
    tail = F.lag("_vl_tail").over(_buckets())
    summ = summ.withColumn("_vl_tail_before", tail).withColumn("_vl_opens", F.col("_vl_tail_before").isNull() | differ(F.col("_vl_tail_before"), F.col("_vl_head")))
    change = F.when(F.col("_vl_opens"), F.col("_vl_head_ts")).otherwise(F.col("_vl_inner"))
    later = F.last(change, ignorenulls=True).over(Window.partitionBy(KEY).orderBy(F.desc(BUCKET)).rowsBetween(*_BEFORE))
    summ = summ.select(KEY, BUCKET, "_vl_opens", later.alias("_vl_later"))
    d = kept.join(summ, [KEY, BUCKET], "left").filter(~F.col("_vl_first") | F.col("_vl_opens"))
    return d.select(*[F.col("_vl_row")[c].alias(c) for c in (*keys, *tracked)], ts, F.coalesce("_vl_next", "_vl_later").alias(until))


def number_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], carried: Sequence[str], breaks, *,
                band: Column, out: str = "run") -> DataFrame:
    """Gaps and islands: add ``out``, the number (from 1) of the row's run within ``keys`` in ``order``.

    ``breaks(before, here)`` tells whether a row begins a new run, from two
    structs of the columns ``carried``. Rows are sorted by ``(keys, band)``,
    where ``band`` must not fall as ``order`` rises, so a long key is sorted
    by several tasks; a summary row per band carries runs over its edges.
    """
    keys, order = list(keys), list(order)
    whole = _exchanged(df, keys, band)
    w = _in_order(order)
    here = _values(carried)
    d = whole.withColumn("_vl_before", F.lag(here).over(w)).withColumn("_vl_here", here)
    begins = F.when(F.col("_vl_before").isNull(), 0).otherwise(F.coalesce(breaks(F.col("_vl_before"), F.col("_vl_here")).cast("int"), F.lit(0)))
    d = d.withColumn("_vl_begins", begins)
    d = d.withColumn("_vl_in", F.sum("_vl_begins").over(w.rowsBetween(*_SO_FAR)))
    at = _order_struct(order)
    bands = _per_bucket(d, df.columns, F.min_by("_vl_here", at).alias("_vl_first"), F.max_by("_vl_here", at).alias("_vl_last"), F.sum("_vl_begins").alias("_vl_inner"))
    bands = bands.withColumn("_vl_before_band", F.lag("_vl_last").over(_buckets())).withColumn("_vl_opens", F.when(F.col("_vl_before_band").isNull(), 1).otherwise(
        F.coalesce(breaks(F.col("_vl_before_band"), F.col("_vl_first")).cast("int"), F.lit(0))))
    base = F.sum(F.col("_vl_opens") + F.col("_vl_inner")).over(_buckets().rowsBetween(*_SO_FAR)) - F.col("_vl_inner")
    d = d.join(bands.select(KEY, BUCKET, base.alias("_vl_base")), [KEY, BUCKET], "left")
    return d.select(*df.columns, (F.col("_vl_base") + F.col("_vl_in")).alias(out))
