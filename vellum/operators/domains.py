"""Domain sets: membership tables, containment probes, write-back.

A domain is a named set of labels (plus alternative labels).  The system of
record is the exact member table ``(domain_name, key)`` where ``key`` is the
folded label; every set operation is a join / aggregate on that key, never a
cross product.  The member side of a probe is usually small and AQE turns the
join into a broadcast when its measured size is under the broadcast
threshold; otherwise it stays a shuffle join — no unchecked broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import fold_label


def members(domains: DataFrame, domain: str = "domain_name", label: str = "label",
            alt_labels: str | None = "alt_labels", fold: bool = True) -> DataFrame:
    """M1/M2: distinct ``(domain_name, key, label)`` from labels and aliases."""
    lab = domains.select(F.col(domain).alias("domain_name"), F.col(label).alias("label"))
    if alt_labels:
        alt = domains.select(F.col(domain).alias("domain_name"),
                             F.explode_outer(alt_labels).alias("label")).filter(F.col("label").isNotNull())
        lab = lab.unionByName(alt)
    key = fold_label("label") if fold else F.lower("label")
    return lab.filter(F.col("label").isNotNull()).select("domain_name", key.alias("key"), "label").distinct()


def cardinality(mem: DataFrame) -> DataFrame:
    """Label rows and distinct normalised keys per domain."""
    return mem.groupBy("domain_name").agg(F.count(F.lit(1)).alias("label_rows"),
                                          F.count_distinct("key").alias("n_keys"))


def column_values(tables: dict[str, DataFrame], columns: dict[str, Sequence[str]]) -> DataFrame:
    """Unpivot ``(table_name, column_name, value, freq)`` for the probed
    columns; ``freq`` is pre-aggregated per distinct value (partial
    aggregation before the shuffle)."""
    parts = []
    for tname, cols in columns.items():
        df = tables[tname].select(*[F.col(c).cast("string").alias(c) for c in cols])
        u = df.unpivot([], list(cols), "column_name", "value").withColumn("table_name", F.lit(tname))
        parts.append(u)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.filter(F.col("value").isNotNull())
             .groupBy("table_name", "column_name", "value").agg(F.count(F.lit(1)).alias("freq")))


def probe(values: DataFrame, mem: DataFrame, fold: bool = True) -> DataFrame:
    """M4 + M5 + M6 + M7: containment, weighted containment and Jaccard of
    every probed column against every domain it touches.

    containment = |probe ∩ domain| / |probe| over distinct folded values,
    weighted = matched frequency / total frequency, jaccard = |∩| / |∪|.
    Only pairs with at least one match are returned (containment > 0).
    """
    key = fold_label("value") if fold else F.lower("value")
    v = (values.withColumn("key", key)
               .groupBy("table_name", "column_name", "key").agg(F.sum("freq").alias("freq")))
    tot = v.groupBy("table_name", "column_name").agg(F.count(F.lit(1)).alias("n_values"),
                                                     F.sum("freq").alias("total_freq"))
    dk = mem.select("domain_name", "key").distinct()
    dsize = dk.groupBy("domain_name").agg(F.count(F.lit(1)).alias("domain_size"))
    hit = v.join(dk, "key")
    agg = hit.groupBy("table_name", "column_name", "domain_name").agg(
        F.count(F.lit(1)).alias("n_matches"), F.sum("freq").alias("matched_freq"))
    out = agg.join(tot, ["table_name", "column_name"]).join(dsize, "domain_name")
    return out.select("table_name", "column_name", "domain_name", "n_values", "n_matches",
                      (F.col("n_matches") / F.col("n_values")).alias("containment"),
                      (F.col("matched_freq") / F.col("total_freq")).alias("weighted_containment"),
                      (F.col("n_matches") / (F.col("n_values") + F.col("domain_size") - F.col("n_matches")))
                      .alias("jaccard"))


def writeback(enumeration: DataFrame, incoming: DataFrame, now) -> DataFrame:
    """M10 + A24: upsert domain definitions; on conflict only
    ``member_count`` and ``updated_at`` change, everything else is kept."""
    now = F.lit(now).cast("timestamp_ntz")
    e = enumeration.alias("e")
    i = incoming.alias("i")
    j = e.join(i, F.col("e.domain_name") == F.col("i.domain_name"), "full_outer")
    both = F.col("e.domain_name").isNotNull() & F.col("i.domain_name").isNotNull()
    return j.select(
        F.coalesce(F.col("e.domain_name"), F.col("i.domain_name")).alias("domain_name"),
        F.coalesce(F.col("e.source"), F.col("i.source")).alias("source"),
        F.coalesce(F.col("i.member_count"), F.col("e.member_count")).alias("member_count"),
        F.coalesce(F.col("e.created_at"), now).alias("created_at"),
        F.when(both | F.col("e.domain_name").isNull(), now).otherwise(F.col("e.updated_at")).alias("updated_at"))


def new_only(suggested: DataFrame, known: DataFrame, col: str = "domain_name") -> DataFrame:
    """Suggestions not already known (null-safe anti join)."""
    k = known.select(F.col(col).alias("_k")).filter(F.col("_k").isNotNull())
    return suggested.join(k, suggested[col] == k["_k"], "left_anti")


def store_members(mem: DataFrame, path: str) -> None:
    """Members in a folder a domain, so that a request reads its domains' folders only."""
    mem.select("domain_name", "key", "label").write.mode("overwrite").partitionBy("domain_name").parquet(path)


def requested_members(stored: DataFrame, requests: DataFrame) -> DataFrame:
    """M9: the stored members of the requested domains (``requests.domain_name``; repeated and unknown names do no harm).

    An inner join on the partition column with the distinct requests, so the
    request prunes partitions while the query runs.
    """
    return stored.join(requests.select("domain_name").filter("domain_name IS NOT NULL").distinct(), "domain_name")


def materialised(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """A reference table for a session: a broadcast hint if it has at most ``most_rows`` rows as counted, else none."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def sketches(keyed: DataFrame, by: Sequence[str], key: str = "key", log_size: int = 14) -> DataFrame:
    """M7, approximate: a theta sketch (``2 ** log_size`` hashes at most) of the distinct keys of each group.

    Sketches merge, so parts may be sketched apart and kept. Sets of fewer
    keys than that are held exactly.
    """
    return keyed.filter(F.col(key).isNotNull()).groupBy(*by).agg(F.theta_sketch_agg(F.col(key), log_size).alias("sketch"))


def sampled_pairs(left: DataFrame, right: DataFrame, left_by: Sequence[str], right_by: Sequence[str], one_in: int = 16, whole: int = 4096) -> DataFrame:
    """Pairs of groups that may share keys: those that share one of a sample of keys by hash; groups of up to ``whole`` keys are sampled whole."""

    def sample(df: DataFrame, by: Sequence[str]) -> DataFrame:
        keys = df.select(*by, "key").distinct()
        small = keys.groupBy(*by).agg((F.count(F.lit(1)) <= whole).alias("_vl_small"))
        return keys.join(small, list(by)).filter(F.col("_vl_small") | (F.pmod(F.xxhash64("key"), F.lit(one_in)) == 0)).drop("_vl_small")

    return sample(left, left_by).join(sample(right, right_by), "key").select(*left_by, *right_by).distinct()


def compare_sketches(left: DataFrame, right: DataFrame, pairs: DataFrame, left_by: Sequence[str], right_by: Sequence[str], log_size: int = 14) -> DataFrame:
    """M7, approximate: per pair ``n_left, n_right, n_both, containment, jaccard``, all from the sketches, without the members."""
    a = left.select(*left_by, F.col("sketch").alias("_vl_a"))
    b = right.select(*right_by, F.col("sketch").alias("_vl_b"))
    j = pairs.join(a, list(left_by)).join(b, list(right_by))
    size = lambda c: F.theta_sketch_estimate(c)
    j = j.select(*left_by, *right_by, size("_vl_a").alias("n_left"), size("_vl_b").alias("n_right"),
                 size(F.theta_intersection("_vl_a", "_vl_b")).alias("n_both"), size(F.theta_union("_vl_a", "_vl_b", log_size)).alias("n_either"))
    return j.select(*left_by, *right_by, "n_left", "n_right", "n_both", F.try_divide("n_both", "n_left").alias("containment"), F.try_divide("n_both", "n_either").alias("jaccard"))


def discover(values: DataFrame, known: DataFrame, catalog: DataFrame, put: Callable[[DataFrame, str], DataFrame], *, covered: float = 0.9,
             min_matches: int = 1, most_rounds: int = 20) -> tuple[DataFrame, DataFrame]:
    """Domains for the columns that the known ones don't cover, round by round.

    ``values(column_name, key)``, ``known`` and ``catalog`` ``(domain_name,
    key)``. A round suggests, for each column of which less than ``covered``
    of the distinct keys are in a known domain, the domain of the catalog that
    isn't known and holds most of its keys that no known domain holds (of
    equals the first by name); suggestions become known, for all columns.
    Rounds end when a round suggests nothing, or after ``most_rounds``. Each
    round is written by ``put(frame, name)``, the log as well.

    Gives the known members, and the log ``(round, column_name, n_keys,
    n_covered, domain_name, n_matches, status)``: every round's columns that
    weren't covered, with what was suggested (``accepted``) or nothing
    (``no_match``, once a column, in the round that finds it).
    """
    values = put(values.select("column_name", "key").filter("key IS NOT NULL").distinct(), "values")
    catalog = put(catalog.select("domain_name", "key").distinct(), "catalog")
    known = put(known.select("domain_name", "key").distinct(), "known-0")
    log, given_up = None, None
    for n in range(1, most_rounds + 1):
        held = values.join(known.select("key").distinct().withColumn("_vl_held", F.lit(True)), "key", "left")
        state = held.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_keys"), F.count("_vl_held").alias("n_covered"))
        open_ = state.filter(F.col("n_covered") < covered * F.col("n_keys"))
        if given_up is not None:
            open_ = open_.join(given_up, "column_name", "left_anti")
        left = held.filter("_vl_held IS NULL").join(open_.select("column_name"), "column_name", "left_semi").select("column_name", "key")
        fresh = catalog.join(known.select("domain_name").distinct(), "domain_name", "left_anti")
        hits = left.join(fresh, "key").groupBy("column_name", "domain_name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_matches)
        best = hits.groupBy("column_name").agg(F.min(F.struct((-F.col("n")).alias("n"), "domain_name")).alias("b"))
        rows = open_.join(best, "column_name", "left").select(
            F.lit(n).alias("round"), "column_name", "n_keys", "n_covered", F.col("b.domain_name").alias("domain_name"), F.coalesce(-F.col("b.n"), F.lit(0)).alias("n_matches"),
            F.when(F.col("b").isNull(), "no_match").otherwise("accepted").alias("status"))
        rows = put(rows, f"log-{n}")
        log = rows if log is None else log.unionByName(rows)
        accepted = rows.filter("status = 'accepted'").select("domain_name").distinct()
        gone = rows.filter("status = 'no_match'").select("column_name")
        given_up = gone if given_up is None else given_up.unionByName(gone)
        if not accepted.take(1):
            break
        known = put(known.unionByName(catalog.join(accepted, "domain_name", "left_semi")), f"known-{n}")
    return known, log
