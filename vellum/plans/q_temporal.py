"""Temporal-history queries (flagship family).

Observations:
* ``events`` — key ``user_id``, tracked ``event_type``, observed at ``ts``
  (ties at one instant: highest ``event_id`` wins);
* ``lineitem`` — unit price of a part (``extendedprice / quantity``)
  observed at ``l_shipdate``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import temporal as T
from vellum.plans.registry import query

T_ASOF = "2024-01-15 00:00:00"
T_DIFF_1, T_DIFF_2 = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
T_SNAP_FROM, T_SNAP_TO = "2024-01-15 00:00:00", "2024-01-22 00:00:00"


def event_chain(t, until=None):
    ev = t.events
    if until is not None:
        ev = ev.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return T.chain(ev, ["user_id"], "ts", ["event_type"], tiebreak=["event_id"])


def unit_prices(t):
    li = t.lineitem
    return li.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber",
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))


def price_chain(t):
    return T.chain(unit_prices(t), ["l_partkey"], "l_shipdate", ["unit_price"],
                   tiebreak=["l_orderkey", "l_linenumber", "unit_price"])


_EVENT_CHAIN_SQL = """
obs AS (
  SELECT user_id, ts AS sys_from, arg_max(event_type, event_id) AS event_type
  FROM events {where} GROUP BY user_id, ts),
lagged AS (
  SELECT *, lag(event_type) OVER w AS prev_t, row_number() OVER w AS rn
  FROM obs WINDOW w AS (PARTITION BY user_id ORDER BY sys_from)),
starts AS (
  SELECT user_id, event_type, sys_from FROM lagged
  WHERE rn = 1 OR prev_t IS DISTINCT FROM event_type),
chain AS (
  SELECT user_id, event_type, sys_from,
         lead(sys_from) OVER (PARTITION BY user_id ORDER BY sys_from) AS sys_to
  FROM starts)
"""
EVENT_CHAIN = _EVENT_CHAIN_SQL.format(where="")

PRICE_CHAIN = """
obs AS (
  SELECT l_partkey, l_shipdate AS sys_from, unit_price FROM (
    SELECT l_partkey, l_shipdate, l_extendedprice / l_quantity AS unit_price,
           row_number() OVER (PARTITION BY l_partkey, l_shipdate
                              ORDER BY l_orderkey DESC, l_linenumber DESC,
                                       l_extendedprice / l_quantity DESC) AS rn
    FROM lineitem) WHERE rn = 1),
lagged AS (
  SELECT *, lag(unit_price) OVER w AS prev_p, row_number() OVER w AS rn
  FROM obs WINDOW w AS (PARTITION BY l_partkey ORDER BY sys_from)),
starts AS (
  SELECT l_partkey, unit_price, sys_from FROM lagged
  WHERE rn = 1 OR prev_p IS DISTINCT FROM unit_price),
pchain AS (
  SELECT l_partkey, unit_price, sys_from,
         lead(sys_from) OVER (PARTITION BY l_partkey ORDER BY sys_from) AS sys_to
  FROM starts)
"""


@query("ttst_chain", oracle=f"WITH {EVENT_CHAIN} SELECT * FROM chain")
def ttst_chain(t):
    """Version chain of each user's event type."""
    return event_chain(t)


@query("ttst_current", oracle=f"WITH {EVENT_CHAIN} SELECT * FROM chain WHERE sys_to IS NULL")
def ttst_current(t):
    """T5: current version per user."""
    return T.current(event_chain(t))


@query("ttst_asof", oracle=f"""WITH {EVENT_CHAIN}
SELECT * FROM chain
WHERE sys_from <= TIMESTAMP '{T_ASOF}' AND (sys_to IS NULL OR TIMESTAMP '{T_ASOF}' < sys_to)""")
def ttst_asof(t):
    """Versions in effect at a fixed instant."""
    return T.as_of(event_chain(t), T_ASOF)


@query("ttst_diff", oracle=f"""WITH {EVENT_CHAIN},
a AS (SELECT user_id, event_type FROM chain
      WHERE sys_from <= TIMESTAMP '{T_DIFF_1}' AND (sys_to IS NULL OR TIMESTAMP '{T_DIFF_1}' < sys_to)),
b AS (SELECT user_id, event_type FROM chain
      WHERE sys_from <= TIMESTAMP '{T_DIFF_2}' AND (sys_to IS NULL OR TIMESTAMP '{T_DIFF_2}' < sys_to)),
j AS (
  SELECT coalesce(a.user_id, b.user_id) AS user_id,
         CASE WHEN a.user_id IS NULL THEN 'added'
              WHEN b.user_id IS NULL THEN 'removed'
              WHEN a.event_type IS DISTINCT FROM b.event_type THEN 'changed' END AS change,
         a.event_type AS old_event_type, b.event_type AS new_event_type
  FROM a FULL OUTER JOIN b ON a.user_id = b.user_id)
SELECT * FROM j WHERE change IS NOT NULL""")
def ttst_diff(t):
    """Snapshot diff between two instants."""
    return T.snapshot_diff(event_chain(t), ["user_id"], ["event_type"], T_DIFF_1, T_DIFF_2)


def _upsert(t):
    hist = event_chain(t, until=T_SNAP_FROM)
    snap = (t.events.filter((F.col("ts") >= F.lit(T_SNAP_FROM).cast("timestamp_ntz"))
                            & (F.col("ts") < F.lit(T_SNAP_TO).cast("timestamp_ntz")))
            .select("user_id", "event_type",
                    F.struct("ts", "event_id").alias("ordinal")))
    return T.upsert(hist, snap, ["user_id"], ["event_type"], T_SNAP_TO, ordinal="ordinal")


_UPSERT_SQL = _EVENT_CHAIN_SQL.format(where=f"WHERE ts < TIMESTAMP '{T_SNAP_FROM}'") + f""",
snap AS (
  SELECT user_id, event_type FROM (
    SELECT user_id, event_type,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts >= TIMESTAMP '{T_SNAP_FROM}' AND ts < TIMESTAMP '{T_SNAP_TO}')
  WHERE rn = 1),
cur AS (SELECT * FROM chain WHERE sys_to IS NULL),
acts AS (
  SELECT s.user_id, s.event_type AS new_type, c.event_type AS old_type, c.sys_from AS old_from,
         CASE WHEN c.user_id IS NULL THEN 'new'
              WHEN c.event_type IS NOT DISTINCT FROM s.event_type THEN 'unchanged'
              ELSE 'changed' END AS action
  FROM snap s LEFT JOIN cur c ON s.user_id = c.user_id),
new_hist AS (
  SELECT user_id, event_type, sys_from, sys_to FROM chain WHERE sys_to IS NOT NULL
  UNION ALL
  SELECT user_id, event_type, sys_from, sys_to FROM cur
  WHERE user_id NOT IN (SELECT user_id FROM acts WHERE action = 'changed')
  UNION ALL
  SELECT user_id, old_type, old_from, TIMESTAMP '{T_SNAP_TO}' FROM acts WHERE action = 'changed'
  UNION ALL
  SELECT user_id, new_type, TIMESTAMP '{T_SNAP_TO}', CAST(NULL AS TIMESTAMP) FROM acts WHERE action <> 'unchanged')
"""


@query("ttst_upsert", oracle=f"WITH {_UPSERT_SQL} SELECT * FROM new_hist")
def ttst_upsert(t):
    """Temporal upsert of a week's snapshot into the history."""
    hist, _ = _upsert(t)
    return hist


_NULL_KEY = "CASE WHEN user_id % 10 <> 0 THEN user_id END"


@query("ttst_null_keys", oracle=f"""WITH events0 AS (SELECT * REPLACE ({_NULL_KEY} AS user_id) FROM events), {_UPSERT_SQL
    .replace("FROM events ", "FROM events0 ").replace("s.user_id = c.user_id", "s.user_id IS NOT DISTINCT FROM c.user_id").replace("c.user_id IS NULL THEN 'new'", "c.sys_from IS NULL THEN 'new'")
    .replace("WHERE user_id NOT IN (SELECT user_id FROM acts WHERE action = 'changed')", "WHERE NOT EXISTS (SELECT 1 FROM acts a WHERE a.action = 'changed' AND a.user_id IS NOT DISTINCT FROM cur.user_id)")}
SELECT * FROM new_hist""")
def ttst_null_keys(t):
    """The upsert where a tenth of the users share the null key, which is a key like any other."""
    from types import SimpleNamespace

    return _upsert(SimpleNamespace(events=t.events.withColumn("user_id", F.expr(_NULL_KEY))))[0]


@query("ttst_upsert_actions", oracle=f"WITH {_UPSERT_SQL} SELECT action, count(*) AS n FROM acts GROUP BY action")
def ttst_upsert_actions(t):
    """Inserted / changed / unchanged counters of the upsert."""
    _, actions = _upsert(t)
    return T.action_counts(actions)


@query("ttst_upsert_idempotent", oracle=f"WITH {_UPSERT_SQL} SELECT 'unchanged' AS action, count(*) AS n FROM snap")
def ttst_upsert_idempotent(t):
    """O3: re-applying the same snapshot to the upserted history changes nothing."""
    hist, _ = _upsert(t)
    snap = (t.events.filter((F.col("ts") >= F.lit(T_SNAP_FROM).cast("timestamp_ntz"))
                            & (F.col("ts") < F.lit(T_SNAP_TO).cast("timestamp_ntz")))
            .select("user_id", "event_type", F.struct("ts", "event_id").alias("ordinal")))
    _, actions = T.upsert(hist, snap, ["user_id"], ["event_type"], T_SNAP_TO, ordinal="ordinal")
    return T.action_counts(actions)


@query("ttst_integrity", oracle=f"""WITH {EVENT_CHAIN},
nx AS (SELECT *, lead(sys_from) OVER (PARTITION BY user_id ORDER BY sys_from) AS nf FROM chain),
per AS (
  SELECT user_id,
         count(*) FILTER (WHERE sys_to IS NULL) AS n_current,
         count(*) FILTER (WHERE nf IS NOT NULL AND (sys_to IS NULL OR nf < sys_to)) AS n_overlap,
         count(*) FILTER (WHERE sys_to < sys_from) AS n_inverted,
         count(*) AS n_versions
  FROM nx GROUP BY user_id)
SELECT count(*) AS n_keys, CAST(sum(n_versions) AS BIGINT) AS n_versions,
       count(*) FILTER (WHERE n_current <> 1) AS bad_current,
       count(*) FILTER (WHERE n_overlap > 0) AS bad_overlap,
       count(*) FILTER (WHERE n_inverted > 0) AS bad_inverted
FROM per""")
def ttst_integrity(t):
    """One current row per key, no overlaps, no inversions."""
    h = event_chain(t)
    per = T.integrity_per_key(h, ["user_id"])
    return per.agg(F.count(F.lit(1)).alias("n_keys"),
                   F.sum("n_versions").cast("long").alias("n_versions"),
                   F.count_if(F.col("n_current") != 1).alias("bad_current"),
                   F.count_if(F.col("n_overlap") > 0).alias("bad_overlap"),
                   F.count_if(F.col("n_inverted") > 0).alias("bad_inverted"))


@query("price_chain", oracle=f"WITH {PRICE_CHAIN} SELECT * FROM pchain")
def price_chain_q(t):
    """T3 on prices: part unit-price history from line observations."""
    return price_chain(t)


@query("asof_cost_join", oracle=f"""WITH {PRICE_CHAIN},
li AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, o.o_orderdate
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT li.l_orderkey, li.l_linenumber, li.l_partkey, li.o_orderdate,
       p.unit_price, li.l_quantity * p.unit_price AS cost
FROM li ASOF LEFT JOIN pchain p
  ON li.l_partkey = p.l_partkey AND li.o_orderdate >= p.sys_from""")
def asof_cost_join(t):
    """J13 + H6: price in effect at order time, times quantity."""
    li = (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
          .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey"))
    j = T.as_of_join(li, price_chain(t), ["l_partkey"], "o_orderdate", "sys_from", ["unit_price"], sizes=t.lineitem)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "unit_price",
                    (F.col("l_quantity") * F.col("unit_price")).alias("cost"))


@query("latest_per_key", oracle="""
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00') WHERE rn = 1""")
def latest_per_key(t):
    """Latest row per key at an instant (DISTINCT ON ... ORDER BY ts DESC)."""
    ev = t.events.filter(F.col("ts") <= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return T.dedupe_last(ev.select("user_id", "event_id", "ts", "event_type", "value"),
                         ["user_id"], ["ts", "event_id"])


_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("dedupe_last", oracle=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' DESC' for c in _LI_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_last_q(t):
    """De-duplicate overlapping rows on a non-unique key, last wins."""
    return T.dedupe_last(t.lineitem, ["l_orderkey", "l_linenumber"], _LI_ORDER)
