"""Relational operators from the JSON-path-vs-SQL comparison, on the
TPC-H-like tables: set operations, self join, recursive hierarchy,
correlated subquery, GROUP BY + HAVING, running totals, monthly averages,
and the predicted-vs-actual agreement matrix."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.operators.sequence import running_sum
from vellum.plans.registry import query


@query("set_ops", oracle="""
SELECT 'union' AS op, n FROM (SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', n FROM (SELECT c_nationkey AS n FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except', n FROM (SELECT n_nationkey AS n FROM nation EXCEPT SELECT s_nationkey FROM supplier)""")
def set_ops(t):
    """G1 + G4: UNION / INTERSECT / EXCEPT (distinct) over key sets."""
    c = t.customer.select(F.col("c_nationkey").alias("n"))
    s = t.supplier.select(F.col("s_nationkey").alias("n"))
    nat = t.nation.select(F.col("n_nationkey").alias("n"))
    return (c.union(s).distinct().select(F.lit("union").alias("op"), "n")
            .unionByName(c.intersect(s).select(F.lit("intersect").alias("op"), "n"))
            .unionByName(nat.subtract(s).select(F.lit("except").alias("op"), "n")))


@query("self_join_manager", oracle="""
SELECT e.c_custkey AS custkey, e.c_name AS name, m.c_custkey AS manager_key, m.c_name AS manager_name
FROM customer e JOIN customer m ON m.c_custkey = e.c_custkey // 10 WHERE e.c_custkey >= 10""")
def self_join_manager(t):
    """Aliased self join (each key's parent is key div 10, fan-out <= 10)."""
    e = t.customer.filter(F.col("c_custkey") >= 10).select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
        F.floor(F.col("c_custkey") / 10).cast("long").alias("manager_key"))
    m = t.customer.select(F.col("c_custkey").alias("manager_key"), F.col("c_name").alias("manager_name"))
    return e.join(m, "manager_key").select("custkey", "name", "manager_key", "manager_name")


@query("hierarchy_recursive", oracle="""
WITH RECURSIVE chain(custkey, ancestor, depth) AS (
  SELECT c_custkey, c_custkey, 0 FROM customer
  UNION ALL
  SELECT ch.custkey, p.c_custkey, ch.depth + 1
  FROM chain ch JOIN customer p ON p.c_custkey = ch.ancestor // 10
  WHERE ch.ancestor >= 10)
SELECT custkey, max(depth) AS depth, min(ancestor) AS root FROM chain GROUP BY custkey""")
def hierarchy_recursive(t):
    """The walk up a hierarchy to its root, whatever its depth.

    A pointer-jumping loop: each turn doubles the steps, so the joins are the
    logarithm of the depth, and no row count limits them.
    """
    own = t.customer.select(F.col("c_custkey").alias("node"))
    parents = own.select(F.col("node").alias("parent_key"))
    up = own.join(parents, (own.node >= 10) & (F.floor(own.node / 10) == F.col("parent_key")), "left")
    jumps = up.select("node", F.coalesce("parent_key", "node").alias("to"), F.when(F.col("parent_key").isNull(), 0).otherwise(1).cast("long").alias("steps")).persist()
    while True:
        further = jumps.select(F.col("node").alias("mid"), F.col("to").alias("to2"), F.col("steps").alias("steps2"))
        longer = jumps.join(further, F.col("to") == F.col("mid")).select("node", F.col("to2").alias("to"), (F.col("steps") + F.col("steps2")).alias("steps"))
        if not longer.join(further, F.col("to") == F.col("mid")).filter("steps2 > 0").take(1):
            return longer.select(F.col("node").alias("custkey"), F.col("steps").alias("depth"), F.col("to").alias("root"))
        jumps = longer.persist()


@query("correlated_counts", oracle="""
SELECT c.c_custkey, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_orders,
       (SELECT max(o_totalprice) FROM orders o WHERE o.o_custkey = c.c_custkey) AS max_price
FROM customer c""")
def correlated_counts(t):
    """Correlated scalar subqueries (Catalyst decorrelates to joins)."""
    t.customer.createOrReplaceTempView("_vl_customer")
    t.orders.createOrReplaceTempView("_vl_orders")
    return t.spark.sql("""
        SELECT c.c_custkey,
               (SELECT count(*) FROM _vl_orders o WHERE o.o_custkey = c.c_custkey) AS n_orders,
               (SELECT max(o_totalprice) FROM _vl_orders o WHERE o.o_custkey = c.c_custkey) AS max_price
        FROM _vl_customer c""")


@query("having_counts", oracle="""
SELECT n.n_name, count(*) AS n_customers, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS acctbal_cents
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name HAVING count(*) > 50""")
def having_counts(t):
    """D16 + D20 + J15: join, GROUP BY + HAVING."""
    c, n = t.customer, t.nation
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    g = j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"),
                                F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("acctbal_cents"))
    return g.filter(F.col("n_customers") > 50)


@query("running_total", oracle="""
SELECT o_custkey, o_orderkey, o_orderdate,
       sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_cents,
       CAST(round(o_totalprice * 100) AS BIGINT) - lag(CAST(round(o_totalprice * 100) AS BIGINT))
         OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS delta_cents
FROM orders""")
def running_total(t):
    """Running total and delta to the previous row per key, with the
    bucketed prefix-sum (a hot key is split by time bucket)."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate",
                        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    r = running_sum(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "cents", out="running_cents",
                    bucket_seconds=365 * 86400)
    return r.select("o_custkey", "o_orderkey", "o_orderdate", "running_cents",
                    (F.col("cents") - F.col("prev_cents")).alias("delta_cents"))


@query("monthly_trend", oracle="""
WITH m AS (
  SELECT date_trunc('month', o_orderdate) AS month, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
         count(*) AS n FROM orders GROUP BY ALL)
SELECT month, cents, n, cents / n AS avg_cents,
       cents - lag(cents, 12) OVER (ORDER BY month) AS yoy_cents,
       sum(cents) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS cents_3m
FROM m""")
def monthly_trend(t):
    """Monthly totals and average, year-over-year delta and 3-month
    moving sum (windows over the already aggregated months)."""
    o = t.orders.select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"),
                        F.round(F.col("o_totalprice") * 100).cast("long").alias("c"))
    m = o.groupBy("month").agg(F.sum("c").alias("cents"), F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("month")
    return m.select("month", "cents", "n", (F.col("cents") / F.col("n")).alias("avg_cents"),
                    (F.col("cents") - F.lag("cents", 12).over(w)).alias("yoy_cents"),
                    F.sum("cents").over(w.rowsBetween(-2, 0)).alias("cents_3m"))


@query("agreement_matrix", oracle="""
SELECT CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS predicted, l.quality AS actual, count(*) AS n
FROM documents d JOIN labels l USING (doc_id) GROUP BY ALL""")
def agreement_matrix(t):
    """D18 + J19: predicted label (length rule) vs actual label, confusion counts."""
    d = t.documents.select("doc_id", F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("predicted"))
    j = d.join(t.labels.select("doc_id", F.col("quality").alias("actual")), "doc_id")
    return j.groupBy("predicted", "actual").agg(F.count(F.lit(1)).alias("n"))


@query("route_by_type", oracle="""
SELECT CASE WHEN n_chars < 500 THEN 'small-model' WHEN lang = 'en' THEN 'default-model'
            ELSE 'multilingual-model' END AS route, count(*) AS n
FROM documents GROUP BY ALL""")
def route_by_type(t):
    """Q7 + B18: route rows to a model by a rule column."""
    route = (F.when(F.col("n_chars") < 500, "small-model")
              .when(F.col("lang") == "en", "default-model").otherwise("multilingual-model"))
    return t.documents.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query("request_cross_product", oracle="""
SELECT r.r_name AS substance, m.metric, r.r_name || ':' || m.metric AS request_key
FROM region r, (VALUES ('boiling_point'), ('density'), ('melting_point')) m(metric)""")
def request_cross_product(t):
    """Q8: every subject x every requested metric (explode of a fixed,
    three-element metric list — no table cross join)."""
    metrics = F.array(*[F.lit(m) for m in ("boiling_point", "density", "melting_point")])
    r = t.region.select(F.col("r_name").alias("substance"), F.explode(metrics).alias("metric"))
    return r.select("substance", "metric", F.concat_ws(":", "substance", "metric").alias("request_key"))
