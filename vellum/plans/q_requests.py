"""Costs at call time, prompts, provider selection, orders and slices, staging."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import domains as D
from vellum.operators import embeddings as E
from vellum.operators import pricing as P
from vellum.operators import reshape as R
from vellum.plans.q_domains import _DOMAIN_ROWS_SQL, domain_rows
from vellum.plans.q_embed import CONSTRAINTS, unified
from vellum.plans.q_temporal import PRICE_CHAIN, price_chain
from vellum.plans.registry import query


@query("usage_cost_by_model", oracle=f"""WITH {PRICE_CHAIN},
call AS (
  SELECT o_custkey AS user_id, l_partkey, o_orderdate, l_quantity * 1000 AS prompt_tokens, l_linenumber * 100 AS completion_tokens,
         CASE l_returnflag WHEN 'R' THEN 'cache_read' WHEN 'A' THEN 'batch' END AS mode FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
priced AS (
  SELECT c.*, p.unit_price AS i, p.unit_price * 5 AS o, CASE mode WHEN 'cache_read' THEN 0.1 WHEN 'batch' THEN 0.5 ELSE 1 END::DOUBLE AS mi, CASE mode WHEN 'batch' THEN 0.5 ELSE 1 END::DOUBLE AS mo
  FROM call c ASOF LEFT JOIN pchain p ON c.l_partkey = p.l_partkey AND c.o_orderdate >= p.sys_from)
SELECT l_partkey AS model, count(DISTINCT user_id) AS n_users, count(*) AS calls, count(*) FILTER (i IS NULL) AS unpriced, round(sum((prompt_tokens * i * mi + completion_tokens * o * mo) / 1e6), 4) AS cost
FROM priced GROUP BY l_partkey""")
def usage_cost_by_model(t):
    """Q6 + H6 + J13: calls with the price of their time, and what cache and batch do to it, summed by model."""
    line = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("model"), "l_quantity", "l_linenumber", "l_returnflag")
    calls = line.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("called_at")), "l_orderkey").select(
        "model", "user_id", "called_at", (F.col("l_quantity") * 1000).alias("prompt_tokens"), (F.col("l_linenumber") * 100).alias("completion_tokens"),
        F.when(F.col("l_returnflag") == "R", "cache_read").when(F.col("l_returnflag") == "A", "batch").alias("mode"))
    history = price_chain(t).select(F.col("l_partkey").alias("model"), "sys_from", F.col("unit_price").alias("input_per_mtok"), (F.col("unit_price") * 5).alias("output_per_mtok"))
    priced = P.cost_at_call(calls, history, "model", "called_at", sizes=line)
    return priced.groupBy("model").agg(F.count_distinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("calls"), F.count_if(F.col("cost").isNull()).alias("unpriced"),
                                       F.round(F.sum("cost"), 4).alias("cost"))


@query("prompt_table", oracle="""
SELECT p_partkey, 'As ' || lower(p_type) || ': prices of ' || p_brand || ' in ' || CASE WHEN p_size > 25 THEN 'EUR' ELSE 'USD' END || ' for ' || p_name || '.' AS prompt,
       CASE WHEN p_size > 25 THEN 3 ELSE 3 END AS n_used FROM part WHERE p_type <> 'PROMO'""")
def prompt_table(t):
    """Q1 + B13: parts as parameters, their types as adapters (one type has none); a part's own values go before the defaults."""
    adapters = t.part.select(F.col("p_type").alias("adapter")).distinct().filter("adapter <> 'PROMO'").select(
        "adapter", F.concat(F.lit("As "), F.lower("adapter"), F.lit(": prices of {{ provider }} in {{currency}} for {{ page }}{{ none }}.")).alias("template"),
        F.create_map(F.lit("currency"), F.lit("USD"), F.lit("page"), F.lit("all")).alias("defaults"))
    own = F.create_map(F.lit("provider"), F.col("p_brand"), F.lit("page"), F.col("p_name"), F.lit("currency"), F.when(F.col("p_size") > 25, "EUR"))
    made = R.prompts(t.part.select("p_partkey", F.col("p_type").alias("adapter"), own.alias("params")), adapters)
    return made.select("p_partkey", "prompt", F.size("used").alias("n_used"))


@query("provider_selection", oracle="""
WITH p AS (SELECT p_brand AS provider, bool_and(p_size % 2 = 0) AS browser, max(p_size) AS biggest, min(p_size) AS smallest, count(*) AS n FROM part GROUP BY p_brand)
SELECT provider, 'https://' || lower(provider) || '/pricing' AS pricing_url, CASE WHEN biggest % 3 = 0 THEN 'browser' ELSE 'reader' END AS fetch, n AS n_models
FROM p WHERE smallest % 2 = 1 AND provider <> 'Brand#2'""")
def provider_selection(t):
    """B18 + B11: brands as providers; those that are current, on the list and have a pricing page, with the models under their prefix."""
    brand = t.part.groupBy(F.col("p_brand").alias("provider")).agg(F.max("p_size").alias("biggest"), F.min("p_size").alias("smallest"))
    url = F.when(F.col("smallest") % 2 == 1, F.concat(F.lit("https://"), F.lower("provider"), F.lit("/pricing")))
    providers = brand.select("provider", F.create_map(F.lit("pricing"), url).alias("urls"), F.when(F.col("provider") == "Brand#2", F.current_timestamp()).alias("sys_to"),
                             (F.col("biggest") % 3 == 0).alias("needs_browser"))
    models = t.part.select(F.concat_ws("/", "p_brand", F.col("p_partkey").cast("string")).alias("model"), F.col("p_brand").alias("owner"))
    chosen = P.selected_providers(providers)
    own = P.models_of(chosen.join(models, F.col("owner") == F.col("provider")), F.col("provider"))
    return own.groupBy("provider", "pricing_url", "fetch").agg(F.count(F.lit(1)).alias("n_models"))


@query("probe_ranked", oracle=f"""WITH {_DOMAIN_ROWS_SQL},
v AS (SELECT 'name' AS col, lower(p_name) AS key FROM part UNION SELECT 'name', lower(unnest(string_split(p_name, ' '))) FROM part UNION SELECT 'name', lower(p_brand) FROM part UNION SELECT 'type', lower(p_type) FROM part UNION SELECT 'type', lower(r_name) FROM region),
n AS (SELECT col, count(*) AS n FROM v GROUP BY col),
h AS (SELECT v.col, domain_name, count(*) AS m FROM v JOIN (SELECT DISTINCT domain_name, key FROM mem) d USING (key) GROUP BY ALL)
SELECT col AS column_name, domain_name, m AS n_matches, row_number() OVER (PARTITION BY col ORDER BY m DESC, m / n DESC, domain_name) AS rank FROM h JOIN n USING (col)""")
def probe_ranked(t):
    """a column's domains by matches, then containment, then name."""
    from pyspark.sql import Window

    value = lambda col, df, c: df.select(F.lit("v").alias("table_name"), F.lit(col).alias("column_name"), F.col(c).alias("value")).distinct()
    words = t.part.select(F.explode(F.concat(F.split("p_name", " "), F.array("p_name", "p_brand"))).alias("w"))
    values = value("name", words, "w").unionByName(value("type", t.part, "p_type")).unionByName(value("type", t.region, "r_name")).withColumn("freq", F.lit(1))
    probed = D.probe(values, D.members(domain_rows(t)))
    order = Window.partitionBy("column_name").orderBy(F.desc("n_matches"), F.desc("containment"), "domain_name")
    return probed.select("column_name", "domain_name", "n_matches", F.row_number().over(order).alias("rank"))


@query("word_slices", oracle="""
WITH d AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
SELECT doc_id, array_to_string(w[1:3], ' ') AS first_three, array_to_string(list_reverse(w[-2:]), ' ') AS last_two_back, list_sort(w)[1] AS least FROM d""")
def word_slices(t):
    """F3 + F4: slices from either end, reversal and order of arrays."""
    w = F.split("text", " ")
    tail = F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), F.lit(2))
    return t.documents.select("doc_id", F.array_join(F.slice(w, 1, 3), " ").alias("first_three"), F.array_join(F.reverse(tail), " ").alias("last_two_back"), F.array_min(w).alias("least"))


@query("gazetteer_staging", oracle="""
SELECT c_custkey AS place_id, c_name AS place_name, n_name AS country, r_name AS continent, r_name || '/' || n_name || '/' || c_name AS full_path
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def gazetteer_staging(t):
    """Places with their country, continent and path; of each table only the columns named are read."""
    c, n, r = t.customer.select("c_custkey", "c_name", "c_nationkey"), t.nation.select("n_nationkey", "n_name", "n_regionkey"), t.region.select("r_regionkey", "r_name")
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select(F.col("c_custkey").alias("place_id"), F.col("c_name").alias("place_name"), F.col("n_name").alias("country"), F.col("r_name").alias("continent"),
                    F.concat_ws("/", "r_name", "n_name", "c_name").alias("full_path"))


@query("prefilter_reduction", oracle="""
SELECT count(*) AS n, count(*) FILTER (label IN (1, 3, 5) AND CAST(embedding[1] AS DOUBLE) BETWEEN -0.05 AND 0.2) AS kept,
       round(100.0 * (1 - count(*) FILTER (label IN (1, 3, 5) AND CAST(embedding[1] AS DOUBLE) BETWEEN -0.05 AND 0.2) / count(*)), 2) AS reduction_pct FROM embeddings""")
def prefilter_reduction(t):
    """P10: how far the constraints shrink the vectors before the search, in one pass."""
    u = unified(t)
    kept = F.count_if(E.constraint_predicate(u, CONSTRAINTS))
    return u.agg(F.count(F.lit(1)).alias("n"), kept.alias("kept"), F.round(100.0 * (1 - kept / F.count(F.lit(1))), 2).alias("reduction_pct"))
