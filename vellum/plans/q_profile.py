"""Schema columns, column profiles, keys, pivots, dependencies and value domains of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions.text import fold_label
from vellum.operators import domains as D
from vellum.operators import profile as P
from vellum.plans.q_domains import _DOMAIN_ROWS_SQL, domain_rows
from vellum.plans.registry import query


@query("schema_columns", oracle="""
SELECT p_partkey, 0 AS pos, 'id' AS name, 'integer' AS type, 'int64' AS format, '' AS enum_values, p_name AS description, '' AS ref_name FROM part
UNION ALL SELECT p_partkey, 1, 'kind', 'string', '', 'A|' || p_type, '', '' FROM part
UNION ALL SELECT p_partkey, 2, 'brand', 'unknown', '', '', '', p_brand FROM part
UNION ALL SELECT p_partkey, 3, 'odd', 'unknown', '', '', '', '' FROM part""")
def schema_columns(t):
    """L1: columns of a response schema per part; even parts answer with an array."""
    props = F.concat(F.lit('{"type":"object","properties":{"id":{"type":"integer","format":"int64","description":"'), "p_name",
                     F.lit('"},"kind":{"type":"string","enum":["A","'), "p_type", F.lit('"]},"brand":{"$ref":"#/components/schemas/'), "p_brand", F.lit('"},"odd":"x"}}'))
    schema = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('{"type":"array","items":'), props, F.lit("}"))).otherwise(props)
    out = P.schema_columns(t.part.select("p_partkey", schema.alias("schema")), keep=["p_partkey"])
    return out.withColumn("enum_values", F.array_join("enum_values", "|"))


def counts(t):
    """Distinct values with their counts of eight numeric columns of three tables."""
    parts = [P.value_counts(df, cols) for df, cols in (
        (t.orders, ["o_orderkey", "o_custkey", "o_totalprice"]), (t.customer, ["c_custkey", "c_nationkey", "c_acctbal"]), (t.nation, ["n_nationkey", "n_regionkey"]))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _profile_sql(columns: str) -> str:
    one = "SELECT '{0}' AS column, count(*) AS n_rows, count({0}) AS n_values, count(DISTINCT {0}) AS n_distinct, avg(CASE WHEN {0} = floor({0}) THEN 1.0 ELSE 0 END) FILTER ({0} IS NOT NULL) AS discreteness, min({0}) AS lo, max({0}) AS hi FROM {1}"
    return " UNION ALL ".join(one.format(*c.split("@")) for c in columns.split())


_COLUMNS = "o_orderkey@orders o_custkey@orders o_totalprice@orders c_custkey@customer c_nationkey@customer c_acctbal@customer n_nationkey@nation n_regionkey@nation"


@query("column_profile", oracle=f"""WITH p AS ({_profile_sql(_COLUMNS)})
SELECT "column", n_rows, n_values, n_distinct, n_distinct / n_values AS cardinality, 1 - n_distinct / n_values AS repeatability, discreteness,
       n_distinct / (hi - lo + 1) AS density FROM p""")
def column_profile(t):
    """Shape of each column: distinct share, repeats, whole numbers, density of the range."""
    return P.profile(counts(t))


_VALUES_SQL = " UNION ALL ".join("SELECT DISTINCT '{0}' AS col, CAST({0} AS DOUBLE) AS v FROM {1} WHERE {0} IS NOT NULL".format(*c.split("@")) for c in _COLUMNS.split())


@query("key_triage", oracle=f"""WITH p AS ({_profile_sql(_COLUMNS)}),
kind AS (SELECT "column" AS col, n_distinct, coalesce(discreteness = 1, false) AS whole, coalesce(discreteness = 1 AND n_distinct = n_rows, false) AS is_key FROM p),
value AS ({_VALUES_SQL}),
held AS (
  SELECT a.col, b.col AS refers_to, count(*) AS c FROM value a JOIN kind k ON a.col = k.col AND k.whole AND NOT k.is_key
  JOIN value b ON a.v = b.v JOIN kind kb ON b.col = kb.col AND kb.is_key GROUP BY ALL),
best AS (SELECT h.col, refers_to, row_number() OVER (PARTITION BY h.col ORDER BY c DESC, refers_to DESC) AS r FROM held h JOIN kind k ON h.col = k.col WHERE c >= 0.95 * n_distinct)
SELECT k.col AS "column", CASE WHEN is_key THEN 'key' WHEN refers_to IS NOT NULL THEN 'foreign key' ELSE 'measure' END AS role, refers_to
FROM kind k LEFT JOIN best b ON k.col = b.col AND r = 1""")
def key_triage(t):
    """Keys, foreign keys with the key they refer to, and measures, from the profile and containment."""
    return P.key_triage(counts(t))


@query("unpivot_measures", oracle="""
SELECT o_custkey, CAST(y AS VARCHAR) AS year, 'sales' AS stem, sum(CASE WHEN year(o_orderdate) = y THEN o_totalprice END) AS amount
FROM orders, (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL) GROUP BY ALL""")
def unpivot_measures(t):
    """A wide table of yearly sums, of all years there are, back to rows; year and stem come from the column names."""
    y = F.year("o_orderdate")
    years = sorted(r.y for r in t.orders.select(y.alias("y")).distinct().filter("y IS NOT NULL").collect())  # the wide table's columns
    wide = t.orders.groupBy("o_custkey").agg(*[F.sum(F.when(y == n, F.col("o_totalprice"))).alias(f"sales_{n}") for n in years], F.count(F.lit(1)).alias("n_orders"))
    return P.unpivot_measures(wide, ["o_custkey"], r"^([a-z]+)_((?:19|20)\d\d)$", ["stem", "year"], "amount")


@query("pivot_groups", oracle="""
WITH c AS (
  SELECT DISTINCT p_brand, replace(p_name, ' ', '_') AS w, CASE WHEN p_size % 2 = 0 THEN 'q' || (p_partkey % 4 + 1) ELSE CAST(2020 + p_partkey % 3 AS VARCHAR) END AS token FROM part)
SELECT p_brand, '_#_' || w AS stem, count(*) AS n_tokens, min(token) AS least, max(token) AS greatest FROM c GROUP BY p_brand, w HAVING count(*) > 1""")
def pivot_groups(t):
    """Per brand, column names that differ in a year or quarter only."""
    token = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Q"), (F.col("p_partkey") % 4 + 1).cast("string"))).otherwise((F.col("p_partkey") % 3 + 2020).cast("string"))
    return P.pivot_groups(t.part.select("p_brand", F.concat(token, F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_"))).alias("name")), "p_brand")


def _fd_sql(table: str, a: str, b: str) -> str:
    return f"SELECT '{a}' AS determinant, '{b}' AS dependent, count(*) AS n_determinants, avg(CASE WHEN n = 1 THEN 1.0 ELSE 0 END) AS confidence FROM (SELECT {a}, count(DISTINCT {b}) AS n FROM {table} GROUP BY {a})"


@query("fd_check", oracle=" UNION ALL ".join([_fd_sql("customer", "c_custkey", "c_nationkey"), _fd_sql("part", "p_name", "p_type"), _fd_sql("orders", "o_custkey", "o_orderpriority")]))
def fd_check(t):
    """How far one column decides another."""
    out = P.dependency(t.customer, "c_custkey", "c_nationkey")
    return out.unionByName(P.dependency(t.part, "p_name", "p_type")).unionByName(P.dependency(t.orders, "o_custkey", "o_orderpriority"))


@query("value_domains", oracle=f"""WITH {_DOMAIN_ROWS_SQL},
v AS (SELECT 'segment' AS "column", c_mktsegment AS value FROM customer UNION ALL SELECT 'name', p_name FROM part UNION ALL SELECT 'type', p_type FROM part),
d AS (SELECT DISTINCT "column", strip_accents(lower(value)) AS key FROM v),
h AS (SELECT "column", domain_name, count(*) AS n FROM d LEFT JOIN (SELECT DISTINCT domain_name, key FROM mem) m ON d.key = m.key GROUP BY ALL)
SELECT "column", arg_max(domain_name, n) FILTER (domain_name IS NOT NULL) AS domain_name, coalesce(max(n) FILTER (domain_name IS NOT NULL), 0) AS n_matched,
       coalesce(sum(n) FILTER (domain_name IS NULL), 0)::BIGINT AS n_unknown FROM h GROUP BY "column\"""")
def value_domains(t):
    """Each column's dominant domain, its values there and those known nowhere."""
    v = t.customer.select(F.lit("segment").alias("column"), F.col("c_mktsegment").alias("value"))
    v = v.unionByName(t.part.select(F.lit("name").alias("column"), F.col("p_name").alias("value"))).unionByName(t.part.select(F.lit("type").alias("column"), F.col("p_type").alias("value")))
    return P.value_domains(v, D.members(domain_rows(t)), fold_label("value"))


@query("alias_concat", oracle="""
SELECT p_brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS kinds, '["' || string_agg(DISTINCT p_type, '","' ORDER BY p_type) || '"]' AS kinds_json FROM part GROUP BY p_brand""")
def alias_concat(t):
    """D6 + D11: the distinct kinds of a brand as one text and as JSON; pairs are made distinct before they are gathered."""
    kinds = F.array_sort(F.collect_list("p_type"))
    return t.part.select("p_brand", "p_type").distinct().groupBy("p_brand").agg(kinds.alias("k")).select("p_brand", F.array_join("k", "|").alias("kinds"), F.to_json("k").alias("kinds_json"))


@query("entity_counts", oracle="""
SELECT 'documents' AS entity, count(*) AS n FROM documents UNION ALL SELECT 'lines', sum(len(string_split(text, chr(10))))::BIGINT FROM documents
UNION ALL SELECT 'blobs', count(DISTINCT text) FROM documents UNION ALL SELECT 'sources', count(DISTINCT source) FROM documents""")
def entity_counts(t):
    """Entities read from the documents: rows, lines, distinct contents and sources."""
    d = t.documents.select("source", F.sha2("text", 256).alias("h"), F.size(F.split("text", "\n", -1)).alias("lines")).groupBy("source", "h").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("h").isNotNull(), F.col("lines"))).alias("lines"))
    by = d.groupBy("h").agg(F.sum("n").alias("documents"), F.sum("lines").alias("lines"))
    totals = by.agg(F.sum("documents").alias("documents"), F.sum("lines").alias("lines"), F.count("h").alias("blobs"))
    sources = d.select("source").distinct().agg(F.count("source").alias("n")).select(F.lit("sources").alias("entity"), "n")
    return totals.unpivot([], ["documents", "lines", "blobs"], "entity", "n").unionByName(sources)
