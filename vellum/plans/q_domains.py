"""Domain-set and schema-fingerprint queries.

Domains are built from the categorical columns of the TPC-H-like tables;
probes run every categorical column (and every document word) against them.
Fingerprints treat each document as a table whose column names are its
words: names are classified into domains, tables get domain sets, subject
areas and their most similar peers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions.text import fold_label
from vellum.operators import domains as D
from vellum.operators import fingerprint as FP
from vellum.plans.registry import query
from vellum.sources.shared import fresh_dir

NOW = "2024-02-01 00:00:00"
WORD_SPLIT = r"[^\p{L}\p{N}_]+"


def domain_rows(t):
    """(domain_name, label, alt_labels) rows derived from the tables."""
    no_alt = F.array().cast("array<string>")
    parts = [
        t.nation.select(F.lit("nation").alias("domain_name"), F.col("n_name").alias("label"),
                        F.array(F.regexp_replace("n_name", "_", " ")).alias("alt_labels")),
        t.region.select(F.lit("region"), "r_name", no_alt),
        t.customer.select(F.lit("segment"), "c_mktsegment", no_alt),
        t.part.select(F.lit("part_type"), "p_type", no_alt),
        t.part.select(F.lit("brand"), "p_brand", no_alt),
        t.part.select(F.lit("part_word"), F.split("p_name", " ")[0], F.array(F.split("p_name", " ")[1])),
        t.orders.select(F.lit("priority"), "o_orderpriority", no_alt),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


_DOMAIN_ROWS_SQL = """
drows AS (
  SELECT 'nation' AS domain_name, n_name AS label, [replace(n_name, '_', ' ')] AS alt_labels FROM nation
  UNION ALL SELECT 'region', r_name, []::VARCHAR[] FROM region
  UNION ALL SELECT 'segment', c_mktsegment, []::VARCHAR[] FROM customer
  UNION ALL SELECT 'part_type', p_type, []::VARCHAR[] FROM part
  UNION ALL SELECT 'brand', p_brand, []::VARCHAR[] FROM part
  UNION ALL SELECT 'part_word', string_split(p_name, ' ')[1], [string_split(p_name, ' ')[2]] FROM part
  UNION ALL SELECT 'priority', o_orderpriority, []::VARCHAR[] FROM orders),
mem AS (
  SELECT DISTINCT domain_name, strip_accents(lower(label)) AS key, label FROM (
    SELECT domain_name, label FROM drows
    UNION ALL SELECT domain_name, unnest(alt_labels) FROM drows) WHERE label IS NOT NULL)
"""


@query("label_fold", oracle=r"""
SELECT DISTINCT w AS word, replace(strip_accents(lower(w)), 'ß', 'ss') AS label FROM (
  SELECT unnest(regexp_split_to_array(text, '[^\p{L}\p{N}_]+')) AS w FROM documents) WHERE w <> ''""")
def label_fold(t):
    """H19 + M2: every word of the documents with the label that it folds to."""
    words = t.documents.select(F.explode(F.split("text", WORD_SPLIT)).alias("word")).filter("word <> ''").distinct()
    return words.select("word", fold_label("word").alias("label"))


@query("domain_build", oracle=f"""WITH {_DOMAIN_ROWS_SQL}
SELECT domain_name, count(*) AS label_rows, count(DISTINCT key) AS n_keys FROM mem GROUP BY domain_name""")
def domain_build(t):
    """M1 + M2 + M3 + D10 + G1: member sets from labels and aliases."""
    return D.cardinality(D.members(domain_rows(t)))


PROBE_COLUMNS = {
    "customer": ["c_mktsegment", "c_name"],
    "orders": ["o_orderpriority", "o_orderstatus"],
    "part": ["p_type", "p_brand", "p_name"],
    "nation": ["n_name"],
    "supplier": ["s_name"],
}


def probe_values(t):
    tables = {n: getattr(t, n) for n in PROBE_COLUMNS}
    vals = D.column_values(tables, PROBE_COLUMNS)
    words = (t.documents.select(F.explode(F.split(F.lower("text"), WORD_SPLIT)).alias("value"))
             .filter(F.col("value") != "")
             .groupBy("value").agg(F.count(F.lit(1)).alias("freq"))
             .select(F.lit("documents").alias("table_name"), F.lit("word").alias("column_name"), "value", "freq"))
    return vals.unionByName(words)


def _probe_sql():
    parts = []
    for tname, cols in PROBE_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT '{tname}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value "
                         f"FROM {tname}")
    parts.append("SELECT 'documents', 'word', w FROM (SELECT unnest(regexp_split_to_array(lower(text), "
                 "'[^\\p{L}\\p{N}_]+')) AS w FROM documents) WHERE w <> ''")
    return "\n  UNION ALL ".join(parts)


_PROBE_SQL = f"""{_DOMAIN_ROWS_SQL},
vals AS (
  {_probe_sql()}),
v AS (SELECT table_name, column_name, strip_accents(lower(value)) AS key, count(*) AS freq
      FROM vals WHERE value IS NOT NULL GROUP BY ALL),
tot AS (SELECT table_name, column_name, count(*) AS n_values, sum(freq) AS total_freq FROM v GROUP BY ALL),
dk AS (SELECT DISTINCT domain_name, key FROM mem),
ds AS (SELECT domain_name, count(*) AS domain_size FROM dk GROUP BY ALL),
hit AS (SELECT v.table_name, v.column_name, dk.domain_name, count(*) AS n_matches, sum(v.freq) AS matched_freq
        FROM v JOIN dk ON v.key = dk.key GROUP BY ALL)
"""


@query("domain_probe", oracle=f"""WITH {_PROBE_SQL}
SELECT h.table_name, h.column_name, h.domain_name, t.n_values, h.n_matches,
       round(h.n_matches / t.n_values, 6) AS containment,
       round(h.matched_freq / t.total_freq, 6) AS weighted_containment,
       round(h.n_matches / (t.n_values + ds.domain_size - h.n_matches), 6) AS jaccard
FROM hit h JOIN tot t USING (table_name, column_name) JOIN ds USING (domain_name)""")
def domain_probe(t):
    """M4 + M5 + M6 + M7 + M12: containment / weighted / Jaccard per column x domain."""
    p = D.probe(probe_values(t), D.members(domain_rows(t)))
    return p.select("table_name", "column_name", "domain_name", "n_values", "n_matches",
                    *[F.round(c, 6).alias(c) for c in ("containment", "weighted_containment", "jaccard")])


@query("domain_writeback", oracle=f"""WITH {_DOMAIN_ROWS_SQL},
card AS (SELECT domain_name, count(DISTINCT key) AS member_count FROM mem GROUP BY ALL),
old AS (SELECT domain_name, 'seed' AS source, member_count - 1 AS member_count,
               TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
        FROM card WHERE domain_name IN ('nation', 'region', 'segment')
        UNION ALL SELECT 'legacy', 'seed', 3, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:00'),
inc AS (SELECT domain_name, 'tables' AS source, member_count FROM card)
SELECT coalesce(o.domain_name, i.domain_name) AS domain_name, coalesce(o.source, i.source) AS source,
       coalesce(i.member_count, o.member_count) AS member_count,
       coalesce(o.created_at, TIMESTAMP '{NOW}') AS created_at,
       CASE WHEN i.domain_name IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE o.updated_at END AS updated_at
FROM old o FULL OUTER JOIN inc i ON o.domain_name = i.domain_name""")
def domain_writeback(t):
    """M10 + A24: upsert domain definitions, conflict updates count/updated_at only."""
    card = (D.members(domain_rows(t)).groupBy("domain_name")
            .agg(F.count_distinct("key").alias("member_count")))
    seed = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    old = (card.filter(F.col("domain_name").isin("nation", "region", "segment"))
               .select("domain_name", F.lit("seed").alias("source"), (F.col("member_count") - 1).alias("member_count"),
                       seed.alias("created_at"), seed.alias("updated_at")))
    legacy = (t.spark.createDataFrame([("legacy", "seed", 3)], "domain_name string, source string, member_count long")
              .select("*", seed.alias("created_at"), seed.alias("updated_at")))
    inc = card.select("domain_name", F.lit("tables").alias("source"), "member_count")
    return D.writeback(old.unionByName(legacy), inc, NOW)


@query("domain_new_only", oracle="""
SELECT DISTINCT lower(p_type) AS domain_name FROM part WHERE lower(p_type) NOT IN
  ('nation', 'region', 'segment', 'part_type', 'brand', 'part_word', 'priority', 'small')""")
def domain_new_only(t):
    """J10 + M11: suggested domains minus known ones (anti join)."""
    known = domain_rows(t).select("domain_name").distinct().unionByName(
        t.spark.createDataFrame([("small",)], "domain_name string"))
    sugg = t.part.select(F.lower("p_type").alias("domain_name")).distinct()
    return D.new_only(sugg, known)


# ------------------------------------------------------------- fingerprints
def doc_words(t):
    """(doc_id, name) — distinct name keys (lower, '_' trimmed) per document."""
    w = F.explode(F.array_distinct(F.filter(
        F.transform(F.split(F.lower("text"), WORD_SPLIT), lambda x: F.regexp_replace(x, r"^_+|_+$", "")),
        lambda x: x != "")))
    return t.documents.select("doc_id", w.alias("name"))


def doc_sets(t):
    """(doc_id, names) — each document's names as one array; rows of one id are one document."""
    w = F.filter(F.transform(F.split(F.lower("text"), WORD_SPLIT), lambda x: F.regexp_replace(x, r"^_+|_+$", "")), lambda x: x != "")
    sets = t.documents.select("doc_id", F.array_distinct(w).alias("names"))
    repeated = t.documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").take(1)
    return sets.groupBy("doc_id").agg(F.flatten(F.collect_list("names")).alias("names")) if repeated else sets


def classified_names(t):
    names = doc_words(t).select("name").distinct()
    return names.select("name", FP.classify(F.col("name")).alias("domains"))


def kept_vocabulary(t):
    """The names that have a domain, classified once and written to the shared folder.

    All are written and then filtered: a filter before would be pushed below
    the distinct, and the rules would run for every word of every table.
    """
    path = f"{fresh_dir(t.spark, 'vocabulary')}/names"
    classified_names(t).write.parquet(path)
    return t.spark.read.parquet(path).filter(F.size("domains") > 0)


def _rule_sql(col: str) -> str:
    whens = []
    for dom, pats, _ in FP.DOMAIN_RULES:
        if not pats:
            continue
        pat = "|".join(f"(?:{p})" for p in pats).replace("'", "''")
        whens.append(f"CASE WHEN regexp_matches({col}, '{pat}') THEN '{dom}' END")
    return f"list_filter([{', '.join(whens)}], lambda x: x IS NOT NULL)"


_WORDS_SQL = f"""
words AS (
  SELECT DISTINCT doc_id, regexp_replace(w, '^_+|_+$', '', 'g') AS name
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS w FROM documents)
  WHERE regexp_replace(w, '^_+|_+$', '', 'g') <> ''),
cls AS (SELECT name, {_rule_sql('name')} AS domains FROM (SELECT DISTINCT name FROM words)),
tdom AS (
  SELECT doc_id, list_sort(list_distinct(flatten(list(c.domains)))) AS domains
  FROM words w JOIN cls c USING (name) GROUP BY doc_id)
"""


@query("column_domains", oracle=f"""WITH {_WORDS_SQL}
SELECT name, array_to_string(domains, ',') AS domains FROM cls""")
def column_domains(t):
    """L2: rule-based domains per column name (ordered, de-duplicated)."""
    return classified_names(t).select("name", F.array_join("domains", ",").alias("domains"))


def table_domains(t):
    """Distinct domains per table.

    Only names that have a domain are joined back; under a counted bound they
    are broadcast, so words aren't shuffled and a word that all tables have is
    no hot key. Beyond it the join is by word and a salt of the table.
    """
    words = doc_words(t)
    cls = kept_vocabulary(t)
    small = D.materialised(cls)
    if small is cls:
        salts = 32
        hit = words.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts))).join(
            cls.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))), ["name", "salt"])
    else:
        hit = words.join(small, "name")
    d = hit.select("doc_id", F.explode("domains").alias("d")).unionByName(t.documents.select("doc_id", F.lit(None).cast("string").alias("d")))
    return d.groupBy("doc_id").agg(F.array_sort(F.collect_set("d")).alias("domains"))


@query("table_domains", oracle=f"""WITH {_WORDS_SQL}
SELECT d.doc_id, coalesce(array_to_string(t.domains, ','), '') AS domains
FROM documents d LEFT JOIN tdom t USING (doc_id)""")
def table_domains_q(t):
    """L3 + D14: union of column domains per table."""
    return table_domains(t).select("doc_id", F.array_join("domains", ",").alias("domains"))


def _clusters_sql():
    rows = []
    for name, members in FP.CLUSTERS.items():
        rows.append(f"('{name}', [{', '.join(repr(m) for m in members)}])")
    return "VALUES " + ", ".join(rows)


@query("subject_area", oracle=f"""WITH {_WORDS_SQL},
cl(cluster, members) AS ({_clusters_sql()}),
s AS (SELECT t.doc_id, cl.cluster, len(list_intersect(t.domains, cl.members)) AS ov, len(cl.members) AS nc,
             len(t.domains) AS nd
      FROM tdom t, cl)
SELECT doc_id, cluster, round_even(0.5 * ov / nc + 0.5 * ov / nd, 3) AS score FROM s WHERE ov > 0""")
def subject_area(t):
    """Subject-area clusters with coverage/precision score."""
    td = table_domains(t).filter(F.size("domains") > 0)
    return td.select("doc_id", F.inline(FP.subject_areas(F.col("domains"))))


@query("subject_area_ranked", oracle=f"""WITH {_WORDS_SQL},
cl(cluster, members) AS ({_clusters_sql()}),
placed AS (SELECT *, row_number() OVER () AS pos FROM cl),
s AS (SELECT t.doc_id, p.cluster, p.pos, len(list_intersect(t.domains, p.members)) AS ov, len(p.members) AS nc, len(t.domains) AS nd FROM tdom t, placed p),
c AS (SELECT doc_id, cluster, pos, round_even(0.5 * ov / nc + 0.5 * ov / nd, 3) AS score FROM s WHERE ov > 0)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank, cluster FROM c""")
def subject_area_ranked(t):
    """a document's clusters by score, of equal ones by declaration."""
    td = table_domains(t).filter(F.size("domains") > 0)
    return td.select("doc_id", F.posexplode(FP.subject_areas(F.col("domains"))).alias("pos", "c")).select("doc_id", (F.col("pos") + 1).alias("rank"), "c.cluster")


@query("table_similarity", oracle=f"""WITH {_WORDS_SQL},
n AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
wl AS (SELECT doc_id, list(name) AS l FROM words GROUP BY ALL),
inter AS (SELECT a.doc_id AS target, b.doc_id AS candidate, count(*) AS inter
          FROM words a JOIN words b ON a.name = b.name AND a.doc_id <> b.doc_id GROUP BY ALL),
j AS (SELECT i.target, i.candidate, i.inter, i.inter / (na.n + nb.n - i.inter) AS name_jaccard
      FROM inter i JOIN n na ON na.doc_id = i.target JOIN n nb ON nb.doc_id = i.candidate),
f AS (SELECT j.*, coalesce(ta.domains, []) AS da, coalesce(tb.domains, []) AS db FROM j
      LEFT JOIN tdom ta ON ta.doc_id = j.target LEFT JOIN tdom tb ON tb.doc_id = j.candidate
      WHERE name_jaccard * 5 >= 1),
g AS (SELECT target, candidate, inter, name_jaccard,
             CASE WHEN len(list_distinct(list_concat(da, db))) = 0 THEN 0.0
                  ELSE len(list_intersect(da, db)) / len(list_distinct(list_concat(da, db))) END AS domain_jaccard
      FROM f),
r AS (SELECT *, 0.6 * name_jaccard + 0.4 * domain_jaccard AS combined,
             row_number() OVER (PARTITION BY target ORDER BY 0.6 * name_jaccard + 0.4 * domain_jaccard DESC,
                                candidate) AS rank FROM g)
SELECT target, candidate, inter AS matched_columns, round(name_jaccard, 6) AS name_jaccard,
       round(domain_jaccard, 6) AS domain_jaccard, round(combined, 6) AS combined, rank, array_to_string(list_sort(list_intersect(wa.l, wb.l)), ' ') AS matched_names
FROM r JOIN wl wa ON wa.doc_id = target JOIN wl wb ON wb.doc_id = candidate WHERE rank <= 20""")
def table_similarity(t):
    """L4 + L5 + L6 + F1: peers with name Jaccard >= 0.2, combined score
    0.6 name + 0.4 domain, top 20 per table."""
    classes, members = FP.equal_sets(doc_sets(t), "doc_id", "names")
    td = FP.kept(table_domains(t), f"{fresh_dir(t.spark, 'domains')}/tables")
    da = td.select(F.col("doc_id").alias("a"), F.col("domains").alias("da"))
    db = td.select(F.col("doc_id").alias("b"), F.col("domains").alias("db"))
    several = members.groupBy(F.col("rep").alias("doc_id")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    n = F.size("names")
    own = classes.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"), n.alias("n_a"), n.alias("n_b"), n.alias("inter"), F.lit(1.0).alias("jaccard"))

    def best(pairs):
        s = (pairs.unionByName(own).join(da, "a", "left").join(db, "b", "left")
                  .withColumn("domain_jaccard", FP.set_jaccard(F.coalesce("da", F.array().cast("array<string>")),
                                                               F.coalesce("db", F.array().cast("array<string>"))))
                  .withColumn("combined", F.lit(0.6) * F.col("jaccard") + F.lit(0.4) * F.col("domain_jaccard")))
        # a class's copies are alike and its smallest id stands for it: a table's own copies and 20 other classes hold its 20 best
        return FP.top_k(s, "a", [F.col("combined").desc(), F.col("b")], 21, salt_on="b").drop("da", "db", "rank")

    pairs = FP.kept(FP.similar_sets(classes.join(td, "doc_id", "left"), "doc_id", "names", 1, 5, keep=best, closest=FP.Closest(21, "domains", 0.4)), f"{fresh_dir(t.spark, 'similar')}/pairs")
    few = FP.top_k(members, "rep", [F.col("doc_id")], 21, salt_on="doc_id").select(F.col("rep").alias("b"), F.col("doc_id").alias("candidate"))
    top = FP.top_k(pairs.drop("shared").join(few, "b"), "a", [F.col("combined").desc(), F.col("candidate")], 21, salt_on="candidate")
    row = F.struct("rank", "b", "candidate", "inter", "jaccard", "domain_jaccard", "combined")
    lists = top.groupBy("a").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    others = F.slice(F.filter("rows", lambda r: r["candidate"] != F.col("target")), 1, 20)
    out = members.select(F.col("doc_id").alias("target"), F.col("rep").alias("a")).join(lists, "a").select("target", "a", F.posexplode(others).alias("at", "r"))
    out = out.select("target", "a", "r.*", (F.col("at") + 1).alias("place")).join(pairs.select("a", "b", F.array_join("shared", " ").alias("names")), ["a", "b"])
    return out.select("target", "candidate", F.col("inter").alias("matched_columns"), F.round("jaccard", 6).alias("name_jaccard"),
                      F.round("domain_jaccard", 6).alias("domain_jaccard"), F.round("combined", 6).alias("combined"),
                      F.col("place").alias("rank"), F.col("names").alias("matched_names"))
