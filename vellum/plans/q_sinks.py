"""Sinks: merged prices, refreshed specifications, domains with their members.

Each query writes its tables under the shared folder, applies the change,
applies it once more (which must write nothing), and returns what the tables
then hold with the version in force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import domains as D
from vellum.operators import sinks as S
from vellum.operators.temporal import dedupe_last
from vellum.plans.q_domains import _DOMAIN_ROWS_SQL, domain_rows
from vellum.plans.registry import query
from vellum.sources.shared import fresh_dir

SPLIT = "1998-01-01 00:00:00"


def observed_prices(t, before: bool):
    """Prices per part observed before ``SPLIT``, or since."""
    when = F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz")
    li = t.lineitem.filter(when if before else ~when)
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select(F.col("l_partkey").alias("part"), price.alias("unit_price"), price.alias("highest"), F.col("l_shipdate").alias("first_seen"),
                     F.when(F.col("l_returnflag") == "R", "returned").alias("note"), "l_orderkey", "l_linenumber")


ORDER = ("first_seen", "l_orderkey", "l_linenumber", "unit_price", "note")
_LAST_SQL = """SELECT l_partkey AS part, l_extendedprice / l_quantity AS unit_price, l_shipdate AS first_seen, CASE WHEN l_returnflag = 'R' THEN 'returned' END AS note,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice / l_quantity DESC,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END DESC) AS k FROM lineitem WHERE l_shipdate"""


@query("price_refresh", oracle=f"""WITH
a AS (SELECT * FROM ({_LAST_SQL} < TIMESTAMP '{SPLIT}') WHERE k = 1),
b AS (SELECT * FROM ({_LAST_SQL} >= TIMESTAMP '{SPLIT}') WHERE k = 1)
SELECT coalesce(a.part, b.part) AS part, coalesce(b.unit_price, a.unit_price) AS unit_price, greatest(a.unit_price, b.unit_price) AS highest,
       coalesce(a.first_seen, b.first_seen) AS first_seen, coalesce(b.note, a.note) AS note, 2 AS version
FROM a FULL JOIN b ON a.part = b.part""")
def price_refresh(t):
    """T10 + A24: known prices merged with later ones: price replaced, first sight kept, highest raised, note filled."""
    tables = S.TableSet(t.spark, fresh_dir(t.spark, "prices"))
    known = observed_prices(t, before=True)
    tables.create({"prices": (dedupe_last(known, ["part"], ORDER).select("part", "unit_price", "highest", "first_seen", "note"), "part")})
    for _ in range(2):
        done = S.merge(tables, "prices", observed_prices(t, before=False), ["part"], {"first_seen": "keep", "highest": "greatest", "note": "filled"}, ORDER)
    return tables.read("prices").select("part", "unit_price", "highest", "first_seen", "note", F.lit(done.version).alias("version"))


def spec_snapshots(t, version: int):
    """An API per two documents: the even one is its first version, the odd one its second.

    Specs, their paths (a line's first word; of equal ones the last line by
    its text) and operations (``get``, and ``post`` where the line has a comma).
    """
    docs = t.documents.filter(F.pmod("doc_id", F.lit(2)) == version - 1).withColumn("api", F.floor(F.col("doc_id") / 2))
    line = docs.select("api", F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line") != "")
    # exchanged by ranges of the api, in which lines of a path meet and a first load is written
    path = line.repartitionByRange("api").select("api", F.concat(F.lit("/"), F.substring_index("line", " ", 1)).alias("path"), F.col("line").alias("summary"))
    path = path.groupBy("api", "path").agg(F.max("summary").alias("summary"))
    method = F.when(F.col("summary").contains(","), F.array(F.lit("get"), F.lit("post"))).otherwise(F.array(F.lit("get")))
    # of the paths as the refresh has them, so that the texts aren't exchanged again
    ops = lambda done: done["paths"].select("api", "path", F.explode(method).alias("method"), (F.length("summary") % 2 == 0).alias("deprecated"))
    return {"specs": S.Snapshot(docs.select("api", F.col("lang").alias("title"), F.col("source").alias("spec_version")), ("api",), ("api",), ("title", "spec_version")),
            "paths": S.Snapshot(path, ("api", "path"), ("api",), ("summary",), ranged=True), "operations": S.Snapshot(ops, ("api", "path", "method"), ("api",), ("deprecated",))}


_SPECS_SQL = """
docs AS (SELECT doc_id // 2 AS api, doc_id % 2 AS v, lang, source, text FROM documents),
line AS (SELECT api, v, unnest(string_split(text, chr(10))) AS line FROM docs),
path AS (SELECT api, v, '/' || string_split(line, ' ')[1] AS path, max(line) AS summary FROM line WHERE line <> '' GROUP BY ALL),
op AS (SELECT api, v, path, unnest(CASE WHEN contains(summary, ',') THEN ['get', 'post'] ELSE ['get'] END) AS method, length(summary) % 2 = 0 AS deprecated FROM path),
every AS (
  SELECT 'specs' AS kind, api, v, '' AS path, '' AS method, coalesce(lang, '~') || '|' || coalesce(source, '~') AS value FROM docs
  UNION ALL SELECT 'paths', api, v, path, '', summary FROM path UNION ALL SELECT 'operations', api, v, path, method, deprecated::VARCHAR FROM op),
held AS (SELECT DISTINCT api, v FROM docs),
version AS (
  SELECT coalesce(a.kind, b.kind) AS kind, coalesce(a.api, b.api) AS api, coalesce(a.path, b.path) AS path, coalesce(a.method, b.method) AS method,
         a.value AS old, b.value AS new, a.api IS NOT NULL AS was, b.api IS NOT NULL AS now_is FROM
    (SELECT * FROM every WHERE v = 0) a FULL JOIN (SELECT * FROM every WHERE v = 1) b
    ON a.kind = b.kind AND a.api = b.api AND a.path = b.path AND a.method = b.method)"""


@query("spec_refresh", oracle=f"""WITH {_SPECS_SQL},
stays AS (SELECT *, was AND (CASE WHEN now_is THEN old = new ELSE api NOT IN (SELECT api FROM held WHERE v = 1) END) AS kept FROM version)
SELECT kind, api, path, method, TIMESTAMP '2024-01-01' AS sys_from, CASE WHEN NOT kept THEN TIMESTAMP '2024-02-01' END AS sys_to, sha256(old) AS value, 2 AS version FROM stays WHERE was
UNION ALL SELECT kind, api, path, method, TIMESTAMP '2024-02-01', NULL, sha256(new), 2 FROM stays WHERE now_is AND NOT kept""")
def spec_refresh(t):
    """T8 + A23: specs with paths and operations, loaded, refreshed by their second version, and refreshed once more."""
    tables = S.TableSet(t.spark, fresh_dir(t.spark, "specs"))
    for version, now in ((1, "2024-01-01"), (2, "2024-02-01"), (2, "2024-03-01")):
        S.refresh(tables, "specs", spec_snapshots(t, version), now)
    now_in_force = tables.manifest()
    value = {"specs": F.concat(F.coalesce("title", F.lit("~")), F.lit("|"), F.coalesce("spec_version", F.lit("~"))), "paths": F.col("summary"), "operations": F.col("deprecated").cast("string")}
    out = None
    for name, v in value.items():
        rows = tables.read(name, now_in_force)
        rows = rows.select(F.lit(name).alias("kind"), "api", *[F.col(c) if c in rows.columns else F.lit("").alias(c) for c in ("path", "method")],
                           "sys_from", "sys_to", F.sha2(v, 256).alias("value"), F.lit(now_in_force["version"]).alias("version"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("domain_members_writeback", oracle=f"""WITH {_DOMAIN_ROWS_SQL},
old AS (SELECT DISTINCT domain_name, key FROM mem WHERE domain_name IN ('nation', 'region', 'segment')),
new AS (SELECT domain_name, key, min(label) AS label FROM mem WHERE domain_name <> 'region' GROUP BY ALL)
SELECT coalesce(o.domain_name, n.domain_name) AS domain_name, coalesce(o.key, n.key) AS key, CASE WHEN o.key IS NULL THEN 'found' ELSE 'seed' END AS source,
       count(*) OVER (PARTITION BY coalesce(o.domain_name, n.domain_name)) AS member_count, 3 AS version
FROM old o FULL JOIN new n ON o.domain_name = n.domain_name AND o.key = n.key""")
def domain_members_writeback(t):
    """M10 + A24: domains and their members written back: known ones keep their source, counts are of what is then held."""
    tables = S.TableSet(t.spark, fresh_dir(t.spark, "domains"))
    mem = D.members(domain_rows(t)).groupBy("domain_name", "key").agg(F.min("label").alias("label"))
    counted = lambda m: m.groupBy("domain_name").agg(F.count(F.lit(1)).alias("member_count"))
    seed = mem.filter(F.col("domain_name").isin("nation", "region", "segment")).withColumn("source", F.lit("seed"))
    tables.create({"members": (seed, "domain_name"), "domains": (counted(seed), "domain_name")})
    found = mem.filter(F.col("domain_name") != "region").withColumn("source", F.lit("found"))
    for _ in range(2):
        S.merge(tables, "members", found, ["domain_name", "key"], {"source": "keep", "label": "keep"}, ["label"])
        done = S.merge(tables, "domains", counted(tables.read("members")), ["domain_name"], {}, ["member_count"])
    return tables.read("members").join(tables.read("domains"), "domain_name").select("domain_name", "key", "source", "member_count", F.lit(done.version).alias("version"))
