"""Listings, adapters, blobs and provider responses derived from the tables, a body per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import registry as R
from vellum.plans.registry import query


def listings(t):
    """A listing object per part: one ``provider:name`` key, of several versions, and one plain key."""
    key = F.col("p_partkey").cast("string")
    version = lambda updated, field: F.concat(
        F.lit('{"updated":"'), updated, F.lit(f'","{field}":"https://x.org/'), F.when(F.col("p_partkey") % 13 == 0, "").otherwise(key), F.lit('"}'))
    many = F.concat(F.lit('{"v1":'), version(F.lit("2023-01-01T00:00:00Z"), "swaggerUrl"), F.lit(',"v2":'),
                    version(F.concat(F.lit("2024-01-0"), (F.col("p_size") % 9 + 1).cast("string"), F.lit("T00:00:00Z")), "openapiUrl"), F.lit("}"))
    none = F.col("p_partkey") % 11 == 0
    preferred = F.when(F.col("p_size") % 3 == 0, "v2").otherwise("v9")
    body = F.concat(F.lit('{"'), "p_type", F.lit(":"), "p_name", F.lit(":"), key, F.lit('":{"preferred":"'), preferred, F.lit('","versions":'),
                    F.when(none, "{}").otherwise(many), F.lit('},"k'), key, F.lit('":{"versions":{"only":{"updated":"2024-02-01T00:00:00Z","openapiUrl":"https://x.org/k"}}}}'))
    return t.part.select(body.alias("body"))


def last_seen(t):
    """State before the run: every second plain key seen at its present time, every third named key earlier."""
    key = F.col("p_partkey").cast("string")
    plain = t.part.filter("p_partkey % 2 = 0").select(F.concat(F.lit("k"), key).alias("api_key"), F.lit("2024-02-01T00:00:00Z").alias("seen"))
    named = t.part.filter("p_partkey % 3 = 0").select(F.concat_ws(":", "p_type", "p_name", key).alias("api_key"), F.lit("2022-01-01T00:00:00Z").alias("seen"))
    return plain.unionByName(named)


_LISTING = """
named AS (
  SELECT p_partkey AS k, p_type || ':' || p_name || ':' || p_partkey AS api_key, p_type AS provider, p_name || ':' || p_partkey AS api_name,
         CASE WHEN p_size % 3 = 0 THEN '2024-01-0' || (p_size % 9 + 1) || 'T00:00:00Z' ELSE '2023-01-01T00:00:00Z' END AS updated,
         CASE WHEN p_partkey % 13 = 0 THEN 'https://x.org/' ELSE 'https://x.org/' || p_partkey END AS spec_url
  FROM part WHERE p_partkey % 11 <> 0),
listed AS (
  SELECT api_key, provider, api_name, updated, spec_url, CASE WHEN k % 3 = 0 THEN '2022-01-01T00:00:00Z' END AS seen FROM named
  UNION ALL SELECT 'k' || p_partkey, 'k' || p_partkey, 'k' || p_partkey, '2024-02-01T00:00:00Z', 'https://x.org/k',
                   CASE WHEN p_partkey % 2 = 0 THEN '2024-02-01T00:00:00Z' END FROM part),
changes AS (SELECT *, CASE WHEN seen = updated THEN 'unchanged' WHEN seen IS NOT NULL THEN 'updated' ELSE 'new' END AS status FROM listed)
"""


@query("registry_changes", oracle=f"WITH {_LISTING} SELECT api_key, provider, api_name, updated, spec_url, seen, status FROM changes")
def registry_changes(t):
    """A7 + A8: APIs of the listing, the version picked and what changed since the last run."""
    return R.change_status(R.listing_rows(listings(t)), last_seen(t))


@query("registry_state", oracle=f"""WITH {_LISTING}
SELECT api_key, updated AS seen FROM changes WHERE status <> 'unchanged'
UNION ALL SELECT api_key, seen FROM changes WHERE status = 'unchanged'
UNION ALL SELECT p_type || ':' || p_name || ':' || p_partkey, '2022-01-01T00:00:00Z' FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 11 = 0""")
def registry_state(t):
    """O2: what the next run will have seen; keys that are no longer listed keep their time."""
    seen = last_seen(t)
    return R.next_state(R.change_status(R.listing_rows(listings(t)), seen), seen)


def blob_events(t):
    """A change event per document: its content's hash, a time and a kind."""
    kind = F.when(F.col("doc_id") % 7 == 0, "D").when(F.col("doc_id") % 2 == 0, "M").otherwise("A")
    ts = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id AS INT), 0)")
    return t.documents.select("doc_id", F.sha2("text", 256).alias("blob_sha"), ts.alias("commit_ts"), kind.alias("change"))


@query("spec_incremental", oracle="""
SELECT doc_id, sha256(text) AS blob_sha, CASE WHEN doc_id % 2 = 0 THEN 'M' ELSE 'A' END AS change
FROM documents WHERE doc_id > 90 AND doc_id % 7 <> 0""")
def spec_incremental(t):
    """A3 + O1: events after the last commit read, added or modified only."""
    return R.since(blob_events(t), F.expr("TIMESTAMP_NTZ '2024-01-01 01:30:00'")).select("doc_id", "blob_sha", "change")


@query("blob_read", oracle="""
SELECT sha256(text) AS blob_sha, max(length(text)) AS n_chars, max(len(string_split(text, chr(10)))) AS n_lines
FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING bool_or(doc_id > 90 AND doc_id % 7 <> 0)""")
def blob_read(t):
    """A4: each distinct blob that the incremental events name, read once and whole."""
    events = R.since(blob_events(t), F.expr("TIMESTAMP_NTZ '2024-01-01 01:30:00'"))
    blobs = t.documents.select(F.sha2("text", 256).alias("blob_sha"), F.col("text").alias("content"))
    found = R.needed_blobs(blobs, events)
    return found.select("blob_sha", F.length("content").cast("long").alias("n_chars"), F.size(F.split("content", "\n", -1)).cast("long").alias("n_lines"))


def adapter_configs(t):
    """A configuration list per supplier: an HTTP entry (two versions of every fourth) and a prompt entry."""
    k = F.col("s_suppkey").cast("string")
    method = F.when(F.col("s_suppkey") % 2 == 0, ',"method":"post"').otherwise("")
    body = F.concat(F.lit('[{"name":"h'), k, F.lit('","provider":"s'), k, F.lit('","api":"lines","path":"/r/N","call_jmespath":"rows"'), method,
                    F.lit('},{"name":"p'), k, F.lit('","provider":"s'), k, F.lit('","api":"lines","path":"/r/N","prompt_template":"List prices"}]'))
    old = F.when(F.col("s_suppkey") % 4 == 0, F.lit("2024-01-01"))
    current = t.supplier.select("s_suppkey", F.lit(None).cast("string").alias("sys_to"), body.alias("body"))
    return current.unionByName(t.supplier.filter("s_suppkey % 4 = 0").select("s_suppkey", old.alias("sys_to"), body.alias("body")))


@query("adapter_load", oracle="""
WITH v AS (SELECT s_suppkey AS k, NULL AS sys_to FROM supplier UNION ALL SELECT s_suppkey, '2024-01-01' FROM supplier WHERE s_suppkey % 4 = 0)
SELECT sys_to, 'h' || k AS name, 's' || k AS provider, 'lines' AS api, '/r/N' AS path, CASE WHEN k % 2 = 0 THEN 'post' ELSE 'get' END AS method,
       'rows' AS call_jmespath, NULL AS prompt_template, 'http' AS kind FROM v
UNION ALL SELECT sys_to, 'p' || k, 's' || k, 'lines', '/r/N', 'get', NULL, 'List prices', 'llm' FROM v""")
def adapter_load(t):
    """A9 + A10: configuration lists to adapter rows, each of its kind."""
    return R.adapter_rows(adapter_configs(t), keep=["sys_to"])


@query("adapter_join", oracle="""
SELECT l_orderkey, l_linenumber, 'h' || l_suppkey AS adapter
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'N' AND l_suppkey % 2 = 1""")
def adapter_join(t):
    """A response per order line, with the adapter of its address in its current version."""
    r = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("provider"),
                          F.lit("lines").alias("api"), F.concat(F.lit("/r/"), "l_returnflag").alias("path"), F.lit("get").alias("method"))
    return R.adapter_join(r, R.adapter_rows(adapter_configs(t), keep=["sys_to"])).select("l_orderkey", "l_linenumber", "adapter")


def folders(t):
    """A folder listing per customer: a sheet and a text file."""
    k = F.col("c_custkey").cast("string")
    body = F.concat(F.lit('{"files":[{"id":"f'), k, F.lit('","name":"'), "c_name", F.lit('","mimeType":"sheet","modifiedTime":"2024-01-01T00:00:00Z","size":"'), k,
                    F.lit('","parents":["root","'), "c_mktsegment", F.lit('"]},{"id":"g'), k, F.lit('","name":"notes","mimeType":"text","size":"unknown"}]}'))
    return t.customer.select(F.col("c_custkey").alias("folder"), body.alias("body"))


@query("file_listing", oracle="""
SELECT c_custkey AS folder, 'f' || c_custkey AS id, c_name AS name, 'sheet' AS mime_type, '2024-01-01T00:00:00Z' AS modified, c_custkey AS size,
       '["root","' || c_mktsegment || '"]' AS parents FROM customer
UNION ALL SELECT c_custkey, 'g' || c_custkey, 'notes', 'text', NULL, NULL, NULL FROM customer""")
def file_listing(t):
    """A15 + A16: file rows with parents as JSON; a size that is no number is null."""
    return R.file_rows(folders(t), keep=["folder"])


@query("sheet_values", oracle="""
SELECT c_custkey AS folder, 'f' || c_custkey AS id, unnest([c_mktsegment, 'totals']) AS title, unnest([c_nationkey, c_nationkey + 1]) AS sheet_id,
       unnest([1000, NULL]) AS row_count, unnest([26, 5]) AS column_count FROM customer""")
def sheet_values(t):
    """A17 + J4: the tabs of each sheet in each folder; fetched bodies are a table keyed by file id."""
    tab = lambda title, n, rows, cols: F.concat(
        F.lit('{"properties":{"title":"'), title, F.lit('","sheetId":'), n.cast("string"), F.lit(f',"gridProperties":{{"rowCount":{rows},"columnCount":{cols}}}}}}}'))
    n = F.col("c_nationkey")
    bodies = t.customer.select(F.concat(F.lit("f"), F.col("c_custkey").cast("string")).alias("id"), F.concat(
        F.lit('{"sheets":['), tab(F.col("c_mktsegment"), n, 1000, 26), F.lit(","), tab(F.lit("totals"), n + 1, '"many"', 5), F.lit("]}")).alias("body"))
    sheets = R.file_rows(folders(t), keep=["folder"]).filter("mime_type = 'sheet'").select("folder", "id")
    return sheets.join(R.tab_rows(bodies, keep=["id"]), "id")


@query("company_rows", oracle="""
SELECT CASE WHEN c_custkey % 3 = 0 THEN '900000000000' || c_custkey ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS cik, c_name AS name,
       CASE WHEN c_custkey % 2 = 0 THEN left('T' || c_mktsegment || c_custkey, 10) ELSE '' END AS ticker, CAST(c_nationkey + 100 AS VARCHAR) AS sic,
       left(repeat(c_mktsegment || ' ', 40), 200) AS sic_description, '' AS state, c_mktsegment AS category
FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0""")
def company_rows(t):
    """Submissions without industry code dropped, ids padded but never cut, texts cut to their width."""
    k = F.col("c_custkey")
    s = k.cast("string")
    sic = F.when(k % 5 == 0, "").when(k % 7 == 0, "0000").otherwise((F.col("c_nationkey") + 100).cast("string"))
    body = F.to_json(F.struct(
        F.when(k % 3 == 0, F.concat(F.lit("900000000000"), s)).otherwise(s).alias("cik"), F.col("c_name").alias("name"),
        F.when(k % 2 == 0, F.array(F.concat(F.lit("T"), "c_mktsegment", s), F.lit("OTHER"))).otherwise(F.array().cast("array<string>")).alias("tickers"),
        sic.alias("sic"), F.expr("repeat(c_mktsegment || ' ', 40)").alias("sicDescription"), F.col("c_mktsegment").alias("category")))
    return R.company_rows(t.customer.select(body.alias("body")))


@query("new_since_snapshot", oracle="""
SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate < TIMESTAMP '1998-01-01')""")
def new_since_snapshot(t):
    """Customers that the snapshot of earlier orders does not hold."""
    snapshot = t.orders.filter("o_orderdate < TIMESTAMP '1998-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(snapshot, "c_custkey", "left_anti")


@query("referential_integrity", oracle="""
SELECT 'lineitem.l_partkey' AS reference, count(*) AS n_rows, count(*) FILTER (p.p_partkey IS NULL) AS n_orphans FROM lineitem LEFT JOIN part p ON l_partkey = p.p_partkey
UNION ALL SELECT 'orders.o_custkey', count(*), count(*) FILTER (c.c_custkey IS NULL) FROM orders LEFT JOIN customer c ON o_custkey = c.c_custkey""")
def referential_integrity(t):
    """References of one response that another does not hold; references are counted per key before the join."""
    def check(name, rows, ref, other, key):
        n = rows.groupBy(F.col(ref).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        known = other.select(F.col(key).alias("key"), F.lit(True).alias("known")).distinct()
        joined = n.join(known, "key", "left")
        return joined.agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("n_orphans")).select(F.lit(name).alias("reference"), "*")
    return check("lineitem.l_partkey", t.lineitem, "l_partkey", t.part, "p_partkey").unionByName(check("orders.o_custkey", t.orders, "o_custkey", t.customer, "c_custkey"))


@query("provider_date_join", oracle="""
WITH a AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n_orders FROM orders GROUP BY 1),
b AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS n_shipped FROM lineitem GROUP BY 1)
SELECT coalesce(a.day, b.day) AS day, n_orders, n_shipped FROM a FULL JOIN b ON a.day = b.day""")
def provider_date_join(t):
    """Two providers' daily figures side by side, days of either kept."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias("day")
    a = t.orders.groupBy(day("o_orderdate")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.groupBy(day("l_shipdate")).agg(F.count(F.lit(1)).alias("n_shipped"))
    return a.join(b, "day", "full_outer")




def price_pages(t):
    """A page per part whose prices stand in two push blocks, in one of three shapes."""
    k = F.col("p_partkey").cast("string")
    q = lambda s: s.replace('"', '\\"')
    fill = lambda s: F.replace(F.replace(F.lit(q(s)), F.lit("@x"), (F.col("p_partkey") + 1).cast("string")), F.lit("@"), k)
    block = lambda c: F.concat(F.lit('<script>self.__next_f.push([1,"'), c, F.lit('"])</script>'))
    one = lambda n: ('{"api_endpoint":"m@%s","price":[{"value":"Input (/M tokens)","price_dollar":"$$@x.5"},'  # noqa: E731
                     '{"value":"Output (/M tokens)","price_dollar":"$$@x.75"}]}' % n)
    half = '{"api":"bad@","price":[{"value":"Input","price_dollar":"$1"}]}'
    lists = (fill(one("") + "," + half), fill(one("") + "," + one("b")))
    scaled = '{"name":"grok-@","promptTextTokenPrice":"$n@x","completionTextTokenPrice":"$n20000"}\\n'
    plain = '{"modelName":"Big M @","inputPrice":@x.5,"outputPrice":2}\\n'
    kind = F.col("p_partkey") % 3
    a = F.when(kind == 0, lists[0]).when(kind == 1, fill(scaled)).otherwise(fill(plain))
    b = F.when(kind == 0, lists[1]).when(kind == 1, fill(scaled)).otherwise(fill(plain))
    return t.part.select("p_partkey", kind.alias("kind"), F.concat(F.lit('<script>"api":"no"</script>'), block(a), "p_name", block(b)).alias("html"))


@query("payload_prices", oracle="""
SELECT p_partkey, unnest(['a/m' || p_partkey, 'a/m' || p_partkey || 'b']) AS model_id, p_partkey + 1 + 0.5::DOUBLE AS input_per_mtok, p_partkey + 1 + 0.75::DOUBLE AS output_per_mtok
FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, 'b/grok-' || p_partkey, (p_partkey + 1) / 10000::DOUBLE, 2 FROM part WHERE p_partkey % 3 = 1
UNION ALL SELECT p_partkey, unnest(['c/big-m-' || p_partkey, 'c/big-m-' || p_partkey]), p_partkey + 1 + 0.5::DOUBLE, 2 FROM part WHERE p_partkey % 3 = 2""")
def payload_prices(t):
    """N14 + N15: push blocks joined and unescaped, prices in three shapes; repeats stay in the plain one only."""
    from vellum.operators import pricing as P

    pages = price_pages(t).select("p_partkey", "kind", P.page_payload("html").alias("payload"))
    parts = [P.payload_prices(pages.filter(f"kind = {i}"), "payload", provider, shape, keep=["p_partkey"], name_prefix="grok")
             for i, (provider, shape) in enumerate((("a", "list"), ("b", "scaled"), ("c", "plain")))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
