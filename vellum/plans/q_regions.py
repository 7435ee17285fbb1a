"""Tables found in laid-out pages, matched with a wanted schema, and runs of pages.

Input: a customer's orders as a document, an order as a page of word boxes
(``x = 6 * offset``, ``h = 10``): a large heading, a line of prose, the
order's lines as a table (five columns, the last one often empty), a line of
prose, and a small table of totals. The SQL knows the layout, not the boxes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import domains as D
from vellum.operators import regions as R
from vellum.plans.registry import query

#: Where the item table's columns end or, for the first and the fourth, begin.
QUANTITY, PRICE, DATE, DISCOUNT = 300, 400, 440, 590
HEAD = 80


def _money(c):
    return F.col(c).cast("decimal(18,2)").cast("string")


def boxes(t):
    """``(doc_id, page_id, style_id, x, y, w, h, text)``: the words of every order's page."""
    line = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left").select(
        F.col("l_orderkey").alias("o_orderkey"), F.struct(
            "l_linenumber", F.coalesce("p_name", F.lit("?")).alias("part"), F.col("l_quantity").cast("int").cast("string").alias("quantity"),
            _money("l_extendedprice").alias("price"), F.col("l_shipdate").cast("date").cast("string").alias("date"),
            F.when(F.col("l_discount") > 0.05, _money("l_discount")).alias("discount")).alias("item"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    items = line.groupBy("o_orderkey").agg(F.array_sort(F.collect_list("item")).alias("items"), F.sum("amount").alias("subtotal"))
    page = t.orders.join(items, "o_orderkey", "left").withColumn("items", F.coalesce("items", F.array().cast(items.schema["items"].dataType)))

    def text(value, x, y, right=False, h=10):
        wide = 6 if h == 10 else 12
        left = F.lit(x) - wide * F.length(value) if right else F.lit(x)
        return F.struct(value.alias("value"), left.cast("double").alias("x"), y.cast("double").alias("y"), F.lit(float(h)).alias("h"))

    n, lit, k = F.size("items"), lambda s: F.lit(s), F.col("k")
    none = F.array().cast("array<struct<value: string, x: double, y: double, h: double>>")
    head = [text(lit(v), x, F.lit(HEAD), right) for v, x, right in (
        ("Part", 0, False), ("Quantity", QUANTITY, True), ("Unit price", PRICE, True), ("Ship date", DATE, False), ("Discount", DISCOUNT, True))]
    i, y = F.col("i"), HEAD + 12 * (k + 1)
    row = [text(i["part"], 0, y), text(i["quantity"], QUANTITY, y, True), text(i["price"], PRICE, y, True), text(i["date"], DATE, y), text(i["discount"], DISCOUNT, y, True)]
    low = HEAD + 12 * (F.col("n") + 1)
    total = [(lit("Subtotal"), F.coalesce(F.col("subtotal"), F.lit(0)).cast("decimal(18,2)").cast("string")), (lit("Total"), _money("o_totalprice")), (lit("Status"), F.col("o_orderstatus"))]
    always = [text(F.concat(lit("Order #"), F.col("o_orderkey").cast("string")), 0, F.lit(20), h=20),
              text(F.concat(lit("Sold in dollars, priority "), F.col("o_orderpriority")), 0, F.lit(56)), text(lit("Thank you"), 0, low + 12)]
    always += [x for j, (a, v) in enumerate(total) for x in (text(a, 0, low + 36 + 12 * j), text(v, QUANTITY, low + 36 + 12 * j, True))]
    # a row per item, or one for an order without any; the page's own texts come with the first
    item = page.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_id"), "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus", "subtotal",
                       n.alias("n"), F.posexplode_outer("items").alias("k", "i"))
    texts = F.concat(F.when(F.coalesce(k, F.lit(0)) == 0, F.array(*always)).otherwise(none), F.when(k == 0, F.array(*head)).otherwise(none), F.when(k >= 0, F.array(*row)).otherwise(none))
    placed = item.select("doc_id", "page_id", F.explode(texts).alias("b")).filter("b.value IS NOT NULL")
    wide = F.when(F.col("b.h") == 10, 6.0).otherwise(12.0)
    word = placed.select("doc_id", "page_id", "b", F.posexplode(F.split("b.value", " ")).alias("k", "text"))
    before = F.when(k == 0, 0).otherwise(F.length(F.expr("substring_index(b.value, ' ', k)")) + 1)
    return word.select("doc_id", "page_id", F.lit(1).alias("style_id"), (F.col("b.x") + wide * before).alias("x"), F.col("b.y").alias("y"),
                       (wide * F.length("text")).alias("w"), F.col("b.h").alias("h"), "text")


def part_names(t):
    return D.members(t.part.select(F.lit("part_name").alias("domain_name"), F.col("p_name").alias("label")), alt_labels=None)


WANTED = (R.Wanted("part", ("item", "part"), "text", domain="part_name"), R.Wanted("quantity", ("qty", "quantity"), "number", minimum=1, maximum=50),
          R.Wanted("price", ("price", "unit price"), "number", pattern=r"^[0-9]+\.[0-9]{2}$"), R.Wanted("shipped", ("date",), "date"),
          R.Wanted("discount", ("discount", "rebate"), "number", minimum=0, maximum=1))


def page_sizes(t):
    """About how many boxes pages have: a line's texts are a dozen words."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("page_id")).agg((F.count(F.lit(1)) * 12).alias("n"))
    return t.orders.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_id")).join(lines, "page_id").select("doc_id", "page_id", "n")


def rows(t):
    return R.table_rows(boxes(t), sizes=page_sizes(t))


_ITEM_SQL = """
item AS (
  SELECT o_custkey AS doc_id, o_orderkey AS page_id, l_linenumber AS line, coalesce(p_name, '?') AS part, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_shipdate AS DATE) AS shipped, CASE WHEN l_discount > 0.05 THEN CAST(l_discount AS DECIMAL(18,2)) END AS discount
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey),
sums AS (SELECT page_id, count(*) AS n, count(discount) AS d, sum(price) AS subtotal FROM item GROUP BY page_id),
page AS (SELECT o_custkey AS doc_id, o_orderkey AS page_id, coalesce(n, 0) AS n, coalesce(d, 0) AS d, coalesce(subtotal, 0)::DECIMAL(18,2) AS subtotal, o_totalprice::DECIMAL(18,2) AS total,
         o_orderstatus AS status, o_orderpriority AS priority FROM orders LEFT JOIN sums ON page_id = o_orderkey)"""


@query("table_regions", oracle=f"""WITH {_ITEM_SQL}
SELECT doc_id, page_id, 0::DOUBLE AS x, 80::DOUBLE AS y, 590::DOUBLE AS w, (12 * n + 10)::DOUBLE AS h, 5 AS n_columns, n AS n_rows,
       'Part|Quantity|Unit price|Ship date|Discount' AS headers, 'text|number|number|date|number' AS kinds,
       round((4::DOUBLE * n + d) / (n * 5) * ((CASE WHEN d > 0 THEN 5::DOUBLE ELSE 4 END) / 5), 4) AS confidence FROM page WHERE n > 0
UNION ALL
SELECT doc_id, page_id, 0, 80 + 12 * (n + 1) + 36, 300, 34, 2, 3, '|', 'text|number', round((1 + 2::DOUBLE / 3) / 2, 4) FROM page""")
def table_regions(t):
    """Candidates of every page with region, size, headers, kinds of columns and confidence."""
    found = R.table_regions(rows(t))
    return found.select("doc_id", "page_id", "x", "y", "w", "h", "n_columns", "n_rows", F.array_join("headers", "|").alias("headers"), F.array_join("kinds", "|").alias("kinds"), "confidence")


@query("table_values", oracle=f"""WITH {_ITEM_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY line, part, quantity::VARCHAR, price::VARCHAR, shipped, discount::VARCHAR) AS k FROM item)
SELECT doc_id, page_id, (80 + 12 * k)::DOUBLE AS top, part || '|' || quantity || '|' || price || '|' || shipped || '|' || coalesce(discount::VARCHAR, '') AS value FROM numbered
UNION ALL SELECT doc_id, page_id, 80 + 12 * (n + 1) + 36 + 12 * i, CASE i WHEN 0 THEN 'Subtotal|' || subtotal WHEN 1 THEN 'Total|' || total ELSE 'Status|' || status END FROM page, range(3) r(i)""")
def table_values(t):
    """The body rows of all candidates, a text per column."""
    return rows(t).filter("NOT is_header").select("doc_id", "page_id", "top", F.array_join("values", "|", "").alias("value"))


_MATCH_SQL = f"""{_ITEM_SQL},
cell AS (
  SELECT doc_id, page_id, 3 AS run, 0 AS col, 'part' AS header, part AS v FROM item UNION ALL SELECT doc_id, page_id, 3, 1, 'quantity', quantity::VARCHAR FROM item
  UNION ALL SELECT doc_id, page_id, 3, 2, 'unit price', price::VARCHAR FROM item UNION ALL SELECT doc_id, page_id, 3, 3, 'ship date', shipped::VARCHAR FROM item
  UNION ALL SELECT doc_id, page_id, 3, 4, 'discount', discount::VARCHAR FROM item
  UNION ALL SELECT doc_id, page_id, CASE WHEN n > 0 THEN 5 ELSE 4 END, 0, '', unnest(['Subtotal', 'Total', 'Status']) FROM page
  UNION ALL SELECT doc_id, page_id, CASE WHEN n > 0 THEN 5 ELSE 4 END, 1, '', unnest([subtotal::VARCHAR, total::VARCHAR, status]) FROM page),
share AS (
  SELECT doc_id, page_id, run, col, header, greatest(count(v), 1) AS n,
    count(*) FILTER (regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS n_date, count(*) FILTER (try_cast(v AS DOUBLE) IS NOT NULL) AS n_number,
    count(*) FILTER (try_cast(v AS DOUBLE) IS NULL AND NOT regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS n_text,
    count(*) FILTER (lower(v) IN (SELECT lower(p_name) FROM part)) AS n_part, count(*) FILTER (try_cast(v AS DOUBLE) BETWEEN 1 AND 50) AS n_fifty,
    count(*) FILTER (regexp_matches(v, '^[0-9]+[.][0-9]{{2}}$')) AS n_money, count(*) FILTER (try_cast(v AS DOUBLE) BETWEEN 0 AND 1) AS n_unit
  FROM cell GROUP BY ALL),
score AS (
  SELECT doc_id, page_id, run, col, unnest([0, 1, 2, 3, 4]) AS want, unnest([
    round(((header = 'part')::INT + n_text / n + n_part / n) / 3 * 1000)::INT, round(((header = 'quantity')::INT + n_number / n + n_fifty / n) / 3 * 1000)::INT,
    round(((header = 'unit price')::INT + n_number / n + n_money / n) / 3 * 1000)::INT, round(((header = 'ship date')::INT * 0.5::DOUBLE + n_date / n) / 2 * 1000)::INT,
    round(((header = 'discount')::INT + n_number / n + n_unit / n) / 3 * 1000)::INT]) AS score FROM share),
pair AS (SELECT * FROM score WHERE score >= 300 UNION ALL SELECT DISTINCT doc_id, page_id, run, NULL, want, 0 FROM score),
w AS (SELECT a.doc_id, a.page_id, a.run, a.col AS p0, b.col AS p1, c.col AS p2, d.col AS p3, e.col AS p4, a.score + b.score + c.score + d.score + e.score AS score
  FROM pair a JOIN pair b USING (page_id, run) JOIN pair c USING (page_id, run) JOIN pair d USING (page_id, run) JOIN pair e USING (page_id, run)
  WHERE a.want = 0 AND b.want = 1 AND c.want = 2 AND d.want = 3 AND e.want = 4 AND len(list_distinct([x for x in [p0, p1, p2, p3, p4] if x IS NOT NULL])) = len([x for x in [p0, p1, p2, p3, p4] if x IS NOT NULL])),
best AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, run ORDER BY score DESC, p0 NULLS LAST, p1 NULLS LAST, p2 NULLS LAST, p3 NULLS LAST, p4 NULLS LAST) AS k FROM w),
matched AS (
  SELECT doc_id, page_id, run, round(score / 5000::DOUBLE, 4) AS score, coalesce(p0::VARCHAR, '-') || ',' || coalesce(p1::VARCHAR, '-') || ',' || coalesce(p2::VARCHAR, '-') || ','
    || coalesce(p3::VARCHAR, '-') || ',' || coalesce(p4::VARCHAR, '-') AS picks FROM best WHERE k = 1)"""


@query("schema_match", oracle=f"WITH {_MATCH_SQL} SELECT * FROM matched")
def schema_match(t):
    """Every candidate's columns against hints, kinds, pattern, bounds and domain; the best one-to-one assignment."""
    found = R.schema_match(rows(t), WANTED, part_names(t), least=0.3)
    return found.select(*R.RUN, "score", F.array_join(F.transform("picks", lambda p: p.cast("string")), ",", "-").alias("picks"))


@query("schema_best_candidate", oracle=f"""WITH {_MATCH_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, page_id, run) AS k FROM matched)
SELECT doc_id, page_id, run, score, picks FROM ranked WHERE k = 1""")
def schema_best_candidate(t):
    """The candidate of each document that matches the wanted schema best."""
    found = R.best_candidates(R.schema_match(rows(t), WANTED, part_names(t), least=0.3))
    return found.select("doc_id", "page_id", "run", "score", F.array_join(F.transform("picks", lambda p: p.cast("string")), ",", "-").alias("picks"))


@query("price_like_boxes", oracle="""SELECT o_custkey AS doc_id, o_orderkey AS page_id, unnest([0::DOUBLE, 72::DOUBLE]) AS x, 20::DOUBLE AS y, unnest(['Order', '#' || o_orderkey]) AS text FROM orders""")
def price_like_boxes(t):
    """Boxes with a currency sign or of large type."""
    return R.price_like(boxes(t)).select("doc_id", "page_id", "x", "y", "text")


def page_members(t):
    """Domains of one label each: the words of part names, and the priorities' first words."""
    word = t.part.select(F.explode(F.split("p_name", " ")).alias("label")).select(F.concat(F.lit("word:"), F.col("label")).alias("domain_name"), "label")
    kind = t.orders.select(F.substring_index("o_orderpriority", " ", 1).alias("label")).select(F.concat(F.lit("priority:"), F.col("label")).alias("domain_name"), "label")
    return D.members(word.unionByName(kind).distinct(), alt_labels=None)


@query("page_runs", oracle=f"""WITH {_ITEM_SQL},
said AS (
  SELECT doc_id, page_id, string_split('Order #' || page_id || ' Sold in dollars, priority ' || priority || ' Thank you Subtotal ' || subtotal || ' Total ' || total || ' Status ' || status
         || CASE WHEN n > 0 THEN ' Part Quantity Unit price Ship date Discount' ELSE '' END, ' ') AS words FROM page
  UNION ALL SELECT doc_id, page_id, string_split(part || ' ' || quantity || ' ' || price || ' ' || shipped || coalesce(' ' || discount, ''), ' ') FROM item),
token AS (SELECT DISTINCT doc_id, page_id, lower(unnest(words)) AS key FROM said),
label AS (
  SELECT DISTINCT 'word:' || w AS domain, lower(w) AS key FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)
  UNION SELECT DISTINCT 'priority:' || string_split(o_orderpriority, ' ')[1], lower(string_split(o_orderpriority, ' ')[1]) FROM orders),
held AS (SELECT token.doc_id, token.page_id, domain, count(*) AS c FROM token JOIN label USING (key) GROUP BY ALL),
sized AS (SELECT doc_id, page_id, count(*) AS n FROM token GROUP BY ALL),
signed AS (
  SELECT s.doc_id, s.page_id, coalesce(list_sort(list(domain) FILTER (c >= 0.06 * n)), []) AS domains FROM sized s LEFT JOIN held h ON s.page_id = h.page_id GROUP BY ALL),
follow AS (SELECT *, lag(domains) OVER (PARTITION BY doc_id ORDER BY page_id) AS was FROM signed),
cut AS (
  SELECT *, CASE WHEN was IS NULL THEN 1 WHEN len(domains) + len(was) = 0 THEN 0
    WHEN len(list_intersect(domains, was)) / len(list_distinct(list_concat(domains, was))) < 0.4 THEN 1 ELSE 0 END AS opens FROM follow),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY page_id) AS run FROM cut),
sizes AS (SELECT doc_id, run, min(page_id) AS first_page, max(page_id) AS last_page, count(*) AS n_pages FROM numbered GROUP BY ALL),
names AS (SELECT doc_id, run, list_sort(list(DISTINCT d)) AS domains FROM (SELECT doc_id, run, unnest(domains) AS d FROM numbered) GROUP BY ALL)
SELECT s.doc_id, s.run::BIGINT AS run, first_page, last_page, n_pages, coalesce(array_to_string(domains, ','), '') AS domains FROM sizes s LEFT JOIN names n ON s.doc_id = n.doc_id AND s.run = n.run""")
def page_runs(t):
    """Runs of a document's pages whose domains are alike."""
    signatures = R.page_signatures(boxes(t), page_members(t), min_share=0.06)
    found = R.page_runs(signatures, min_similarity=0.4, pages_per_band=4096)
    return found.withColumn("domains", F.array_join("domains", ","))
