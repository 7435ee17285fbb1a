"""Pricing, model-id and usage-cost queries.

Model listings are derived from ``part``: the id is ``brand/name-size`` with
the size written as a dotted version, per-token prices are decimal texts.
Usage comes from ``conversations`` (tokens ~ characters / 4); each
conversation is billed to the model of the part with the same key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions.text import host_prefix, model_id_normalise, provider_of, unescape_payload
from vellum.operators import pricing as P
from vellum.operators.reshape import template_fill
from vellum.plans.registry import query

_RAW_ID = """concat(' ', p_brand, '/', replace(p_name, ' ', '-'), '-',
                CAST(p_size // 10 AS VARCHAR), '.', CAST(p_size % 10 AS VARCHAR), ' ')"""
_LISTING_SQL = f"""
listing AS (
  SELECT p_partkey, {_RAW_ID} AS raw_id,
         regexp_replace(lower(trim({_RAW_ID})), '(\\d)\\.(\\d)', '\\1-\\2', 'g') AS model_id,
         '0.00000' || CAST(p_size AS VARCHAR) AS prompt,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE '0.0000' || CAST(p_size AS VARCHAR) END AS completion
  FROM part),
prices AS (
  SELECT model_id AS model,
         CASE WHEN contains(model_id, '/') THEN split_part(model_id, '/', 1) ELSE 'unknown' END AS provider,
         CAST(prompt AS DOUBLE) * 1000000.0 AS input_per_mtok,
         CAST(completion AS DOUBLE) * 1000000.0 AS output_per_mtok
  FROM listing WHERE completion IS NOT NULL)
"""


def listing(t):
    p = t.part
    raw = F.concat(F.lit(" "), F.col("p_brand"), F.lit("/"), F.regexp_replace("p_name", " ", "-"), F.lit("-"),
                   F.floor(F.col("p_size") / 10).cast("string"), F.lit("."), (F.col("p_size") % 10).cast("string"),
                   F.lit(" "))
    return p.select("p_partkey", raw.alias("raw_id"), model_id_normalise(raw).alias("model_id"),
                    F.concat(F.lit("0.00000"), F.col("p_size").cast("string")).alias("prompt"),
                    F.when(F.col("p_type") != "PROMO",
                           F.concat(F.lit("0.0000"), F.col("p_size").cast("string"))).alias("completion"))


def prices(t):
    return P.normalise_listing(listing(t), id_col="model_id")


@query("model_id_normalise", oracle=f"""WITH {_LISTING_SQL}
SELECT p_partkey, raw_id, model_id,
       CASE WHEN contains(model_id, '/') THEN split_part(model_id, '/', 1) ELSE 'unknown' END AS provider
FROM listing""")
def model_id_normalise_q(t):
    """H2 + H3: lower/trim, digit.digit -> digit-digit, provider prefix."""
    return listing(t).select("p_partkey", "raw_id", "model_id", provider_of(F.col("model_id")).alias("provider"))


@query("price_normalise", oracle=f"WITH {_LISTING_SQL} SELECT * FROM prices")
def price_normalise(t):
    """H4 + B9: per-token text -> per-million DOUBLE; incomplete rows dropped."""
    return prices(t)


@query("tier_multipliers", oracle=f"""WITH {_LISTING_SQL}
SELECT *,
  CASE WHEN provider = 'brand#2' THEN round_even(input_per_mtok * 1.25, 4) END AS cache_write_5m_per_mtok,
  CASE WHEN provider = 'brand#2' THEN round_even(input_per_mtok * 2.0, 4) END AS cache_write_1h_per_mtok,
  CASE WHEN provider = 'brand#2' THEN round_even(input_per_mtok * 0.1, 4) END AS cache_read_per_mtok,
  CASE WHEN provider = 'brand#2' THEN round_even(input_per_mtok * 0.5, 4) END AS batch_input_per_mtok,
  CASE WHEN provider = 'brand#2' THEN round_even(output_per_mtok * 0.5, 4) END AS batch_output_per_mtok
FROM prices""")
def tier_multipliers(t):
    """H5 / trap 1.4-e: derived tiers for one provider only."""
    return P.with_tiers(prices(t), ["brand#2"])


@query("model_id_prefix_match", oracle=f"""WITH {_LISTING_SQL},
canon AS (SELECT DISTINCT lower(p_brand || '/' || replace(p_name, ' ', '-') || '-' || p_type) AS c FROM part
          UNION SELECT DISTINCT lower(p_brand || '/' || replace(p_name, ' ', '-')) FROM part WHERE p_size > 40),
ids AS (SELECT DISTINCT lower(p_brand || '/' || replace(p_name, ' ', '-')) AS model_id FROM part
        UNION SELECT DISTINCT lower(p_brand || '/' || p_type) FROM part),
m AS (SELECT i.model_id, arg_min(c.c, (length(c.c), c.c)) AS best
      FROM ids i LEFT JOIN canon c ON starts_with(c.c, i.model_id) GROUP BY i.model_id)
SELECT model_id, coalesce(best, model_id) AS matched_id FROM m""")
def model_id_prefix_match(t):
    """Id -> shortest canonical id it prefixes; exact first; else itself."""
    p = t.part
    stem = F.lower(F.concat(F.col("p_brand"), F.lit("/"), F.regexp_replace("p_name", " ", "-")))
    canon = (p.select(F.lower(F.concat(stem, F.lit("-"), F.col("p_type"))).alias("canonical_id"))
             .unionByName(p.filter(F.col("p_size") > 40).select(stem.alias("canonical_id"))).distinct())
    ids = (p.select(stem.alias("model_id"))
           .unionByName(p.select(F.lower(F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type"))).alias("model_id")))
           .distinct())
    return P.prefix_match(ids, canon)


_USAGE_SQL = f"""{_LISTING_SQL},
usage AS (
  SELECT c.conv_id, c.turn, c.role, l.model_id AS model,
         CASE WHEN c.role = 'assistant' THEN 0 ELSE CAST(ceil(length(c.text) / 4.0) AS BIGINT) END AS prompt_tokens,
         CASE WHEN c.role = 'assistant' THEN CAST(ceil(length(c.text) / 4.0) AS BIGINT) ELSE 0 END AS completion_tokens
  FROM conversations c LEFT JOIN listing l ON c.conv_id = l.p_partkey),
ledger AS (
  SELECT u.*, p.input_per_mtok, p.output_per_mtok,
         (u.prompt_tokens * p.input_per_mtok + u.completion_tokens * p.output_per_mtok) / 1000000.0 AS cost
  FROM usage u LEFT JOIN prices p ON u.model = p.model)
"""


def usage(t):
    c = t.conversations
    tokens = F.ceil(F.length("text") / F.lit(4.0)).cast("long")
    u = c.join(listing(t).select(F.col("p_partkey").alias("conv_id"), F.col("model_id").alias("model")),
               "conv_id", "left")
    return u.select("conv_id", "turn", "role", "model",
                    F.when(F.col("role") == "assistant", F.lit(0).cast("long")).otherwise(tokens).alias("prompt_tokens"),
                    F.when(F.col("role") == "assistant", tokens).otherwise(F.lit(0).cast("long")).alias("completion_tokens"))


@query("usage_ledger", oracle=f"WITH {_USAGE_SQL} SELECT * FROM ledger")
def usage_ledger(t):
    """Q6 + J3 + H6: per-call cost with the model's price (left join)."""
    return P.usage_cost(usage(t), prices(t))


@query("usage_cost_by_role", oracle=f"""WITH {_USAGE_SQL}
SELECT role, count(*) AS calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
       CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
       round(sum(cost), 6) AS cost, count(*) FILTER (WHERE cost IS NULL) AS unpriced
FROM ledger GROUP BY role""")
def usage_cost_by_role(t):
    """Q6: cost accounting per role (group-by over the ledger)."""
    led = P.usage_cost(usage(t), prices(t))
    return led.groupBy("role").agg(F.count(F.lit(1)).alias("calls"),
                                   F.sum("prompt_tokens").alias("prompt_tokens"),
                                   F.sum("completion_tokens").alias("completion_tokens"),
                                   F.round(F.sum("cost"), 6).alias("cost"),
                                   F.count_if(F.col("cost").isNull()).alias("unpriced"))


def replies(t):
    """One model reply per part in six shapes chosen by ``p_type``; every seventh part has a record without a price too."""
    p = listing(t).join(t.part.select("p_partkey", "p_type"), "p_partkey")
    key = F.col("p_partkey")
    rec = F.to_json(F.struct(F.col("raw_id").alias("model_id"), key.cast("double").alias("input_per_mtok"), (key * 2).cast("double").alias("output_per_mtok"),
                             (key * 0.5).cast("double").alias("cache_read_per_mtok"), (key * 0.25).cast("double").alias("batch_input_per_mtok")))
    rec = F.concat(F.lit("["), rec, F.when(key % 7 == 0, ', {"model_id": "half", "input_per_mtok": "n/a", "output_per_mtok": 1}').otherwise(""), F.lit("]"))
    content = (F.when(F.col("p_type") == "ECONOMY", rec)
                .when(F.col("p_type") == "SMALL", F.concat(F.lit("```json\n"), rec, F.lit("\n```")))
                .when(F.col("p_type") == "STANDARD", F.concat(F.lit("```\n"), rec, F.lit("\n```")))
                .when(F.col("p_type") == "PROMO", F.concat(F.lit("Here are the prices:\n"), rec))
                .when(F.col("p_type") == "LARGE", F.concat(F.lit('{"models": 3, "data": '), rec, F.lit("}")))
                .otherwise(F.concat(rec, F.lit("\nsee [docs]"))))
    return p.select("p_partkey", content.alias("content"))


@query("reply_parse", oracle=f"""WITH {_LISTING_SQL}
SELECT l.p_partkey, l.model_id AS model, CAST(l.p_partkey AS DOUBLE) AS input_per_mtok, CAST(l.p_partkey * 2 AS DOUBLE) AS output_per_mtok,
       CAST(NULL AS DOUBLE) AS cache_write_5m_per_mtok, CAST(NULL AS DOUBLE) AS cache_write_1h_per_mtok, l.p_partkey * 0.5::DOUBLE AS cache_read_per_mtok,
       l.p_partkey * 0.25::DOUBLE AS batch_input_per_mtok, CAST(NULL AS DOUBLE) AS batch_output_per_mtok
FROM listing l JOIN part p ON l.p_partkey = p.p_partkey WHERE p.p_type <> 'MEDIUM'""")
def reply_parse(t):
    """H11 + Q3 + Q5: fences, text before, wrappers, text after -> price rows with all tiers."""
    return P.reply_records(replies(t))


@query("reply_quarantine", oracle="""
SELECT p_partkey, CASE WHEN p_type <> 'MEDIUM' THEN 1 END AS item,
       CASE WHEN p_type = 'MEDIUM' THEN 'no list of records' ELSE 'record without id or price' END AS reason
FROM part WHERE p_type = 'MEDIUM' OR p_partkey % 7 = 0""")
def reply_quarantine(t):
    """Q4: replies and records that yield no price, with the reason."""
    return P.reply_rejects(replies(t))


@query("page_metadata", oracle="""
SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host,
       regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
       regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang
FROM pages""")
def page_metadata(t):
    """Metadata by regex over raw page text, host prefix."""
    pg = t.pages
    return pg.select("page_id", host_prefix("url").alias("host"),
                     F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
                     F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("lang"))


@query("host_profiles", oracle="""
SELECT regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host_prefix,
       CASE WHEN url LIKE 'https:%' THEN 'secure' ELSE 'plain' END AS profile, count(*) AS n_pages
FROM pages GROUP BY ALL""")
def host_profiles(t):
    """Distinct (host prefix, rate profile) with page counts."""
    pg = t.pages.select(host_prefix("url").alias("host_prefix"),
                        F.when(F.col("url").startswith("https:"), "secure").otherwise("plain").alias("profile"))
    return pg.groupBy("host_prefix", "profile").agg(F.count(F.lit(1)).alias("n_pages"))


@query("page_payload_extract", oracle="""
SELECT page_id, len(regexp_extract_all(html, '(?s)<script>(.*?)</script>', 1)) AS n_blocks,
       replace(replace(replace(replace(array_to_string(regexp_extract_all(html, '(?s)<script>(.*?)</script>', 1), ''),
               '\\\\"', '"'), '\\"', '"'), '\\n', chr(10)), '\\/', '/') AS payload
FROM pages""")
def page_payload_extract(t):
    """N14 + H7: collect all embedded script blocks, join, unescape."""
    blocks = F.regexp_extract_all("html", F.lit(r"(?s)<script>(.*?)</script>"), 1)
    return t.pages.select("page_id", F.size(blocks).alias("n_blocks"),
                          unescape_payload(F.array_join(blocks, "")).alias("payload"))


@query("request_plan", oracle="""
SELECT page_id,
       'https://api.example.org/v1/' || regexp_extract(html, '<html lang="([a-z]+)"', 1) || '/pages/' ||
       CAST(page_id AS VARCHAR) || '?host=' || regexp_extract(url, '^https?://([^/?#]+)', 1) AS request_url,
       CASE WHEN url LIKE 'https:%' THEN 2 ELSE 1 END AS n_headers
FROM pages""")
def request_plan(t):
    """B13 + B14 + Q1: context rows x adapter template -> request rows;
    NULL headers dropped from the header map."""
    pg = t.pages.select("page_id", "url", F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("lang"),
                        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"))
    url = template_fill("https://api.example.org/v1/{{ lang }}/pages/{{ page_id }}?host={{host}}",
                        {"lang": F.col("lang"), "page_id": F.col("page_id"), "host": F.col("host")})
    headers = F.map_filter(F.create_map(F.lit("accept"), F.lit("application/json"),
                                        F.lit("authorization"),
                                        F.when(F.col("url").startswith("https:"), F.lit("Bearer <token>"))),
                           lambda k, v: v.isNotNull())
    return pg.select("page_id", url.alias("request_url"), F.size(headers).alias("n_headers"))
