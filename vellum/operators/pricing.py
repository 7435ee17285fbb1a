"""Model pricing normalisation, id matching and usage cost accounting.

All work is column expressions, joins and aggregates; no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import model_id_normalise, per_million, provider_of, unescape_payload
from vellum.operators.temporal import as_of_join

# Derived price tiers as multiples of the base prices
# (cache write 5 min and 1 h, cache read, batch input of input; batch output
# of output), rounded to 4 decimals half-even.
TIER_MULTIPLIERS = {
    "cache_write_5m_per_mtok": ("input_per_mtok", 1.25),
    "cache_write_1h_per_mtok": ("input_per_mtok", 2.0),
    "cache_read_per_mtok": ("input_per_mtok", 0.1),
    "batch_input_per_mtok": ("input_per_mtok", 0.5),
    "batch_output_per_mtok": ("output_per_mtok", 0.5),
}


def normalise_listing(listing: DataFrame, id_col: str = "id", prompt: str = "prompt",
                      completion: str = "completion") -> DataFrame:
    """H3 + H4 + B9: listing rows -> (model, provider, input/output per
    million); rows lacking an id or either price are dropped."""
    d = listing.filter(F.col(id_col).isNotNull() & (F.col(id_col) != "")
                       & F.col(prompt).isNotNull() & F.col(completion).isNotNull())
    return d.select(F.col(id_col).alias("model"), provider_of(F.col(id_col)).alias("provider"),
                    per_million(F.col(prompt)).alias("input_per_mtok"),
                    per_million(F.col(completion)).alias("output_per_mtok"))


def with_tiers(prices: DataFrame, providers: list[str] | None) -> DataFrame:
    """H5: derived tiers for the given providers only (``None`` = all)."""
    scope = F.lit(True) if providers is None else F.col("provider").isin(providers)
    out = prices
    for name, (base, mult) in TIER_MULTIPLIERS.items():
        out = out.withColumn(name, F.when(scope, F.bround(F.col(base) * F.lit(mult), 4)))
    return out


def prefix_match(ids: DataFrame, canonical: DataFrame, id_col: str = "model_id",
                 canon_col: str = "canonical_id") -> DataFrame:
    """Map each normalised id to the shortest canonical id it is a
    prefix of (ties lexicographic); exact matches win; no match -> itself.

    Every canonical id is expanded to all its prefixes and reduced to the
    best candidate per prefix with a map-side-combined aggregate *before*
    the join, so a popular prefix never gathers its candidates in one task
    and the final join is a plain 1:1 equi-join.
    """
    c = canonical.select(F.col(canon_col).alias("_c")).filter(F.col("_c").isNotNull())
    pref = (c.select("_c", F.explode(F.sequence(F.lit(1), F.length("_c"))).alias("_n"))
             .select(F.expr("substring(_c, 1, _n)").alias("_p"), "_c"))
    best = pref.groupBy("_p").agg(F.min(F.struct(F.length("_c").alias("l"), F.col("_c").alias("c"))).alias("_b"))
    j = ids.join(best, ids[id_col] == best["_p"], "left")
    return j.select(*[ids[c] for c in ids.columns],
                    F.coalesce(F.col("_b")["c"], ids[id_col]).alias("matched_id"))


def usage_cost(usage: DataFrame, prices: DataFrame, model_col: str = "model") -> DataFrame:
    """J3 + H6: cost = (prompt * in + completion * out) / 1e6 per call;
    unknown models get NULL cost (left join)."""
    p = prices.select(F.col("model").alias("_pm"), "input_per_mtok", "output_per_mtok")
    j = usage.join(p, usage[model_col] == p["_pm"], "left").drop("_pm")
    return j.withColumn("cost", (F.col("prompt_tokens") * F.col("input_per_mtok")
                                 + F.col("completion_tokens") * F.col("output_per_mtok")) / F.lit(1e6))


#: The fields of a price record, as replies name them.
PRICE_FIELDS = ("input_per_mtok", "output_per_mtok", "cache_write_5m_per_mtok", "cache_write_1h_per_mtok",
                "cache_read_per_mtok", "batch_input_per_mtok", "batch_output_per_mtok")


def _reply_items(replies: DataFrame, content: str) -> DataFrame:
    """Each reply with ``_vl_items``, its records as variants; null if it is not JSON or holds no list. It is parsed once.

    A code fence (with or without a ``json`` tag) is taken off and what comes
    before the first ``[`` or ``{`` skipped; the rest must be one JSON value
    without text after it: a list, or an object with a list under ``models``,
    ``data`` or ``pricing``, the first of them that is one.
    """
    bound = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)  # noqa: E731  evaluated once, however often ``f`` uses it

    def body(c: Column) -> Column:
        fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)```", 1)
        return F.regexp_replace(F.when(fenced != "", fenced).otherwise(c), r"(?s)\A[^\[{]*", "")

    def items(whole: Column) -> Column:
        list_at = lambda p: F.try_variant_get(whole, p, "array<variant>")
        listed = F.coalesce(list_at("$[0]"), *[list_at(f"$[0].{k}") for k in ("models", "data", "pricing")])
        return F.when(F.try_variant_get(whole, "$[1]", "variant").isNull(), listed)

    # parsers stop at a value's end: as an array's only item it must fill the text
    text = bound(F.trim(F.col(content)), lambda c: F.concat(F.lit("["), body(c), F.lit("]")))
    return replies.withColumn("_vl_items", bound(F.try_parse_json(text), items))


def _price(record: str, field: str) -> Column:
    """A price that is a JSON number and not below zero; else null."""
    at = f"$.{field}"
    number = F.schema_of_variant(F.try_variant_get(record, at, "variant")).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    value = F.try_variant_get(record, at, "double")
    return F.when(number & (value >= 0), value)


def reply_records(replies: DataFrame, content: str = "content") -> DataFrame:
    """H11 + Q3 + Q5: one row per priced record, with its model id normalised and all seven prices.

    A record without a model id, an input or an output price is left to
    :func:`reply_rejects`; a price that is no number, or below zero, counts
    as missing. The declared schema as a whole is checked by
    :mod:`vellum.operators.validate`.
    """
    keep = [x for x in replies.columns if x != content]
    rows = _reply_items(replies, content).select(*keep, F.explode("_vl_items").alias("_r"))
    rows = rows.select(*keep, model_id_normalise(F.try_variant_get("_r", "$.model_id", "string")).alias("model"), *[_price("_r", f).alias(f) for f in PRICE_FIELDS])
    return rows.filter((F.col("model") != "") & F.col("input_per_mtok").isNotNull() & F.col("output_per_mtok").isNotNull())


def reply_rejects(replies: DataFrame, content: str = "content") -> DataFrame:
    """Q4: what ``reply_records`` left out, with a reason: whole replies (``item`` null) and single records."""
    keep = [x for x in replies.columns if x != content]
    d = _reply_items(replies, content).withColumn("_bad", F.col("_vl_items").isNull()).select(*keep, "_bad", F.posexplode_outer("_vl_items").alias("item", "_r"))
    lacks = F.coalesce(F.try_variant_get("_r", "$.model_id", "string"), F.lit("")) == ""
    for f in PRICE_FIELDS[:2]:
        lacks = lacks | _price("_r", f).isNull()
    reason = F.when(F.col("_bad"), "no list of records").when(F.col("item").isNotNull() & lacks, "record without id or price")
    return d.select(*keep, "item", reason.alias("reason")).filter("reason is not null")


#: The block that carries a page's payload, and where prices stand in it.
PUSH_BLOCK = r'(?s)self\.__next_f\.push\(\[\d+,\s*"(.*?)"\]\)'
LIST_PRICE = r'(?s)"api(?:_endpoint)?"\s*:\s*"([^"]+)".{0,500}?"price"\s*:\s*\[(.*?)\]'
LIST_SIDE = r"%s.*?price_dollar.*?\$+([0-9.]+)"
SCALED_PRICE = r'"name"\s*:\s*"(%s[^"]+)".*?"promptTextTokenPrice"\s*:\s*"\$n(\d+)".*?"completionTextTokenPrice"\s*:\s*"\$n(\d+)"'
PLAIN_PRICE = r'"modelName"\s*:\s*"([^"]+)".*?"inputPrice"\s*:\s*([0-9.]+).*?"outputPrice"\s*:\s*([0-9.]+)'


def page_payload(html) -> Column:
    """The page's push blocks, joined and unescaped."""
    return unescape_payload(F.array_join(F.regexp_extract_all(html, F.lit(PUSH_BLOCK), 1), ""))


def _price_structs(payload: Column, shape: str, name_prefix: str) -> Column:
    def groups(pattern, n):
        return [F.regexp_extract_all(payload, F.lit(pattern), i + 1) for i in range(n)]

    def struct(name, a, b):
        return F.struct(name.alias("name"), a.try_cast("double").alias("input_per_mtok"), b.try_cast("double").alias("output_per_mtok"))

    if shape == "list":
        name, block = groups(LIST_PRICE, 2)
        side = lambda b, s: F.nullif(F.regexp_extract(b, LIST_SIDE % s, 1), F.lit(""))
        return F.zip_with(name, block, lambda n, b: struct(n, side(b, "Input"), side(b, "Output")))
    name, low, high = groups(SCALED_PRICE % name_prefix if shape == "scaled" else PLAIN_PRICE, 3)
    rows = F.zip_with(F.zip_with(name, low, lambda n, a: F.struct(n.alias("n"), a.alias("a"))), high, lambda s, b: struct(s["n"], s["a"], b))
    if shape == "scaled":
        return F.transform(rows, lambda r: F.struct(r["name"].alias("name"), (r["input_per_mtok"] / 10000).alias("input_per_mtok"),
                                                    (r["output_per_mtok"] / 10000).alias("output_per_mtok")))
    return F.transform(rows, lambda r: F.struct(F.replace(F.lower(r["name"]), F.lit(" "), F.lit("-")).alias("name"), r["input_per_mtok"], r["output_per_mtok"]))


def payload_prices(pages: DataFrame, payload: str, provider: str, shape: str, keep=(), name_prefix: str = "") -> DataFrame:
    """Prices in page payloads, a row per model.

    ``shape``: ``list`` (entries with dollar texts), ``scaled`` (integers of a
    ten-thousandth) or ``plain`` (numbers). Entries without both prices are
    left out; the first of a name stays, but ``plain`` keeps all.
    """
    rows = pages.select(*keep, _price_structs(F.col(payload), shape, name_prefix).alias("_vl_rows"))
    rows = rows.select(*keep, F.posexplode(F.filter("_vl_rows", lambda r: r["input_per_mtok"].isNotNull() & r["output_per_mtok"].isNotNull())).alias("_vl_pos", "r"),
                       F.transform(F.filter("_vl_rows", lambda r: r["input_per_mtok"].isNotNull() & r["output_per_mtok"].isNotNull()), lambda r: r["name"]).alias("_vl_names"))
    if shape != "plain":
        rows = rows.filter(F.array_position("_vl_names", F.col("r.name")) == F.col("_vl_pos") + 1)
    return rows.select(*keep, F.concat(F.lit(provider + "/"), F.col("r.name")).alias("model_id"), "r.input_per_mtok", "r.output_per_mtok")


#: What a call's mode does to the base prices: (input, output) multiples.
MODES = {"standard": (1.0, 1.0), "cache_read": (0.1, 1.0), "cache_write_5m": (1.25, 1.0), "cache_write_1h": (2.0, 1.0), "batch": (0.5, 0.5)}


def cost_at_call(calls: DataFrame, history: DataFrame, model: str, called_at: str, mode: str = "mode", modes: dict[str, tuple[float, float]] = MODES,
                 sizes: DataFrame | None = None) -> DataFrame:
    """Q6 + H6 + J13: each call with the prices that were in effect when it was made, and its cost.

    ``calls`` has ``prompt_tokens`` and ``completion_tokens``; ``history`` has
    ``model``, ``sys_from``, ``input_per_mtok`` and ``output_per_mtok``. A
    null mode is ``standard``; a call of an unknown mode, or from before its
    model's first price, has a null cost. ``sizes`` is as in ``as_of_join``.
    """
    priced = as_of_join(calls, history, [model], called_at, "sys_from", ["input_per_mtok", "output_per_mtok"], sizes=sizes)
    kind = F.coalesce(F.col(mode), F.lit("standard"))
    times = [F.create_map(*[F.lit(x) for k, v in modes.items() for x in (k, v[i])])[kind] for i in (0, 1)]
    cost = F.col("prompt_tokens") * F.col("input_per_mtok") * times[0] + F.col("completion_tokens") * F.col("output_per_mtok") * times[1]
    return priced.withColumn("cost", cost / F.lit(1e6))


def selected_providers(providers: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Current providers (no ``sys_to``) that have a pricing URL (``urls['pricing']``), of a list if one is given, with how to fetch: ``browser`` or ``reader``."""
    url = F.col("urls")["pricing"]
    out = providers.filter(F.col("sys_to").isNull() & (F.coalesce(url, F.lit("")) != ""))
    out = out.filter(F.col("provider").isin(only)) if only else out
    return out.withColumn("pricing_url", url).withColumn("fetch", F.when(F.coalesce("needs_browser", F.lit(False)), "browser").otherwise("reader"))


def models_of(models: DataFrame, provider: Column | str, col: str = "model") -> DataFrame:
    """The models under a provider's prefix, ``provider/``."""
    provider = F.lit(provider) if isinstance(provider, str) else provider
    return models.filter(F.startswith(F.col(col), F.concat(provider, F.lit("/"))))
