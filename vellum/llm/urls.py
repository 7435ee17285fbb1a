"""URL filter: host and path rules first, a character language-model ratio for the rest.

URLs that a rule decides are the labelled ones. Four in five of them train two
variable-order Markov models, of accepted and of rejected URLs: the chance of
a character after its last ``order`` characters, smoothed by the chance after
one character less, down to a uniform one. A URL's score is the difference of
its two log-likelihoods over its length. The threshold is set on the fifth of
the labelled URLs left out, where the two kinds are told apart best.

Counts, models and scores are tables: every URL's n-grams are counted, each
order's model is built from the order below by one join, and scores are sums
over a join of n-grams. Nothing but a histogram of scores reaches the driver.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellum.llm.common import Scratch

#: Marks before a URL's first character and after its last, outside of what URLs hold.
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @classmethod
    def parse(cls, text: str) -> Rule:
        """From ``allow example.org/en/``."""
        verdict, _, place = text.partition(" ")
        host, slash, path = place.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", "")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), F.coalesce(path, F.lit("")))


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The rule's name and verdict: the longest rule that fits, the longer host among equals."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def grams(text: Column, order: int) -> Column:
    """Every character and the end mark, each after its ``order`` characters before."""
    marked = F.concat(F.lit(START * order), F.translate(text, START + END, ""), F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(marked) - order), lambda i: F.substring(marked, i, F.lit(order + 1)))


def model(counted: DataFrame, scratch: Scratch, *, order: int, weight: float, alphabet: int) -> DataFrame:
    """``counted(gram, a, r)``, counts among accepted and rejected, to ``(gram, d)``: the difference of log chances."""
    below = None
    for k in range(order + 1):
        own = counted.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = Window.partitionBy(F.substring("gram", 1, k))  # no more rows than there are characters
        own = own.select("gram", "a", "r", F.sum("a").over(context).alias("all_a"), F.sum("r").over(context).alias("all_r"))
        if below is None:
            pa = pr = F.lit(1.0 / alphabet)
        else:
            own = own.join(below, F.substring("gram", 2, k) == F.col("short"))
            pa, pr = F.col("low_a"), F.col("low_r")
        own = own.select("gram", ((F.col("a") + weight * pa) / (F.col("all_a") + weight)).alias("pa"), ((F.col("r") + weight * pr) / (F.col("all_r") + weight)).alias("pr"))
        if k < order:
            below = scratch.put(own, f"order-{k}").select(F.col("gram").alias("short"), F.col("pa").alias("low_a"), F.col("pr").alias("low_r"))
    return own.select("gram", (F.ln("pa") - F.ln("pr")).alias("d"))


def threshold(held: DataFrame, bin_: float = 0.005) -> float:
    """The score from which on URLs are accepted: least errors, both kinds weighing the same. ``held(score, accepted)``."""
    bins = held.groupBy(F.floor(F.col("score") / bin_).alias("b")).agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")).orderBy("b").collect()
    all_a, all_r = sum(x["a"] for x in bins), sum(x["r"] for x in bins)
    if not all_a or not all_r:
        return 0.0
    lost, kept, cuts = 0, all_r, []
    for x in bins:
        cuts.append((lost / all_a + kept / all_r, x["b"] * bin_))
        lost, kept = lost + x["a"], kept - x["r"]
    cuts.append((lost / all_a + kept / all_r, (bins[-1]["b"] + 1) * bin_))
    least = min(c for c, _ in cuts)
    best = [t for c, t in cuts if c == least]
    return best[len(best) // 2]


def judge_urls(pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", order: int = 5, weight: float = 2.0, alphabet: int = 256) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` per row of ``pages``.

    ``verdict`` is the rule's, else ``allow`` if the score reaches the
    calibrated threshold. A null url, or one without ``://``, has an empty host
    and path and no rule; its score is that of its text, empty if null. With
    no accepted or no rejected URL to learn from, scores are of one model
    against a uniform one and the threshold is 0. Repeated rows get the same
    result; null ids stay; other columns are ignored; an empty table gives no
    rows.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = host_and_path(F.col(url_col))
    name, verdict = matched(F.col("host"), F.col("path"), rules)
    text = F.coalesce(F.when(F.instr(url_col, "://") > 0, F.concat(F.col("host"), F.substring(F.regexp_replace(url_col, r"(?s)\A.*?://", ""), F.length("host") + 1, F.length(url_col)))).otherwise(F.col(url_col)), F.lit(""))
    own = pages.select(F.col(id_col), F.col(url_col), host.alias("host"), path.alias("path")).select(
        id_col, "host", "path", name.alias("rule"), verdict.alias("told"), text.alias("text"))
    own = own.withColumn("u", F.xxhash64("text")).withColumn("held", F.pmod(F.xxhash64("text", F.lit("held")), F.lit(5)) == 0)
    texts = own.groupBy("u").agg(*(F.first(c).alias(c) for c in ("text", "told", "held")))
    texts = scratch.put(texts, "texts")
    learn = lambda v: F.count_if((F.col("told") == v) & ~F.col("held"))
    spread = texts.select("u", "told", "held", F.explode(grams(F.col("text"), order)).alias("gram"))
    counted = scratch.put(spread.groupBy("gram").agg(learn("allow").alias("a"), learn("block").alias("r")), "counts")
    diff = scratch.put(model(counted, scratch, order=order, weight=weight, alphabet=alphabet), "model")
    per_text = spread.select("u", "gram").groupBy("u", "gram").agg(F.count("*").alias("c")).join(diff, "gram").groupBy("u").agg((F.sum(F.col("c") * F.col("d")) / F.sum("c")).alias("score"))
    scored = scratch.put(texts.select("u", "told", "held").join(per_text, "u").select("u", "told", "held", F.round("score", 9).alias("score")), "scored")
    cut = threshold(scored.filter("held and told is not null").select("score", (F.col("told") == "allow").alias("accepted")))
    judged = own.select(id_col, "host", "path", "rule", "told", "u").join(scored.select("u", "score"), "u")
    return judged.select(id_col, "host", "path", "rule", F.coalesce("told", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"), "score")
