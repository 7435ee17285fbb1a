"""Benchmark decontamination: a BM25 index of test items, searched by block-max WAND.

Each training passage is a query; an item's score is its BM25 score divided by
the score of the item against itself, so that one threshold serves all items.
Postings hold that ratio per term, in blocks with their largest value. A
passage first sums, for all of its terms at once, the block maxima of each
block of items (no block can beat its sum); a passage with a block at the
threshold is searched by WAND over the postings, and every item at or above
the threshold is retrieved. A retrieved item counts if its question and its
answer both overlap the passage.

The index comes from the test items alone and is broadcast in slices of
bounded size. Documents are scanned once; each slice has a Python worker of its
own in a task, so a task's memory grows with the number of slices, that is with
the test items.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


@dataclass(frozen=True)
class Rules:
    """``threshold`` is the share of an item's own score; ``overlap`` the share of the question's, and of the answer's,
    distinct word pairs that the passage must hold. Items longer than ``item_words`` are indexed in pieces of it. An
    index holds at most ``slice_items`` pieces, so at most ``slice_items * item_words`` terms: that bounds a broadcast."""

    threshold: float = 0.5
    overlap: float = 0.5
    item_words: int = 128
    k1: float = 1.2
    b: float = 0.75
    block_items: int = 4
    slice_items: int = 1024


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """The answer is the last sentence or line; of a single sentence, its last third."""
    parts = [w for w in (words(s) for s in SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    own = parts[0] if parts else []
    cut = len(own) - len(own) // 3
    return own[:cut], own[cut:]


def pairs(tokens: list) -> set:
    return set(zip(tokens, tokens[1:], strict=False)) or set(tokens)


@dataclass
class Piece:
    """A run of words of an item's question or answer, or both, that fits a passage."""

    item: int
    question: set
    answer: set
    tokens: list[str] = field(repr=False)


def pieces_of(item: int, text: str | None, size: int) -> list[Piece]:
    question, answer = question_answer(text or "")
    tokens = question + answer
    if len(tokens) <= size:
        return [Piece(item, pairs(question), pairs(answer), tokens)] if tokens else []
    out = []
    for at in range(0, len(tokens), size):
        own = tokens[max(0, min(at, len(tokens) - size)):at + size]
        out.append(Piece(item, pairs(own[: len(own) // 2]), pairs(own[len(own) // 2:]), own))
    return out


class Index:
    """Postings of pieces with normalised BM25 weights, and the largest weight of each block of pieces."""

    def __init__(self, pieces: list[Piece], df: dict[str, int], n: int, mean: float, rules: Rules):
        self.pieces, self.rules = pieces, rules
        self.terms: dict[str, int] = {}
        post: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for i, p in enumerate(pieces):
            norm = rules.k1 * (1 - rules.b + rules.b * len(p.tokens) / mean)
            w = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (rules.k1 + 1) / (c + norm) for t, c in Counter(p.tokens).items()}
            own = sum(w.values())
            for t, x in w.items():
                post[self.terms.setdefault(t, len(self.terms))].append((i, x / own))
        self.post = [(np.array([i for i, _ in post[t]]), np.array([x for _, x in post[t]])) for t in range(len(self.terms))]
        self.blocks = -(-len(pieces) // rules.block_items)
        self.block_max = np.zeros((len(self.terms) + 1, self.blocks), np.float32)  # the last row: words in no item
        for t, (i, x) in enumerate(self.post):
            np.maximum.at(self.block_max[t], i // rules.block_items, x)
        self.block_max *= np.float32(1 + 1e-6)  # never below the exact weight
        self.width = 2 * max((len(p.tokens) for p in pieces), default=1)  # any piece lies whole in one of two overlapping passages

    def passages(self, tokens: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """The passages (words and distinct term ids) in which some block of items can reach the threshold."""
        get, none, half = self.terms.get, len(self.terms), self.width // 2
        ids = np.fromiter((get(w, none) for w in tokens), np.int64, len(tokens))
        known = np.flatnonzero(ids != none)
        if not len(known):
            return
        chunk = known // half
        key = np.unique(chunk * (none + 1) + ids[known])  # a term counts once a chunk
        at, term = key // (none + 1), key % (none + 1)
        chunks = -(-len(tokens) // half)
        bound = np.zeros((chunks + 1, self.blocks), np.float32)
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        step = max(1, (1 << 22) // max(1, self.blocks) // max(1, half))  # chunks whose rows are gathered at once
        for lo in range(0, len(starts), step):
            s = starts[lo:lo + step]
            to = starts[lo + step] if lo + step < len(starts) else len(term)
            bound[at[s]] = np.add.reduceat(self.block_max[term[s[0]:to]], s - s[0], axis=0)
        reach = (bound[:-1] + bound[1:]).max(axis=1) >= self.rules.threshold
        for c in np.flatnonzero(reach):
            own = ids[c * half:(c + 2) * half]
            yield tokens[c * half:(c + 2) * half], np.unique(own[own != none])

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Block-max WAND: all pieces whose score over ``terms`` is at least the threshold."""
        need, size = self.rules.threshold - 1e-9, self.rules.block_items
        # a block whose maxima over all of the passage's terms stay below the threshold is passed over in every list
        open_ = self.block_max[terms].sum(axis=0) >= need
        if not open_.any():
            return []
        lists = []
        for t in terms.tolist():
            i, x = self.post[t]
            if len(i := i[keep := open_[i // size]]):
                lists.append([0, i, x[keep], self.block_max[t], float(self.block_max[t].max())])
        found: list[tuple[int, float]] = []
        at = lambda x: int(x[1][x[0]])
        while True:
            lists = sorted((x for x in lists if x[0] < len(x[1])), key=at)
            total, pivot = 0.0, -1
            for k, x in enumerate(lists):
                total += x[4]
                if total >= need:
                    pivot = k
                    break
            if pivot < 0:
                return found
            doc = at(lists[pivot])
            while pivot + 1 < len(lists) and at(lists[pivot + 1]) == doc:
                pivot += 1
            block = doc // size
            if sum(float(x[3][block]) for x in lists[: pivot + 1]) < need:
                # no item of this block can do it with these lists: on to the next block, or to where one more list joins in
                target = (block + 1) * size
                if pivot + 1 < len(lists):
                    target = max(doc + 1, min(target, at(lists[pivot + 1])))
                for x in lists[: pivot + 1]:
                    x[0] = int(np.searchsorted(x[1], target))
            elif at(lists[0]) == doc:
                score = sum(float(x[2][x[0]]) for x in lists[: pivot + 1])
                if score >= need:
                    found.append((doc, score))
                for x in lists[: pivot + 1]:
                    x[0] += 1
            else:
                for x in lists[:pivot]:
                    x[0] = int(np.searchsorted(x[1], doc))

    def leaks(self, text: str | None) -> dict[int, float]:
        """The items found in a whole text, with their best score."""
        out: dict[int, float] = {}
        for own, terms in self.passages(words(text or "")):
            have = None
            for i, score in self.search(terms):
                p = self.pieces[i]
                have = have or (set(zip(own, own[1:], strict=False)) | set(own))
                if score > out.get(p.item, 0) and all(len(part & have) >= self.rules.overlap * len(part) for part in (p.question, p.answer)):
                    out[p.item] = score
        return out


def indexes(items: DataFrame, rules: Rules, *, item_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """One index per slice of the test items, with statistics of all of them.

    Items are read to the driver a slice at a time, in order of their ids; a
    null id is item -1. The term statistics are of the items, counted by Spark
    for each slice's terms.
    """
    tokens = F.udf(words, T.ArrayType(T.StringType()))
    own = items.select(F.coalesce(F.col(item_col).cast("long"), F.lit(-1)).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("words", tokens("text"))
    n, total = own.agg(F.count("*"), F.sum(F.size("words"))).first()
    last = None
    while n:
        later = F.lit(True) if last is None else (F.col("item") > last[0]) | ((F.col("item") == last[0]) & (F.col("text") > last[1]))
        rows = own.filter(later).select("item", "text").distinct().orderBy("item", "text").limit(rules.slice_items).collect()
        if not rows:
            return
        last = rows[-1]
        pieces = [p for r in rows for p in pieces_of(r["item"], r["text"], rules.item_words)]
        vocabulary = items.sparkSession.createDataFrame([(t,) for t in {t for p in pieces for t in p.tokens}] or [("",)], "t string")
        df = own.select(F.explode(F.array_distinct("words")).alias("t")).join(vocabulary, "t").groupBy("t").agg(F.count("*").alias("c"))
        df = {r["t"]: r["c"] for r in df.collect()}
        for at in range(0, len(pieces), rules.slice_items):
            yield Index(pieces[at:at + rules.slice_items], df, n, max(1.0, (total or 0) / n), rules)


def leak_udf(spark: SparkSession, index: Index):
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(index))

    @F.pandas_udf("array<struct<item: long, score: double>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = cloudpickle.loads(sent.value)
        for texts in batches:
            yield pd.Series([[{"item": i, "score": s} for i, s in sorted(own.leaks(t).items())] for t in texts], dtype=object)
    return found


def find_leaks(docs: DataFrame, items: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_items, item_ids, best_score, contaminated)`` per row of ``docs``.

    ``item_ids``: the ids found, in order, joined by commas, empty if none.
    Null and empty texts and items match nothing; without items nothing is
    contaminated; null ids stay; repeated rows get the same result; repeated
    items count as they are; other columns are ignored; an empty table gives
    no rows. Texts are searched whole, however long.
    """
    found = _found(docs, items, rules, text_col)
    return found.select(
        F.col(id_col), F.size("hits").cast("long").alias("n_items"),
        F.array_join(F.transform(F.array_sort(F.array_distinct(F.col("hits.item"))), lambda x: x.cast("string")), ",").alias("item_ids"),
        F.coalesce(F.round(F.array_max("hits.score"), 6), F.lit(0.0)).alias("best_score"), (F.size("hits") > 0).alias("contaminated"))


def _found(docs: DataFrame, items: DataFrame, rules: Rules, text_col: str) -> DataFrame:
    none = F.array().cast("array<struct<item: long, score: double>>")
    hits = [leak_udf(docs.sparkSession, index)(docs[text_col]) for index in indexes(items, rules)]
    return docs.withColumn("hits", F.concat(*hits) if hits else none)


def keep_clean(docs: DataFrame, items: DataFrame, rules: Rules = Rules(), *, text_col: str = "text") -> DataFrame:
    """Whole rows of documents without a test item.

    Null and empty texts stay, as do null ids, repeated rows and other
    columns; an empty table gives an empty table.
    """
    for index in indexes(items, rules):
        docs = docs.filter(F.size(leak_udf(docs.sparkSession, index)(docs[text_col])) == 0)
    return docs
