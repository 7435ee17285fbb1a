"""Language identification by a byte convolutional network trained in numpy.

A text's UTF-8 bytes are cut into windows of fixed length; filters of several
widths run over the embedded bytes, the largest response of each filter goes
through a linear layer and a softmax. A document's class is that of the mean
of its windows' probabilities, weighted by their bytes, over the whole text.

Training runs on the driver over a bounded sample of labelled rows (``Plan``);
the model is some ten thousand numbers and travels with the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
LETTER_LIKE = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Plan:
    """Bounds and sizes. Every label is a class. The sample has about ``docs_per_lang`` documents a language, fewer if
    that were more than ``sample_docs`` in all but at least one, by a hash of id and text, and never more than about
    twice as many in all; of each, ``windows_per_doc`` windows spread over the text."""

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embed: int = 8
    docs_per_lang: int = 300
    sample_docs: int = 60_000
    windows_per_doc: int = 4
    turns: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numerals such as one half or a circled one are none."""
    like = LETTER_LIKE.search(text)
    return like is not None and (like.group().isalpha() or any(map(str.isalpha, text)))


def windows(data: bytes, size: int) -> np.ndarray:
    """All of ``data`` as rows of ``size`` bytes, the last one filled with zeros."""
    n = max(1, -(-len(data) // size))
    out = np.zeros(n * size, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, size)


class Network:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, langs: list[str], plan: Plan):
        rng = np.random.default_rng(plan.seed)
        self.langs, self.plan = langs, plan
        self.embed = rng.normal(0, 0.5, (256, plan.embed)).astype(np.float32)
        self.w = [rng.normal(0, (w * plan.embed) ** -0.5, (w, plan.embed, plan.filters)).astype(np.float32) for w in plan.widths]
        self.b = [np.zeros(plan.filters, np.float32) for _ in plan.widths]
        hidden = plan.filters * len(plan.widths)
        self.out = rng.normal(0, hidden ** -0.5, (hidden, len(langs))).astype(np.float32)
        self.out_b = np.zeros(len(langs), np.float32)

    def tables(self) -> list[np.ndarray]:
        """For each width and place in the filter, the response to each byte: what a trained filter does, by look-up."""
        return [np.ascontiguousarray(np.einsum("be,wef->wbf", self.embed, w)) for w in self.w]

    def pooled(self, x: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        parts, best = [], []
        for table, bias in zip(tables, self.b, strict=True):
            n = x.shape[1] - len(table) + 1
            r = table[0][x[:, :n]]
            for j in range(1, len(table)):
                r += table[j][x[:, j:j + n]]
            best.append(r.argmax(axis=1))
            parts.append(np.maximum(np.take_along_axis(r, best[-1][:, None], 1)[:, 0] + bias, 0))
        return np.concatenate(parts, axis=1), best

    def probabilities(self, x: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
        tables = tables or self.tables()
        out = []
        for at in range(0, len(x), self.plan.batch):
            block, parts = x[at:at + self.plan.batch], []
            for table, bias in zip(tables, self.b, strict=True):
                n = block.shape[1] - len(table) + 1
                r = table[0].take(block[:, :n], axis=0)
                for j in range(1, len(table)):
                    r += table[j].take(block[:, j:j + n], axis=0)
                parts.append(np.maximum(r.max(axis=1) + bias, 0))
            out.append(softmax(np.concatenate(parts, axis=1) @ self.out + self.out_b))
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)), np.float32)

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        """Adam on the cross-entropy; classes weigh the same however many windows they have."""
        rng = np.random.default_rng(self.plan.seed)
        params = [self.embed, *self.w, *self.b, self.out, self.out_b]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        weight = (len(y) / np.maximum(np.bincount(y, minlength=len(self.langs)), 1) / len(self.langs)).astype(np.float32)
        step = 0
        for _ in range(self.plan.turns):
            order = rng.permutation(len(x))
            for at in range(0, len(x), self.plan.batch):
                rows = order[at:at + self.plan.batch]
                for i, g in enumerate(self.gradients(x[rows], y[rows], weight[y[rows]])):
                    if i == 0:
                        step += 1
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.99 * v[i] + 0.01 * g * g
                    params[i] -= self.plan.rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        hidden, best = self.pooled(x, self.tables())
        d = softmax(hidden @ self.out + self.out_b)
        d[np.arange(len(y)), y] -= 1
        d *= weight[:, None] / len(y)
        g_out, g_out_b = hidden.T @ d, d.sum(axis=0)
        back = (d @ self.out.T) * (hidden > 0)
        g_embed, g_w, g_b, f = np.zeros_like(self.embed), [], [], self.plan.filters
        for k, (w, at) in enumerate(zip(self.w, best, strict=True)):
            g = back[:, k * f:(k + 1) * f]
            g_b.append(g.sum(axis=0))
            gw = np.zeros_like(w)
            for j in range(len(w)):
                symbol = np.take_along_axis(x, at + j, 1)  # the byte under place j where the filter answered most
                gw[j] = np.einsum("nfe,nf->ef", self.embed[symbol], g)
                np.add.at(g_embed, symbol.ravel(), (g[:, :, None] * w[j].T[None]).reshape(-1, self.plan.embed))
            g_w.append(gw)
        return [g_embed, *g_w, *g_b, g_out, g_out_b]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def is_held_out(id_col: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, mod 4, is 2 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, plan: Plan = Plan(), *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    """Train on labelled documents that aren't held out. No such document: a network without classes."""
    own = docs.filter(~is_held_out(id_col) & F.col(lang_col).isNotNull() & (F.length(F.trim(text_col)) > 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    counts = {r["lang"]: (r["n"], r["least"]) for r in own.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()}
    langs = sorted(counts)
    net = Network(langs, plan)
    if not langs:
        return net
    each = max(1, min(plan.docs_per_lang, plan.sample_docs // len(langs)))
    shares = docs.sparkSession.createDataFrame([(lang, min(1.0, each / n), least) for lang, (n, least) in sorted(counts.items())], "lang string, share double, least long")
    drawn = own.join(F.broadcast(shares), "lang").filter((F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003) & (F.col("h") != F.col("least")))
    # a label's least hash is always there, once: none is without a document
    first = own.join(F.broadcast(shares), "lang").filter("h = least").dropDuplicates(["lang"])
    picked = drawn.select("lang", "text", "h").limit(2 * each * len(langs)).unionByName(first.select("lang", "text", "h"))
    places = [F.substring("text", F.floor(F.length("text") * i / plan.windows_per_doc).cast("int") + 1, F.lit(plan.window)) for i in range(plan.windows_per_doc)]
    rows = picked.select("lang", "h", F.array(*places).alias("parts")).collect()
    rows.sort(key=lambda r: (r["lang"], r["h"]))
    x, y = [], []
    for r in rows:
        for part in dict.fromkeys(r["parts"]):
            if has_letter(part):
                x.append(windows(part.encode("utf-8", "replace")[: plan.window], plan.window)[0])
                y.append(langs.index(r["lang"]))
    if x:
        whole, rng = np.stack(x), np.random.default_rng(plan.seed)
        # once more with only so many bytes of each window: texts may be short
        short = np.where(np.arange(plan.window) < rng.integers(6, plan.window, len(x))[:, None], whole, 0).astype(np.uint8)
        net.train(np.concatenate((whole, short)), np.array(y * 2))
    return net


def classifier(net: Network):
    """A column function: text to ``struct(lang, score)``; ``und`` with score 0 for null or letterless texts."""

    @F.pandas_udf("lang string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables, size = net.tables(), net.plan.window
        for texts in batches:
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            cut, owner, lens = [], [], []

            def flush():
                if not cut:
                    return
                p = net.probabilities(np.concatenate(cut), tables) * np.concatenate(lens)[:, None]  # noqa: B023
                starts = np.cumsum([0] + [len(c) for c in cut[:-1]])  # noqa: B023
                mean = np.add.reduceat(p, starts, axis=0) / np.array([n.sum() for n in lens])[:, None]  # noqa: B023
                for i, best, score in zip(owner, mean.argmax(axis=1), mean.max(axis=1), strict=True):  # noqa: B023
                    langs[i], scores[i] = net.langs[best], min(1.0, float(score))  # noqa: B023
                cut.clear(), owner.clear(), lens.clear()  # noqa: B023

            held = 0
            for i, t in enumerate(texts):
                if t is None or not net.langs or not has_letter(t):
                    continue
                data = t.encode("utf-8", "replace")
                rows = windows(data, size)
                n = np.full(len(rows), size, np.float32)
                n[-1] = len(data) - size * (len(rows) - 1)
                cut.append(rows), owner.append(i), lens.append(n)
                held += len(rows)
                if held > 1 << 14:
                    flush()
                    held = 0
            flush()
            yield pd.DataFrame({"lang": langs, "score": scores})
    return classify


def identify(docs: DataFrame, net: Network | None = None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` per row.

    Null, empty and letterless texts (no character is a letter; a numeral or a
    sign is none), and all texts if nothing is labelled, are ``und`` with
    score 0. Every window of a very long text counts. Repeated rows get the
    same result; null ids are kept and never held out; other columns are
    ignored; an empty table gives no rows.
    """
    net = net or fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    found = docs.select(F.col(id_col), is_held_out(id_col).alias("held_out"), classifier(net)(F.col(text_col)).alias("p"))
    return found.select(id_col, "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_known(docs: DataFrame, min_score: float = 0.3, net: Network | None = None) -> DataFrame:
    """Whole rows of documents whose language is recognised with at least ``min_score``.

    Null, empty and letterless texts go; null ids, repeated rows and other
    columns stay as they are; an empty table gives no rows.
    """
    p = classifier(net or fit(docs))(docs["text"])
    return docs.filter((p["lang"] != UNKNOWN) & (p["score"] >= min_score))
