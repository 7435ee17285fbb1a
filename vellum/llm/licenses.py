"""Licence scan: a trained paragraph classifier, confirmed by the templates.

A run of lines that aren't blank is a paragraph, however its text is wrapped.
Its windows are the places that hold enough of a template's word pairs, at
any offset. A logistic regression over the words and word pairs of a window
gives each licence family, and ``unknown``, a probability. It is trained on
the driver: positives are varied templates, negatives a bounded sample of the
corpus's own paragraphs. A quarter is left out of training and calibrates the
probabilities (a temperature) and the least probability that counts. Every
window whose template is of a family with at least that probability is a hit.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
MARK = re.compile(r"^\s*(?:@?rem|dnl)(?:\s|$)", re.I)  # comment marks made of letters; the others hold no word
UNKNOWN = "unknown"

# The wordings by which texts name these licence families.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Distributed under the Apache License 2.0.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GPL version 2 or later.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "AGPL": ("Licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC0": ("Released under CC0 1.0 Universal.", "This work has been dedicated to the public domain under CC0."),
    "Proprietary": ("All rights reserved.", "Copyright Example Corporation. All rights reserved."),
}


@dataclass(frozen=True)
class Plan:
    """Bounds: about ``sample_docs`` documents, never more than twice as many, give up to ``per_doc`` paragraphs each,
    of ``sample_chars`` characters at most, as negatives; the model knows the templates' words and pairs and
    ``negative_terms`` more."""

    sample_docs: int = 500
    per_doc: int = 4
    sample_chars: int = 600
    negative_terms: int = 1500
    variants: int = 12
    window: int = 80
    least: float = 0.5
    contained: float = 0.6
    stray: int = 8
    steps: int = 120
    seed: int = 5


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def terms(tokens: list[str]) -> set:
    return set(tokens) | set(zip(tokens, tokens[1:], strict=False))


def pairs(tokens: list[str]) -> set:
    return set(zip(tokens, tokens[1:], strict=False))


def contained(template: list[str], tokens: list[str]) -> float:
    """The share of a template's word pairs that the paragraph holds."""
    own = pairs(template)
    return len(own & pairs(tokens)) / len(own)


class Classifier:
    def __init__(self, plan: Plan, templates: dict[str, tuple[str, ...]] = TEMPLATES):
        self.plan = plan
        self.families = [UNKNOWN, *templates]
        self.templates = {f: [words(t) for t in ts] for f, ts in templates.items()}
        self.needs: list[tuple[str, int, int]] = []  # of each template, its family, how many of its pairs are enough and how many it has
        self.by_pair: dict[tuple[str, str], list[int]] = {}
        for f, ts in self.templates.items():
            for own in map(pairs, ts):
                for pair in own:
                    self.by_pair.setdefault(pair, []).append(len(self.needs))
                self.needs.append((f, next(n for n in range(1, len(own) + 1) if n / len(own) >= plan.contained), len(own)))
        self.vocabulary: dict = {}
        self.weights = np.zeros((1, len(self.families)), np.float32)
        self.heat, self.least = 1.0, plan.least

    def varied(self, rng: np.random.Generator) -> Iterator[tuple[int, list[str]]]:
        """Templates as they are, with words left out, and between other words."""
        filler = [w for ts in self.templates.values() for t in ts for w in t]
        for f, ts in self.templates.items():
            for t in ts:
                yield self.families.index(f), t
                for _ in range(self.plan.variants):
                    own = [w for w in t if rng.random() > 0.08] or t
                    extra = [f"w{rng.integers(10**6)}" if rng.random() < 0.7 else filler[rng.integers(len(filler))] for _ in range(rng.integers(0, 6))]
                    cut = rng.integers(0, len(extra) + 1)
                    yield self.families.index(f), extra[:cut] + own + extra[cut:]

    def fit(self, negatives: list[str]) -> Classifier:
        rng = np.random.default_rng(self.plan.seed)
        rows = list(self.varied(rng))
        for text in negatives:
            tokens = words(text)
            # not a negative if it holds a template, or is a piece of one: the sample is unlabelled
            if tokens and all(contained(t, tokens) < 0.5 and (len(tokens) < 4 or contained(tokens, t) < 0.5) for ts in self.templates.values() for t in ts):
                rows.append((0, tokens))
        known = set().union(*(terms(t) for ts in self.templates.values() for t in ts))
        often = Counter(x for y, t in rows if y == 0 for x in terms(t))
        known |= {x for x, _ in sorted(often.items(), key=lambda x: (-x[1], str(x[0])))[: self.plan.negative_terms]}
        self.vocabulary = {x: i + 1 for i, x in enumerate(sorted(known, key=str))}
        self.weights = np.zeros((len(self.vocabulary) + 1, len(self.families)), np.float32)  # row 0: the bias
        x = np.stack([self.features(t) for _, t in rows])
        y = np.array([y for y, _ in rows])
        held = rng.random(len(y)) < 0.25
        weight = (1 / np.maximum(np.bincount(y[~held], minlength=len(self.families)), 1))[y[~held]].astype(np.float32)
        weight[y[~held] == 0] *= 4  # most paragraphs are of no licence
        m, v, tx, ty = np.zeros_like(self.weights), np.zeros_like(self.weights), x[~held], y[~held]
        for step in range(1, self.plan.steps + 1):
            d = softmax(tx @ self.weights)
            d[np.arange(len(ty)), ty] -= 1
            g = tx.T @ (d * weight[:, None]) / weight.sum() + 1e-5 * self.weights
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            self.weights -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        z, hy = x[held] @ self.weights, y[held]
        if len(hy):
            heats = np.geomspace(0.25, 8, 40)
            self.heat = float(min(heats, key=lambda t: -np.log(softmax(z / t)[np.arange(len(hy)), hy] + 1e-12).mean()))
            wrong = softmax(z[hy == 0] / self.heat)[:, 1:].max(axis=1, initial=0)
            self.least = float(min(0.95, max(self.plan.least, wrong.max(initial=0) + 0.01)))
        return self

    def features(self, tokens: list[str]) -> np.ndarray:
        out = np.zeros(len(self.vocabulary) + 1, np.float32)
        out[0] = 1
        own = [self.vocabulary[t] for t in terms(tokens) if t in self.vocabulary]
        out[own] = 1 / np.sqrt(len(tokens))
        return out

    def judge(self, tokens: list[str]) -> np.ndarray:
        """The probability of each family."""
        get = self.vocabulary.get
        own = [i for i in map(get, terms(tokens)) if i]
        z = self.weights[0] + self.weights[own].sum(axis=0) / np.sqrt(len(tokens))
        return softmax(z[None] / self.heat)[0]

    def held(self, tokens: list[str]) -> Iterator[tuple[int, int, str, float, frozenset[int]]]:
        """Where at most a window of words holds enough of a template's word pairs: first word, end, family, share of the pairs, their places."""
        places: dict[int, list[tuple[int, tuple[str, str]]]] = {}
        for i, pair in enumerate(zip(tokens, tokens[1:], strict=False)):
            for t in self.by_pair.get(pair, ()):
                places.setdefault(t, []).append((i, pair))
        for t, own in places.items():
            family, need, total = self.needs[t]
            if len(own) < need:
                continue
            spans, count, lo = [], Counter(), 0
            for hi, (end, pair) in enumerate(own):
                count[pair] += 1
                while end + 2 - own[lo][0] > self.plan.window or count[own[lo][1]] > 1:
                    count[own[lo][1]] -= 1
                    if not count[own[lo][1]]:
                        del count[own[lo][1]]
                    lo += 1
                if len(count) >= need:
                    spans.append((-len(count), lo, hi))
            # the fullest first; then all that touch none taken before
            taken: list[tuple[int, int]] = []
            for _, lo, hi in sorted(spans, key=lambda x: (x[0], x[2] - x[1], x[1])):
                at = bisect_left(taken, (lo, hi))
                if (at and taken[at - 1][1] >= lo) or (at < len(taken) and taken[at][0] <= hi):
                    continue
                taken.insert(at, (lo, hi))
                # a stray pair far from the others, without which they are enough, isn't part of it
                while hi - lo >= need and own[lo + 1][0] - own[lo][0] > self.plan.stray:
                    lo += 1
                while hi - lo >= need and own[hi][0] - own[hi - 1][0] > self.plan.stray:
                    hi -= 1
                inner = own[lo:hi + 1]
                yield own[lo][0], own[hi][0] + 2, family, len({pair for _, pair in inner}) / total, frozenset(i for i, _ in inner)

    def hits(self, tokens: list[str]) -> list[tuple[int, int, str, float]]:
        """Every licence of a paragraph: first word, end, family, probability; overlapping ones of a family are one.

        A template's place stands if its own words, or the window around them,
        give the template's family the least probability or more, unless most
        of its pairs there are those of another family that holds more of its own.
        """
        sure = []
        for start, end, family, share, places in sorted(self.held(tokens), key=lambda x: x[:4]):
            k, room = self.families.index(family), (self.plan.window - (end - start)) // 2
            p = max(float(self.judge(tokens[a:b])[k]) for a, b in ((start, end), (max(0, start - room), end + room)))
            if p >= self.least:
                sure.append((start, end, family, p, share, places))
        found: dict[str, list[list]] = {}
        for start, end, family, p, share, places in sure:
            # spans are no longer than a window, so those that overlap this one start within a window of it
            low, high = bisect_left(sure, start - self.plan.window, key=lambda x: x[0]), bisect_left(sure, end, key=lambda x: x[0])
            if any(x[2] != family and 2 * len(places & x[5]) > len(places) and (x[4], len(x[5]), x[3]) > (share, len(places), p) for x in sure[low:high]):
                continue
            own = found.setdefault(family, [])
            if own and start < own[-1][1]:
                own[-1][1:] = [max(end, own[-1][1]), family, max(p, own[-1][3])]
            else:
                own.append([start, end, family, p])
        return sorted(tuple(x) for own in found.values() for x in own)

    def scan(self, text: str | None) -> tuple[int, int, list[tuple[int, int, str, float]]]:
        """How many paragraphs a whole text has, how many with a licence, and each licence: first and last line, family, probability."""
        n, licensed, found = 0, 0, []
        for tokens, lines in paragraphs(text or ""):
            n += 1
            own = self.hits(tokens)
            licensed += bool(own)
            found += [(lines[start], lines[end - 1], family, p) for start, end, family, p in own]
        return n, licensed, found


def paragraphs(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """The words of each run of lines that aren't blank, and the line of each word; a line of marks alone is blank."""
    tokens: list[str] = []
    lines: list[int] = []
    for i, line in enumerate(text.split("\n")):
        own = words(MARK.sub("", line))
        if own:
            tokens += own
            lines += [i] * len(own)
        elif tokens:
            yield tokens, lines
            tokens, lines = [], []
    if tokens:
        yield tokens, lines


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, plan: Plan = Plan(), *, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Train on the templates and a sample of the corpus; an empty corpus leaves the templates alone."""
    own = docs.filter(F.length(F.trim(text_col)) > 0).select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    share = min(1.0, plan.sample_docs / max(1, own.count()))
    lines = F.split("text", "\n")
    spread = F.array(*(F.substring(F.element_at(lines, F.floor(F.size(lines) * i / plan.per_doc).cast("int") + 1), 1, plan.sample_chars) for i in range(plan.per_doc)))
    rows = own.filter(F.pmod("h", F.lit(1_000_003)) < share * 1_000_003).limit(2 * plan.sample_docs).select("h", F.array_distinct(spread).alias("lines")).collect()
    return Classifier(plan).fit([x for r in sorted(rows, key=lambda r: r["h"]) for x in r["lines"]])


FOUND = "n_paragraphs long, n_licensed long, families string, spans string, best double"


def scan_licenses(docs: DataFrame, model: Classifier | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_paragraphs, n_licensed, families, spans, best)`` per row of ``docs``.

    ``families``: those found, in order, joined by commas; ``spans``:
    ``line:family`` of each licence, ``first-last:family`` where it goes over
    several lines; ``best``: the largest probability, 0 without any.
    Paragraphs end at blank lines, which are in none; null and empty
    texts have none; repeated rows get the same result; null ids stay; other
    columns are ignored; an empty table gives no rows.
    """
    model = model or fit(docs, id_col=id_col, text_col=text_col)

    @F.pandas_udf(FOUND)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                n, licensed, found = model.scan(t)
                spans = ",".join(f"{i}:{f}" if i == j else f"{i}-{j}:{f}" for i, j, f, _ in found)
                rows.append((n, licensed, ",".join(sorted({f for *_, f, _ in found})), spans, round(max((p for *_, p in found), default=0.0), 6)))
            yield pd.DataFrame(rows, columns=["n_paragraphs", "n_licensed", "families", "spans", "best"])

    return docs.select(F.col(id_col), scanned(F.col(text_col)).alias("s")).select(id_col, "s.*")
