"""Alignment of two tokenizers: groups of tokens between the byte offsets where both end one.

A byte range of a text gives a :class:`Fragment`: the tokens that end before
its first common cut (open prefix), the groups between cuts (closed), and the
tokens after its last cut (open suffix). Fragments of neighbouring ranges
compose, and composing is associative, so a very long document is cut into
ranges that are spread over tasks and meet in a tree, ``FAN`` at a time; a
shorter document is one range.

An id pair's count is the number of documents that link it. A batch of
documents sends each of its pairs once, with how many of its documents link
it, so a pair that all documents hold is one row a batch; the counts come
back by the same rows, and the batch's links, kept packed, are scored.
"""

from __future__ import annotations

import base64
import hashlib
import pickle
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, is_empty

FAN = 8
#: Bytes of a range; a shorter document is one range.
RANGE = 1 << 16
#: A batch of documents ends at so many links, a step within it at so many bytes.
BATCH_LINKS = 1 << 22
STEP_BYTES = 1 << 21
#: A group with more links is counted from its distinct ids.
GROUP_LINKS = 1 << 16
LONG_WORD = re.compile(r"\S{2000}|\s{2000}")
CUT = re.compile(rb"(?<=[\x21-\x7e\x80-\xbf]) (?=[\x21-\x7e\xc2-\xf4])")

NONE = np.zeros(0, np.int64)


@dataclass(frozen=True)
class Paths:
    """Files of the two tokenizers on the executors: A's tokenizer file and merge ranks, B's model."""

    a: str
    a_ranks: str
    b: str


class Tokens:
    """Both tokenizers, and each id's bytes."""

    def __init__(self, paths: Paths):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(paths.a_ranks, "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow_path, self.slow, self._load = paths.a, None, Tokenizer.from_file
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths.b)
        self.size_a = np.ones(max(ranks.values()) + 2, np.int64)
        for t, i in ranks.items():
            self.size_a[i] = len(t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plain = [not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)) for i in range(len(pieces))]
        self.bytes_b = [b"" if not ok else bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, (p, ok) in enumerate(zip(pieces, plain, strict=True))]
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # Neither may join over a space that follows something else, or texts can't be cut there.
        self.cuttable = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode_a(self, text: str) -> list[int]:
        if len(text) < 2000 or not LONG_WORD.search(text):
            return self.fast.encode_ordinary(text)
        if self.slow is None:  # very long words take the other library quadratic time
            self.slow = self._load(self.slow_path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def both(self, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of ``data``, which starts with a space; None if the tokens' bytes aren't ``data``."""
        text = data.decode()
        a, b = self.encode_a(text), self.b.encode(text[1:])
        if b"".join(map(self.bytes_b.__getitem__, b)) != data or self.fast.decode_bytes(a) != data:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


def unique_sums(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else NONE
    return keys[starts], np.add.reduceat(times, starts) if len(keys) else NONE


def group_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct id pairs of one group and how often each is linked."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    return (ua[:, None] << 32 | ub).ravel(), np.outer(ca, cb).ravel()


def group_text(a: np.ndarray, b: np.ndarray) -> str:
    return ",".join(map(str, a.tolist())) + "|" + ",".join(map(str, b.tolist()))


@dataclass
class Fragment:
    """What a byte range knows of its groups. ``closed`` tells that it has a cut; without one all tokens are prefix."""

    ok: bool = True
    closed: bool = False
    prefix: tuple = (NONE, NONE)
    suffix: tuple = (NONE, NONE)
    groups: list = field(default_factory=list)  # text of the closed groups, in order, each piece joined by ";"
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pairs: np.ndarray = field(default_factory=lambda: NONE)
    times: np.ndarray = field(default_factory=lambda: NONE)

    def with_group(self, a: np.ndarray, b: np.ndarray, front: bool) -> None:
        """Closes one group before or after the closed ones."""
        self.groups = [group_text(a, b), *self.groups] if front else [*self.groups, group_text(a, b)]
        p, t = group_pairs(a, b)
        self.pairs, self.times = unique_sums(np.r_[self.pairs, p], np.r_[self.times, t])
        self.n_groups += 1
        self.n_links += len(a) * len(b)


def packed(f: Fragment) -> bytes:
    return zlib.compress(pickle.dumps(vars(f)), 1)  # by its fields: the class itself travels with the task


def unpacked(data: bytes) -> Fragment:
    return Fragment(**pickle.loads(zlib.decompress(data)))


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, and ``Fragment()`` is neutral."""
    out = Fragment(left.ok and right.ok, left.closed or right.closed, n_a=left.n_a + right.n_a, n_b=left.n_b + right.n_b,
                   n_groups=left.n_groups + right.n_groups, n_links=left.n_links + right.n_links)
    if not out.ok:
        return Fragment(ok=False)
    join = lambda x, y: (np.r_[x[0], y[0]], np.r_[x[1], y[1]])
    if not left.closed:
        out.prefix, out.suffix = join(left.prefix, right.prefix), right.suffix
        out.groups, out.pairs, out.times = right.groups, right.pairs, right.times
    elif not right.closed:
        out.prefix, out.suffix = left.prefix, join(left.suffix, right.prefix)
        out.groups, out.pairs, out.times = left.groups, left.pairs, left.times
    else:
        out.prefix, out.suffix = left.prefix, right.suffix
        out.groups, out.pairs, out.times = left.groups, left.pairs, left.times
        middle = join(left.suffix, right.prefix)
        out.with_group(*middle, front=False)
        out.groups = out.groups + right.groups
        out.pairs, out.times = unique_sums(np.r_[out.pairs, right.pairs], np.r_[out.times, right.times])
    return out


def grouped(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which A tokens end at a common cut, and the group of each A and each B token."""
    at = np.searchsorted(ends_b, ends_a)
    cut_a = (at < len(ends_b)) & (ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a) if len(ends_b) else np.zeros(len(a), bool)
    cut_b = np.zeros(len(b), bool)
    cut_b[at[cut_a]] = True
    return cut_a, np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b


def range_fragment(tokens: Tokens, data: bytes, window: int, start: int, stop: int) -> Fragment:
    """The fragment of the bytes ``start`` to ``stop`` of a text, from a window of it that begins at byte ``window``."""
    ids = tokens.both(data)
    if ids is None:
        return Fragment(ok=False)
    a, b = ids
    ends_a, ends_b = window + np.cumsum(tokens.size_a[a]), window + np.cumsum(tokens.size_b[b])
    in_a, in_b = (ends_a > start) & (ends_a <= stop), (ends_b > start) & (ends_b <= stop)
    a, b, ends_a, ends_b = a[in_a], b[in_b], ends_a[in_a], ends_b[in_b]
    cut_a, ga, gb = grouped(a, b, ends_a, ends_b)
    out = Fragment(n_a=len(a), n_b=len(b))
    last = int(cut_a.sum())
    if not last:
        out.prefix = (a, b)
        return out
    out.closed, out.prefix, out.suffix = True, (a[ga == 0], b[gb == 0]), (a[ga == last], b[gb == last])
    inner_a, inner_b = (ga > 0) & (ga < last), (gb > 0) & (gb < last)
    a, b, ga, gb = a[inner_a], b[inner_b], ga[inner_a] - 1, gb[inner_b] - 1
    out.n_groups = last - 1
    if out.n_groups:
        na, nb = np.bincount(ga, minlength=last - 1), np.bincount(gb, minlength=last - 1)
        out.n_links = int((na * nb).sum())
        pairs, _, times = linked(a, b, ga, na, nb, np.zeros(last - 1, np.int64))
        out.pairs, out.times = unique_sums(pairs, times)
        out.groups = ["".join(Strings.get().pieces(a, b, ga, gb, na, nb, np.array([last - 2])))]
    return out


class Strings:
    """Ids as text with the mark that follows, to write groups without a step per group."""

    _one: Strings | None = None

    @classmethod
    def get(cls) -> Strings:
        cls._one = cls._one or cls()
        return cls._one

    def __init__(self):
        self.table: list[str] = []

    def pieces(self, a, b, ga, gb, na, nb, last_groups) -> list[str]:
        """Every token's text and mark in the order of the groups; ``last_groups`` end a text."""
        top = max(1 << 16, int(max(a.max(initial=0), b.max(initial=0))) + 1)
        if len(self.table) < 4 * top:
            self.table = [f"{i}{mark}" for i in range(top) for mark in (",", "|", ";", "")]
        ends_group = np.zeros(len(na), np.int64) + 2
        ends_group[last_groups] = 3
        last_a = np.r_[ga[1:] != ga[:-1], True]
        last_b = np.r_[gb[1:] != gb[:-1], True]
        out = np.empty(len(a) + len(b), np.int64)
        before_b, upto_a = np.cumsum(nb) - nb, np.cumsum(na)
        out[np.arange(len(a)) + before_b[ga]] = 4 * a + last_a
        out[np.arange(len(b)) + upto_a[gb]] = 4 * b + np.where(last_b, ends_group[gb], 0)
        return list(map(self.table.__getitem__, out.tolist()))


def linked(a, b, ga, na, nb, owner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, owner, times)`` of all links: one each, or one a distinct pair of a group with very many."""
    before_b, before_a = np.cumsum(nb) - nb, np.cumsum(na) - na
    large = np.flatnonzero(na * nb > GROUP_LINKS)
    each = nb[ga].copy()
    each[np.isin(ga, large)] = 0
    total = int(each.sum())
    right = np.repeat(before_b[ga] - (np.cumsum(each) - each), each) + np.arange(total)
    pairs, owners, times = [np.repeat(a, each) << 32 | b[right]], [np.repeat(owner[ga], each)], [np.ones(total, np.int64)]
    for g in large:
        p, t = group_pairs(a[before_a[g]:before_a[g] + na[g]], b[before_b[g]:before_b[g] + nb[g]])
        pairs.append(p)
        owners.append(np.full(len(p), owner[g]))
        times.append(t)
    return np.concatenate(pairs), np.concatenate(owners), np.concatenate(times)


class Batch:
    """Documents whose links are sent together."""

    def __init__(self):
        self.docs: list[tuple] = []  # (doc_id, n_a, n_b, n_groups, n_links, groups_sha256)
        self.steps: list[tuple] = []  # (pair, document, times), by document and pair
        self.links = 0

    def add(self, pairs: np.ndarray, docs: np.ndarray, times: np.ndarray) -> None:
        known, at = np.unique(pairs, return_inverse=True)
        keys, times = unique_sums(docs * len(known) + at, times)
        self.steps.append((known[keys % max(len(known), 1)], keys // max(len(known), 1), times))
        self.links += len(keys)

    def sent(self, number: int) -> Iterator[pa.RecordBatch]:
        """The packed batch, and its pairs with their documents."""
        pairs, docs, times = (np.concatenate([s[i] for s in self.steps] or [NONE]) for i in range(3))
        known, at = np.unique(pairs, return_inverse=True)
        blob = zlib.compress(pickle.dumps((self.docs, np.bincount(docs, minlength=len(self.docs)).astype(np.uint32),
                                           at.astype(np.uint32), times.astype(np.uint32 if times.max(initial=0) < 2**32 else np.int64))), 1)
        yield rows(number, blob=blob)
        counts = np.bincount(at, minlength=len(known))
        for i in range(0, len(known), 1 << 16):
            yield rows(number, pairs=known[i:i + (1 << 16)], docs=counts[i:i + (1 << 16)])


ROWS = "batch long, packed binary, pair long, docs long"


def rows(number: int, blob: bytes | None = None, pairs: np.ndarray = NONE, docs: np.ndarray = NONE) -> pa.RecordBatch:
    n = 1 if blob is not None else len(pairs)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, number, np.int64)), pa.array([blob] if blob is not None else [None] * n, pa.binary()),
        pa.nulls(1, pa.int64()) if blob is not None else pa.array(pairs, pa.int64()),
        pa.nulls(1, pa.int64()) if blob is not None else pa.array(docs.astype(np.int64))], names=["batch", "packed", "pair", "docs"])


def add_texts(batch: Batch, tokens: Tokens, ids: list, texts: list) -> None:
    """Digests whole documents, each one range, together."""
    got, owners = [], []
    first = len(batch.docs)
    for doc, text in zip(ids, texts, strict=True):
        both = tokens.both(b" " + text.encode()) if text else None
        if both is None:
            batch.docs.append((doc, 0, 0, 0, 0, ""))
        else:
            owners.append(len(batch.docs))
            got.append(both)
            batch.docs.append((doc, len(both[0]), len(both[1])))
    if not got:
        return
    a, b = np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])
    cut_a, ga, gb = grouped(a, b, np.cumsum(tokens.size_a[a]), np.cumsum(tokens.size_b[b]))
    count = int(cut_a.sum())
    na, nb = np.bincount(ga, minlength=count), np.bincount(gb, minlength=count)
    size_a, size_b = (np.array([len(x[i]) for x in got]) for i in range(2))
    last = ga[np.cumsum(size_a) - 1]  # a document's end is a cut
    n_groups = np.diff(last, prepend=-1)
    owner = np.repeat(np.array(owners), n_groups)
    links = np.add.reduceat(na * nb, np.r_[0, last[:-1] + 1])
    pieces = Strings.get().pieces(a, b, ga, gb, na, nb, last)
    stops = np.cumsum(size_a + size_b)
    for o, start, stop, g, n in zip(owners, np.r_[0, stops[:-1]], stops, n_groups, links, strict=True):
        digest = hashlib.sha256("".join(pieces[start:stop]).encode()).hexdigest()
        batch.docs[o] = (*batch.docs[o], int(g), int(n), digest)
    assert first + len(ids) == len(batch.docs)
    batch.add(*linked(a, b, ga, na, nb, owner))


def add_fragment(batch: Batch, doc, f: Fragment) -> None:
    """A whole document's fragment: its prefix is the first group, and nothing is open after it."""
    if not f.ok or not f.closed or len(f.suffix[0]) or len(f.suffix[1]):
        batch.docs.append((doc, 0, 0, 0, 0, ""))
        return
    whole = Fragment(True, True, groups=f.groups, n_groups=f.n_groups, n_links=f.n_links, pairs=f.pairs, times=f.times)
    whole.with_group(*f.prefix, front=True)
    sha = hashlib.sha256()
    for i, g in enumerate(whole.groups):
        sha.update((";" if i else "").encode() + g.encode())
    batch.docs.append((doc, f.n_a, f.n_b, whole.n_groups, whole.n_links, sha.hexdigest()))
    batch.add(whole.pairs, np.full(len(whole.pairs), len(batch.docs) - 1), whole.times)


def ranges_of(data: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """``(start, stop, window start, window stop)`` of the ranges of ``data``.

    Ranges end at multiples of ``size`` that have a place where the text can
    be cut (a single space between other characters) at most ``size`` bytes
    before and after; a window reaches from such a place to another.
    """

    def cut_after(at: int) -> int | None:
        for m in CUT.finditer(data, at, min(len(data), at + size)):
            left = data[max(0, m.start() - 4):m.start()].decode(errors="ignore")[-1:]
            right = data[m.end():m.end() + 4].decode(errors="ignore")[:1]
            if left.strip() and right.strip():
                return m.start()
        return None

    marks = [(0, 0, 0)]  # the boundary, a cut at or before it, a cut at or after it
    for at in range(size, len(data), size):
        after, before = cut_after(at), None
        for back in (256, size):  # cuts are frequent, so a few bytes do
            low, found = max(marks[-1][2], at - back, 1), None
            while low < at and (c := cut_after(low)) is not None and c <= at:
                found, low = c, c + 1
            before = found if found is not None else before
            if before is not None:
                break
        if after is not None and before is not None:
            marks.append((at, before, after))
    marks.append((len(data),) * 3)
    for (start, before, _), (stop, _, after) in zip(marks, marks[1:], strict=False):
        yield start, stop, before, after


def align(docs: DataFrame, paths: Callable[[], Paths], *, range_bytes: int = RANGE, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents with their alignment, and the pair table.

    Documents: ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256)``, one row per row of ``docs``. Null ids and repeated rows
    are documents of their own; null and empty texts, and those whose tokens'
    bytes aren't the text, have zeros and an empty digest; other columns are
    ignored; empty tables give empty tables. Pairs: ``(a, b, n, best)``: the
    documents that link the pair, and whether no pair of ``a`` has more.

    A batch's documents and its distinct pairs are what one task holds; a
    document's group text (as long as its text, about) is composed in full,
    as its digest is that of one string. A group of very many tokens counts
    from its distinct ids. Texts without a place to cut aren't cut.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    length = F.coalesce(F.octet_length("text"), F.lit(0))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, key = Tokens(paths()), TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = b" " + text.encode()
                key += 1
                all_ranges = list(ranges_of(data, range_bytes)) if tokens.cuttable else [(0, len(data), 0, len(data))]
                for at, (start, stop, low, high) in enumerate(all_ranges):
                    yield pa.RecordBatch.from_pydict({
                        "key": [key], "at": [at], "doc_id": pa.array([doc], pa.int64()), "start": [start], "stop": [stop], "window": [low],
                        "data": pa.array([data[low:high]], pa.binary())})

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(paths())
        for batch in batches:
            for r in batch.to_pylist():
                f = range_fragment(tokens, r["data"], r["window"], r["start"], r["stop"])
                yield pa.RecordBatch.from_pydict({"key": [r["key"]], "at": [r["at"]], "doc_id": pa.array([r["doc_id"]], pa.int64()),
                                                  "fragment": pa.array([packed(f)], pa.binary())})

    def meet(group: pa.Table) -> pa.Table:
        got = group.sort_by("at")
        f = Fragment()
        for x in got["fragment"]:
            f = compose(f, unpacked(x.as_py()))
        return pa.table({"key": got["key"][:1], "at": pa.array([got["at"][0].as_py() // FAN]), "doc_id": got["doc_id"][:1],
                         "fragment": pa.array([packed(f)], pa.binary())})

    def digest(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(paths()) if whole else None
        number, batch = (TaskContext.get().partitionId() << 32) + (not whole) * (1 << 62), Batch()
        for got in batches:
            ids, values = got.column(0).to_pylist(), got.column(1).to_pylist()
            low = 0
            while low < len(ids):
                high, size = low, 0
                while high < len(ids) and size < STEP_BYTES:
                    size += len(values[high] or "")
                    high += 1
                if whole:
                    add_texts(batch, tokens, ids[low:high], values[low:high])
                else:
                    for doc, f in zip(ids[low:high], values[low:high], strict=True):
                        add_fragment(batch, doc, unpacked(f))
                low = high
                if batch.links >= BATCH_LINKS:
                    yield from batch.sent(number)
                    number, batch = number + 1, Batch()
        if batch.docs:
            yield from batch.sent(number)

    parts = [texts.where(length < range_bytes).mapInArrow(lambda it: digest(it, True), ROWS)]
    cuts = scratch.put(texts.where(length >= range_bytes).mapInArrow(
        cut, "key long, at long, doc_id long, start long, stop long, window long, data binary"), "ranges")
    if not is_empty(cuts):
        kind = "key long, at long, doc_id long, fragment binary"
        tree = scratch.put(cuts.repartition("key", "at").mapInArrow(fragments, kind), "fragments0")
        most, level = cuts.agg(F.max("at")).first()[0], 0
        while most > 0:
            most, level = most // FAN, level + 1
            tree = scratch.put(tree.groupBy("key", F.floor(F.col("at") / FAN)).applyInArrow(meet, kind), f"fragments{level}")
        parts.append(tree.select("doc_id", "fragment").mapInArrow(lambda it: digest(it, False), ROWS))
    sent = scratch.put(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), "batches")

    of_batch = sent.where("pair is not null").select("batch", "pair", "docs")
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(0xFFFFFFFF)
    counts = of_batch.groupBy("pair").agg(F.sum("docs").alias("n"))
    pairs = scratch.put(counts.select("pair", a.alias("a"), b.alias("b"), "n").withColumn(
        "best", F.col("n") == F.max("n").over(Window.partitionBy("a"))), "pairs")
    looked = of_batch.select(F.col("batch").alias("of"), "pair").join(pairs.select("pair", "n", "best"), "pair")

    def score(batch: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        order = np.argsort(found["pair"].to_numpy())
        n, best = found["n"].to_numpy()[order], found["best"].to_numpy()[order].astype(np.int64)
        for blob in batch["packed"]:
            docs, links, at, times = pickle.loads(zlib.decompress(blob.as_py()))
            times, doc = times.astype(np.int64), np.repeat(np.arange(len(docs)), links)
            sums, tops = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            np.add.at(sums, doc, times * n[at])
            np.add.at(tops, doc, times * best[at])
            out += [(*d[:5], int(t), int(s), d[5]) for d, t, s in zip(docs, tops, sums, strict=True)]
        columns = list(zip(*out, strict=True)) or [()] * 8
        return pa.table({f: pa.array(c, pa.string() if f == "groups_sha256" else pa.int64()) for f, c in zip(
            ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), columns, strict=True)})

    result = sent.where("packed is not null").select("batch", "packed").groupBy("batch").cogroup(looked.groupBy("of")).applyInArrow(
        score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return result, pairs.select("a", "b", "n", "best")
