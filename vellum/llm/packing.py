"""Packing token sequences by the sum-of-squares rule.

Each task packs the documents it reads, in order, as they come. A level array
holds how many open windows are filled to each level; a document's part goes
into the level that makes the sum of the squared counts smallest, which keeps
levels evenly used and so leaves room of every size. Documents longer than a
window give full windows and one rest. When a task's input ends, its open
windows are filled up from the emptiest of them by cutting; one window at most
is left partly filled, and is cut into powers of two, which aren't padded.
No shuffle: memory is the level array and the open windows' pieces.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SPECIAL = "<|endoftext|>"
LONG = 2000
LONG_WORD = re.compile(r"\S{%d}|\s{%d}" % (LONG, LONG))


def encoder(path: str, ranks_path: str | None = None) -> Callable[[str], np.ndarray]:
    """Text to ids of the tokenizer file at ``path``, without special tokens added.

    ``ranks_path`` names the same vocabulary as merge ranks, for the faster
    library; texts with the special token or with very long words, on which
    the two may differ in result or in time, always go to the tokenizer file.
    """
    from tokenizers import Tokenizer

    tokenizer = functools.cache(lambda: Tokenizer.from_file(path))
    if ranks_path:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if ranks_path and SPECIAL not in text and (len(text) < LONG or not LONG_WORD.search(text)):
            return np.array(fast.encode_ordinary(text), np.uint32)
        return np.array(tokenizer().encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


class Packer:
    """One task's windows. ``add`` and ``close`` yield ``(sequence, pieces)`` of finished windows."""

    def __init__(self, size: int):
        self.size, self.count = size, np.zeros(size + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]  # by level: the windows, each a list of pieces

    def level_for(self, n: int) -> int:
        """The fill level, 0 for a new window, that a piece of ``n`` ids makes the squares smallest."""
        size, c = self.size, self.count
        top = size - n  # the highest level with room
        change = 2 * c[n:size + 1] + 1  # a window more at level h + n ...
        change[top] = 0  # ... unless that is full
        change[1:] -= 2 * c[1:top + 1] - 1  # and one less at h
        change[1:][c[1:top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))  # ties: the fullest

    def add(self, piece: tuple) -> list | None:
        n = piece[2]
        if n == self.size:
            return [piece]
        h = self.level_for(n)
        window = self.open[h].pop() if h else []
        self.count[h] -= h > 0
        window.append(piece)
        if h + n == self.size:
            return window
        self.open[h + n].append(window)
        self.count[h + n] += 1
        return None

    def close(self) -> Iterator[list]:
        """The open windows, filled up from the emptiest; what stays is cut into powers of two."""
        left = [(h, w) for h in range(1, self.size) for w in self.open[h]]  # emptiest first
        loose: list[tuple] = []
        have = 0
        lo, hi = 0, len(left) - 1
        while lo <= hi:
            level, window = left[hi]
            hi -= 1
            while level + have < self.size and lo <= hi:
                loose += left[lo][1]
                have += left[lo][0]
                lo += 1
            if level + have < self.size:
                loose += window
                have += level
                break
            taken, loose = take(loose, self.size - level)
            have -= self.size - level
            yield window + taken
        while have:
            n = min(self.size, 1 << (have.bit_length() - 1))
            taken, loose = take(loose, n)
            have -= n
            yield taken


def take(pieces: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
    """The last ``n`` ids of ``pieces`` and the rest; a piece may be cut. A piece: (doc_id, start, length, ids, doc_tokens)."""
    out, rest = [], list(pieces)
    while n:
        doc, start, length, ids, total = rest.pop()
        if length > n:
            rest.append((doc, start, length - n, ids[: length - n], total))
            doc, start, length, ids, total = doc, start + length - n, n, ids[length - n:], total
        out.append((doc, start, length, ids, total))
        n -= length
    return out, rest


def pack(docs: DataFrame, tokenizer_paths: Callable[[], tuple[str, str | None]], *, size: int = 1024, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids, ``end_id`` after them, as pieces in windows of at most ``size`` ids.

    One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)``. Null and empty texts are the end id alone; null
    ids and repeated rows are packed like others, each row on its own; other
    columns are ignored; an empty table gives no rows. ``tokenizer_paths``
    is called in the task, since the files are the executor's: the tokenizer
    file and, or None, the same vocabulary as merge ranks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(*tokenizer_paths())
        packer, base, used = Packer(size), TaskContext.get().partitionId() << 40, 0
        rows: list[tuple] = []

        def done(window: list[tuple] | None) -> None:
            nonlocal used
            at = 0
            for doc, start, length, ids, total in window or []:
                rows.append((doc, start, length, zlib.crc32(ids.astype("<u4").tobytes()), total, base + used, at))
                at += length
            used += window is not None

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            rows.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype(np.uint32)
                doc = None if doc is pd.NA else int(doc)
                for at in range(0, len(ids), size):
                    part = ids[at:at + size].copy()
                    done(packer.add((doc, at, len(part), part, len(ids))))
            yield frame()
        for window in packer.close():
            done(window)
        yield frame()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, SCHEMA)
