"""Line dedup within an edit bound, by a deletion-neighbourhood join.

Lines are compared in normal form (runs of blanks as one space, trimmed, lower
case). Two lines are near if at most ``edits`` insertions, deletions and
substitutions of a character turn one into the other; lines under
``min_chars`` characters must be equal. A line goes if an earlier line, by document id and place, is equal
or near; lines are judged on the input, not on what is left.

Equal lines are one node, kept as two hashes.

One edit: two near lines agree in the first or the last half of the shorter one, so lines that share no half with
another line drop out before any variant is made. The others emit all variants
with one character deleted as hashed keys. Lines with equal variants after
deletions at one place differ by one substitution; a line equal to another's
variant differs by one insertion: so the earliest line of each key decides,
and is verified by edit distance, without pairs within a key.

More edits: of ``edits + 1`` parts of the shorter line one is in the longer,
moved by few places. Lines that share a part with few others are compared one
by one. Where many share a part, they emit all variants with up to ``edits``
characters outside of it deleted, with the gaps. Lines of equal variants are
as far apart as their gaps say, so the earliest line of each set of gaps
decides for all sets near enough, and no pairs are formed there either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch, fresh, id_key

BLANKS = re.compile(r"[ \t\r\f\v]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(line: str) -> str:
    return BLANKS.sub(" ", line).strip(" ").lower()


def near(a: str, b: str) -> bool:
    """Edit distance <= 1."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def half_keys(line: str) -> tuple[int, ...]:
    """Hashes of the halves that this line shares with every near line at one end or the other: first and last, twice.

    Of two near lines the shorter has n characters and both agree in the first
    or the last n // 2; a line is the shorter one, or is one longer than it.
    Where the two lengths are one, the second pair is (0, 0), which is no key.
    """
    n, digest = len(line), xxhash.xxh64_intdigest
    h, g = n // 2, (n - 1) // 2
    out = (digest(line[:h], 2 * h), digest(line[n - h:], 2 * h + 1))
    return out + ((0, 0) if g == h else (digest(line[:g], 2 * g), digest(line[n - g:], 2 * g + 1)))


def variant_hashes(line: str) -> np.ndarray:
    """Hash of the line without its character i, for each i, in one pass over the line."""
    x = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    x = (x + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    n = len(x)
    power = np.ones(n + 1, np.uint64)
    np.cumprod(np.full(n, BASE), out=power[1:])
    # the sum of x[j] * BASE^j; what follows the deleted place moves down by one
    before = np.concatenate(([np.uint64(0)], np.cumsum(x * power[:n], dtype=np.uint64)))
    shifted = np.concatenate(([np.uint64(0)], np.cumsum(x[1:] * power[: n - 1], dtype=np.uint64)))
    return _mix(before[:n] + (shifted[-1] - shifted), n - 1)


def whole_hash(line: str) -> int:
    """What ``variant_hashes`` of a longer line gives where only this line is left."""
    return int(variant_hashes("\0" + line)[0])


def _mix(h: np.ndarray, n: int) -> np.ndarray:
    h = h ^ np.uint64(n * 0x9FB21C651E98DF25 % 2**64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


NO_KEYS = (0, 0, 0, 0)
KEYS = [f"k{i}" for i in range(4)]


def line_rows(min_chars: int):
    """Per line that isn't blank: its document, place, two hashes, and half keys (0: none) if it can be near another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, place, digests, keys = [], [], [], []
            for text in batch["text"]:
                had = len(place)
                for i, line in enumerate((text or "").split("\n")):
                    line = normal(line)
                    if line:
                        place.append(i)
                        digests.append(xxhash.xxh3_128_digest(line))
                        keys.append(half_keys(line) if len(line) >= min_chars else NO_KEYS)
                counts.append(len(place) - had)
            two = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            four = np.array(keys, np.uint64).reshape(-1, 4).view(np.int64)
            yield pd.DataFrame({"did": np.repeat(batch["did"].to_numpy(), counts), "th": np.repeat(batch["th"].to_numpy(), counts), "place": np.array(place, np.int32),
                                "h1": two[:, 0], "h2": two[:, 1]} | {k: four[:, i] for i, k in enumerate(KEYS)})
    return run


LINE = "did long, th long, place int, h1 long, h2 long, k0 long, k1 long, k2 long, k3 long"
VARIANT = "nid long, at int, variant long, did long, th long, place int, line string"


def variant_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The variants of the lines that ``sides`` names, by the deleted place ``at``; with -1, the line itself and where it is.

    A line that shares its first (last) half is only changed after (before) it.
    """
    for batch in batches:
        rows, at, variant = [], [], []
        for text, did, th, sides in zip(batch["text"], batch["did"], batch["th"], batch["sides"], strict=True):
            lines = text.split("\n")
            first, last = ({s["place"] for s in sides if s["side"] == k} for k in (0, 1))
            for p in first | last:
                line = normal(lines[p])
                n, h = len(line), (len(line) - 1) // 2
                low, high = (0 if p in last else h), (n if p in first else n - h)
                rows.append((node_id(line), did, th, p, line, high - low + 1))
                at.append(np.concatenate(([-1], np.arange(low, high))))
                variant.append(np.concatenate(([np.uint64(whole_hash(line))], variant_hashes(line)[low:high])))
            if sum(len(x) for x in at[-64:]) > 1 << 16 or len(rows) > 2000:
                yield _variants(rows, at, variant)
                rows, at, variant = [], [], []
        if rows:
            yield _variants(rows, at, variant)


def _variants(rows: list[tuple], at: list[np.ndarray], variant: list[np.ndarray]) -> pd.DataFrame:
    nid, did, th, place, line, size = zip(*rows, strict=True)
    out = pd.DataFrame({"nid": np.repeat(np.array(nid, np.int64), size), "at": np.concatenate(at).astype(np.int32), "variant": np.concatenate(variant).view(np.int64)})
    own = np.concatenate(([0], np.cumsum(size)[:-1]))  # what is said once, with the line itself
    for c, v, kind in (("did", did, "Int64"), ("th", th, "Int64"), ("place", place, "Int32"), ("line", line, "object")):
        out[c] = pd.Series(pd.array(v, kind) if kind != "object" else list(v), index=own, dtype=kind).reindex(out.index)
    out["line"] = out["line"].where(out["line"].notna(), None)
    return out


def node_id(line: str) -> int:
    return int(np.frombuffer(xxhash.xxh3_128_digest(line), np.int64)[0])


PART = "key long, nid long, short boolean, at int, size int, did long, th long, place int"
#: Up to so many rows of a key are compared one by one: first by letters and length, then by edit distance.
FEW = 256


@lru_cache(4096)
def part_places(m: int, edits: int, min_chars: int) -> list[tuple[int, int, int, bool]]:
    """Start, end, seed, and whether as the shorter line, of each part of a line of m characters that a near line may share.

    A shorter line has n characters and a part at ``low``; here that part is
    moved by what the edits before it add, and those after it make up the rest.
    """
    out = []
    for n in range(max(m - edits, min_chars), m + 1):
        for j in range(edits + 1):
            low, high = j * n // (edits + 1), (j + 1) * n // (edits + 1)
            out += [(low + s, high + s, n * (edits + 1) + j, n == m and s == 0) for s in range(-edits, edits + 1)
                    if abs(s) + abs(m - n - s) <= edits and low + s >= 0 and high + s <= m]
    return out


def part_rows(edits: int, min_chars: int):
    """The keys of the parts of each line of ``min_chars`` characters, and where a batch has it first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            seen: dict[str, tuple] = {}
            for text, did, th in zip(batch["text"], batch["did"], batch["th"], strict=True):
                for place, line in enumerate((text or "").split("\n")):
                    line = normal(line)
                    if len(line) >= max(min_chars, 1):
                        own = (did, th, place)
                        if line not in seen or own < seen[line]:
                            seen[line] = own
            todo = iter(seen.items())
            while some := list(islice(todo, 4096)):
                keys, parts, counts = [], [], []
                for line, _ in some:
                    own = part_places(len(line), edits, min_chars)
                    keys += [digest(line[low:high], seed) for low, high, seed, _ in own]
                    parts += own
                    counts.append(len(own))
                low, high, _, short = zip(*parts, strict=True)
                out = pd.DataFrame({"key": np.array(keys, np.uint64).view(np.int64), "nid": np.repeat(np.array([node_id(x) for x, _ in some]), counts),
                                    "short": np.array(short), "at": np.array(low, np.int32), "size": np.subtract(high, low, dtype=np.int32)})
                for i, c in enumerate(("did", "th", "place")):
                    out[c] = np.repeat(np.array([x[i] for _, x in some]), counts)
                yield out
    return run


def letters(line: str) -> int:
    """Of 64 classes of characters, those that the line has an odd number of: an edit changes two bits at most."""
    out = 0
    for c in line:
        out ^= 1 << (ord(c) * 0x9E3779B1 >> 8 & 63)
    return out - (1 << 64 if out >> 63 else 0)


def named_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines at ``places``, their letters and length."""
    for batch in batches:
        out = []
        for text, did, th, places in zip(batch["text"], batch["did"], batch["th"], batch["places"], strict=True):
            lines = text.split("\n")
            out += [(node_id(line), did, th, p, letters(line), len(line), line) for p in places for line in [normal(lines[p])]]
        yield pd.DataFrame(out, columns=["nid", "did", "th", "place", "letters", "chars", "line"])


def deletions(line: str, places: list[int], edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the line without each set of at most ``edits`` of ``places``, and the gaps: where in what is left, -1 for none."""
    x = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    x = (x + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    n, back = len(x), pow(int(BASE), -1, 2**64)
    power = np.ones(n, np.uint64)
    np.cumprod(np.full(n - 1, BASE), out=power[1:])
    before = np.concatenate(([np.uint64(0)], np.cumsum(x * power, dtype=np.uint64)))
    for d in range(edits + 1):
        sets = combinations(places, d)
        while block := list(islice(sets, 1 << 14)):
            gone = np.array(block, np.int64).reshape(len(block), d)
            edge = np.concatenate((gone, np.full((len(block), 1), n)), axis=1)
            h = before[edge[:, 0]]
            for t in range(1, d + 1):
                h = h + np.uint64(pow(back, t, 2**64)) * (before[edge[:, t]] - before[edge[:, t - 1] + 1])
            gaps = np.full((len(block), edits), -1, np.int32)
            gaps[:, :d] = gone - np.arange(d)
            yield _mix(h, n - d), gaps


def gap_rows(edits: int):
    """The variants of a line whose deleted characters are outside the shared part; ``key`` keeps groups apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for nid, key, line, low, size in zip(batch["nid"], batch["key"], batch["line"], batch["at"], batch["size"], strict=True):
                outside = [*range(low), *range(low + size, len(line))]
                for h, gaps in deletions(line, outside, edits):
                    h = _mix(h ^ np.int64(key).view(np.uint64), 1)
                    yield pd.DataFrame({"variant": h.view(np.int64), "nid": np.full(len(h), nid, np.int64)} | {f"g{i}": gaps[:, i] for i in range(edits)})
    return run


def near_within(texts: DataFrame, scratch: Scratch, edits: int, min_chars: int) -> DataFrame:
    """``first`` of the lines that are at most ``edits`` edits from an earlier one, for any bound."""
    order = F.struct("did", "th", "place")
    parts = texts.mapInPandas(part_rows(edits, min_chars), PART)
    shared = parts.groupBy("key").agg(F.min("nid").alias("low"), F.max("nid").alias("high"), F.max("short").alias("any")).filter("low <> high AND any").select("key")
    member = parts.join(scratch.put(shared, "keys"), "key", "left_semi").groupBy("key", "nid", "short", "at", "size").agg(F.min(order).alias("own"))
    member = scratch.put(member, "members")
    many = scratch.put(member.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > FEW).select("key"), "many")
    chosen = member.groupBy("nid").agg(F.min("own").alias("own")).select("own.*").groupBy("did", "th").agg(F.collect_set("place").alias("places"))
    once = texts.join(chosen, ["did", "th"]).dropDuplicates(["did", "th"])
    lines = scratch.put(once.mapInPandas(named_lines, "nid long, did long, th long, place int, letters long, chars int, line string").select("nid", order.alias("own"), "letters", "chars", "line"), "lines")
    own = lines.select("nid", "own")
    few = member.join(many, "key", "left_anti").select("key", "nid", "short").distinct().join(lines.drop("line"), "nid")
    a, b = (few.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("nid", "own", "short", "letters", "chars"))) for x in "ab")
    pairs = a.join(b, "key").filter("own_a > own_b AND (short_a OR short_b)").filter(
        (F.abs(F.col("chars_a") - F.col("chars_b")) <= edits) & (F.bit_count(F.col("letters_a").bitwiseXOR(F.col("letters_b"))) <= 2 * edits)).select(F.col("own_a").alias("own"), F.col("nid_a").alias("nid"), F.col("nid_b").alias("to"))
    # where many share a part: sets of gaps in one variant
    hot = member.join(many, "key", "left_semi").select("key", "nid", "at", "size").distinct().join(lines.select("nid", "line"), "nid")
    gaps = [f"g{i}" for i in range(edits)]
    variants = scratch.put(hot.mapInPandas(gap_rows(edits), ", ".join(["variant long", "nid long", *(f"{g} int" for g in gaps)])), "variants")
    several = variants.groupBy("variant").agg(F.min("nid").alias("low"), F.max("nid").alias("high")).filter("low <> high").select("variant")
    variants = scratch.put(variants.join(several, "variant", "left_semi").distinct().join(own, "nid"), "shared")
    heads = variants.groupBy("variant", *gaps).agg(F.min(F.struct("own", "nid")).alias("head"))
    mine, other = heads.select("variant", *gaps), heads.select("variant", F.filter(F.array(*gaps), lambda g: g >= 0).alias("there"), "head")
    here = F.filter(F.array(*gaps), lambda g: g >= 0)
    count = lambda xs, g: F.size(F.filter(xs, lambda x: x == g))
    both = F.aggregate(F.array_distinct(here), F.lit(0), lambda n, g: n + F.least(count(here, g), count(F.col("there"), g)))
    best = mine.join(other, "variant").filter(F.size(here) + F.size("there") - both <= edits).groupBy("variant", *gaps).agg(F.min("head").alias("head"))
    reached = variants.join(best, ["variant", *gaps]).filter(F.col("head.own") < F.col("own")).select("own", "nid", F.col("head.nid").alias("to"))
    pairs = pairs.unionByName(reached).distinct()
    verified = pairs.join(lines.select("nid", "line"), "nid").join(lines.select(F.col("nid").alias("to"), F.col("line").alias("earlier")), "to")
    return verified.filter(F.levenshtein("line", "earlier", edits).between(0, edits)).select(F.col("own").alias("first")).distinct()


def near_by_one(texts: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``first`` of the lines that are one edit from an earlier one."""
    order = F.struct("did", "th", "place")
    half = nodes.select("first", F.posexplode(F.array(*KEYS)).alias("i", "half")).filter("half <> 0")
    shared = half.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    chosen = half.join(shared, "half", "left_semi").select("first.*", (F.col("i") % 2).alias("side")).distinct()
    chosen = chosen.groupBy("did", "th").agg(F.collect_set(F.struct("place", "side")).alias("sides"))
    once = texts.join(chosen, ["did", "th"]).dropDuplicates(["did", "th"])  # a repeated document has its lines once
    keyed = scratch.put(once.mapInPandas(variant_rows, VARIANT), "variants")
    lines = keyed.filter("at < 0").select("nid", order.alias("own"), "line")
    several = keyed.groupBy("variant").agg(F.count("*").alias("c")).filter("c > 1").select("variant")
    keyed = keyed.select("nid", "at", "variant").join(several, "variant", "left_semi").join(lines.select("nid", "own"), "nid")
    keyed = scratch.put(keyed, "shared")
    node = F.struct("own", "nid")
    # one substitution: equal variants, deleted at one place; the earliest line there is a partner of all others
    swap = keyed.filter("at >= 0").groupBy("variant", "at").agg(F.min(node).alias("head"))
    swap = keyed.join(swap, ["variant", "at"]).select("own", "nid", "head")
    # one insertion: a line that equals a longer line's variant; each is judged by the earliest on the other side
    ends = keyed.groupBy("variant").agg(F.min(F.when(F.col("at") < 0, node)).alias("short"), F.min(F.when(F.col("at") >= 0, node)).alias("long"))
    grow = keyed.join(ends, "variant").select("own", "nid", F.when(F.col("at") < 0, F.col("long")).otherwise(F.col("short")).alias("head"))
    pairs = swap.unionByName(grow).filter(F.col("head.own") < F.col("own")).select("own", "nid", F.col("head.nid").alias("to")).distinct()
    verified = pairs.join(lines.select("nid", "line"), "nid").join(lines.select(F.col("nid").alias("to"), F.col("line").alias("earlier")), "to")
    return verified.filter(F.levenshtein("line", "earlier", 1).between(0, 1)).select(F.col("own").alias("first")).distinct()


def dropped_lines(docs: DataFrame, *, id_col: str, text_col: str, min_chars: int, edits: int = 1) -> DataFrame:
    """``(did, th, place, near)`` of the lines that go; ``near`` is false where an earlier line is equal."""
    if edits < 0:
        raise ValueError(f"edits is {edits}")
    scratch = Scratch(docs.sparkSession, "lines")
    texts = docs.select(id_key(F.col(id_col)).alias("did"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    rows = scratch.put(texts.mapInPandas(line_rows(min_chars), LINE), "rows")
    order = F.struct("did", "th", "place")
    nodes = rows.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.count("*").alias("n"), *(F.first(k).alias(k) for k in KEYS))
    nodes = scratch.put(nodes, "nodes")
    if edits == 0:
        verified = nodes.select("first").limit(0)
    else:
        verified = near_by_one(texts, nodes, scratch) if edits == 1 else near_within(texts, scratch, edits, min_chars)
    fate = nodes.join(verified.withColumn("near", F.lit(True)), "first", "left").filter("n > 1 or near").select(
        "h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = rows.select("did", "th", "place", "h1", "h2").join(fate, ["h1", "h2"])
    return gone.filter((order > F.col("first")) | F.col("near")).select("did", "th", "place", (order == F.col("first")).alias("near")).distinct()


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 16, edits: int = 1) -> DataFrame:
    """Each row of ``docs``, whole, with its dropped lines out of the text, and ``n_lines, n_equal, n_near``.

    Blank lines are never compared and stay. A null text stays null, with no
    lines; an empty text has one blank line; a document all of whose lines go
    has an empty text. A null id comes after all ids; rows of equal id and text
    are one document and keep the same lines; columns that ``docs`` has under
    the names of the counts are replaced by them; an empty table gives no rows.
    """
    gone = dropped_lines(docs, id_col=id_col, text_col=text_col, min_chars=min_chars, edits=edits).groupBy("did", "th").agg(
        F.collect_set("place").alias("places"), F.count_if("near").alias("near"))
    own_did, own_th, own_gone, own_near = (fresh(docs, x) for x in ("did", "th", "gone", "near"))
    marked = docs.select("*", id_key(docs[id_col]).alias(own_did), F.xxhash64(docs[text_col]).alias(own_th))
    joined = marked.join(gone.select(F.col("did").alias(own_did), F.col("th").alias(own_th), F.col("places").alias(own_gone), F.col("near").alias(own_near)), [own_did, own_th], "left")
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col(own_gone), i)), "\n")
    counts = {"n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"),
              "n_equal": (F.coalesce(F.size(own_gone), F.lit(0)) - F.coalesce(own_near, F.lit(0))).cast("long"),
              "n_near": F.coalesce(own_near, F.lit(0)).cast("long")}
    out = [F.when(F.col(own_gone).isNull(), F.col(text_col)).otherwise(left).alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in counts]
    return joined.select(*out, *(e.alias(c) for c, e in counts.items()))


def stripped(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs`` with the text deduplicated and ``n_chars``, where it was set, counted anew."""
    out = dedup_lines(docs.select(*docs.columns), **options)
    cols = [F.when(F.col(c).isNotNull(), F.coalesce(F.length("text"), F.lit(0))).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*cols)
