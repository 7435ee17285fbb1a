"""Scalar string helpers as Spark ``Column`` expressions (JVM-side)."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_outer_quotes(x) -> Column:
    """H1: remove one pair of matching outer quotes (length >= 2)."""
    return F.regexp_replace(_c(x), r"""^(["'])(.*)\1$""", "$2")


def model_id_normalise(x) -> Column:
    """H2: lower, trim, ``digit.digit`` -> ``digit-digit`` (non-overlapping,
    left to right, so ``4.6.1`` becomes ``4-6.1``)."""
    return F.regexp_replace(F.lower(F.trim(_c(x))), r"(\d)\.(\d)", "$1-$2")


def provider_of(x) -> Column:
    """H3: text before the first ``/``, else ``unknown``."""
    c = _c(x)
    return F.when(c.contains("/"), F.substring_index(c, "/", 1)).otherwise(F.lit("unknown"))


def per_million(x) -> Column:
    """H4: per-token price text -> price per million tokens (DOUBLE)."""
    return _c(x).try_cast("double") * F.lit(1_000_000.0)


#: Fixed value: the texts that Spark casts to a double.
NUMBER = (r"^[\x00-\x20]*(?:[+-]?(?:NaN|Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[fFdD]?"
          r"|0[xX](?:[0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?|(?i:inf|infinity))|(?i:nan))[\x00-\x20]*$")


def to_number(x) -> Column:
    """H8: numeric value of a text after removing ``,`` and ``$``. A cast that fails costs an exception, so other texts are told first."""
    plain = F.translate(_c(x), ",$", "")
    return F.when(plain.rlike(NUMBER), plain.try_cast("double"))


def name_key(x) -> Column:
    """H9: lower case with leading/trailing underscores stripped."""
    return F.expr(f"trim(BOTH '_' FROM lower({_sql(x)}))")


def ref_tail(x) -> Column:
    """Last ``/`` segment of a ``$ref``."""
    return F.substring_index(_c(x), "/", -1)


def host_prefix(url) -> Column:
    """Scheme + host of a URL."""
    return F.regexp_extract(_c(url), r"^(https?://[^/?#]+)", 1)


def unescape_payload(x) -> Column:
    """H7: the four ordered replacements for embedded page payloads (fixed values, in this order)."""
    c = _c(x)
    c = F.replace(c, F.lit('\\\\"'), F.lit('"'))
    c = F.replace(c, F.lit('\\"'), F.lit('"'))
    c = F.replace(c, F.lit("\\n"), F.lit("\n"))
    return F.replace(c, F.lit("\\/"), F.lit("/"))


def parse_iso_ts(x) -> Column:
    """ISO-8601 text with ``Z`` / offset / nanoseconds -> UTC timestamp."""
    c = F.regexp_replace(_c(x), r"(\.\d{6})\d+", "$1")
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")),
                      F.try_to_timestamp(c))


#: The blocks of combining marks that are accents; vowel signs and other marks that spell are in others.
ACCENTS = r"[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+"


def _folded(ch: str) -> str:
    """Compatibility form, case folded, without accents."""
    low = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", ch).casefold())
    return "".join(c for c in low if not re.match(ACCENTS, c))


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """By rule from the Unicode database: the letters and digits of the basic plane that fold to one character, those
    characters, and the Latin, Greek and Armenian letters and Roman numerals that fold to several (``translate`` can't do these)."""
    src, dst, several = [], [], {}
    for cp in range(0x80, 0xFFFE):
        ch = chr(cp)
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF or not ch.isalnum() or ch.lower() != ch:
            continue
        to = _folded(ch)
        if len(to) == 1 and to != ch:
            src.append(ch)
            dst.append(to)
        elif len(to) > 1 and unicodedata.name(ch, "").split(" ")[0] in ("LATIN", "GREEK", "ARMENIAN", "SMALL"):
            several[ch] = to
    return "".join(src), "".join(dst), several


FOLDED, PLAIN, SEVERAL = _fold_tables()


def fold_label(x) -> Column:
    """Lower case, compatibility forms (full width, ligatures) and case folds (sharp s, final sigma) resolved, accents taken off.

    Composed and decomposed letters fold alike; marks that spell, as vowel
    signs do, stay. Outside the basic plane only case is folded. A text of
    ASCII alone (as many bytes as characters) has nothing but case to fold.
    """
    c = _c(x)
    low = F.translate(F.lower(c), FOLDED, PLAIN)
    table = F.create_map(*[F.lit(v) for kv in SEVERAL.items() for v in kv])
    spelled = F.array_join(F.transform(F.split(low, ""), lambda c: F.coalesce(table[c], c)), "")
    folded = F.regexp_replace(F.when(low.rlike(f"[{''.join(SEVERAL)}]"), spelled).otherwise(low), ACCENTS, "")
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(folded)


def _sql(x) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("SQL-expression helpers take a column name")
