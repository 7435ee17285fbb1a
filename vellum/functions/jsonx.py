"""JSON / array / map helpers (H12–H15) as Column expressions.

Object order matters for some rules ("first media type wins"), so objects
are read with ``from_json(..., 'map<string,string>')``, which keeps document
order and leaves nested values as JSON text; ``VARIANT`` sorts keys and is
used only where order is irrelevant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJ = "map<string,string>"
ARR = "array<string>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def obj(x) -> Column:
    """JSON object text -> ordered ``map<string,string>`` (nested as text)."""
    return F.from_json(_c(x), OBJ)


def arr(x) -> Column:
    """JSON array text -> ``array<string>`` of element JSON texts."""
    return F.from_json(_c(x), ARR)


def is_object(x) -> Column:
    """True when a JSON text is an object (first non-blank char ``{``)."""
    return F.ltrim(_c(x)).startswith("{")


def is_array(x) -> Column:
    return F.ltrim(_c(x)).startswith("[")


def path(x, p: str) -> Column:
    """Null-on-missing JSONPath lookup returning text."""
    return F.get_json_object(_c(x), p)


def zip_arrays(*cols) -> Column:
    """H12 zip_arrays: parallel arrays -> array of structs; uneven arrays
    are padded with NULL."""
    return F.arrays_zip(*[_c(c) for c in cols])


def unzip_arrays(x, fields: list[str]) -> list[Column]:
    """H12 unzip_arrays: array of structs -> one array per field."""
    def field(f):
        return lambda s: s[f]

    return [F.transform(_c(x), field(f)).alias(f) for f in fields]


def to_entries(x) -> Column:
    """H12 to_entries: map -> array<struct<key,value>>."""
    return F.map_entries(_c(x))


def from_entries(x) -> Column:
    """H12 from_entries: array<struct<key,value>> -> map (last key wins)."""
    return F.map_from_entries(_c(x))
