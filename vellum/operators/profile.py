"""Columns of response schemas, and profiles of table columns.

Values are counted per distinct value before anything else, so a hot value is
one row after the map-side combine and no group is gathered.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_columns(schemas: DataFrame, schema: str = "schema", keep: Iterable[str] = ()) -> DataFrame:
    """L1: a response schema -> one row per property, in declared order.

    An array stands for its items. A property that is no object has a name
    only; a missing type is ``unknown``, other missing texts are empty.
    """
    top = F.when(F.get_json_object(schema, "$.type") == "array", F.get_json_object(schema, "$.items")).otherwise(F.col(schema))
    props = F.from_json(F.get_json_object(top, "$.properties"), "map<string,string>")
    rows = schemas.select(*keep, F.posexplode(F.map_entries(props)).alias("pos", "e"))
    own = F.when(F.ltrim("e.value").startswith("{"), F.col("e.value"))
    get = lambda p, default: F.coalesce(F.get_json_object(own, p), F.lit(default))
    return rows.select(*keep, "pos", F.col("e.key").alias("name"), get("$.type", "unknown").alias("type"), get("$.format", "").alias("format"),
                       F.coalesce(F.from_json(F.get_json_object(own, "$.enum"), "array<string>"), F.array().cast("array<string>")).alias("enum_values"),
                       get("$.description", "").alias("description"), F.substring_index(get("$['$ref']", ""), "/", -1).alias("ref_name"))


WHOLE = r"^-?\d+$"


def exact_text(c: Column, kind: str) -> Column:
    """A number as text that tells any two apart: whole numbers by their digits, whatever their type."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("string")
    if kind.startswith("decimal"):
        return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    d = c.cast("double")
    return F.when((d == F.floor(d)) & (F.abs(d) < 1e18), F.floor(d).cast("string")).otherwise(d.cast("string"))


def value_counts(df: DataFrame, columns: Iterable[str], prefix: str = "") -> DataFrame:
    """``(column, value, n)``: numeric columns unpivoted, rows counted per distinct value; null values stay.

    ``value`` is the number as ``exact_text``, so large keys stay apart.
    """
    kinds = dict(df.dtypes)
    wide = df.select(*[exact_text(F.col(c), kinds[c]).alias(prefix + c) for c in columns])
    return wide.unpivot([], wide.columns, "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def profile(counts: DataFrame) -> DataFrame:
    """Shape of each column of ``counts``; shares are over rows that aren't null.

    ``density``: distinct values over the integers between least and greatest.
    """
    some, whole = F.col("value").isNotNull(), F.col("value").rlike(WHOLE)
    exact, rough = F.when(whole, F.col("value")).try_cast("decimal(38,0)"), F.col("value").try_cast("double")
    g = counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(some, F.col("n"))), F.lit(0)).alias("n_values"), F.count("value").alias("n_distinct"),
        F.sum(F.when(whole, F.col("n"))).alias("whole"), F.count(F.when(whole, 1)).alias("n_whole"),
        (F.max(exact) - F.min(exact)).cast("double").alias("exact_range"), (F.max(rough) - F.min(rough)).alias("rough_range"))
    ratio = F.try_divide("n_distinct", "n_values")
    spread = F.when(F.col("n_whole") == F.col("n_distinct"), F.col("exact_range")).otherwise(F.col("rough_range"))
    return g.select("column", "n_rows", "n_values", "n_distinct", ratio.alias("cardinality"), (1 - ratio).alias("repeatability"),
                    F.try_divide(F.coalesce("whole", F.lit(0)), "n_values").alias("discreteness"),
                    F.try_divide(F.col("n_distinct"), spread + 1).alias("density"))


def key_triage(counts: DataFrame, contained: float = 0.95) -> DataFrame:
    """``(column, role, refers_to)``: key, foreign key (``contained`` of its values in a key) or measure.

    ``refers_to`` is the key that holds most of its values, of equals the
    last by name. Values meet in one equi-join on the value; a value has at
    most one row a column.
    """
    p = profile(counts)
    whole = F.col("discreteness") == 1
    is_key = whole & (F.col("n_distinct") == F.col("n_rows"))
    kinds = p.select("column", "n_distinct", F.coalesce(is_key, F.lit(False)).alias("key"), F.coalesce(whole, F.lit(False)).alias("whole"))
    values = counts.filter("value IS NOT NULL").join(kinds, "column")
    keys = values.filter("key").select("value", F.col("column").alias("refers_to"))
    other = values.filter("whole AND NOT key").select("value", "column", "n_distinct")
    hits = other.join(keys, "value").groupBy("column", "refers_to", "n_distinct").agg(F.count(F.lit(1)).alias("c"))
    best = hits.filter(F.col("c") >= contained * F.col("n_distinct")).groupBy("column").agg(F.max_by("refers_to", F.struct("c", "refers_to")).alias("refers_to"))
    role = F.when(F.col("key"), "key").when(F.col("refers_to").isNotNull(), "foreign key").otherwise("measure")
    return kinds.join(best, "column", "left").select("column", role.alias("role"), "refers_to")


def unpivot_measures(wide: DataFrame, ids: list[str], pattern: str, parts: list[str], measure: str) -> DataFrame:
    """The columns that ``pattern`` fits become rows; its groups become the columns ``parts``."""
    import re

    fit = [c for c in wide.columns if c not in ids and re.search(pattern, c)]
    long = wide.select(*ids, *fit).unpivot(ids, fit, "_vl_name", measure)
    return long.select(*ids, *[F.regexp_extract("_vl_name", pattern, i + 1).alias(x) for i, x in enumerate(parts)], measure)


#: Name parts that tell a pivoted column from its siblings.
PIVOT_TOKEN = r"(?:19|20)\d\d|q[1-4]|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|male|female"


def pivot_groups(columns: DataFrame, table: str, name: str = "name") -> DataFrame:
    """Stems that a table has under two or more tokens: ``(table, stem, n_tokens, least, greatest)``."""
    low = F.lower(F.col(name))
    token = F.regexp_extract(low, rf"(?:^|_)({PIVOT_TOKEN})(?:_|$)", 1)
    stem = F.regexp_replace(low, rf"(?:^|_)(?:{PIVOT_TOKEN})(?=_|$)", "_#")
    rows = columns.select(table, token.alias("token"), stem.alias("stem")).filter("token <> ''").distinct()
    return rows.groupBy(table, "stem").agg(F.count(F.lit(1)).alias("n_tokens"), F.min("token").alias("least"), F.max("token").alias("greatest")).filter("n_tokens > 1")


def dependency(df: DataFrame, determinant: str, dependent: str) -> DataFrame:
    """One row: how many determinants there are and the share with a single dependent (null is a value)."""
    d = F.col(dependent)
    g = df.groupBy(determinant).agg(F.min(d).alias("lo"), F.max(d).alias("hi"), F.count(F.lit(1)).alias("n"), F.count(d).alias("some"))
    single = (F.col("lo").isNull() | (F.col("lo") == F.col("hi"))) & ((F.col("some") == F.col("n")) | (F.col("some") == 0))
    return g.agg(F.lit(determinant).alias("determinant"), F.lit(dependent).alias("dependent"), F.count(F.lit(1)).alias("n_determinants"),
                 F.avg(F.when(single, 1.0).otherwise(0.0)).alias("confidence"))


def value_domains(values: DataFrame, members: DataFrame, key: Column) -> DataFrame:
    """Per column its dominant domain, the values in it, and the values in no domain."""
    distinct = values.select("column", key.alias("key")).distinct()
    hit = distinct.join(members.select("domain_name", "key").distinct(), "key", "left")
    by = hit.groupBy("column", "domain_name").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(F.col("n"), F.col("domain_name"))
    known = F.col("domain_name").isNotNull()
    return by.groupBy("column").agg(F.max(F.when(known, rank)).alias("top"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_unknown")).select(
        "column", F.col("top.domain_name").alias("domain_name"), F.coalesce("top.n", F.lit(0)).alias("n_matched"), "n_unknown")
