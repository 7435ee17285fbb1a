"""Q4: records against a declared schema: one column of violations, a quarantine, a retry queue."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.steps import name_path
from vellum.operators.pricing import _reply_items


@dataclass(frozen=True)
class Rule:
    """What a field must be. ``kind``: string, number, integer, boolean, array or object."""

    field: str
    kind: str | None = None
    required: bool = False
    enum: tuple | None = None
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None


#: A price record as it is declared.
PRICE_RULES = (Rule("model_id", "string", True), Rule("input_per_mtok", "number", True, minimum=0), Rule("output_per_mtok", "number", True, minimum=0),
               *(Rule(f, "number", minimum=0) for f in ("cache_write_5m_per_mtok", "cache_write_1h_per_mtok", "cache_read_per_mtok", "batch_input_per_mtok", "batch_output_per_mtok")))


def rules_of(rows: DataFrame) -> tuple[Rule, ...]:
    """Rules from rows with the fields of :class:`Rule`, in their ``field``'s order; a declaration, so it is small."""
    return tuple(Rule(**{k: tuple(v) if isinstance(v, list) else v for k, v in r.asDict().items()}) for r in rows.orderBy("field").collect())


def violations(record: str, rules: Sequence[Rule], extra_keys: bool = False) -> Column:
    """An array of what is wrong with a JSON text, empty if nothing is: one entry a field, the first rule it breaks, then unknown keys.

    Text that isn't JSON, JSON that is no object, and null are
    ``not an object``. A null value is of no kind; where no kind is given it
    counts as there. A number in quotes is a string. Bounds hold for numbers,
    patterns (found anywhere) and enums for the value as text.
    """
    whole = F.try_parse_json(F.col(record))
    values = [F.try_variant_get(whole, name_path(r.field), "variant") for r in rules]
    return _violations(F.when(whole.isNotNull(), F.json_object_keys(F.col(record))), values, [F.schema_of_variant(v) for v in values], rules, extra_keys)


def _violations(keys: Column, values: Sequence[Column], types: Sequence[Column], rules: Sequence[Rule], extra_keys: bool) -> Column:
    found = [field_violation(v, t, r) for v, t, r in zip(values, types, rules, strict=True)]
    if not extra_keys:
        unknown = F.array_sort(F.array_except(keys, F.array(*[F.lit(r.field) for r in rules]).cast("array<string>")))
        extra = F.transform(unknown, lambda k: F.concat(k, F.lit(": not declared")))
    else:
        extra = F.array().cast("array<string>")
    return F.when(keys.isNull(), F.array(F.lit("not an object"))).otherwise(F.concat(F.array_compact(F.array(*found)), extra))


def field_violation(value: Column, told: Column, rule: Rule) -> Column:
    """What is wrong with a field's ``value`` (a variant) of the type ``told``; null if nothing is."""
    text, number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
    numeric = told.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    kinds = {"string": told == "STRING", "number": numeric, "integer": numeric & (number == F.floor(number)), "boolean": told == "BOOLEAN",
             "array": told.startswith("ARRAY"), "object": told.startswith("OBJECT")}
    broken = F.when(value.isNull(), F.lit("missing") if rule.required else F.lit(None).cast("string"))
    checks = []
    if rule.kind:
        checks.append((kinds[rule.kind], f"no {rule.kind}"))
    if rule.enum is not None:
        checks.append((text.isin(*[str(v) for v in rule.enum]), "not one of the values"))
    if rule.pattern is not None:
        checks.append((text.rlike(rule.pattern), "unlike the pattern"))
    if rule.minimum is not None:
        checks.append((~numeric | (number >= rule.minimum), f"below {rule.minimum:g}"))
    if rule.maximum is not None:
        checks.append((~numeric | (number <= rule.maximum), f"above {rule.maximum:g}"))
    for holds, says in checks:
        broken = broken.when(~F.coalesce(holds, F.lit(False)), says)
    return F.when(broken.isNotNull(), F.concat(F.lit(f"{rule.field}: "), broken))


def _validated(rows: DataFrame, record: str, rules: Sequence[Rule], extra_keys: bool, given: Callable[[Column], Column] = lambda v: v) -> DataFrame:
    """``rows`` with ``violations`` (as ``given`` has them), each record parsed once.

    What several conditions use is in columns of its own. The result comes
    out of a generator: a filter on it would else be pushed below, with all
    of this written out again at each place that uses it.
    """
    d = rows.withColumn("_vl_whole", F.try_parse_json(F.col(record)))
    d = d.withColumns({"_vl_keys": F.when(F.col("_vl_whole").isNotNull(), F.json_object_keys(F.col(record))),
                       **{f"_vl_v{i}": F.try_variant_get("_vl_whole", name_path(r.field), "variant") for i, r in enumerate(rules)}})
    d = d.withColumns({f"_vl_t{i}": F.schema_of_variant(f"_vl_v{i}") for i in range(len(rules))})
    found = _violations(F.col("_vl_keys"), [F.col(f"_vl_v{i}") for i in range(len(rules))], [F.col(f"_vl_t{i}") for i in range(len(rules))], rules, extra_keys)
    return d.select(*[c for c in rows.columns if c != "violations"], F.explode(F.array(given(found))).alias("violations"))


def validate(rows: DataFrame, record: str, rules: Sequence[Rule], extra_keys: bool = False) -> DataFrame:
    """``rows`` with ``violations``; the valid ones have none."""
    return _validated(rows, record, rules, extra_keys)


def validate_replies(replies: DataFrame, rules: Sequence[Rule] = PRICE_RULES, content: str = "content", extra_keys: bool = False) -> DataFrame:
    """Each record of each reply, with ``item`` (its place), ``record`` and ``violations``; a reply without a list is one row with a null item."""
    keep = [c for c in replies.columns if c != content]
    rows = _reply_items(replies, content).withColumn("_vl_bad", F.col("_vl_items").isNull()).select(
        *keep, "_vl_bad", F.posexplode_outer("_vl_items").alias("item", "_vl_record")).withColumn("record", F.to_json("_vl_record"))
    given = lambda v: F.when(F.col("_vl_bad"), F.array(F.lit("no list of records"))).when(F.col("item").isNull(), F.array().cast("array<string>")).otherwise(v)
    return _validated(rows, "record", rules, extra_keys, given).select(*keep, "item", "record", "violations")


def retry_queue(validated: DataFrame, keys: Sequence[str], attempt: str, most: int = 3) -> DataFrame:
    """A row per reply with a violation: its next attempt with the errors to send along, or ``quarantine`` after ``most`` attempts.

    Errors are one text, by item; a reply's items are what one row gathers.
    """
    bad = validated.filter(F.size("violations") > 0)
    errors = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("item", F.lit(-1)).alias("item"), "violations"))), lambda s: F.concat(
        F.when(s["item"] >= 0, F.concat(F.lit("item "), s["item"].cast("string"), F.lit(": "))).otherwise(""), F.array_join(s["violations"], ", "))), "; ")
    queue = bad.groupBy(*keys, attempt).agg(errors.alias("errors"))
    return queue.select(*keys, F.when(F.col(attempt) < most, F.col(attempt) + 1).alias("next_attempt"),
                        F.when(F.col(attempt) < most, "retry").otherwise("quarantine").alias("status"), "errors")
