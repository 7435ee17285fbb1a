"""Chat formatting: a record's nested field paths choose the mapping that turns it into turns.

A record is JSON text in any layout (messages, prompt and completion,
instruction and output, ...). Its nested field paths, in order, are hashed; a
table of declared layouts, each with the fingerprints of the path sets it can
have, names the mapping. The mapping gives canonical turns, a template gives
one string with marked turns and escaped texts, and a loss mask gives the
places of the assistant's texts. ``read_back`` is the inverse. All of it is
DataFrame expressions over the record; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import fresh

TURNS = "array<struct<role: string, text: string>>"
#: A schema's text in pieces: a name, an opening, a closing, a plain type.
PIECES = r"(`(?:[^`]|``)*`: |\w+: |OBJECT<|ARRAY<|>|[A-Z_]+(?:\(\d+,\d+\))?)"


@dataclass(frozen=True)
class Layout:
    """One declared layout.

    Either ``each`` is the path of an array of turns, with ``role`` and
    ``text`` as paths inside an element (``text`` may be ``parts[].text``:
    the parts are joined), or ``turns`` lists ``(role, paths)``, where the
    texts of the paths that aren't empty are joined by a blank line; a
    ``system`` turn without text is left out. ``roles`` renames roles,
    ``optional`` lists paths that may be absent, ``other`` paths that are
    carried without being used (they may be absent as well).
    """

    name: str
    each: str = ""
    role: str = "role"
    text: str = "content"
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()
    other: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        if self.each:
            return [f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"]
        return [p for _, paths in self.turns for p in paths]

    def fingerprints(self) -> tuple[set[str], set[str]]:
        """Of the path sets with or without each path that may be absent; and of those with empty or null arrays."""
        may = [*self.optional, *self.other]
        whole = [frozenset([*self.paths(), *may]) - set(left_out) for n in range(len(may) + 1) for left_out in itertools.combinations(may, n)]
        exact = {fingerprint(s) for s in whole}
        return exact, {fingerprint(c) for s in whole for c in collapsed(s)} - exact


def collapsed(paths: frozenset[str]) -> set[frozenset[str]]:
    """``paths``, and what stays of them where an array on the way is empty or null."""
    out = {paths}
    for prefix in sorted({p[:i + 2] for p in paths for i in range(len(p)) if p.startswith("[].", i)}):
        for s in list(out):
            rest = frozenset(p for p in s if not p.startswith(prefix + "."))
            if rest != s:
                out |= {rest | {prefix}, rest | {prefix[:-2]}}
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


LAYOUTS = (
    Layout("messages", each="messages", other=("id", "source")),
    Layout("message_parts", each="messages", text="content[].text", other=("messages[].content[].type",)),
    Layout("from_value", each="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}, other=("id",)),
    Layout("nested_dialog", each="data.dialog", role="speaker", text="utterance", other=("data.lang",)),
    Layout("prompt_completion", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("question_answer", turns=(("system", ("system",)), ("user", ("question",)), ("assistant", ("answer",))), optional=("system",)),
    Layout("instruction_output", turns=(("user", ("instruction", "input")), ("assistant", ("output",))), optional=("input",)),
)


@dataclass(frozen=True)
class Template:
    """``<tag>role\\ntext</tag>\\n`` a turn.

    The role is percent-encoded. In a text, ``<tag`` and ``</tag`` get a
    backslash after the ``<``, and any that have some get one more, so the
    marks stand nowhere but around turns, and taking one away is the inverse.
    """

    tag: str = "turn"
    learn: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not self.tag.isalpha():
            raise ValueError("a tag is letters only")

    @property
    def close(self) -> str:
        return f"</{self.tag}>\n"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"<(\\*)(/?{self.tag})", r"<\\$1$2")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"<\\(\\*)(/?{self.tag})", "<$1$2")

    def head(self, role: Column) -> Column:
        return F.concat(F.lit(f"<{self.tag}>"), F.url_encode(role), F.lit("\n"))


def field_paths(record: Column) -> Column:
    """The paths of a variant's fields down to the leaves, in order; array elements are ``[]``, mixed ones ``?``."""
    pieces = F.regexp_extract_all(F.schema_of_variant(record), F.lit(PIECES), 1)
    start = F.struct(F.array(F.lit("")).alias("stack"), F.array().cast("array<string>").alias("paths"))

    # A name or an array's element is pushed; a leaf takes its own away, a closing its object's or array's and the copy.
    def step(s: Column, piece: Column) -> Column:
        top, down = F.element_at(s.stack, -1), F.slice(s.stack, 1, F.size(s.stack) - 1)
        put = lambda stack, paths: F.struct(stack.alias("stack"), paths.alias("paths"))
        name = F.regexp_replace(F.regexp_replace(piece, "^`?(.*?)`?: $", "$1"), "``", "`")
        return (F.when(piece.endswith(": "), put(F.array_append(s.stack, F.concat(top, F.when(top == "", "").otherwise("."), name)), s.paths))
                .when(piece == "OBJECT<", put(F.array_append(s.stack, top), s.paths))
                .when(piece == "ARRAY<", put(F.concat(s.stack, F.array(top, F.concat(top, F.lit("[]")))), s.paths))
                .when(piece == ">", put(F.slice(down, 1, F.size(down) - 1), s.paths))
                .otherwise(put(down, F.array_append(s.paths, F.concat(top, F.when(piece == "VARIANT", "?").otherwise(""))))))

    return F.array_sort(F.array_distinct(F.aggregate(pieces, start, step, lambda s: s.paths)))


def json_path(path: str) -> str:
    return "$." + path


def turns_by(layout: Layout, record: Column) -> Column:
    """The canonical turns of ``record`` under ``layout``; null texts and roles are empty."""
    as_text = lambda c: F.coalesce(c, F.lit(""))
    if not layout.each:
        made = []
        for role, paths in layout.turns:
            got = [F.try_variant_get(record, json_path(p), "string") for p in paths]
            text = got[0] if len(got) == 1 else F.concat_ws("\n\n", *[F.when(g != "", g) for g in got])
            made.append(F.struct(F.lit(role).alias("role"), as_text(text).alias("text")))
        return F.filter(F.array(*made), lambda t: (t.role != "system") | (t.text != "")).cast(TURNS)
    if "[]" in layout.text:
        parts, _, inner = layout.text.partition("[].")
        kind = f"{layout.role}: string, {parts}: array<struct<{inner}: string>>"
        text = lambda e: F.array_join(F.transform(e[parts], lambda p: as_text(p[inner])), "")
    else:
        kind = f"{layout.role}: string, {layout.text}: string"
        text = lambda e: e[layout.text]
    named = F.create_map(*[F.lit(x) for kv in layout.roles.items() for x in kv]) if layout.roles else None
    role = lambda e: as_text(F.coalesce(named[e[layout.role]], e[layout.role]) if layout.roles else e[layout.role])
    found = F.filter(F.try_variant_get(record, json_path(layout.each), f"array<struct<{kind}>>"), lambda e: e.isNotNull())
    turns = F.transform(found, lambda e: F.struct(role(e).alias("role"), as_text(text(e)).alias("text")))
    return F.coalesce(turns, F.array().cast(TURNS))


def to_turns(records: DataFrame, layouts=LAYOUTS, *, record_col: str = "record") -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns`` (replaced where they are there already).

    A null record, text that isn't JSON (or has a name twice in one object)
    has no fingerprint; a record whose paths no layout has keeps its
    fingerprint, so that a mapping can be declared for it. Both have a null
    layout and null turns; no row is dropped. Null ids, repeated rows and
    other columns are carried; an empty table gives an empty table.
    """
    named: dict[str, str] = {}
    for layout in layouts:
        for f in layout.fingerprints()[0]:
            if named.setdefault(f, layout.name) != layout.name:
                raise ValueError(f"layouts {named[f]} and {layout.name} can't be told apart")
    for layout in layouts:
        for f in layout.fingerprints()[1]:  # such records have no texts there, so layouts that share one agree
            named.setdefault(f, layout.name)
    work = fresh(records, "variant")
    known = F.create_map(*[F.lit(x) for kv in sorted(named.items()) for x in kv])
    out = records.withColumn(work, F.try_parse_json(F.col(record_col)))
    out = out.withColumn("fingerprint", F.sha2(F.array_join(field_paths(F.col(work)), "\n"), 256))
    out = out.withColumn("layout", known[F.col("fingerprint")])
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, turns_by(layout, F.col(work))).otherwise(turns)
    return out.withColumn("turns", turns).drop(work)


def render(records: DataFrame, template: Template = Template(), *, turns_col: str = "turns") -> DataFrame:
    """``records`` with ``formatted`` and ``loss_mask``: spans ``(turn, start, stop)`` in code points of ``formatted``.

    A turn has a span if its role is one of ``template.learn``, also if its
    text is empty. Null turns give null, no turns an empty string.
    """
    block = lambda t: F.concat(template.head(t.role), template.escape(t.text), F.lit(template.close))
    start = F.struct(F.lit(0).alias("turn"), F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<turn: int, start: long, stop: long>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        begin = s.at + F.length(template.head(t.role))
        stop = begin + F.length(template.escape(t.text))
        span = F.struct(s.turn.alias("turn"), begin.cast("long").alias("start"), stop.cast("long").alias("stop"))
        return F.struct((s.turn + 1).alias("turn"), (stop + len(template.close)).cast("long").alias("at"),
                        F.when(t.role.isin(*template.learn), F.array_append(s.spans, span)).otherwise(s.spans).alias("spans"))

    turns = F.col(turns_col)
    return (records.withColumn("formatted", F.array_join(F.transform(turns, block), ""))
            .withColumn("loss_mask", F.aggregate(turns, start, step, lambda s: s.spans)))


def format_chats(records: DataFrame, layouts=LAYOUTS, template: Template = Template(), *, record_col: str = "record") -> DataFrame:
    """``to_turns`` and ``render``: one row a record, whole texts, no shuffle.

    A very long record is one value of one row, as it is in the input; a
    record over the size of a variant (128 MiB) can't be parsed and has a
    null layout.
    """
    return render(to_turns(records, layouts, record_col=record_col), template)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``formatted`` with ``read_turns`` and ``read_loss`` (the texts under the mask), from ``formatted`` and ``loss_mask`` alone."""
    blocks = F.filter(F.split(F.col("formatted"), template.close, -1), lambda b: b != "")
    work = fresh(formatted, "blocks")
    starts = fresh(formatted, "starts")
    opening = len(f"<{template.tag}>")

    def turn(b: Column) -> Column:
        cut = F.instr(b, "\n")
        return F.struct(F.url_decode(b.substr(F.lit(opening + 1), cut - opening - 1)).alias("role"),
                        template.unescape(b.substr(cut + 1, F.length(b))).alias("text"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all"))
    places = F.aggregate(F.col(work), begin, lambda s, b: F.struct(
        (s.at + F.length(b) + len(template.close)).cast("long").alias("at"), F.array_append(s.all, s.at).alias("all")), lambda s: s.all)
    under = F.transform("loss_mask", lambda m: template.unescape(F.get(F.col(work), m.turn).substr(
        (m.start - F.get(F.col(starts), m.turn) + 1).cast("int"), (m.stop - m.start).cast("int"))))
    return (formatted.withColumn(work, blocks).withColumn(starts, places)
            .withColumn("read_turns", F.transform(work, turn)).withColumn("read_loss", under).drop(work, starts))
