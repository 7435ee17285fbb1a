"""Tables found in positioned text boxes, matched with wanted schemas, and runs of pages.

Boxes become lines, lines become cells, as in :mod:`vellum.operators.sieve`.
A run of neighbouring lines of two cells or more is a candidate. A sweep over
the cells' x intervals finds its column gutters: edges are summed per place
before they are swept, so the sweep is as long as the page is wide, whatever
the number of lines.

Pages are gathered by one sort (``page_rows``) and done many at a time, so
nothing but boxes is exchanged, and these only if they don't lie by page yet.
Pages of more than ``sequence.LONG_KEY`` boxes, counted first, take several
tasks each (``long_page_rows``): their lines, edges and rows are exchanged, and
a page higher than ``BAND`` is numbered in parts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vellum.functions.text import NUMBER, fold_label, to_number
from vellum.operators.domains import materialised
from vellum.operators.sequence import LONG_KEY, null_safe_left, number_runs

# The function that runs in tasks travels with them: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Height of a page's part that one task puts in order.
BAND = 10_000.0
PAGE = ["doc_id", "page_id"]
RUN = [*PAGE, "run"]
DATE = r"^\d{4}-\d{2}-\d{2}"
#: Boxes that are done at once, as far as pages allow.
AT_ONCE = 50_000


def page_lines(boxes: DataFrame) -> DataFrame:
    """``doc_id, page_id, top, bottom, cells``: a row per line, its cells ``(x0, x1, text)`` from left to right.

    Boxes without a place, size, document or page are left out; null texts are
    empty. Boxes
    share a line if ``round((y + h/2) / max(h, 1))`` is equal; a cell begins
    where the gap to the box before exceeds ``max(0.8 * its height, 3)``.
    """
    placed = boxes.dropna(subset=["x", "y", "w", "h", *PAGE])
    middle = F.round((F.col("y") + F.col("h") / 2) / F.greatest(F.col("h"), F.lit(1.0)))
    box = F.struct(F.col("x").cast("double").alias("x0"), (F.col("x") + F.col("w")).cast("double").alias("x1"), F.col("h").cast("double").alias("h"),
                   F.coalesce("text", F.lit("")).alias("text"))
    line = placed.groupBy(*PAGE, middle.alias("height")).agg(
        F.min("y").cast("double").alias("top"), F.max(F.col("y") + F.col("h")).cast("double").alias("bottom"), F.array_sort(F.collect_list(box)).alias("all"))
    starts = F.filter(F.sequence(F.lit(1), F.size("all")), lambda i: F.when(i == 1, True).otherwise(
        F.element_at("all", i)["x0"] - F.element_at("all", i - 1)["x1"] > F.greatest(F.element_at("all", i - 1)["h"] * 0.8, F.lit(3.0))))
    line = line.withColumn("starts", starts)
    runs = F.transform("starts", lambda s, k: F.slice("all", s, F.coalesce(F.get("starts", k + 1), F.size("all") + 1) - s))
    cell = lambda c: F.struct(c[0]["x0"].alias("x0"), F.array_max(F.transform(c, lambda b: b["x1"])).alias("x1"),
                              F.array_join(F.transform(c, lambda b: b["text"]), " ").alias("text"))
    return line.select(*PAGE, "top", "bottom", F.transform(runs, cell).alias("cells"))


def line_runs(lines: DataFrame, max_gap: float = 1.5) -> DataFrame:
    """``lines`` of two cells or more with ``run``: lines of one run follow each other at most ``max_gap`` line heights apart."""
    own = lines.withColumn("tabular", F.size("cells") >= 2)

    def breaks(before: Column, here: Column) -> Column:
        return (before["tabular"] != here["tabular"]) | (here["top"] - before["bottom"] > max_gap * (here["bottom"] - here["top"]))

    numbered = number_runs(own, PAGE, ["top", "bottom"], ["tabular", "top", "bottom"], breaks, band=F.floor(F.col("top") / BAND))
    return numbered.filter("tabular").drop("tabular")


def gutters(runs: DataFrame, min_gutter: float = 8.0, spill: float = 0.0) -> DataFrame:
    """Per run ``(n_lines, body_top, gutters)``, from one pass over its lines.

    Gutters are the inner x intervals, ``min_gutter`` wide or more, that no
    cell covers. ``spill``: a share of the lines that may cover one all the
    same (for cells that span columns; a column that no more lines fill is
    lost to it). ``body_top``: where the first line with a number is, or null.
    """
    numeric = F.exists("cells", lambda c: to_number(c["text"]).isNotNull())
    line = runs.select(*RUN, F.when(numeric, F.col("top")).alias("number_top"), F.posexplode("cells").alias("k", "c"))
    edges = line.select(*RUN, "number_top", F.inline(F.array(
        F.struct(F.floor("c.x0").alias("at"), F.lit(1).alias("d"), (F.col("k") == 0).cast("int").alias("line")),
        F.struct(F.ceil("c.x1").alias("at"), F.lit(-1).alias("d"), F.lit(0).alias("line")))))
    steps = edges.groupBy(*RUN, "at").agg(F.sum("d").alias("d"), F.sum("line").alias("lines"), F.min("number_top").alias("number_top"))
    whole = Window.partitionBy(*RUN)
    w = whole.orderBy("at")
    swept = steps.select(*RUN, "at", F.sum("d").over(w).alias("cover"), F.lead("at").over(w).alias("until"), F.sum("lines").over(whole).alias("n_lines"),
                         F.min("number_top").over(whole).alias("body_top"), F.min("at").over(whole).alias("left"), F.max("at").over(whole).alias("right"))
    swept = swept.withColumn("open", F.col("until").isNotNull() & (F.col("cover") <= F.floor(F.col("n_lines") * spill)))
    # neighbouring intervals that are both open are one, up to the next that is covered
    group = F.sum((~F.col("open")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    gaps = swept.withColumn("g", group).filter("open").groupBy(*RUN, "g", "n_lines", "body_top", "left", "right").agg(F.min("at").alias("lo"), F.max("until").alias("hi"))
    inner = (F.col("hi") - F.col("lo") >= min_gutter) & (F.col("lo") > F.col("left")) & (F.col("hi") < F.col("right"))
    return gaps.filter(inner).groupBy(*RUN).agg(F.first("n_lines").alias("n_lines"), F.first("body_top").alias("body_top"),
                                               F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("gutters"))


def table_rows(boxes: DataFrame, *, min_lines: int = 2, max_gap: float = 1.5, min_gutter: float = 8.0, spill: float = 0.0, sizes: DataFrame | None = None) -> DataFrame:
    """``doc_id, page_id, run, top, bottom, x0, x1, n_cells, is_header, values, headers``: the lines of candidates, a text (or null) per column.

    A candidate has ``min_lines`` lines and a gutter. A cell is of the column
    that its middle is in, between the gutters' middles; cells of one column
    are joined by a blank. Header lines are those before the candidate's first
    line with a number (none if no line has one); ``headers`` are their texts
    by column, of all the candidate's header lines. No boxes, or none in
    columns, give no rows. ``sizes``: ``(doc_id, page_id, n)``, about how many
    boxes pages have, where boxes cost much to count.
    """
    options = {"min_lines": min_lines, "max_gap": max_gap, "min_gutter": min_gutter, "spill": spill}
    own = boxes.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n")) if sizes is None else sizes
    long = own.filter((F.col("n") > LONG_KEY) & F.col("doc_id").isNotNull() & F.col("page_id").isNotNull()).select(*PAGE)
    found = long.collect()  # at most one for that many boxes
    if not found:
        return page_rows(boxes, **options)
    long = F.broadcast(boxes.sparkSession.createDataFrame(found, long.schema))
    return page_rows(boxes.join(long, PAGE, "left_anti"), **options).unionByName(long_page_rows(boxes.join(long, PAGE, "left_semi"), **options))


def page_rows(boxes: DataFrame, **options) -> DataFrame:
    """``table_rows``, whole pages at a time; a page is held by one task."""
    placed = boxes.dropna(subset=["x", "y", "w", "h", *PAGE])
    middle = (F.col("y") + F.col("h") / 2) / F.greatest(F.col("h"), F.lit(1.0))
    # the window brings a page's boxes together, the page's first has number 1; pages that lie together aren't exchanged
    place = F.row_number().over(Window.partitionBy("page_id", "doc_id").orderBy("page_id"))
    own = placed.select(*PAGE, F.col("x").cast("double").alias("x0"), (F.col("x") + F.col("w")).cast("double").alias("x1"), F.col("y").cast("double").alias("top"),
                        (F.col("y") + F.col("h")).cast("double").alias("bottom"), F.col("h").cast("double").alias("h"), middle.cast("double").alias("middle"),
                        F.coalesce("text", F.lit("")).alias("text"), place.alias("place"))
    kinds = ", ".join(f"{c} {boxes.schema[c].dataType.simpleString()}" for c in PAGE)
    schema = StructType.fromDDL(f"{kinds}, run long, top double, bottom double, x0 double, x1 double, n_cells int, is_header boolean, values array<string>, headers array<string>")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pages in whole_pages(batches):
            yield from rows_of_pages(pages, **options).to_batches()

    return own.mapInArrow(rows, schema)


def whole_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches anew, cut before a page's first box."""
    held, n = [], 0
    for b in batches:
        firsts = np.flatnonzero(b["place"].to_numpy() == 1)
        cut = int(firsts[-1]) if len(firsts) and n + firsts[-1] >= AT_ONCE else 0
        if cut or (n >= AT_ONCE and len(firsts)):
            yield pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks()
            held, n = [], 0
        held.append(b.slice(cut))
        n += b.num_rows - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where one of ``keys`` differs from the place before."""
    return np.flatnonzero(np.any([np.concatenate([[True], k[1:] != k[:-1]]) for k in keys], axis=0)) if len(keys[0]) else np.zeros(0, np.int64)


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n`` places from each of ``first``."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def _ordered(texts: pa.Array, *keys: np.ndarray) -> np.ndarray:
    """The order by ``keys``, the first one first, of equals by text."""
    order = np.lexsort(keys[::-1])
    if len(_starts(*[k[order] for k in keys])) < len(order):
        order = np.lexsort((pc.rank(texts, tiebreaker="dense").to_numpy(), *keys[::-1]))
    return order


def _joined(texts: pa.Array, n: np.ndarray) -> pa.Array:
    """Of ``n`` texts in turn, the texts joined by a blank; of none an empty one."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), texts), " ")


def gutters_of(run: np.ndarray, x0: np.ndarray, x1: np.ndarray, n_lines: np.ndarray, min_gutter: float, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """The gutters of cells by their ``run``, as ``gutters`` finds them: their runs, and the sums of their two ends, in order."""
    own, at = np.concatenate([run, run]), np.concatenate([np.floor(x0), np.ceil(x1)])
    step = np.repeat([1, -1], len(run))
    order = np.lexsort((at, own))
    own, at = own[order], at[order]
    first = _starts(own, at)
    cover = np.cumsum(np.add.reduceat(step[order], first))  # a run's steps sum to 0
    own, at = own[first], at[first]
    last = np.concatenate([own[1:] != own[:-1], [True]])
    is_open = ~last & (cover <= np.floor(n_lines[own] * spill))
    lo = np.flatnonzero(is_open & ~np.concatenate([[False], is_open[:-1]]))
    hi = np.flatnonzero(is_open & ~np.concatenate([is_open[1:], [False]])) + 1
    ends = _starts(own)
    left, right = at[ends], at[np.concatenate([ends[1:], [len(own)]]) - 1]
    inner = (at[hi] - at[lo] >= min_gutter) & (at[lo] > left[own[lo]]) & (at[hi] < right[own[lo]])
    return own[lo][inner], (at[lo] + at[hi])[inner]


def rows_of_pages(pages: pa.Table, min_lines: int, max_gap: float, min_gutter: float, spill: float) -> pa.Table:
    """The rows of ``table_rows`` of whole pages, whose boxes stand together."""
    col = {c: pages[c].to_numpy() for c in ("x0", "x1", "top", "bottom", "h", "middle", "place")}
    text = pages["text"].combine_chunks()
    page = np.cumsum(col["place"] == 1)
    v = np.abs(col["middle"])
    height = np.copysign(np.floor(v) + (v - np.floor(v) >= 0.5), col["middle"])  # half up, as round() does
    order = _ordered(text, page, height, col["x0"], col["x1"], col["h"])
    x0, x1, h = (col[c][order] for c in ("x0", "x1", "h"))
    page, height, text = page[order], height[order], text.take(pa.array(order))

    # lines and their cells
    line = _starts(page, height)
    gap = np.concatenate([[True], x0[1:] - x1[:-1] > np.maximum(h[:-1] * 0.8, 3.0)])
    gap[line] = True
    cell = np.flatnonzero(gap)
    n_cells = np.diff(np.append(np.searchsorted(cell, line), len(cell)))
    top, bottom, right = np.minimum.reduceat(col["top"][order], line), np.maximum.reduceat(col["bottom"][order], line), np.maximum.reduceat(x1, line)
    cell_x0, cell_x1, cell_text = x0[cell], np.maximum.reduceat(x1, cell), _joined(text, np.diff(np.append(cell, len(x0))))

    # runs of lines of two cells or more
    by = np.lexsort((bottom, top, page[line]))
    first_cell = (np.cumsum(n_cells) - n_cells)[by]
    line, top, bottom, right, n_cells = line[by], top[by], bottom[by], right[by], n_cells[by]
    of, tabular = page[line], n_cells >= 2
    opens = np.concatenate([[True], (tabular[1:] != tabular[:-1]) | (top[1:] - bottom[:-1] > max_gap * (bottom[1:] - top[1:])) | (of[1:] != of[:-1])])
    number = np.cumsum(opens)
    page_first = _starts(of)
    number -= np.repeat(number[page_first] - 1, np.diff(np.append(page_first, len(of))))
    run = np.cumsum(opens & tabular) - 1
    n_lines = np.bincount(run[tabular], minlength=run.max() + 1)

    # columns between the gutters of runs that have some and enough lines
    own_cell = _spread(first_cell[tabular], n_cells[tabular])
    g_run, g_mid = gutters_of(np.repeat(run[tabular], n_cells[tabular]), cell_x0[own_cell], cell_x1[own_cell], n_lines, min_gutter, spill) if len(own_cell) else (run[:0], top[:0])
    n_columns = np.bincount(g_run, minlength=len(n_lines)) + 1
    kept = np.flatnonzero(tabular & ((n_columns > 1) & (n_lines >= min_lines))[np.where(tabular, run, 0)]) if len(n_lines) else run[:0]
    line, top, bottom, right, n_cells, first_cell, number = (a[kept] for a in (line, top, bottom, right, n_cells, first_cell, number))
    ids, run = np.unique(run[kept], return_inverse=True)
    n_columns = n_columns[ids]
    own_cell, of_line = _spread(first_cell, n_cells), np.repeat(np.arange(len(line)), n_cells)
    own = np.isin(g_run, ids)
    g_run, g_mid = np.searchsorted(ids, g_run[own]), g_mid[own]
    # a cell's column is the number of its run's gutters before its middle
    is_gutter = np.repeat([1, 0], [len(g_run), len(own_cell)])
    c_run = run[of_line]
    swept = np.lexsort((is_gutter, np.concatenate([g_mid, cell_x0[own_cell] + cell_x1[own_cell]]), np.concatenate([g_run, c_run])))
    before = np.empty(len(swept), np.int64)
    before[swept] = np.cumsum(is_gutter[swept])
    place = before[len(g_run):] - (np.cumsum(n_columns - 1) - (n_columns - 1))[c_run]

    # a text per line and column
    width = n_columns[run]
    place += (np.cumsum(width) - width)[of_line]
    cell_text = cell_text.take(pa.array(own_cell))
    held = np.bincount(place, minlength=width.sum())
    value = _joined(cell_text.take(pa.array(np.argsort(place, kind="stable"))), held)
    value = pc.if_else(pa.array(held > 0), value, pa.scalar(None, value.type))
    plain = pc.replace_substring_regex(cell_text, "[,$]", "")
    numeric = np.bincount(of_line, pc.match_substring_regex(plain, NUMBER).to_numpy(zero_copy_only=False), minlength=len(line)) > 0
    body = np.full(len(ids), np.inf)
    np.minimum.at(body, run[numeric], top[numeric])
    body[np.bincount(run, numeric, minlength=len(ids)) == 0] = -np.inf
    is_header = top < body[run]

    # a header's texts by column, from above
    said = np.flatnonzero(np.repeat(is_header, width) & (held > 0))
    said_line = np.repeat(np.arange(len(line)), width)[said]
    column = said - (np.cumsum(width) - width)[said_line] + (np.cumsum(n_columns) - n_columns)[run[said_line]]
    said_text = value.take(pa.array(said))
    header = _joined(said_text.take(pa.array(_ordered(said_text, column, top[said_line]))), np.bincount(column, minlength=n_columns.sum()))
    lists = lambda n, flat: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), flat)
    box = pa.array(order[line])
    return pa.table({**{c: pages[c].combine_chunks().take(box) for c in PAGE}, "run": pa.array(number, pa.int64()), "top": top, "bottom": bottom, "x0": x0[line], "x1": right,
                     "n_cells": pa.array(n_cells, pa.int32()), "is_header": pa.array(is_header), "values": lists(width, value), "headers": lists(n_columns, header).take(pa.array(run))})


def long_page_rows(boxes: DataFrame, min_lines: int, max_gap: float, min_gutter: float, spill: float) -> DataFrame:
    """``table_rows``, a page by several tasks."""
    runs = line_runs(page_lines(boxes), max_gap)
    own = runs.join(gutters(runs, min_gutter, spill).filter(F.col("n_lines") >= min_lines), RUN)
    column = F.transform("cells", lambda c: F.struct(F.size(F.filter("gutters", lambda g: g["lo"] + g["hi"] < c["x0"] + c["x1"])).alias("k"), c["text"].alias("text")))
    own = own.withColumn("own", column)
    joined = lambda k: F.aggregate("own", F.lit(None).cast("string"), lambda said, c: F.when(c["k"] == k, F.concat_ws(" ", said, c["text"])).otherwise(said))
    values = F.transform(F.sequence(F.lit(0), F.size("gutters")), joined)
    rows = own.select(*RUN, "top", "bottom", F.element_at("cells", 1)["x0"].alias("x0"), F.array_max(F.transform("cells", lambda c: c["x1"])).alias("x1"),
                      F.size("cells").alias("n_cells"), F.coalesce(F.col("top") < F.col("body_top"), F.lit(False)).alias("is_header"), values.alias("values"))
    said = rows.filter("is_header").select(*RUN, "top", F.posexplode("values").alias("col", "value")).groupBy(*RUN, "col").agg(
        F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("top", "value")))).alias("said"))
    headers = said.groupBy(*RUN).agg(F.array_sort(F.collect_list(F.struct("col", F.array_join(F.transform("said", lambda s: s["value"]), " ").alias("header")))).alias("heads"))
    heads = F.coalesce(F.transform("heads", lambda c: c["header"]), F.transform("values", lambda v: F.lit("")))
    return rows.join(headers, RUN, "left").select(*rows.columns, heads.alias("headers"))


def column_values(rows: DataFrame) -> DataFrame:
    """A row per line of a candidate and column, with ``value``, its ``kind`` (null where there is none) and the column's ``header``."""
    cells = rows.select(*RUN, "top", "bottom", "x0", "x1", "n_cells", "is_header", F.posexplode(F.arrays_zip("values", "headers")).alias("col", "both"))
    cells = cells.select("*", F.col("both.values").alias("value"), F.col("both.headers").alias("header")).drop("both")
    return cells.withColumn("kind", F.when(F.col("value").rlike(DATE), "date").when(to_number("value").isNotNull(), "number").when(F.col("value").isNotNull(), "text"))


def found_columns(values: DataFrame, *more: Column) -> DataFrame:
    """Per candidate and column, of ``column_values``: ``header`` (its header lines joined, or empty), ``kind``, ``filled``,
    ``n_number``, ``n_date``, ``n_text``, its lines' extent and counts, and the aggregates ``more``.

    The kind that most of the body's values have; of equals, or without any, number before date before text.
    """
    body = ~F.col("is_header")
    n = lambda k: F.count_if(body & (F.col("kind") == k))
    cols = values.groupBy(*RUN, "col", "header").agg(
        F.count(F.when(body, F.col("value"))).alias("filled"),
        n("number").alias("n_number"), n("date").alias("n_date"), n("text").alias("n_text"), F.count("value").alias("hit"), F.count_if(body).alias("n_rows"),
        F.sum("n_cells").alias("n_cells"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("top").alias("top"), F.max("bottom").alias("bottom"), *more)
    most = F.greatest("n_number", "n_date", "n_text")
    return cols.withColumn("kind", F.when(F.col("n_number") == most, "number").when(F.col("n_date") == most, "date").otherwise("text"))


def table_regions(rows: DataFrame) -> DataFrame:
    """One row per candidate of ``table_rows``: region, size, headers, column kinds, confidence.

    Confidence is the share of the body's places that are filled, times the
    mean over columns of their main kind's share, times the columns hit per
    cell (cells that share a column speak against it).
    """
    own = found_columns(column_values(rows)).groupBy(*RUN).agg(
        F.min("x0").alias("x"), F.min("top").alias("y"), F.max("x1").alias("right"), F.max("bottom").alias("low"), F.count(F.lit(1)).alias("n_columns"),
        F.max("n_rows").alias("n_rows"), F.sum("hit").alias("hit"), F.max("n_cells").alias("n_cells"), F.sum("filled").alias("filled"),
        F.sum(F.greatest("n_number", "n_date", "n_text") / F.greatest("filled", F.lit(1))).alias("pure"),
        F.array_sort(F.collect_list(F.struct("col", "header", "kind"))).alias("cols"))
    confidence = F.try_divide("filled", F.col("n_rows") * F.col("n_columns")) * (F.col("pure") / F.col("n_columns")) * (F.col("hit") / F.col("n_cells"))
    return own.select(*RUN, "x", "y", (F.col("right") - F.col("x")).alias("w"), (F.col("low") - F.col("y")).alias("h"), "n_columns", "n_rows",
                      F.transform("cols", lambda c: c["header"]).alias("headers"), F.transform("cols", lambda c: c["kind"]).alias("kinds"),
                      F.round(confidence, 4).alias("confidence"))


@dataclass(frozen=True)
class Wanted:
    """A wanted column: what is known of it. Only what is given counts in the score."""

    name: str
    hints: tuple[str, ...] = ()
    kind: str | None = None
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    domain: str | None = None


def schema_scores(rows: DataFrame, wanted: Sequence[Wanted], members: DataFrame | None = None) -> DataFrame:
    """The columns of ``table_rows`` with ``scores``, per wanted column an integer from 0 to 1000.

    A score is the mean of the evidence that the wanted column names: the
    header against the hints (1 if equal when folded, else the greatest share
    of shared words), and the shares of the body's values that have the kind,
    fit the pattern, lie within the bounds and are labels of the domain
    (``members(domain_name, key)``). A column without values has shares of 0.
    """
    values = column_values(rows).withColumn("number", F.when(~F.col("is_header"), to_number("value")))
    domains = sorted({w.domain for w in wanted if w.domain})
    if domains:
        labels = members.filter(F.col("domain_name").isin(domains)).groupBy(F.col("key").alias("label")).agg(F.collect_set("domain_name").alias("domains"))
        values = values.withColumn("label", F.when(~F.col("is_header"), fold_label("value"))).join(materialised(labels), "label", "left")
    aggs = []
    for i, w in enumerate(wanted):
        within = (F.lit(True) if w.minimum is None else F.col("number") >= w.minimum) & (F.lit(True) if w.maximum is None else F.col("number") <= w.maximum)
        aggs += [F.count_if(~F.col("is_header") & F.col("value").rlike(w.pattern)).alias(f"_pattern{i}")] if w.pattern else []
        aggs += [F.count_if(within & F.col("number").isNotNull()).alias(f"_within{i}")] if w.minimum is not None or w.maximum is not None else []
        aggs += [F.count_if(F.array_contains("domains", w.domain)).alias(f"_domain{i}")] if w.domain else []
    # once a column, not once a hint
    own = found_columns(values, *aggs).withColumn("_header", fold_label("header")).withColumn("_words", header_words(F.col("_header")))
    share = lambda c: F.col(c) / F.greatest("filled", F.lit(1))
    scores = []
    for i, w in enumerate(wanted):
        parts = [header_score(F.col("_header"), F.col("_words"), w.hints)] if w.hints else []
        parts += [share(f"n_{w.kind}")] if w.kind else []
        parts += [share(f"_{p}{i}") for p in ("pattern", "within", "domain") if f"_{p}{i}" in own.columns]
        scores.append(F.round(sum(parts, F.lit(0.0)) / max(len(parts), 1) * 1000).cast("int"))
    return own.select(*RUN, "col", "header", "kind", F.array(*scores).alias("scores"))


def header_words(header: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(header, r"[^\p{L}\p{N}]+"), ""))


def header_score(header: Column, words: Column, hints: Sequence[str]) -> Column:
    """Of a folded header and its ``header_words``; what concerns a hint alone is folded to a constant (without lambdas, which aren't)."""
    def one(hint: str) -> Column:
        own = header_words(fold_label(F.lit(hint)))
        both = F.size(F.array_intersect(words, own))
        return F.when(header == fold_label(F.lit(hint)), 1.0).otherwise(F.coalesce(F.try_divide(both, F.size(words) + F.size(own) - both), F.lit(0.0)))

    return F.greatest(*[one(h) for h in hints], F.lit(0.0))


def assign(columns: Column, n_wanted: int, least: int) -> Column:
    """The best one-to-one assignment of ``columns`` (array of ``(col, scores)``) to ``n_wanted`` columns, exact.

    A sum of scores over sets of wanted columns is carried from column to
    column (``2 ** n_wanted`` sums, so a schema should have no more than about
    10 columns), for a batch of candidates at once. Pairs that score below
    ``least`` are never assigned. Of equal sums the one that gives earlier
    wanted columns the earlier found columns. Gives ``(score, picks)``: per
    wanted column the found one, or null.
    """

    @F.arrow_udf("struct<score: int, picks: array<int>>")
    def assigned(found: pa.Array) -> pa.Array:
        size = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
        parts = dict(zip(("col", "scores"), found.flatten().flatten()))
        score = pc.fill_null(parts["scores"].flatten(), -1).to_numpy(zero_copy_only=False).reshape(-1, n_wanted)
        col = parts["col"].to_numpy(zero_copy_only=False)
        start = np.cumsum(size) - size
        total, picks = np.zeros(len(size), np.int32), np.full((len(size), n_wanted), -1, np.int64)
        for m in np.unique(size[size > 0]):
            own = np.flatnonzero(size == m)
            at = start[own][:, None] + np.arange(m)
            total[own], place = best_picks(score[at], least)
            picks[own] = np.where(place < 0, -1, col[np.take_along_axis(at, np.maximum(place, 0), axis=1)])
        flat = pa.array(picks.ravel(), pa.int32(), mask=picks.ravel() < 0)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * n_wanted, pa.int32()), flat)
        return pa.StructArray.from_arrays([pa.array(total), lists], names=["score", "picks"])

    return assigned(columns)


def best_picks(score: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``score[candidate, found column, wanted column]`` the best sums, and the found columns' places by wanted column (-1: none).

    A sum and its picks are one number, the sum before a digit per wanted
    column that is higher for earlier places, so the greatest number is the
    best assignment. Numbers beyond 64 bits are Python's.
    """
    n, m, k = score.shape
    base = int(m) + 1
    unit = base**k
    kind = np.int64 if (max(int(score.max()), 1) * k + 1) * unit < 1 << 60 else object
    never = -(1 << 60) if kind is np.int64 else -(max(int(score.max()), 1) * k + 1) * unit * 2
    sums = np.full((n, 1 << k), never, kind)
    sums[:, 0] = 0
    for place in range(m):
        before = sums.copy()
        for i in range(k):
            own = score[:, place, i].astype(kind)
            gain = np.where(score[:, place, i] >= least, own * unit + (base - 1 - place) * base ** (k - 1 - i), never)[:, None]
            held = np.flatnonzero(np.arange(1 << k) >> i & 1)
            sums[:, held] = np.maximum(sums[:, held], before[:, held ^ (1 << i)] + gain)
    best = sums.max(axis=1)
    digits = np.stack([best // base ** (k - 1 - i) % base for i in range(k)], axis=1).astype(np.int64)
    return (best // unit).astype(np.int32), np.where(digits > 0, m - digits, -1)


def schema_match(rows: DataFrame, wanted: Sequence[Wanted], members: DataFrame | None = None, *, least: float = 0.5) -> DataFrame:
    """Per candidate the columns assigned to ``wanted``: ``score`` (0 to 1, of all wanted) and one ``picks`` entry each.

    Rows as ``table_rows`` gives them. Candidates without any assigned column
    stay, with score 0.
    """
    scored = schema_scores(rows, wanted, members)
    regions = scored.groupBy(*RUN).agg(F.array_sort(F.collect_list(F.struct("col", "scores"))).alias("columns"))
    best = assign(F.col("columns"), len(wanted), round(least * 1000))
    return regions.select(*RUN, best.alias("best")).select(*RUN, F.round(F.col("best.score") / (1000.0 * len(wanted)), 4).alias("score"), F.col("best.picks").alias("picks"))


def best_candidates(matched: DataFrame) -> DataFrame:
    """The best candidate of each document, of equals the first; ``matched`` as ``schema_match`` gives it."""
    return matched.groupBy("doc_id").agg(F.max_by(F.struct("page_id", "run", "score", "picks"), F.struct(
        "score", -F.col("page_id"), -F.col("run"))).alias("b")).select("doc_id", "b.*")


def price_like(boxes: DataFrame, large: float = 20.0) -> DataFrame:
    """Boxes that hold a currency sign or are ``large`` or higher; the reader orders by ``doc_id, page_id, y, x``."""
    return boxes.filter(F.col("text").rlike(r"[$€£¥]") | (F.col("h") >= large))


def page_signatures(tokens: DataFrame, members: DataFrame, min_share: float = 0.1) -> DataFrame:
    """``doc_id, page_id, domains``: the domains that hold ``min_share`` or more of a page's distinct folded texts.

    Pages without any have an empty list; null texts don't count.
    """
    distinct = tokens.select(*PAGE, fold_label("text").alias("key")).distinct()
    total = distinct.groupBy(*PAGE).agg(F.count("key").alias("n"))
    hit = distinct.join(members.select("domain_name", "key").distinct(), "key").groupBy(*PAGE, "domain_name").agg(F.count(F.lit(1)).alias("c"))
    kept = total.join(hit, PAGE, "left").groupBy(*PAGE).agg(F.array_sort(F.collect_set(F.when(F.col("c") >= min_share * F.col("n"), F.col("domain_name")))).alias("domains"))
    return kept


def page_runs(signatures: DataFrame, min_similarity: float = 0.5, pages_per_band: int = 512) -> DataFrame:
    """Runs of pages whose domains are similar to the page before: ``doc_id, run, first_page, last_page, n_pages, domains``.

    Similarity is the Jaccard share; two pages without domains are alike. A
    document of many pages is put in order by several tasks, and runs go on
    over their edges.
    """

    def breaks(before: Column, here: Column) -> Column:
        both, either = F.size(F.array_intersect(before["domains"], here["domains"])), F.size(F.array_union(before["domains"], here["domains"]))
        return F.when(either == 0, False).otherwise(both / either < min_similarity)

    numbered = number_runs(signatures, ["doc_id"], ["page_id"], ["domains"], breaks, band=F.floor(F.col("page_id") / pages_per_band))
    sizes = numbered.groupBy("doc_id", "run").agg(F.min("page_id").alias("first_page"), F.max("page_id").alias("last_page"), F.count(F.lit(1)).alias("n_pages"))
    named = numbered.select("doc_id", "run", F.explode("domains").alias("d")).groupBy("doc_id", "run").agg(F.array_sort(F.collect_set("d")).alias("domains"))
    return null_safe_left(sizes, named, ["doc_id", "run"]).withColumn("domains", F.coalesce("domains", F.array().cast("array<string>")))
