"""Connected components by repeated contraction, as joins and aggregates.

Each round points every node at the smallest hashed neighbour, replaces the
ends of each link by what they point at, and drops links that became loops.
Links shrink by a constant factor a round, so the rounds are logarithmic; hot
nodes only meet in aggregates that combine before the shuffle and in
one-row-per-node joins, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, tag: str = "cc") -> DataFrame:
    """``links(a, b)`` of longs to ``(node, root)``: nodes of one component share one root.

    The root is some node of the component, not the smallest. Nodes without
    links don't appear; loops and repeated links do no harm; no links give no
    rows.
    """
    links = scratch.put(links.filter("a <> b").select("a", "b").distinct(), f"{tag}-links-0")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = scratch.put(ends.select("node", F.col("node").alias("root")), f"{tag}-labels-0")
    turn = 0
    while links.take(1):
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("v"))  # noqa: E731, B023
        both = links.select(F.col("a").alias("n"), rank(F.col("b")).alias("to")).unionByName(
            links.select(F.col("b").alias("n"), rank(F.col("a")).alias("to")))
        hop = both.groupBy("n").agg(F.min("to").alias("to")).select(
            "n", F.least(F.col("to"), rank(F.col("n")))["v"].alias("to"))
        hop = scratch.put(hop, f"{tag}-hop-{turn}")
        labels = scratch.put(
            labels.join(hop, labels.root == hop.n, "left").select("node", F.coalesce("to", "root").alias("root")),
            f"{tag}-labels-{turn + 1}")
        a, b = (hop.select(F.col("n").alias(c), F.col("to").alias(f"{c}2")) for c in "ab")
        links = scratch.put(
            links.join(a, "a").join(b, "b").filter("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(),
            f"{tag}-links-{turn + 1}")
        scratch.free(f"{tag}-links-{turn}", f"{tag}-labels-{turn}", f"{tag}-hop-{turn}")
        turn += 1
    return labels
