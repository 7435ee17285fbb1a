"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: one record per row; of rows with equal payloads the first is a
response and the others are revisits that refer to it. Records end in two line
ends, which is the writer's line separator, so files are plain WARC and a task
that is run again replaces its file.

Reading: files are split at every occurrence of the record magic, real or
inside a payload, by Spark's line reader, so large files are read by many
tasks. Each piece is a candidate record whose header names the offset of its
successor. Within a split, pointer jumping gives for each candidate the offset
at which its chain leaves the split; across splits, pointer jumping from the
file's start marks the split entries that are reached. Candidates off the
chain are payload, and go back to the record they lie in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellum.llm.common import Scratch

VERSION = "WARC/1.1"
MAGIC = f"{VERSION}\r\n"
EDGE = "\r\n\r\n"  # ends a header, and a record
#: What a revisit of an equal payload says, and the date of a record without one.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"


def classify(pages: DataFrame, scratch: Scratch, *, id_col: str, payload_col: str, min_revisit: int) -> DataFrame:
    """The revisits, narrow: ``(page_id, digest, refers_to)``, by payload digest; the first of a payload isn't among them.

    Only groups of two ids or more leave a row, and the row has no payload.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    marks = pages.select(F.col(id_col).cast("long").alias("page_id"), F.octet_length(payload).alias("n"), F.sha2(payload, 256).alias("digest")).filter(F.col("n") >= min_revisit)
    first = marks.groupBy("digest", "n").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("c")).filter("c > 1 and refers_to is not null").drop("c")
    again = marks.join(first, ["digest", "n"]).filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()
    return scratch.put(again, "revisits")


def write_archive(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date_col: str | None = None, min_revisit: int = 100) -> None:
    """Write a record per row of ``pages`` to text files under ``path``.

    A null payload is empty, a null url is ``about:blank``; ``date_col`` is a
    timestamp, and without one (or where it is null) the date is the epoch.
    Other columns are ignored, whatever their names; an empty table gives an
    archive without records; a payload is one value, however long. Payloads of at
    least ``min_revisit`` bytes that are equal share one response, that of the
    smallest id (each row of that id, if it is repeated); a null id is never
    the smallest, and is a revisit if some other row has an id.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    stamp = F.date_format(F.col(date_col).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date_col else F.lit(None).cast("string")
    own = pages.select(F.coalesce(stamp, F.lit(NO_DATE)).alias("date"), F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.regexp_replace(url_col, r"[\r\n]", " "), F.lit("about:blank")).alias("url"), payload.alias("payload"))
    again = classify(pages, scratch, id_col=id_col, payload_col=payload_col, min_revisit=min_revisit).withColumnRenamed("page_id", "again_id")
    digest = F.sha2(F.encode("payload", "utf-8"), 256)
    typed = own.withColumn("d", digest).join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("d") == F.col("digest")), "left")
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    fields = [("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", uri(F.col("page_id"))),
              ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("url")), ("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
              ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("d"))), ("WARC-Payload-Length", F.octet_length("payload").cast("string")), ("WARC-Refers-To", F.when(revisit, uri(F.col("refers_to")))),
              ("Content-Length", F.octet_length(body).cast("string"))]
    head = F.concat_ws("\r\n", F.lit(VERSION), *(F.concat(F.lit(f"{k}: "), v) for k, v in fields))
    typed.select(F.concat(head, F.lit(EDGE), body)).write.option("lineSep", EDGE).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archive cut at every magic: ``(file, split, row, value)``; ``row`` orders the pieces of a split."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("value"))


def _int(name: str) -> Column:
    return F.least(F.col(name), F.lit(2**31 - 1)).cast("int")


def candidates(cut: DataFrame) -> DataFrame:
    """Each piece, narrow: its size, its header's fields, and how many bytes a record that starts here would have.

    ``digest`` is that of the payload if the piece is a whole record by itself.
    """
    text = F.col("value").cast("string")
    edge = F.instr(text, EDGE)
    head = F.when(edge > 0, F.substring(text, F.lit(1), edge - 1))
    size = F.octet_length("value")
    named = lambda k: F.regexp_extract(F.concat(F.lit("\r\n"), F.col("head")), rf"(?i)\r\n{k}:[ \t]*([^\r\n]*)", 1)
    out = cut.select("file", "split", "row", "value", size.alias("size"), head.alias("head")).withColumn("head_size", F.octet_length("head") + len(EDGE))
    out = out.withColumn("content", F.when(named("Content-Length").rlike(r"^\d{1,18}$"), named("Content-Length").cast("long")))
    whole = F.col("size") == F.col("head_size") + F.col("content") + len(EDGE)
    body = F.substring(F.col("value"), F.col("head_size") + 1, _int("content"))
    return out.select("file", "split", "row", "size", "content", "head_size", (F.lit(len(MAGIC)) + F.col("head_size") + F.col("content") + len(EDGE)).alias("span"),
                      *(named(k).alias(c) for k, c in (("WARC-Type", "type"), ("WARC-Record-ID", "id"), ("WARC-Refers-To", "refers"), ("WARC-Payload-Digest", "told"), ("WARC-Payload-Length", "told_size"))),
                      F.when(whole, F.sha2(body, 256)).alias("digest"))


def located(rows: DataFrame) -> DataFrame:
    """Adds ``at``, the offset of the magic before each piece, and ``to``, that of the successor its header names.

    Pieces and magics are all of a file's bytes, so offsets are running sums:
    within a split, and over the sums of the splits before it.
    """
    step = F.col("size") + len(MAGIC)
    sums = rows.groupBy("file", "split").agg(F.sum(step).alias("bytes"))
    base = sums.withColumn("base", F.coalesce(F.sum("bytes").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.coalesce(F.sum(step).over(Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = rows.withColumn("within", within).join(base, ["file", "split"])
    # the file's first piece has no magic before it
    return out.withColumn("at", F.col("base") + F.col("within") - len(MAGIC)).withColumn("to", F.col("at") + F.col("span")).drop("within", "bytes", "base")


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split, where its chain leaves the split; -1 if it breaks off before."""
    pdf = pdf.sort_values("at")
    at, to = pdf["at"].to_numpy(np.int64), pdf["to"].fillna(-1).to_numpy(np.int64)
    n = len(at)
    spot = np.searchsorted(at, to)
    inside = (to >= 0) & (spot < n)
    inside[inside] = at[spot[inside]] == to[inside]
    broken = (to < 0) | (~inside & (to <= at[-1]))
    jump = np.where(inside, spot, np.arange(n))
    while True:  # pointer jumping: the last candidate of each chain within the split
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    exits = np.where(broken[jump], -1, to[jump])
    return pd.DataFrame({"file": pdf["file"].to_numpy(), "split": pdf["split"].to_numpy(), "at": at, "exit": exits})


def _reached(key: tuple, rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split that its entry's chain visits."""
    rows = rows.sort_values("at")
    at, to = rows["at"].to_numpy(np.int64), rows["to"].fillna(-1).to_numpy(np.int64)
    follow, chain = dict(zip(at.tolist(), to.tolist(), strict=True)), []
    for here in entries["at"].tolist():
        while here in follow:
            chain.append(here)
            here = follow[here]
    return pd.DataFrame({"file": key[0], "split": key[1], "at": pd.Series(sorted(set(chain)), dtype="int64")})


def reachable(cands: DataFrame, scratch: Scratch) -> DataFrame:
    """``(file, split, at)`` of the candidates on the chain from their file's start."""
    slim = cands.filter("at >= 0").select("file", "split", "at", "to")
    exits = scratch.put(slim.groupBy("file", "split").applyInPandas(_exits, "file string, split long, at long, exit long"), "exits")
    # nodes: the candidates at which some chain enters a split, or a file begins
    entries = exits.filter("at = 0").select("file", "at").unionByName(exits.filter("exit >= 0").select("file", F.col("exit").alias("at"))).distinct()
    jumps = scratch.put(exits.join(entries, ["file", "at"]).select("file", "split", "at", F.col("exit").alias("to")), "jumps-0")
    reached = jumps.filter("at = 0").select("file", "at", "split")
    turn = 0
    while True:  # the set doubles its reach: what is reached leaps to its image, and leaps double in length
        leap = jumps.select(F.col("file").alias("f2"), F.col("at").alias("mid"), F.col("to").alias("to2"))
        more = reached.join(leap, (F.col("file") == F.col("f2")) & (F.col("at") == F.col("mid"))).select("file", F.col("to2").alias("at"))
        more = more.join(jumps.select("file", "at", "split"), ["file", "at"]).select("file", "at", "split")
        grown = scratch.put(reached.unionByName(more).distinct(), f"reached-{turn + 1}")
        if grown.count() == reached.count():
            break
        reached = grown
        jumps = scratch.put(jumps.join(leap, (F.col("file") == F.col("f2")) & (F.col("to") == F.col("mid")), "left").select("file", "split", "at", F.coalesce("to2", F.lit(-1)).alias("to")), f"jumps-{turn + 1}")
        turn += 1
    entered = reached.select("file", "split", "at")
    return slim.groupBy("file", "split").cogroup(entered.groupBy("file", "split")).applyInPandas(_reached, "file string, split long, at long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``(file, at, type, record_id, refers_to, told_digest, told_size, content_size, content_digest)`` per record of the archive.

    ``content_digest`` is the SHA-256 of the bytes read. Bytes that no chain
    reaches, as after a broken record, belong to the last record before them
    and are cut off by its length; an empty archive gives no rows.
    """
    scratch = Scratch(spark, "warc-read")
    cands = scratch.put(located(candidates(pieces(spark, path))), "candidates")
    chain = scratch.put(reachable(cands, scratch), "chain")
    records = cands.join(chain, ["file", "split", "at"])
    whole = records.filter(F.col("digest").isNotNull()).select("file", "at", "type", "id", "refers", "told", "told_size", "content", "digest")
    torn = scratch.put(records.filter(F.col("digest").isNull()).select("file", "split", "at", "to", "type", "id", "refers", "told", "told_size", "content", "head_size"), "torn")
    if torn.take(1):
        whole = whole.unionByName(_assembled(spark, path, cands, torn))
    return whole.select("file", "at", "type", F.col("id").alias("record_id"), F.col("refers").alias("refers_to"), F.col("told").alias("told_digest"),
                        F.col("told_size").cast("long").alias("told_size"), F.col("content").alias("content_size"), F.col("digest").alias("content_digest"))


def _assembled(spark: SparkSession, path: str, cands: DataFrame, torn: DataFrame) -> DataFrame:
    """Records with magics inside their payload, from all the pieces that lie in them; one record is one row."""
    mark = torn.select("file", "split", "at", F.col("at").alias("owner"), F.col("to").alias("end"))
    owner = F.last("owner", True).over(Window.partitionBy("file").orderBy("at", "split"))
    spans = cands.filter("at >= 0").select("file", "split", "row", "at").join(mark, ["file", "split", "at"], "left")
    spans = spans.withColumn("end", F.last("end", True).over(Window.partitionBy("file").orderBy("at", "split"))).withColumn("owner", owner).filter("at < end")
    parts = pieces(spark, path).join(spans.select("file", "split", "row", "at", "owner"), ["file", "split", "row"])
    bytes_ = parts.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
    magic = F.encode(F.lit(MAGIC), "utf-8")
    joined = F.aggregate("parts", F.encode(F.lit(""), "utf-8"), lambda acc, p: F.concat(acc, magic, p["value"]))
    made = bytes_.select(F.col("file").alias("f"), "owner", joined.alias("bytes"))
    out = torn.join(made, (F.col("file") == F.col("f")) & (F.col("at") == F.col("owner")))
    start = F.lit(len(MAGIC) + 1) + F.col("head_size")
    return out.select("file", "at", "type", "id", "refers", "told", "told_size", "content", F.sha2(F.substring(F.col("bytes"), start.cast("int"), _int("content")), 256).alias("digest"))
