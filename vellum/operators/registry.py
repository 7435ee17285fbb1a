"""API listings, change state, adapter configuration and response projections.

All functions are row-local expressions, equi-joins or partial aggregates:
nothing here looks at a table on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "struct<updated:string,swaggerUrl:string,openapiUrl:string>"
LISTING = f"map<string,struct<preferred:string,versions:map<string,{VERSION}>>>"


def listing_rows(bodies: DataFrame, body: str = "body", keep: Iterable[str] = ()) -> DataFrame:
    """Listing object -> one row per API with the version picked.

    ``provider:name`` splits at the first colon, a key without colon is both.
    The preferred version counts if it is listed, else the first one; an entry
    without versions gives no row.
    """
    rows = bodies.select(*keep, F.explode(F.from_json(body, LISTING)).alias("api_key", "entry"))
    versions = F.col("entry.versions")
    at = F.instr("api_key", ":")
    picked = F.coalesce(F.try_element_at(versions, F.col("entry.preferred")),
                        F.try_element_at(F.map_values(versions), F.lit(1)))
    rows = rows.filter(F.size(versions) > 0).withColumn("v", picked)
    return rows.select(
        *keep, "api_key",
        F.when(at > 0, F.substring_index("api_key", ":", 1)).otherwise(F.col("api_key")).alias("provider"),
        F.when(at > 0, F.expr("substr(api_key, instr(api_key, ':') + 1)")).otherwise(F.col("api_key")).alias("api_name"),
        F.col("v.updated").alias("updated"),
        F.coalesce(_text("v.swaggerUrl"), _text("v.openapiUrl")).alias("spec_url"))


def _text(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def change_status(listing: DataFrame, last_seen: DataFrame, force: bool = False) -> DataFrame:
    """``status`` of each listed API against ``last_seen(api_key, seen)``.

    unchanged: seen with the same time (never under ``force``); skipped: no
    specification address; updated: seen before; new: otherwise.
    """
    same = F.coalesce(F.col("seen") == F.col("updated"), F.lit(False)) & F.lit(not force)
    status = (F.when(same, "unchanged").when(F.col("spec_url").isNull(), "skipped")
               .when(F.col("seen").isNotNull(), "updated").otherwise("new"))
    return listing.join(last_seen, "api_key", "left").withColumn("status", status)


def next_state(changes: DataFrame, last_seen: DataFrame) -> DataFrame:
    """O2: state after a run: loaded APIs take their new time, all others keep what they had."""
    loaded = changes.filter(F.col("status").isin("new", "updated")).select("api_key", "updated", F.lit(True).alias("loaded"))
    both = last_seen.join(loaded, "api_key", "full_outer")
    return both.select("api_key", F.when(F.col("loaded"), F.col("updated")).otherwise(F.col("seen")).alias("seen"))


def since(events: DataFrame, floor: Column, ts: str = "commit_ts", kind: str = "change",
          kinds: Iterable[str] = ("A", "M")) -> DataFrame:
    """A3 + O1: events after ``floor`` of the given kinds; a null floor reads everything."""
    return events.filter((floor.isNull() | (F.col(ts) > floor)) & F.col(kind).isin(*kinds))


def needed_blobs(blobs: DataFrame, events: DataFrame, sha: str = "blob_sha") -> DataFrame:
    """A4: each blob that an event names, once; undecodable (null) contents are skipped."""
    return blobs.filter(F.col("content").isNotNull()).join(events.select(sha).distinct(), sha, "left_semi").dropDuplicates([sha])


CONFIG = ("name", "provider", "api", "path", "method", "call_jmespath", "prompt_template")


def adapter_rows(bodies: DataFrame, body: str = "body", keep: Iterable[str] = ()) -> DataFrame:
    """A9 + A10: configuration lists -> one row per adapter with its kind.

    The method is ``get`` unless given. A prompt template, or no response
    path, makes it a ``llm`` adapter.
    """
    rows = bodies.select(*keep, F.explode(F.from_json(body, "array<string>")).alias("entry"))
    rows = rows.select(*keep, *[F.get_json_object("entry", f"$.{c}").alias(c) for c in CONFIG])
    llm = F.col("prompt_template").isNotNull() | F.col("call_jmespath").isNull()
    return rows.withColumn("method", F.coalesce("method", F.lit("get"))).withColumn("kind", F.when(llm, "llm").otherwise("http"))


def adapter_join(responses: DataFrame, adapters: DataFrame) -> DataFrame:
    """Responses with their HTTP adapter's current version, on the four-part address."""
    on = ["provider", "api", "path", "method"]
    current = adapters.filter("kind = 'http' AND sys_to IS NULL").select(*on, F.col("name").alias("adapter"), "call_jmespath")
    return responses.join(current, on)


FILES = "struct<files:array<struct<id:string,name:string,mimeType:string,modifiedTime:string,size:string,parents:string>>>"
TABS = "struct<sheets:array<struct<properties:struct<title:string,sheetId:string,gridProperties:struct<rowCount:string,columnCount:string>>>>>"


def file_rows(bodies: DataFrame, body: str = "body", keep: Iterable[str] = ()) -> DataFrame:
    """A15 + A16: file listing -> rows; ``parents`` stays JSON text."""
    rows = bodies.select(*keep, F.inline(F.from_json(body, FILES)["files"]))
    return rows.select(*keep, "id", "name", F.col("mimeType").alias("mime_type"), F.col("modifiedTime").alias("modified"),
                       F.col("size").try_cast("long").alias("size"), "parents")


def tab_rows(bodies: DataFrame, body: str = "body", keep: Iterable[str] = ()) -> DataFrame:
    """Sheet tabs with their grid size; a size that is no integer is null."""
    rows = bodies.select(*keep, F.explode(F.from_json(body, TABS)["sheets"]["properties"]).alias("p"))
    grid = F.col("p.gridProperties")
    return rows.select(*keep, F.col("p.title").alias("title"), F.col("p.sheetId").try_cast("long").alias("sheet_id"),
                       grid["rowCount"].try_cast("int").alias("row_count"), grid["columnCount"].try_cast("int").alias("column_count"))


#: Longest text kept of each company field.
COMPANY_WIDTH = {"name": 500, "ticker": 10, "sic": 10, "sic_description": 200, "state": 10, "category": 100}
SUBMISSION = "struct<cik:string,name:string,tickers:array<string>,sic:string,sicDescription:string,stateOfIncorporation:string,category:string>"


def company_rows(bodies: DataFrame, body: str = "body", width: dict[str, int] | None = None) -> DataFrame:
    """Company submissions with an industry code; ids are padded to 10 digits, never cut."""
    width = width or COMPANY_WIDTH
    s = bodies.select(F.from_json(body, SUBMISSION).alias("s")).select("s.*").filter("sic <> '' AND sic <> '0000'")
    cik = F.coalesce("cik", F.lit(""))
    fields = {"name": F.col("name"), "ticker": F.try_element_at("tickers", F.lit(1)), "sic": F.col("sic"),
              "sic_description": F.col("sicDescription"), "state": F.col("stateOfIncorporation"), "category": F.col("category")}
    return s.select(F.when(F.length(cik) < 10, F.lpad(cik, 10, "0")).otherwise(cik).alias("cik"),
                    *[F.substring(F.coalesce(c, F.lit("")), 1, width[n]).alias(n) for n, c in fields.items()])
