"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return put


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)


@query("op9_langid")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def byte_bpe_paths() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), byte_bpe_paths, size=1024, end_id=0)


#: Lines as the operator compares them; near: one substitution, or one character more.
LINE_SQL = r"""
WITH split AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place, unnest(string_split(text, chr(10))) AS line FROM documents),
norm AS (
  SELECT doc_id, place, line, lower(trim(regexp_replace(line, '[ \t\r\f\v]+', ' ', 'g'), ' ')) AS n FROM split),
node AS (SELECT n, min((doc_id, place)) AS first, length(n) AS len FROM norm WHERE n <> '' GROUP BY n),
part AS (
  SELECT n, len, first, h, unnest([hash(0, h, n[1:h]), hash(1, h, right(n, h))]) AS k
  FROM (SELECT *, unnest(list_distinct([len // 2, (len - 1) // 2])) AS h FROM node WHERE len >= 16)),
pair AS (
  SELECT DISTINCT a.n AS a, b.n AS b FROM part a JOIN part b ON a.k = b.k AND a.h = b.h AND b.first < a.first AND abs(a.len - b.len) <= 1),
near AS (
  SELECT DISTINCT a FROM pair WHERE CASE
    WHEN length(a) = length(b) THEN len(list_filter(range(1, length(a) + 1), lambda i: a[i:i] <> b[i:i])) = 1
    WHEN length(a) < length(b) THEN list_contains(list_transform(range(1, length(b) + 1), lambda i: left(b, i - 1) || substr(b, i + 1)), a)
    ELSE list_contains(list_transform(range(1, length(a) + 1), lambda i: left(a, i - 1) || substr(a, i + 1)), b) END),
fate AS (
  SELECT m.doc_id, m.place, m.line, (m.n <> '' AND (m.doc_id, m.place) > d.first) AS equal,
         (m.n <> '' AND r.a IS NOT NULL AND (m.doc_id, m.place) = d.first) AS near,
         (m.n <> '' AND ((m.doc_id, m.place) > d.first OR r.a IS NOT NULL)) AS gone
  FROM norm m LEFT JOIN node d ON m.n = d.n LEFT JOIN near r ON m.n = r.a)
SELECT d.doc_id, d.lang, d.source, d.n_chars,
       coalesce(string_agg(f.line, chr(10) ORDER BY f.place) FILTER (NOT f.gone), CASE WHEN d.text IS NOT NULL THEN '' END) AS text,
       count(f.place) AS n_lines, count(*) FILTER (f.equal) AS n_equal, count(*) FILTER (f.near) AS n_near
FROM documents d LEFT JOIN fate f ON d.doc_id = f.doc_id GROUP BY d.doc_id, d.lang, d.source, d.n_chars, d.text
"""


@query("op1_line_dedup", LINE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.lines import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents"), min_chars=16)


@query("op1_line_dedup_edits2")
def op1_edits2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same within two edits, which LINE_SQL doesn't say."""
    from vellum.llm.lines import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents"), min_chars=16, edits=2)


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ARCHIVE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, payload_bytes, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY ALL)
SELECT d.page_id, d.payload_bytes, d.payload_digest, CASE WHEN f.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND d.payload_bytes = f.payload_bytes
"""


@query("op4_warc", ARCHIVE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vellum.llm.common import Scratch
    from vellum.llm.warc import read_archive, write_archive

    path = Scratch(spark, "archive").path("records")
    write_archive(table(spark, sf_dir, "pages"), path)
    records = read_archive(spark, path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    revisit = F.col("type") == "revisit"
    return records.select(
        page("record_id").alias("page_id"), F.when(revisit, F.col("told_size")).otherwise(F.col("content_size")).alias("payload_bytes"),
        F.when(revisit, F.substring_index("told_digest", ":", -1)).otherwise(F.col("content_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, page("refers_to")).alias("refers_to"))

URL_RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.urls import Rule, judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), [Rule.parse(r) for r in URL_RULES])


@query("op5_embedding_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.vectors import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.suffixes import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=50).drop("spans")


def chat_records(conversations: DataFrame) -> DataFrame:
    """Stand-in records ``(conv_id, record)``: each conversation as JSON in one of the layouts that can hold it.

    Rows are ordered by turn (null last, then role and text), null text is
    empty. The layout goes by the conversation's id, among those for its roles.
    """
    from pyspark.sql import functions as F

    turn = F.struct(F.col("turn").isNull().alias("late"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("rows"))
    roles, at = F.transform("rows", lambda r: r.role), lambda i: F.element_at("rows", i).text
    named = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"))
    told = lambda role, text: lambda r: F.struct(r.role.alias(role), r.text.alias(text))
    any_roles = [
        F.struct(F.transform("rows", told("role", "content")).alias("messages")),
        F.struct(F.transform("rows", lambda r: F.struct(r.role.alias("role"), F.array(F.struct(
            F.lit("text").alias("type"), r.text.alias("text"))).alias("content"))).alias("messages")),
        F.struct(F.struct(F.transform("rows", told("speaker", "utterance")).alias("dialog")).alias("data"))]
    known = F.struct(F.transform("rows", lambda r: F.struct(F.coalesce(named[r.role], r.role).alias("from"), r.text.alias("value"))).alias("conversations"))
    pair = [F.struct(at(1).alias("prompt"), at(2).alias("completion")), F.struct(at(1).alias("question"), at(2).alias("answer")),
            F.struct(at(1).alias("instruction"), F.lit("").alias("input"), at(2).alias("output"))]
    triple = [F.struct(at(1).alias("system"), at(2).alias("question"), at(3).alias("answer"))]
    text = lambda s: F.to_json(s, {"ignoreNullFields": "false"})

    def dealt(choices):
        which = F.pmod(F.xxhash64("conv_id"), F.lit(len(choices)))
        out = text(choices[-1])
        for i, c in enumerate(choices[:-1]):
            out = F.when(which == i, text(c)).otherwise(out)
        return out

    usual = [*any_roles, known]
    record = (F.when(roles == F.array(F.lit("user"), F.lit("assistant")), dealt(usual + pair))
              .when((roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))) & (at(1) != ""), dealt(usual + triple))
              .when(F.forall(roles, lambda r: r.isin("system", "user", "assistant")), dealt(usual)).otherwise(dealt(any_roles)))
    return rows.select("conv_id", record.alias("record"))


CHAT_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn>' || role || chr(10) || regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g') || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""


@query("op12_chat_format", CHAT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, digested from what ``read_back`` finds in the formatted text and its mask.

    A conversation is one record, so its rows meet in one row: a value's size bounds it.
    """
    from pyspark.sql import functions as F

    from vellum.llm.chat import format_chats, read_back

    odd = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    back = read_back(format_chats(chat_records(rows)))
    said = F.array_join(F.transform("read_turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("read_loss", "")
    return back.select("conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100000)


def both_tokenizers():
    import public_tokenizers as files

    from vellum.llm.align import Paths

    return Paths(*(str(files.path(n)) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.align import align

    return align(table(spark, sf_dir, "documents"), both_tokenizers)[0]
