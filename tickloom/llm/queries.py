"""The queries of this subpackage, one per operator, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    cover_tree,
    decontaminate,
    html_text,
    line_dedup,
    pieces,
    pii,
    prefix_trie,
    reply_trees,
    simhash,
    token_orc,
    toxicity,
    warc,
    whitening,
)
from tickloom.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file. Workers open it at the same path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", "text")


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    return token_orc.token_digests(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hex_text(F.col("fingerprint")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages"))
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archive_round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more, whose texts hold the template's own marks."""
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marks = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    return reply_trees.chat_digests(conversations.unionByName(more))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


QUERIES: tuple[Query, ...] = (
    op1_decontaminate,
    op2_toxicity,
    op3_topk,
    op4_pii,
    op5_line_dedup,
    op6_sentencepiece,
    op7_simhash,
    op8_token_orc,
    op9_html_text,
    op10_warc,
    op11_chat_format,
    op12_prefix_trie,
    op13_whitening,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


# --- SQL ----------------------------------------------------------------------------------------

# Base 32 of 20 bytes: 32 groups of five bits, taken from the hexadecimal digest.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST(list_sum(list_transform(range(5), lambda b:
    ((instr('0123456789abcdef', substr(sha, CAST((i * 5 + b) // 4 + 1 AS BIGINT), 1)) - 1) >> CAST(3 - (i * 5 + b) % 4 AS INTEGER)) % 2
    << CAST(4 - b AS INTEGER))) AS BIGINT), 1)), '')"""

_WARC = f"""WITH hashed AS (
  SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS sha FROM pages),
named AS (SELECT *, MAX(page_id) OVER (PARTITION BY sha) AS top FROM hashed)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM named"""


_WORDS = r"""regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_DECONTAMINATE = f"""WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, ws, least(len(ws), 13) AS t FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, t, array_to_string(ws[s + 1 : s + t], ' ') AS w
  FROM (SELECT *, UNNEST(range(len(ws) - t + 1)) AS s FROM i)),
dw AS (SELECT doc_id, t, s, array_to_string(ws[s + 1 : s + t], ' ') AS w
  FROM (SELECT doc_id, ws, t, UNNEST(range(len(ws) - t + 1)) AS s FROM d, (SELECT DISTINCT t FROM i) WHERE len(ws) >= t)),
met AS (SELECT doc_id, item_id, s, dw.t AS t FROM dw JOIN iw ON dw.w = iw.w AND dw.t = iw.t),
hit AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, UNNEST(range(s, s + t)) AS p FROM met) GROUP BY doc_id),
named AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit > 0 AND 20 * n_hit >= len(ws), FALSE) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

_TOPK = """WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5"""


def _escapes(text: str) -> str:
    """Characters that escaping adds: before backslashes, the third and further hashes of a run, end marks."""
    return f"""(len({text}) - len(replace({text}, chr(92), ''))
    + COALESCE(list_sum(list_transform(regexp_extract_all({text}, '#{{3,}}'), lambda r: len(r) - 2)), 0)
    + (len({text}) - len(replace({text}, '</turn>', ''))) // 7)"""


# Marks of the template: 4 and 5 characters around the role, 9 after the text.
_CHATS = f"""WITH said AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations UNION ALL
    SELECT -7, UNNEST([0, 1]), UNNEST(['user', 'assistant']), '\\### Assistant: </turn> ok')),
listed AS (
  SELECT conv_id, COUNT(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learnt,
    SUM(18 + len(role) + len(text) + {_escapes("role")} + {_escapes("text")}) AS chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(len(learnt) AS BIGINT) AS loss_chars,
  sha256(learnt) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM listed"""


# CRC-32 of a text of digits, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda r, s: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295)"""

_TRIE = f"""WITH own AS (
  SELECT conv_id AS c, list({{'role': COALESCE(role, ''), 'text': COALESCE(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
named AS (SELECT c, ts, {_CRC} % 9 AS h FROM own),
seq AS (
  SELECT n.c, list_concat(COALESCE(b.ts, [])[1:n.h], n.ts[n.h + 1:]) AS s FROM named n LEFT JOIN own b ON b.c = n.c - n.c % 5),
nodes AS (
  SELECT p, d, MIN(c) AS conv_id, COUNT(*) AS n_convs, (COUNT(*) - 1) * COALESCE(strlen(p[d].text), 0) AS saved
  FROM (SELECT c, d, s[1:d] AS p FROM (SELECT c, s, UNNEST(range(len(s) + 1)) AS d FROM seq)) GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, COUNT(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
known AS (SELECT n.*, COALESCE(n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.p = n.p),
totals AS (
  SELECT p[1:a] AS p, SUM(CAST(n_children = 0 AS BIGINT)) AS n_leaves, SUM(saved) AS saved_tokens
  FROM (SELECT *, UNNEST(range(d + 1)) AS a FROM known) GROUP BY ALL),
ends AS (SELECT s AS p, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM seq GROUP BY s)
SELECT k.conv_id, k.d AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(COALESCE(ids, '')) AS ends_sha256
FROM known k JOIN totals t ON t.p = k.p LEFT JOIN ends e ON e.p = k.p LEFT JOIN known u ON k.d > 0 AND u.p = k.p[1:k.d - 1]"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": _DECONTAMINATE,
        "op3_topk": _TOPK,
        "op10_warc": _WARC,
        "op11_chat_format": _CHATS,
        "op12_prefix_trie": _TRIE,
    }
