"""One query per operator over its whole table, with SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm import ann, bpe, chat, decontaminate, langid, licenses, pii, resampling, simhash, substrings, toxicity, warc, whitening
from skyflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL counterpart if there is one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def tokenizer_path() -> str:
    """The byte-level vocabulary the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_path() -> str:
    """The piece vocabulary the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


_SPLIT = r"""[x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']"""
PASSAGES_SQL = f"""
WITH docs AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_SPLIT} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS v
  FROM (SELECT *, least(len(w), 10) AS n FROM items WHERE len(w) > 0) b, unnest(generate_series(1, len(w) - n + 1)) AS s(i)
), windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS v
  FROM docs, (SELECT DISTINCT n FROM wanted) l, unnest(generate_series(1, len(w) - n + 1)) AS s(i) WHERE len(w) >= n
), found AS (SELECT doc_id, n, i, item FROM windows JOIN wanted USING (n, v)),
hits AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT DISTINCT doc_id, n, i FROM found) f, unnest(generate_series(0, n - 1)) AS s(k) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM found) f GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op8_decontaminate", PASSAGES_SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_licenses")
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op5_neighbours")
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before,
    length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS text_chars,
    length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN n > 1 AND before = role THEN length('<next>')
    ELSE length('<turn ></turn>') + 1 + role_chars END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op6_chat", CHAT_SQL)
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    said = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.report(conversations.union(added))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


REPEATS_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce([x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''], []) AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS v
  FROM words, unnest(generate_series(1, len(w) - 12)) AS s(i) WHERE len(w) >= 13
), firsts AS (SELECT v, min(doc_id) AS least FROM windows GROUP BY v),
hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (v) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, unnest(generate_series(0, 12)) AS s(k)),
places AS (SELECT doc_id, i, w[i] AS word FROM words, unnest(generate_series(1, len(w))) AS s(i)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query("op3_repeats", REPEATS_SQL)
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


ARCHIVES_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (SELECT payload_digest, min(page_id) AS least FROM p WHERE payload_bytes >= 100 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN least IS NOT NULL AND page_id IS DISTINCT FROM least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM p LEFT JOIN firsts USING (payload_digest)
"""


@query("op12_warc", ARCHIVES_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


# The table of the checksum is made from its polynomial, and applied to the bytes of every distinct word.
RESAMPLE_SQL = rf"""
WITH codes AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS codes
), texts AS (
  SELECT doc_id, row_number() OVER () AS r, {_SPLIT} AS w FROM documents
), doc_words AS (SELECT r, unnest(w) AS word FROM texts),
target_words AS (SELECT unnest({_SPLIT}) AS word FROM benchmark),
vocabulary AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words) v),
buckets AS (
  SELECT word, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(length(h) // 2), lambda i:
      instr('0123456789ABCDEF', h[2 * i + 1]) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 17),
    lambda c, b: xor(c // 256, codes[xor(c, b) % 256 + 1]))) % 10000 AS bucket
  FROM vocabulary, codes
), s AS (SELECT bucket, count(*) AS s FROM doc_words JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN buckets USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS all_s, (SELECT coalesce(sum(t), 0) FROM t) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), sums
), weighed AS (
  SELECT r, count(*) AS n, sum(gain) AS weight FROM doc_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT doc_id, r, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN weighed USING (r)
), ranks AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () * 10 // 100 AS wanted
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= wanted THEN rank END AS rank FROM scored LEFT JOIN ranks USING (r)
"""


@query("op13_resampling", RESAMPLE_SQL)
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
