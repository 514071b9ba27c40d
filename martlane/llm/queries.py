"""Queries of the thirteen operators, with production parameters over the whole
tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.llm import align, ann, audit, bpe, chat, ctw, linededup, mixing, quality, secrets, simhash, suffixes, toxicity
from martlane.llm.base import crc_mod, table

BPE_FILE = "word_bpe_49k.json"


def bpe_path(name: str = BPE_FILE) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_ordered(table(spark, sf_dir, "conversations"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", "removed", F.sha2("text", 256).alias("text_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"), "weight", "block", "start")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, max_bits=2)


def op7_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 10) == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe(docs, bpe_path(), outputs=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op10_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), a="byte_bpe_50k.json", b="piece_bpe_32k.model")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.dedup_bytes(docs, length=100, outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256")).drop("text")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality": op2_quality,
    "op3_chat": op3_chat,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_ctw": op7_ctw,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_forest": op10_forest,
    "op11_align": op11_align,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_filter_audit": op13_filter_audit,
}

CHAT_SQL = r"""
WITH m AS (SELECT row_number() OVER () AS rid, conv_id, turn, role, COALESCE(text, '') AS text FROM conversations),
l AS (
  SELECT rid, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS k
  FROM m
),
p AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]*((>[ \t]?)+)', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[ \t]*((>[ \t]?)+)', '') AS body
  FROM l
),
n AS (SELECT *, trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM p),
b AS (
  SELECT *, lag(level) OVER w AS level_before, lag(norm) OVER w AS norm_before
  FROM n WINDOW w AS (PARTITION BY rid ORDER BY k)
),
g AS (
  SELECT *, COUNT(*) FILTER (WHERE norm = '' OR COALESCE(norm_before, '') = '' OR level <> level_before)
              OVER (PARTITION BY rid ORDER BY k) AS run
  FROM b
),
runs AS (
  SELECT rid, run, conv_id, turn, level, string_agg(norm, ' ' ORDER BY k) AS unit, COUNT(*) AS lines
  FROM g WHERE norm <> '' GROUP BY ALL
),
units AS (
  SELECT conv_id, turn, level, unit FROM runs
  UNION ALL
  SELECT g.conv_id, g.turn, g.level, g.norm FROM g JOIN runs USING (rid, run) WHERE runs.lines > 1 AND g.norm <> ''
),
said AS (SELECT conv_id, unit, MIN(turn) AS origin FROM units WHERE level = 0 GROUP BY ALL),
found AS (
  SELECT q.conv_id, q.turn, q.level, q.unit, s.origin, len(string_split(q.unit, ' ')) AS words
  FROM units q JOIN said s ON q.conv_id = s.conv_id AND q.unit = s.unit
  WHERE q.level > 0 AND s.origin < q.turn
),
linked AS (
  SELECT conv_id, turn, arg_max(origin, (-level, words, origin)) AS origin, COUNT(DISTINCT (level, unit)) AS n_linked
  FROM found GROUP BY ALL
),
told AS (
  SELECT rid, COUNT(*) FILTER (WHERE level > 0) AS n_quoted,
         COALESCE(string_agg(body, chr(10) ORDER BY k) FILTER (WHERE level = 0), '') AS text
  FROM p GROUP BY rid
),
answers AS (
  SELECT m.conv_id, m.turn, m.role,
         COALESCE(k.origin, CASE WHEN EXISTS (SELECT 1 FROM m b WHERE b.conv_id = m.conv_id AND b.turn = m.turn - 1)
                                 THEN m.turn - 1 END) AS parent_turn,
         t.n_quoted, COALESCE(k.n_linked, 0) AS n_linked, t.text
  FROM m JOIN told t USING (rid) LEFT JOIN linked k ON m.conv_id = k.conv_id AND m.turn = k.turn
)
SELECT conv_id, turn, role, parent_turn,
       row_number() OVER (PARTITION BY conv_id ORDER BY parent_turn NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, text) - 1
         AS place,
       n_quoted, n_linked, text
FROM answers"""

AUDIT_SQL = r"""
WITH RECURSIVE orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f) WHERE length(o) < 5 AND NOT contains(o, f)
),
d AS (SELECT doc_id, COALESCE(text, '') AS t, COALESCE(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
least AS (SELECT t, MIN(doc_id) AS first_id FROM d GROUP BY t),
marks AS (SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
          FROM labels GROUP BY doc_id),
f AS (
  SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         COALESCE(first_id < w.doc_id, false) AS e, COALESCE(good, 0) AS good, COALESCE(bad, 0) AS bad
  FROM w JOIN least USING (t) LEFT JOIN marks ON marks.doc_id = w.doc_id
),
g AS (
  SELECT part, good, bad, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                                 CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails, COUNT(*) AS n
  FROM f GROUP BY ALL
),
s AS (
  SELECT part, o AS filter_order, step, n, good, bad, substr(o, step, 1) AS letter, contains(fails, substr(o, step, 1)) AS here,
         length(translate(substr(o, 1, step - 1), fails, '')) < step - 1 AS earlier, length(fails) = 1 AS alone
  FROM g, (SELECT o FROM orders WHERE length(o) = 5), (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
),
r AS (
  SELECT part, filter_order, step, letter,
         CAST(SUM(CASE WHEN NOT here AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(SUM(CASE WHEN here AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(SUM(CASE WHEN here AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(SUM(CASE WHEN here AND alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(SUM(CASE WHEN here AND NOT earlier THEN n * good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(SUM(CASE WHEN here AND NOT earlier THEN n * bad ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r"""

#: Hashes, fingerprints, compressors, tokens, fitted models and approximate
#: search have no SQL form; tests compare those queries with brute force.
ORACLE_SQL: dict[str, str] = {"op3_chat": CHAT_SQL, "op13_filter_audit": AUDIT_SQL}
