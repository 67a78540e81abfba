"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from epochfold.llm import (
    alignment,
    bpe,
    chat,
    decontaminate,
    embeddings,
    lines,
    near_dup,
    quality,
    repair,
    secret_scan,
    token_store,
    topk,
    warc,
)
from epochfold.llm.shared import pick, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment of every dialogue from every speaker's point of view."""
    return chat.listed(chat.rotate(table(spark, sf_dir, "conversations")))


def op2_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.payloads(warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0))


def op4_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    scored = quality.score(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written in byte planes and read back."""
    docs = table(spark, sf_dir, "documents")
    return token_store.digests(token_store.round_trip(docs, TOKENIZER, end_id=2))


def op6_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(table(spark, sf_dir, "documents"), percent=85)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.find(docs, items))


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with the first occurrence of its group."""
    return lines.groups(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.find(table(spark, sf_dir, "documents")))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(alignment.tokenized(table(spark, sf_dir, "documents"), TOKENIZER, PIECES))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with planted faults, repaired at the least cost."""
    turns = table(spark, sf_dir, "conversations")
    return repair.report(turns, repair.repair(repair.damage(turns)))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_perspectives,
    op2_subspace_join,
    op3_warc_chunks,
    op4_quality_score,
    op5_token_planes,
    op6_minhash_forest,
    op7_decontamination,
    op8_fuzzy_lines,
    op9_secret_scan,
    op10_bpe_round_trip,
    op11_exact_top_k,
    op12_token_alignment,
    op13_conversation_repair,
]

ORACLE_SQL: dict[str, str] = {}

# -- SQL counterparts -------------------------------------------------------------------------

_SMALL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Pairs of documents by shared shingles, then reachability over the links.
ORACLE_SQL["op6_minhash_forest"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_SMALL.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5
    THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n_both FROM shingles a
  JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least AS (SELECT a AS doc_id, MIN(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
  FROM sizes JOIN least USING (doc_id)"""

#: Turns in order within segments; offsets by sums over the turns before.
ORACLE_SQL["op1_perspectives"] = """
WITH turns AS (
  SELECT conv_id, turn >> 5 AS block, turn,
         COALESCE(NULLIF(regexp_replace(trim(role), '[\\s<>|]+', '_', 'g'), ''), 'unknown') AS name,
         replace(COALESCE(text, ''), '<|', '< |') AS body FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, block ORDER BY turn, name, body) - 1 AS pos FROM turns),
speakers AS (SELECT DISTINCT conv_id, name AS speaker FROM turns WHERE name <> 'system'),
rendered AS (
  SELECT conv_id, speaker, block, pos >> 5 AS part, pos, name = speaker AS own, body,
         '<|im_start|>' || CASE WHEN name = 'system' THEN 'system' WHEN name = speaker THEN 'assistant'
           ELSE 'user name=' || name END || chr(10) AS head
    FROM numbered JOIN speakers USING (conv_id)),
placed AS (
  SELECT *, head || body || '<|im_end|>' || chr(10) AS whole,
         COALESCE(SUM(length(head || body || '<|im_end|>' || chr(10))) OVER (
           PARTITION BY conv_id, speaker, block, part ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM rendered)
SELECT conv_id, speaker, block, CAST(part AS INT) AS part, CAST(COUNT(*) AS INT) AS n_turns,
       string_agg(whole, '' ORDER BY pos) AS text,
       COALESCE(string_agg(CAST(start + length(head) AS BIGINT) || '-'
         || CAST(start + length(whole) - 1 AS BIGINT), ',' ORDER BY pos) FILTER (WHERE own), '') AS mask
  FROM placed GROUP BY conv_id, speaker, block, part"""

#: All pairs of a label.
ORACLE_SQL["op2_subspace_join"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a
  JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least AS (SELECT a AS vec_id, MIN(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, COUNT(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
  FROM embeddings JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)"""

#: The SHA-1 in groups of five hexadecimal digits, each four letters of base 32.
ORACLE_SQL["op3_warc_chunks"] = """
WITH sized AS (
  SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes,
         sha1(COALESCE(html, '')) AS hex FROM pages),
latest AS (SELECT hex, COUNT(*) AS n, MAX(page_id) AS latest FROM sized GROUP BY hex)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS INT),
         1)), '') AS payload_digest,
       CASE WHEN n > 1 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id <> latest THEN latest END AS refers_to
  FROM sized JOIN latest USING (hex)"""

#: Windows of documents joined with windows of items, for each length that item windows have.
ORACLE_SQL["op7_decontamination"] = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_SMALL.format("COALESCE(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_SMALL.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i
          FROM d, (SELECT DISTINCT k FROM item_windows))),
hits AS (SELECT doc_id, item_id, i, k FROM doc_windows JOIN item_windows USING (k, x)),
words AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, COUNT(*) AS n_items,
    string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS listed
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(listed, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
  FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


#: All queries with all rows; a shorter vector counts as filled up with zeros.
ORACLE_SQL["op11_exact_top_k"] = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, MAX(CAST(list_sum([0.0::DOUBLE] || list_transform(
      range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT)) AS score
  FROM usable a JOIN usable b ON a.vec_id IS DISTINCT FROM b.vec_id
  WHERE a.vec_id % 50 = 0 GROUP BY a.vec_id, b.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS n FROM scored)
SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM ranked WHERE n <= 5"""

#: CRC-32 bit by bit; then the least (cost, audit) of every state, turn after turn.
ORACLE_SQL["op13_conversation_repair"] = """
WITH RECURSIVE hashed AS (
  SELECT *, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(
      string_split(COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS left_over FROM conversations),
kinds AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
         xor(left_over, 4294967295) % 20 AS kind FROM hashed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial FROM damaged),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS ahead FROM placed),
inserts(state, spot, letters, cost, lines) AS (VALUES
  (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
  (0, 2, 'I', 5, chr(10) || 'user:'), (1, 2, 'I', 5, chr(10) || 'user:'),
  (2, 3, 'I', 5, chr(10) || 'assistant:'), (3, 2, 'I', 5, chr(10) || 'user:'),
  (0, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(action, initial, spot, next_state, cost, new_role) AS (VALUES
  ('D', NULL, 0, 0, 2, NULL), ('D', NULL, 1, 1, 2, NULL), ('D', NULL, 2, 2, 2, NULL), ('D', NULL, 3, 3, 2, NULL),
  ('K', 's', 0, 1, 0, NULL), ('K', 'u', 0, 2, 0, NULL), ('K', 'u', 1, 2, 0, NULL), ('K', 'u', 3, 2, 0, NULL),
  ('K', 'a', 2, 3, 0, NULL), ('R', NULL, 0, 2, 1, 'user'), ('R', NULL, 1, 2, 1, 'user'),
  ('R', NULL, 2, 3, 1, 'assistant'), ('R', NULL, 3, 2, 1, 'user')),
paths(conv_id, i, state, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': '', 'lines': ''} FROM conversations
  UNION ALL
  SELECT p.conv_id, p.i + 1, e.next_state, MIN({
      'cost': p.best.cost + n.cost + e.cost + CASE WHEN e.action <> 'D' AND t.fault = 'truncated' THEN 5 ELSE 0 END,
      'audit': p.best.audit || n.letters || e.action,
      'lines': p.best.lines || n.lines || CASE WHEN e.action = 'D' THEN ''
        ELSE chr(10) || COALESCE(e.new_role, t.role) || ':' || t.text END})
  FROM paths p JOIN judged t ON t.conv_id = p.conv_id AND t.i = p.i + 1
  JOIN inserts n ON n.state = p.state
  JOIN edits e ON e.spot = n.spot AND (e.initial IS NULL OR e.initial = t.initial)
   AND (e.action = 'D' OR t.fault NOT IN ('blank', 'duplicate'))
  GROUP BY p.conv_id, p.i + 1, e.next_state),
ended AS (
  SELECT p.conv_id, MIN({'cost': p.best.cost + n.cost, 'audit': p.best.audit || n.letters,
                         'lines': p.best.lines || n.lines}) AS best
  FROM paths p JOIN (SELECT conv_id, MAX(i) AS last FROM paths GROUP BY conv_id) l
    ON l.conv_id = p.conv_id AND l.last = p.i
  JOIN inserts n ON n.state = p.state AND (n.spot = 3 OR (p.state = 0 AND n.spot = 0)) GROUP BY p.conv_id),
counted AS (
  SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
         COUNT(*) FILTER (fault = 'blank') AS blank, COUNT(*) FILTER (fault = 'duplicate') AS duplicate,
         COUNT(*) FILTER (fault = 'truncated') AS truncated,
         COUNT(*) FILTER (ahead IS NOT NULL AND ahead || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT conv_id, CAST(COALESCE(gaps, 0) AS BIGINT) AS gaps, CAST(COALESCE(blank, 0) AS BIGINT) AS blank,
       CAST(COALESCE(duplicate, 0) AS BIGINT) AS duplicate, CAST(COALESCE(truncated, 0) AS BIGINT) AS truncated,
       CAST(COALESCE(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(substr(best.lines, 2)) AS repaired_sha256
  FROM ended LEFT JOIN counted USING (conv_id)"""
