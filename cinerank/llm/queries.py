"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm import (ann, bpe, conversations, embedding_dedup, hard_negatives, html_extract, jaccard_join, langid, licenses,
                          packing, pii, toxicity, urlfilter)
from cinerank.llm.common import table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, d, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, d, "embeddings"))


def op3_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents"))


def op4_nearest_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(table(spark, d, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path(WORD_BPE), cache=1_000_000)


def op6_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return html_extract.extract(table(spark, d, "pages"))


def op7_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out() & docs["doc_id"].isNotNull()))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op8_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_pii(table(spark, d, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


URL_RULES = "VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"


def op9_url_filter(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM {URL_RULES} AS t(host, path, verdict)")
    return urlfilter.judge(table(spark, d, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op10_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.digests(table(spark, d, "documents"), public_tokenizers.path(BYTE_BPE))


def op11_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations")
    return conversations.repair(conversations.damaged(rows), rows)


def op12_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = toxicity.fit(docs.where(~langid.held_out()), table(spark, d, "labels"))
    return toxicity.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "score", "predicted")


def op13_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, d, "embeddings"), relabel=moved)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_embedding_near_dedup": op2_embedding_near_dedup,
        "op3_license_scan": op3_license_scan,
        "op4_nearest_neighbours": op4_nearest_neighbours,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_html_extraction": op6_html_extraction,
        "op7_language_id": op7_language_id,
        "op8_pii": op8_pii,
        "op9_url_filter": op9_url_filter,
        "op10_bpe": op10_bpe,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_toxicity": op12_toxicity,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": corpus_pipeline.run,
    }


# Links of texts with equal sets and between sets that share a shingle; the
# label that every document ends with is the smallest it can reach.
OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]) END) AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
flat AS (SELECT doc_id, unnest(s) AS g FROM sets),
hits AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM hits JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id FROM sizes s JOIN reach r USING (doc_id) GROUP BY 1, 2
"""


# All pairs of a label by cosine in double precision.
OP2_SQL = r"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON l.x = r.other),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, l.component_id = e.vec_id AS kept
FROM embeddings e JOIN low l USING (vec_id) LEFT JOIN counts c ON c.x = e.vec_id
"""

# Host and path by position, then the rules, longest written first.
OP9_SQL = f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^([^/?#]*)([^?#]*)', 2) AS path FROM rest),
rules AS (SELECT * FROM ({URL_RULES}) AS t(h, p, v)),
fits AS (SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC, v DESC) AS k
         FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT a.page_id, a.host, a.path, f.rule, coalesce(f.v, 'allow') AS verdict
FROM parts a LEFT JOIN fits f ON f.page_id = a.page_id AND f.k = 1
"""


# Row by row, the best way (cost, then audit) into each state of the grammar.
OP11_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
summed AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(ord(substr(k, i, 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, j: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)),
      4294967295) % 20 AS f FROM keyed),
broken AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed WHERE f <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM broken),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM placed),
rows_ AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ranked),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id),
ins(q, q1, c, letters, lines) AS (VALUES
  ('0', '0', 0, '', ''), ('0', 'U', 2, 'I', 'user:' || chr(10)), ('0', 'A', 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  ('S', 'S', 0, '', ''), ('S', 'U', 2, 'I', 'user:' || chr(10)), ('S', 'A', 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  ('U', 'U', 0, '', ''), ('U', 'A', 2, 'I', 'assistant:' || chr(10)), ('A', 'A', 0, '', ''), ('A', 'U', 2, 'I', 'user:' || chr(10))),
acts(q1, act, q2, need) AS (VALUES
  ('0', 'D', '0', ''), ('S', 'D', 'S', ''), ('U', 'D', 'U', ''), ('A', 'D', 'A', ''),
  ('0', 'K', 'S', 's'), ('0', 'K', 'U', 'u'), ('S', 'K', 'U', 'u'), ('A', 'K', 'U', 'u'), ('U', 'K', 'A', 'a'),
  ('0', 'R', 'U', ''), ('S', 'R', 'U', ''), ('A', 'R', 'U', ''), ('U', 'R', 'A', '')),
best(conv_id, i, q, cost, audit, rep) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '0', CAST(0 AS BIGINT), '', '' FROM conversations
  UNION ALL
  SELECT conv_id, i, q2, cost, audit, rep FROM (
    SELECT b.conv_id, r.i, a.q2, b.cost + n.c + CASE a.act WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
             + CASE WHEN a.act <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
           b.audit || n.letters || a.act AS audit,
           b.rep || n.lines || CASE a.act WHEN 'D' THEN '' ELSE
             (CASE WHEN a.act = 'K' THEN r.role WHEN a.q2 = 'U' THEN 'user' ELSE 'assistant' END) || ':' || r.text || chr(10) END AS rep
    FROM best b JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN ins n ON n.q = b.q JOIN acts a ON a.q1 = n.q1
    WHERE a.act = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (a.need = '' OR a.need = r.r)))
  QUALIFY row_number() OVER (PARTITION BY conv_id, i, q2 ORDER BY cost, audit) = 1),
ended AS (
  SELECT b.conv_id, b.i, b.cost + n.c AS cost, b.audit || n.letters AS audit, b.rep || n.lines AS rep
  FROM best b JOIN ins n ON n.q = b.q LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
  WHERE b.i = coalesce(c.n, 0) AND n.q1 IN ('0', 'A')
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + n.c, b.audit || n.letters) = 1)
SELECT e.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(e.cost AS BIGINT) AS cost, e.audit,
       sha256(left(e.rep, greatest(length(e.rep) - 1, 0))) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

# Scores of anchors with all other rows; windows by rank.
OP13_SQL = """
WITH ok AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": OP1_SQL, "op2_embedding_near_dedup": OP2_SQL, "op9_url_filter": OP9_SQL,
            "op11_conversation_repair": OP11_SQL, "op13_hard_negatives": OP13_SQL}
