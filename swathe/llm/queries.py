"""The registered query of each operator, over its whole table, and its SQL if SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathe.llm import (
    audit, bpe, chat, fingerprints, licenses, minhash, negatives, neighbours, packing, secrets, simhash, toxicity, wrappers,
)
from swathe.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    """``query`` with this package sent to the executors first."""
    return lambda spark, sf_dir: query(ship(spark), sf_dir)


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat.digests(chat.format_chat(turns.unionByName(extra)))


OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), marked AS (
  SELECT *, role IN ('system', 'user', 'assistant', 'tool') AS known,
    lag(role) OVER w AS before, lead(turn) OVER w IS NULL AND lead(role) OVER w IS NULL AS is_last,
    length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '### System: ', ''))) // 12
      + (length(text) - length(replace(text, '### User: ', ''))) // 10
      + (length(text) - length(replace(text, '### Assistant: ', ''))) // 15
      + (length(text) - length(replace(text, '### Tool: ', ''))) // 10
      + (length(text) - length(replace(text, '### Role ', ''))) // 9
      + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS escapes
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(escapes + length(text) + 9 + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
    WHEN 'tool' THEN 10 ELSE 11 + length(role) * 3 - length(replace(role, '\', '')) - length(replace(role, ':', '')) END)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL OR before NOT IN ('system', 'user', 'assistant', 'tool') THEN role IN ('system', 'user')
    WHEN before IN ('system') THEN role = 'user' WHEN before IN ('user', 'tool') THEN role = 'assistant'
    ELSE role IN ('user', 'tool') END) AND bool_or(is_last AND role = 'assistant') AS valid
FROM marked GROUP BY conv_id
"""


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learnt from the labels outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels").where("crc32(cast(doc_id as string)) % 4 <> 2")
    return toxicity.learn(docs, labels)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, docs, sf_dir)
    held_out = F.expr("coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)")
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "matches")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.learn(docs)).drop("text")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def digest(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "format")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


def op4_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.encode(docs, path, pattern).drop("text")
    return bpe.decode(tokens, path, pattern).select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b
    ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept
FROM sets LEFT JOIN least USING (doc_id)
"""


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), said AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit
), met AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * list_unique(w) < 65 * len(w) THEN 2 ELSE 0 END
      + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS f
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY t) AS first_id FROM docs) LEFT JOIN said USING (doc_id) GROUP BY ALL
), orders AS (
  SELECT '' AS o UNION ALL SELECT o || x FROM orders, letters WHERE NOT contains(o, x)
), steps AS (
  SELECT o AS filter_order, k::INTEGER AS step, l.x, any_value(l.bit) AS bit, coalesce(sum(p.bit) FILTER (strpos(o, p.x) < k), 0)::INTEGER AS before
  FROM orders, range(1, 6) r(k), letters l, letters p WHERE length(o) = 5 AND l.x = o[k] GROUP BY o, k, l.x
), counted AS (
  SELECT part, filter_order, step, x,
    coalesce(sum(n) FILTER (f & (before | bit) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (f & before = 0 AND f & bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (f & before > 0 AND f & bit > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (f = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (f & before = 0 AND f & bit > 0 AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (f & before = 0 AND f & bit > 0 AND toxic), 0)::BIGINT AS toxic_lost
  FROM met, steps GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counted
"""


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end"))
    return negatives.hard_negatives(rows, "vec_id % 50 = 0")


OP13_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM pairs WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, p.vec_id AS positive_id,
  (row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n USING (anchor_id)
WHERE NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""

_ALL: dict[str, tuple[Query, str | None]] = {
    "op1_chat": (op1_chat, OP1_SQL),
    "op2_toxicity": (op2_toxicity, None),
    "op3_secrets": (op3_secrets, None),
    "op4_wrappers": (op4_wrappers, None),
    "op5_neighbours": (op5_neighbours, None),
    "op6_fingerprints": (op6_fingerprints, None),
    "op7_packing": (op7_packing, None),
    "op8_bpe": (op8_bpe, None),
    "op9_simhash": (op9_simhash, None),
    "op10_licenses": (op10_licenses, None),
    "op11_minhash": (op11_minhash, OP11_SQL),
    "op12_audit": (op12_audit, OP12_SQL),
    "op13_negatives": (op13_negatives, OP13_SQL),
}

QUERIES = {name: (shipped(query), sql) for name, (query, sql) in _ALL.items()}
