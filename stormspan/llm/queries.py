"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, embeddings, extraction, language, packing, passages, periodic, personal, pieces, rules, search, shared, simhash, tokens


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(read(spark, folder, "documents"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    made = rules.apply(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return made.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    back = archives.archive(read(spark, folder, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, folder, "embeddings"))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    scored = passages.score(docs, passages.fit(docs, read(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        shared.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= passages.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(read(spark, folder, "pages"))


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find(read(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_other")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), lasting=True)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    judged = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return judged.select("doc_id", shared.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count(read(spark, folder, "documents"))


def replayed(doc_id: int, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by the checksum of its number, goes on in a period from a word on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + [words[first + (i - first) % period] for i in range(first, n)]


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find(read(spark, folder, "documents"), edit=replayed)
    line = lambda r: F.concat_ws(",", r.start, r.length, r.period)
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_dedup,
        op2_sentencepiece,
        op3_quality_rules,
        op4_warc_bundles,
        op5_embedding_dedup,
        op6_quality_classifier,
        op7_html_extraction,
        op8_personal_data,
        op9_packing,
        op10_language_id,
        op11_lexical_search,
        op12_token_counts,
        op13_periodic_runs,
    )
}

ORACLES: dict[str, str] = {
    "op4_warc_bundles": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f
""",
    "op5_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95
), walk AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT walk.a, links.b FROM walk JOIN links ON walk.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM walk GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON v.vec_id = least.a
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON v.vec_id = n.a
""",
    "op11_lexical_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), sizes AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes
), norms AS (
  SELECT doc_id, 100 - 25 + (25 * n * docs) // total.words AS m FROM sizes, total
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term
), scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term)
  JOIN tf USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
""",
}
