"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    bytebpe,
    collocations,
    fingerprints,
    jaccard,
    language,
    licenses,
    linededup,
    packing,
    pii,
    prefixtrie,
    topk,
    toxicity,
    warc,
)
from tallyworks.llm.text import documents, fresh_folder


def _remainder(divisor: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(divisor))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(_remainder(3) != 1)
    score = toxicity.scorer(docs, toxicity.fit(docs, labels))
    found = docs.select("doc_id", (_remainder(3) == 1).alias("held_out"), score(F.col("text")).alias("s"))
    return found.select(
        "doc_id", "held_out", F.col("s.score").alias("score"), (F.col("s.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.col("s.strongest").alias("strongest"), F.col("s.positive").alias("positive"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", pii.find(F.col("text")).alias("p")).select("doc_id", "p.*")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.train(language.sample(docs.where(_remainder(5) != 0)))
    found = docs.select("doc_id", (_remainder(5) == 0).alias("held_out"), language.detect(docs, F.col("text"), model).alias("l"))
    return found.select("doc_id", "held_out", F.col("l.lang_pred").alias("lang_pred"), F.col("l.score").alias("score"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, documents=docs.count())


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.without_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "removed_lines", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    found = warc.catalogue(warc.read_records(spark, path))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversed = prefixtrie.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefixtrie.prefix_nodes(prefixtrie.regrown(conversed)).drop("node", "parent")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_licenses, op3_personal_data, op4_fingerprints, op5_language, op6_exact_top_k, op7_packing, op8_byte_bpe,
        op9_jaccard_join, op10_line_dedup, op11_warc, op12_prefix_trie, op13_collocations,
    )
}

_OP6 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

_OP9 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM words
), classes AS (
  SELECT min(doc_id) AS cls, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), tokens AS (
  SELECT cls, n, unnest(s) AS t FROM classes
), links AS (
  SELECT a.cls AS u, b.cls AS v FROM tokens a JOIN tokens b ON a.t = b.t AND a.cls < b.cls
  GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reach AS (
  SELECT cls AS node, cls AS root FROM classes
  UNION SELECT e.v, r.root FROM reach r JOIN both_ways e ON r.node = e.u
), lowest AS (
  SELECT node, min(root) AS component_id FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON s.s = c.s LEFT JOIN lowest l ON c.cls = l.node
"""

ORACLES: dict[str, str] = {
    "op2_licenses": licenses.oracle_sql(),
    "op6_exact_top_k": _OP6,
    "op9_jaccard_join": _OP9,
    "op10_line_dedup": linededup.ORACLE_SQL,
    "op11_warc": warc.ORACLE_SQL,
    "op12_prefix_trie": prefixtrie.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
