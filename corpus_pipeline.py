"""The corpus pipeline: toxicity, line dedup, near duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. The first four return the
columns of their input; the last returns the packed pieces. Only the first reads a second table, the labels.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import jaccard, linededup, packing, pii, toxicity
from tallyworks.llm.text import documents, fresh_name, stored

#: Of the table of token chunks in each worker: less than when packing runs alone, since executors hold more after four stages.
TABLE_BYTES = 64 << 20


def _with_text(docs: DataFrame, source: DataFrame, text) -> DataFrame:
    """The columns of `docs` from `source`, with a new text and, where there is one, its number of characters."""
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return source.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine rejects go. It learns from all labelled rows' bounded sample."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mark = fresh_name(docs, "toxicity_of_text")
    scored = docs.withColumn(mark, toxicity.scorer(docs, model)(F.col("text").cast("string"))["score"])
    return scored.where(F.col(mark) < toxicity.THRESHOLD).drop(mark)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines covered by windows that occurred before go; every document keeps its row."""
    kept = linededup.without_repeats(docs)
    return _with_text(docs, kept, F.col("text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that with the smallest id, and of several the first by text class."""
    return jaccard.first_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    mark = fresh_name(docs, "redacted_text")
    found = docs.withColumn(mark, pii.redact(F.col("text").cast("string"))["text"])
    return _with_text(docs, found, F.col(mark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), table_bytes=TABLE_BYTES)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, documents=docs.count())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: A trained machine and a tokenizer are not expressible in SQL; the tests hold run() to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for at, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = stored(out) if at < len(STAGES) - 1 else out
    return docs
