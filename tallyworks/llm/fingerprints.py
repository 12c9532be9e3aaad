"""Document fingerprints of closed syncmers (operator 4).

A k-mer of code points is an anchor if the least of its s-mers (by hash) is the first or the last one. Whether it is
depends on the k-mer alone, so an edit moves no anchor that it does not touch. A fingerprint holds the `KEEP` anchors
with the smallest hashes, each with the place of its first occurrence. The likeness of two fingerprints is the share of
the `KEEP` smallest of their united anchors that both have in the same order: an estimate of the Jaccard similarity
of the anchor sets in which matches out of place do not count.

Texts without an anchor (shorter than k, null, empty) are one anchor: the hash of the whole text; an empty fingerprint
stands for the empty text. Equal texts have equal fingerprints; two empty texts have likeness 1, an empty and another 0.

`with_next` pairs every document with the next by id without one global sort: ids are cut into ranges, rows go to their
range, and the first document of each range is also sent to the range before. Equal ids are ordered by text, null ids
come first, extra columns are left out. A table with one row has itself as its next.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.text import GROUP

K, S, KEEP = 12, 5, 64
_MIX, _STEP = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15)
_FIRST = -(1 << 63)
_COLUMNS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def _rolling(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every stretch of `length` codes."""
    n = len(codes) - length + 1
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = (out + codes[j : j + n]) * _STEP
    return _mixed(out)


def anchors(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers of a code point array."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    small = _rolling(codes.astype(np.uint64), s)
    inner = k - s + 1  # s-mers in a k-mer
    least, width = small, 1
    while width * 2 <= inner:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[inner - width : inner - width + n])
    at = np.flatnonzero((small[:n] == least) | (small[inner - 1 : inner - 1 + n] == least))
    value = np.zeros(len(at), np.uint64)  # a k-mer's hash from its s-mers
    for j in [*range(0, inner, s), inner - 1]:
        value = (value + small[at + j]) * _STEP
    return at, _mixed(value)


def fingerprint(text: str) -> list[tuple[int, int]]:
    """(32-bit hash, place) of the kept anchors by hash. Long texts are read in stretches that overlap by k - 1."""
    if not text:
        return []
    found: dict[int, int] = {}
    for start in range(0, len(text), GROUP):
        codes = np.frombuffer(text[start : start + GROUP + K - 1].encode("utf-32-le", "replace"), np.uint32)
        at, value = anchors(codes)
        value = (value >> np.uint64(32)).astype(np.int64)
        value, first = np.unique(value, return_index=True)
        for v, p in zip(value[:KEEP].tolist(), (at[first[:KEEP]] + start).tolist(), strict=True):
            found.setdefault(v, p)
    if not found:
        found[int.from_bytes(hashlib.sha256(text.encode("utf-8", "replace")).digest()[:4], "big")] = 0
    return sorted(found.items())[:KEEP]


def written(marks: list[tuple[int, int]]) -> str:
    return ",".join(f"{h:08x}@{p}" for h, p in marks)


def likeness(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> float:
    """Share of the smallest united anchors that both have in one order."""
    if not a or not b:
        return float(not a and not b)
    one, two = dict(a), dict(b)
    smallest = sorted(one.keys() | two.keys())[:KEEP]  # of fewer than KEEP anchors a fingerprint holds all
    both = sorted((one[h], two[h]) for h in smallest if h in one and h in two)
    chain: list[int] = []  # ends of the longest ascending runs of places
    for _, p in both:
        i = bisect_left(chain, p)
        chain[i : i + 1] = [p]
    return len(chain) / len(smallest)


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (range, tail, doc_id, text), partitioned by range and in order; `tail` marks the next range's first rows.

    Only the cuts between ranges and the least id of each range (at most `ranges` numbers) pass through the driver.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * partitions
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("place"),
    )
    found = rows.select(F.percentile_approx("place", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("c")).first()["c"]
    cuts = sorted({float(c) for c in found or [0]})
    # comparing as doubles may join neighbouring ids beyond 2**53 in a range, which keeps the order
    ranged = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="as_double", outputCol="as_range")
    rows = ranged.transform(rows.withColumn("as_double", F.col("place").cast("double"))).select(
        F.col("as_range").cast("int").alias("range"), "doc_id", "text", "place"
    )
    heads = sorted((r["range"], r["head"]) for r in rows.groupBy("range").agg(F.min("place").alias("head")).collect())
    before = spark.createDataFrame([(h, heads[i - 1][0]) for i, (_, h) in enumerate(heads)], "place long, before int")
    sent = rows.join(F.broadcast(before), "place", "left").select(
        "doc_id", "text", "place",
        F.explode(
            F.when(F.col("before").isNull(), F.array(F.struct("range", F.lit(False).alias("tail")))).otherwise(
                F.array(F.struct("range", F.lit(False).alias("tail")), F.struct(F.col("before").alias("range"), F.lit(True).alias("tail")))
            )
        ).alias("to"),
    )
    return (
        sent.select("to.range", "to.tail", "doc_id", "text", "place")
        .repartition(partitions, "range")
        .sortWithinPartitions("range", "tail", "place", "text")
        .select("range", "tail", "doc_id", "text")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # range, doc_id, text, marks of the row that waits for its next

        for batch in batches:
            out: list[list] = [[] for _ in _COLUMNS]
            for part, tail, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marks = None
                if held is not None and held[0] == part:
                    marks = fingerprint(text)
                    _, own_id, own, own_marks = held
                    moved = len(own) // 4
                    edited = own[: len(own) - moved] + text[:moved]
                    edited_marks = fingerprint(edited)
                    values = (
                        own_id, len(own), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
                        written(own_marks), written(edited_marks), likeness(own_marks, edited_marks), likeness(own_marks, marks),
                    )
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                held = None if tail else (part, doc_id, text, fingerprint(text) if marks is None else marks)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _COLUMNS.values(), strict=True)], names=list(_COLUMNS))

    return with_next(docs).mapInArrow(compared, _SCHEMA)
