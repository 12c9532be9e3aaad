"""Phrase collocations by marginalising the longest windows (operator 13).

Every word opens one window of up to four words, padded behind the last word of its piece. Only these longest windows are
counted; a Spark ROLLUP over their columns sums the counts of all shorter prefixes, which are the counts of all phrases.
A phrase that is too rare to matter needs no exact count: a window is also padded from where its first words occur
fewer than `least` times. Such phrases are known by tables of counters of fixed size, one for pairs and, after it, one for
longer phrases made of frequent pairs: phrases that share a counter can only look too frequent, so this spares work and
changes no result, at any size of the corpus.

ASCII letters are lower-cased, pieces end at `[.,;:!?\\x0A-\\x0D]`, words are what spaces and tabs part. A null text is
empty, a null language is `und` (and one with a text of that name). Repeated rows count each. Only the columns text and
lang are read, so other columns may have any name. An empty table gives no row. Texts are worked through in stretches; the
last words of a stretch are carried over to the next, so long texts are counted whole. Equal scores go by the count, then
by the phrase in the byte order of UTF-8.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.text import Codes, stored

WORDS = 4
LEAST = 30
TOP = 2000
#: Counters of a table: 2^27, of which the executors get one bit each (16 MB).
COUNTERS = 27
_BLOCK = 32_768  # bits of one row of Spark's bitmaps
_BYTES = 1 << 22
_END = b"\xff"  # never part of UTF-8
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _END * 10)
_GAP = re.compile(rb"[ \t\xff]")
_COLUMNS = [f"w{i + 1}" for i in range(WORDS)]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words) of about `_BYTES`, pieces parted by `_END`. Windows open at all but the last three words; those come
    again in front of the language's next stretch where a text goes on, and are `_END` otherwise."""
    waiting: dict[str, list[bytes]] = {}
    held = 0

    def words(lang: str, more: list[bytes] = ()) -> list[bytes]:
        return (*waiting.pop(lang, ()), *more)

    def split(parts) -> list[bytes]:
        return b"".join(parts).replace(_END, b" \xff ").split()

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(_TABLE)
            lang = lang.as_py()
            start = 0
            while len(data) - start > _BYTES:
                cut = _GAP.search(data, start + _BYTES)
                if cut is None:
                    break
                found = split(words(lang, [data[start : cut.start()]]))
                yield lang, found
                waiting[lang] = [b" ".join([*found[-(WORDS - 1) :], b""])]
                start = cut.start()
            waiting.setdefault(lang, []).append((data[start:] if start else data) + _END)
            held += len(data) - start
            if held >= _BYTES:
                for each in list(waiting):
                    yield each, split(words(each, [_END * (WORDS - 1)]))
                held = 0
    for each in list(waiting):
        yield each, split(words(each, [_END * (WORDS - 1)]))


def _coded(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    codes = Codes({_END: 0})
    return np.fromiter(map(codes.__getitem__, words), np.int64, len(words)), list(codes)


def _counter(hashes: np.ndarray, columns: list[np.ndarray], bits: int) -> np.ndarray:
    """The counter of each phrase, whose words are given by column; the last of the hashes stands for the language."""
    mixed = np.full(len(columns[0]), hashes[-1] + np.uint64(len(columns)))
    for c in columns:
        mixed = (mixed ^ hashes[c]) * _MIX
        mixed ^= mixed >> np.uint64(31)
    return ((mixed * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _hashes(lang: str, vocabulary: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array([*vocabulary, lang.encode()], object), categorize=False)


def _marked(marks: np.ndarray, counters: np.ndarray) -> np.ndarray:
    return ((marks[counters >> 3] >> (counters & 7).astype(np.uint8)) & 1).astype(bool)


def _pairs(codes: np.ndarray) -> np.ndarray:
    """Whether each word and the next are words of one piece."""
    return (codes[:-1] > 0) & (codes[1:] > 0)


def _frequent_pairs(codes: np.ndarray, hashes: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    return _pairs(codes) & _marked(marks, _counter(hashes, [codes[:-1], codes[1:]], bits))


def _counted(counters: np.ndarray) -> pa.RecordBatch:
    at, n = np.unique(counters, return_counts=True)
    return pa.record_batch([pa.array(at.astype(np.int32)), pa.array(n)], names=["counter", "n"])


def _pairs_counted(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _stretches(batches):
            codes, vocabulary = _coded(words)
            n = max(len(codes) - (WORDS - 1), 0)
            at = np.flatnonzero(_pairs(codes)[:n])
            yield _counted(_counter(_hashes(lang, vocabulary), [codes[at], codes[at + 1]], bits))

    return count


def _longer_counted(pairs, bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(pairs.value, np.uint8)
        for lang, words in _stretches(batches):
            codes, vocabulary = _coded(words)
            n = len(codes) - (WORDS - 1)
            if n <= 0:
                continue
            hashes = _hashes(lang, vocabulary)
            goes_on = _frequent_pairs(codes, hashes, marks, bits)
            found, run = [], goes_on[:n]
            for size in range(3, WORDS + 1):
                run = run & goes_on[size - 2 : size - 2 + n]
                at = np.flatnonzero(run)
                found.append(_counter(hashes, [codes[at + k] for k in range(size)], bits))
            yield _counted(np.concatenate(found))

    return count


def _marks(counts: DataFrame, least: int, bits: int) -> bytes:
    """One bit for each counter: whether the phrases that share it occur `least` times. Runs a job; what comes to the driver
    has 2^bits bits, whatever the corpus."""
    place = F.col("counter").cast("long") + 1
    rows = (
        counts.groupBy("counter").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .groupBy(F.bitmap_bucket_number(place).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("marks"))
        .collect()
    )
    marks = bytearray(max(1 << bits, _BLOCK) // 8)
    for row in rows:
        start = (row.block - 1) * _BLOCK // 8
        marks[start : start + len(row.marks)] = row.marks
    return bytes(marks)


def _windows_counted(pairs, longer, bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_marks, marks = np.frombuffer(pairs.value, np.uint8), np.frombuffer(longer.value, np.uint8)
        for lang, words in _stretches(batches):
            codes, vocabulary = _coded(words)
            n = len(codes) - (WORDS - 1)
            if n <= 0:
                continue
            hashes = _hashes(lang, vocabulary)
            goes_on = _frequent_pairs(codes, hashes, pair_marks, bits)
            columns, run = [codes[:n]], goes_on[:n]
            columns.append(np.where(run, codes[1 : n + 1], 0))
            for size in range(3, WORDS + 1):
                run = run & goes_on[size - 2 : size - 2 + n]
                at = np.flatnonzero(run)
                run[at] = _marked(marks, _counter(hashes, [codes[at + k] for k in range(size)], bits))
                columns.append(np.where(run, codes[size - 1 : size - 1 + n], 0))
            columns = [c[columns[0] > 0] for c in columns]
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            starts = np.flatnonzero(new)
            texts = pa.array([b"", *vocabulary[1:]], pa.binary()).cast(pa.string())
            out = [texts.take(pa.array(c[starts])) for c in columns]
            times = pa.array(np.diff(np.append(starts, len(order))))
            yield pa.record_batch([pa.array([lang] * len(starts), pa.string()), *out, times], names=["lang", *_COLUMNS, "n"])

    return count


def phrase_counts(docs: DataFrame, least: int = LEAST, bits: int = COUNTERS) -> DataFrame:
    """lang, words (their number), w1 to w4 ('' where the phrase is shorter), f of all phrases that occur `least` times, and
    for each language a row of no words with the number of all its words. Runs the two jobs that fill the counters."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    counters = "counter int, n long"
    pairs = spark.sparkContext.broadcast(_marks(texts.mapInArrow(_pairs_counted(bits), counters), least, bits))
    longer = spark.sparkContext.broadcast(_marks(texts.mapInArrow(_longer_counted(pairs, bits), counters), least, bits))
    schema = ", ".join(["lang string", *[f"{c} string" for c in _COLUMNS], "n long"])
    windows = texts.mapInArrow(_windows_counted(pairs, longer, bits), schema).groupBy("lang", *_COLUMNS).agg(F.sum("n").alias("n"))
    # A column that the rollup leaves out is null, one that was padded is ''.
    sums = windows.rollup("lang", *_COLUMNS).agg(F.sum("n").alias("f"))
    length = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in _COLUMNS), F.lit(0))
    padded = F.coalesce(*[F.col(c) for c in reversed(_COLUMNS)], F.lit("-")) == ""
    return sums.where(F.col("lang").isNotNull() & ~padded & (F.col("w1").isNull() | (F.col("f") >= least))).select(
        "lang", length.alias("words"), *[F.coalesce(c, F.lit("")).alias(c) for c in _COLUMNS], "f"
    )


def _phrase(first: int, last: int) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in _COLUMNS[first:last]])


def collocations(docs: DataFrame, top: int | None = TOP, least: int = LEAST, bits: int = COUNTERS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's `top` phrases of two to four words (all for None).

    a = f(phrase) is at least `least`. Cut after its first words, a phrase has l = f(first part), r = f(rest) and the score
    floor(2000000 * a / (l + r)); its lowest cut counts, the first of several. Phrases inside a longer candidate of which
    100 * f >= 80 * a are left out.
    """
    counts = stored(phrase_counts(docs, least, bits))
    phrases = counts.where("words > 0").select("lang", _phrase(0, WORDS).alias("phrase"), "f")
    candidates = counts.where("words > 1").withColumn("phrase", _phrase(0, WORDS))
    cuts = F.array(
        *[
            F.when(F.col("words") == n, F.struct(F.lit(k).alias("k"), _phrase(0, k).alias("left"), _phrase(k, n).alias("right")))
            for n in range(2, WORDS + 1)
            for k in range(1, n)
        ]
    )
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), F.inline(F.filter(cuts, lambda c: c.isNotNull())))
    # Many phrases may share a part, so its count is looked up under one of a few salts.
    salts = 8
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int")
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("f"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    for side, count in (("left", "l"), ("right", "r")):
        looked_up = part.select("lang", F.col("part").alias(side), "salt", F.col("f").alias(count))
        cut = cut.withColumn("salt", salt).join(looked_up, ["lang", side, "salt"])
    exact = F.col("a").cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)")
    cut = cut.withColumn("product", exact).withColumn("score", F.expr("product div (cast(l AS decimal(19,0)) + cast(r AS decimal(19,0)))"))
    scored = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.array(
        *[
            F.when(F.col("words") == n, _phrase(start, start + size))
            for n in range(3, WORDS + 1)
            for size in range(2, n)
            for start in range(n - size + 1)
        ]
    )
    longer = candidates.where("words > 2").select("lang", F.explode(F.filter(inner, lambda p: p.isNotNull())).alias("phrase"), "f")
    covered = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    kept = scored.join(covered, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("longest") < F.lit(80).cast("decimal(3,0)") * F.col("a"))
    )
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k
), counted AS MATERIALIZED (
  SELECT lang, k AS words, phrase, string_split(phrase, ' ') AS p, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
), parts AS MATERIALIZED (
  SELECT lang, phrase, f AS a, cuts.k AS k, array_to_string(p[1:cuts.k], ' ') AS head, array_to_string(p[cuts.k + 1:words], ' ') AS tail
  FROM counted, (VALUES (1), (2), (3)) AS cuts(k) WHERE cuts.k < words
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM parts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
), inside AS (
  SELECT lang, array_to_string(p[s.s:s.s + z.z - 1], ' ') AS phrase, max(f) AS longest
  FROM counted, (VALUES (2), (3)) AS z(z), (VALUES (1), (2), (3)) AS s(s) WHERE z.z < words AND s.s + z.z - 1 <= words
  GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON s.lang = i.lang AND s.phrase = i.phrase
  WHERE i.longest IS NULL OR CAST(100 AS HUGEINT) * i.longest < CAST(80 AS HUGEINT) * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
