"""Line dedup by overlapping three-line windows (operator 10).

Every three consecutive lines of a document are a window, known by two 64-bit hashes. The first occurrence of a window in the
corpus, by (doc_id, hash of the whole text, place), stays; the lines of all later ones are covered, and covered lines are
removed. Occurrences that overlap cover their union. The other lines keep their order and are joined again by a line feed.

Lines end at line feeds and are compared as they are. Documents with fewer than three lines have no window and stay as
they are, as do null and empty texts. Rows without an id come before all ids. Different texts under one id, or without
one, are documents of their own. Rows alike in id and text are the same occurrence, so none of them is later than the
other. A document may lose all its lines; its row stays, with an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.text import fresh_name

WINDOW = 3
_FIRST = -(1 << 63)


def _at() -> Column:
    """What tells documents apart, in their order: doc_id (the least value for null) and the hash of the whole text."""
    return F.struct(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("own"),
    )


def windows(docs: DataFrame) -> DataFrame:
    """at (id, own), place (from 0), one, two (hashes) of every window."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    hashes = F.when(
        F.size("lines") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size("lines") - (WINDOW - 1)),
            lambda i: F.struct(
                F.xxhash64(*[F.element_at("lines", (i + k).cast("int")) for k in range(WINDOW)]).alias("one"),
                F.xxhash64(F.lit(WINDOW), *[F.element_at("lines", (i + k).cast("int")) for k in reversed(range(WINDOW))]).alias("two"),
            ),
        ),
    )
    rows = docs.select(_at().alias("at"), lines.alias("lines"))
    return rows.select("at", F.posexplode(hashes).alias("place", "hash")).select("at", "place", "hash.one", "hash.two")


def later_windows(docs: DataFrame) -> DataFrame:
    """at, place of every window that has occurred before."""
    found = windows(docs)
    occurrence = F.struct("at", "place")
    repeated = (
        found.groupBy("one", "two")
        .agg(F.min(occurrence).alias("first"), F.max(occurrence).alias("last"))
        .where("first <> last")
        .select("one", "two", F.col("first.at").alias("first_at"), F.col("first.place").alias("first_place"))
    )
    return found.join(repeated, ["one", "two"]).where("at <> first_at or place <> first_place").select("at", "place")


def _kept(column_type: str = "string"):
    @F.pandas_udf(column_type)
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, places in batches:
            out = []
            for text, at in zip(texts, places, strict=True):
                if text is None or at is None or not len(at):
                    out.append(text)
                    continue
                lines = text.split("\n")
                covered = np.zeros(len(lines) + WINDOW, bool)
                for k in range(WINDOW):
                    covered[np.asarray(at) + k] = True
                out.append("\n".join(line for line, gone in zip(lines, covered, strict=False) if not gone))
            yield pd.Series(out, dtype=object)

    return kept


def without_repeats(docs: DataFrame) -> DataFrame:
    """All columns and rows, texts without lines that later windows cover, and `removed_lines`."""
    key, places = fresh_name(docs, "row_key"), fresh_name(docs, "later_places")
    count = fresh_name(docs, "removed_lines")
    later = later_windows(docs).groupBy(F.col("at").alias(key)).agg(F.collect_set("place").alias(places))
    joined = docs.withColumn(key, _at()).join(later, key, "left")
    covered: Column = F.when(F.col(places).isNull(), F.lit(0)).otherwise(
        F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + (WINDOW - 1))))))
    )
    text = F.when(F.col(places).isNull(), F.col("text")).otherwise(_kept()(F.col("text").cast("string"), F.col(places)))
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns], covered.cast("long").alias(count))


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), windows AS (
  SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)
), placed AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows
), covered AS (
  SELECT DISTINCT doc_id, i + d AS i FROM placed, (VALUES (0), (1), (2)) AS t(d) WHERE k > 1
), each_line AS (
  SELECT doc_id, l[i] AS line, i FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM lines)
), left_over AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.i) FILTER (WHERE c.i IS NULL) AS text, count(c.i) AS removed_lines
  FROM each_line e LEFT JOIN covered c ON e.doc_id = c.doc_id AND e.i = c.i GROUP BY e.doc_id
)
SELECT doc_id, CAST(removed_lines AS BIGINT) AS removed_lines, md5(coalesce(text, '')) AS text_md5 FROM left_over
"""
