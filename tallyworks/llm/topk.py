"""Exact top-k search by inner product, term at a time (operator 6).

Vectors are packed where they lie, in blocks of at most `CANDIDATES` (and `QUERIES`) rows. Every block of queries meets
every block of candidates: candidate blocks are dealt to `groups` groups, each query block is sent to each group once.
Inside a block pair each query row goes through its non-zero terms; a term's postings, weighted, are added to a dense
array of scores, of which the k best are selected by partition. A task merges over its candidate blocks while it stays
with a query block; Spark merges the rest by query.

Weights are floor(256 x) of each component as a double. Vectors that are null, empty of components, or hold null or
non-finite components take no part; vectors of another length match on the terms that both have. A row never matches
rows of its own id. Ties go to the smaller id; repeated rows of an id count as one match with the best score. Ids that
are null take no part. Fewer than k candidates give fewer rows. A vector whose components are so large that scores may
pass 64 bits (terms times the square of the largest weight) fails the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANDIDATES, QUERIES = 8192, 1024
SCALE = 256
_BLOCK = "block long, n int, terms int, ids binary, weights binary"
_SAFE = 1 << 48
_MOST = 2.0**63


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, embedding) packed into blocks of at most `size` rows of one length, in order of id."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(terms: int) -> pa.RecordBatch:
            rows = sorted(held.pop(terms), key=lambda r: r[0])
            ids = np.array([r[0] for r in rows], np.int64)
            weights = np.array([r[1] for r in rows], np.int64).reshape(len(rows), terms)
            names = ["block", "n", "terms", "ids", "weights"]
            first = int(ids[0])
            return pa.RecordBatch.from_pydict(
                {k: pa.array([v], t) for k, v, t in zip(names, (first, len(rows), terms, ids.tobytes(), weights.tobytes()), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)}
            )

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                rows = held.setdefault(len(x), [])
                scaled = np.floor(x * SCALE)
                if len(x) * float(np.abs(scaled).max()) ** 2 >= _MOST:
                    raise ValueError(f"vector {vec_id}: products of such components may not fit a 64-bit score")
                rows.append((vec_id, scaled.astype(np.int64)))
                if len(rows) >= size:
                    yield block(len(x))
        for terms in list(held):
            yield block(terms)

    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & whole)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).mapInArrow(packed, _BLOCK)


class Postings:
    """The non-zero weights of a candidate block by term."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        self.ids = ids
        self.terms: list[tuple[np.ndarray | None, np.ndarray]] = []
        for t in range(weights.shape[1]):
            rows = np.flatnonzero(weights[:, t])
            whole = len(rows) == len(ids)
            self.terms.append((None if whole else rows, np.ascontiguousarray(weights[rows, t])))

    def scores(self, query: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.ids), np.int64)
        for t in np.flatnonzero(query[: len(self.terms)]):
            rows, weights = self.terms[t]
            if rows is None:
                total += weights * query[t]
            else:
                total[rows] += weights * query[t]
        return total


def best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best (score, id), ties to smaller ids, of distinct ids other than `own`; `ids` ascend."""
    free = ids != own
    repeats = bool((ids[1:] == ids[:-1]).any())
    if repeats or (len(scores) and max(scores.max(), -scores.min()) >= _SAFE):
        found: dict[int, int] = {}
        for i, s in zip(ids[free].tolist(), scores[free].tolist(), strict=True):
            found[i] = max(s, found.get(i, s))
        return sorted(((s, i) for i, s in found.items()), key=lambda x: (-x[0], x[1]))[:k]
    n = len(ids)
    key = scores * n + np.arange(n - 1, -1, -1)  # one order without ties
    key = np.where(free, key, np.iinfo(np.int64).min)
    top = np.argpartition(key, n - k)[n - k :] if n > k else np.arange(n)
    top = top[free[top]]
    return [(int(scores[i]), int(ids[i])) for i in top[np.argsort(-key[top])]]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, groups: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query row."""
    spark = vectors.sparkSession
    groups = groups or int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = blocks(vectors, CANDIDATES).withColumn("grp", F.pmod(F.xxhash64("block", "ids"), F.lit(groups)))
    queries = blocks(vectors.where(is_query), QUERIES).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"),
        F.xxhash64("ids", "weights").alias("q_block"),
        *[F.col(c).alias(f"q_{c}") for c in ("n", "terms", "ids", "weights")],
    )
    met = queries.join(candidates, "grp")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        tops: list[list[tuple[int, int]]] = []
        ids = weights = np.zeros(0, np.int64)
        last: tuple[bytes, Postings] | None = None

        def flush() -> pa.RecordBatch:
            rows = [(q, s, i) for q, top in zip(ids.tolist(), tops, strict=True) for s, i in top]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "score", "vec_id"])

        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(i)[r].as_py() for i, name in enumerate(batch.schema.names)}
                if at != (row["q_block"], row["q_ids"]):
                    if at is not None:
                        yield flush()
                    at = (row["q_block"], row["q_ids"])
                    ids = np.frombuffer(row["q_ids"], np.int64)
                    weights = np.frombuffer(row["q_weights"], np.int64).reshape(row["q_n"], row["q_terms"])
                    tops = [[] for _ in ids]
                if last is None or last[0] != row["ids"]:
                    block = np.frombuffer(row["weights"], np.int64).reshape(row["n"], row["terms"])
                    last = (row["ids"], Postings(np.frombuffer(row["ids"], np.int64), block))
                for j, (own, query) in enumerate(zip(ids.tolist(), weights, strict=True)):
                    found: dict[int, int] = {}
                    for s, i in tops[j] + best(last[1].ids, last[1].scores(query), own, k):
                        found[i] = max(s, found.get(i, s))
                    tops[j] = sorted(((s, i) for i, s in found.items()), key=lambda x: (-x[0], x[1]))[:k]
        if at is not None:
            yield flush()

    partial = met.select("q_block", "q_n", "q_terms", "q_ids", "q_weights", "n", "terms", "ids", "weights").mapInArrow(
        searched, "query_id long, score long, vec_id long"
    )
    merged = partial.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k).alias("top")
    )
    ranked = merged.select("query_id", F.posexplode("top").alias("pos", "t"))
    return ranked.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.minus")).alias("score"))
