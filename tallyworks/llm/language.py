"""Language identification by prediction by partial matching (operator 5).

Each language has a context tree over bytes, of variable order up to `ORDER`, with the escape estimate of method C:
after a context seen n times with u different followers a follower seen c times costs -log2(c / (n + u)) bits, an
escape -log2(u / (n + u)) and then the cost under the context without its oldest byte; under the empty context a byte
never seen costs 8 bits more than the escape. Statistics are frozen after training, so the exact cost of every
(context, byte) is worked out once, in one table of `(context, byte, language)`: scoring a text looks up one row per
byte, whatever the order.

Training takes a bounded sample: about `SAMPLE_DOCS` documents of each language, of longer ones a stretch of `SAMPLE_CHARS`
characters.
Contexts seen fewer than `LEAST` times over all languages, and those beyond the `CONTEXTS` most frequent, are no nodes
of the trees; their bytes are coded by the next shorter context.

Null texts and texts without a letter get `und` and score 0. Equal code lengths go to the smaller name. Without any
labelled text every document gets `und`.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.text import text_column

ORDER = 3
SAMPLE_DOCS = 250
SAMPLE_CHARS = 20_000
CONTEXTS = 16_384
LEAST = 2
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    byte_class: np.ndarray  # of each byte; the last class holds all bytes that training never saw
    row_of: np.ndarray  # of each context of ORDER classes, the row of its longest suffix in a tree
    bits: np.ndarray  # row, class, language
    order: int = ORDER


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS, longest: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(lang, text) of a bounded, repeatable sample of labelled rows; languages with few rows keep all of them.

    Of a longer text a stretch of `longest` characters is taken, at a place that depends on the text alone.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    start = 1 + F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - longest, F.lit(1)))
    stretch = F.when(F.length("text") <= longest, F.col("text")).otherwise(F.substring("text", start.cast("int"), F.lit(longest)))
    rows = usable.where(place < share[F.col("lang")]).select("lang", stretch.alias("text")).limit(2 * per_language * len(counts)).collect()
    return [(r["lang"], r["text"]) for r in rows]


def train(rows: list[tuple[str, str]], order: int = ORDER, contexts: int = CONTEXTS, least: int = LEAST) -> Model | None:
    """Context trees of all languages as one cost table."""
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    data = [(languages.index(lang), np.frombuffer(text.encode(), np.uint8)) for lang, text in rows if text]
    seen = np.zeros(256, bool)
    for _, text in data:
        seen[text] = True
    byte_class = np.full(256, int(seen.sum()), np.int64)
    byte_class[seen] = np.arange(int(seen.sum()))
    size = int(seen.sum()) + 1
    # follower counts of every order: code of (context, follower) -> count, for each language
    counts: list[list[Counter]] = [[Counter() for _ in languages] for _ in range(order + 1)]
    for lang, text in data:
        classes = byte_class[text]
        for k in range(order + 1):
            if len(classes) > k:
                codes = np.zeros(len(classes) - k, np.int64)
                for j in range(k + 1):
                    codes = codes * size + classes[j : len(classes) - k + j]
                values, n = np.unique(codes, return_counts=True)
                counts[k][lang].update(dict(zip(values.tolist(), n.tolist(), strict=True)))
    nodes: list[tuple[int, int]] = [(0, 0)]
    for k in range(1, order + 1):
        total: Counter = Counter()
        for c in counts[k]:
            for code, n in c.items():
                total[code // size] += n
        nodes += [(k, code) for code, n in sorted(total.items()) if n >= least]
        if k > 1 and len(nodes) > contexts:
            weight = {(k, code): total[code] for code in total}
            nodes = sorted(nodes, key=lambda x: (x[0] == k, -weight.get(x, 0), x))[:contexts]
    nodes.sort()
    at = {node: row for row, node in enumerate(nodes)}
    bits = np.empty((len(nodes), size, len(languages)), np.float32)
    follows = np.zeros((len(nodes), size, len(languages)), np.float32)
    for k in range(order + 1):
        for lang, c in enumerate(counts[k]):
            for code, n in c.items():
                row = at.get((k, code // size))
                if row is not None:
                    follows[row, code % size, lang] = n
    for row, (k, code) in enumerate(nodes):
        shorter = code % size ** (k - 1) if k else 0
        parent = at.get((k - 1, shorter)) if k else None
        while k and parent is None:
            k -= 1
            shorter = code % size ** (k - 1) if k > 1 else 0
            parent = at.get((max(0, k - 1), shorter))
        below = bits[parent] if parent is not None else np.full((size, len(languages)), 8, np.float32)
        n, u = follows[row].sum(0), (follows[row] > 0).sum(0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(n > 0, -np.log2(u / (n + u)), 0)
            bits[row] = np.where(follows[row] > 0, -np.log2(follows[row] / (n + u)), escape + below)
    row_of = np.zeros(size**order, np.int32)
    for row, (k, code) in enumerate(nodes):  # longer contexts come later and write over shorter ones
        if k == 0:
            row_of[:] = row
        else:
            row_of.reshape(-1, size**k)[:, code] = row
    return Model(languages, byte_class, row_of, bits, order)


def code_lengths(model: Model, data: bytes) -> np.ndarray:
    """Bits of the bytes under each language. The first bytes are coded after a run of spaces."""
    size = model.bits.shape[1]
    lead = np.full(model.order, model.byte_class[32], np.int64)
    total = np.zeros(len(model.languages))
    for start in range(0, len(data), 1 << 18):
        classes = np.concatenate([lead, model.byte_class[np.frombuffer(data, np.uint8)[start : start + (1 << 18)]]])
        n = len(classes) - model.order
        context = np.zeros(n, np.int64)
        for j in range(model.order):
            context = context * size + classes[j : j + n]
        total += model.bits[model.row_of[context], classes[model.order :]].sum(0, dtype=np.float64)
        lead = classes[-model.order :]
    return total


def detector(docs: DataFrame, model: Model | None):
    """A column function: text -> struct<lang_pred string, score double, bits array<double>>."""
    if model is None:
        return lambda text: F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast("array<double>").alias("bits"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most CONTEXTS rows

    def of_texts(texts: list) -> dict:
        m = held.value
        out: dict = {"lang_pred": [], "score": [], "bits": []}
        for text in texts:
            bits = code_lengths(m, text.encode("utf-8", "replace")) if text else np.zeros(len(m.languages))
            best = int(bits.argmin())
            out["lang_pred"].append(m.languages[best])
            out["score"].append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
            out["bits"].append(bits.tolist())
        return out

    return text_column(of_texts, "lang_pred string, score double, bits array<double>", "language_" + uuid.uuid4().hex[:6])


def detect(docs: DataFrame, text: Column, model: Model | None) -> Column:
    """The language struct of a text column; texts without a letter never reach the model."""
    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast("array<double>").alias("bits"))
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    found = detector(docs, model)(F.when(lettered, text))
    return F.when(lettered, found).otherwise(nothing)
