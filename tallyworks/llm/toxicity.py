"""Toxicity by a subsequence string kernel and a support vector machine over Nyström landmarks (operator 1).

Units are the words of a text in lower case, with a mark for the word's start, and runs of single letters ("i d i o t").
The kernel of two units sums, over all three-symbol subsequences that both hold within a window of `SPAN` symbols, the
product of their weights LAMBDA**(spanned symbols): letters pushed in between, or signs that part the letters, lower a
subsequence's weight and do not lose it. It is normalised by both units' norms.

Training takes the sentences of at most `TRAIN_DOCS` labelled documents (the smallest by hash). Each unit of a sentence
carries the sentence's label; equal units are one row with the counts of both labels as weights, the `TRAIN_UNITS` most
informative and most frequent of which are kept. `LANDMARKS` of them map every unit by the Nyström method, and a linear
machine is fitted there by minimising the squared hinge loss. A logistic curve over the strongest margin and the
number and sum of positive margins, fitted on the same documents, turns a text's margins into a score.

Because the machine is linear in the kernel values, it folds into one weight per subsequence (a table of 32**3 values);
scoring a unit sums the weights of its subsequences and divides by the unit's norm. This is the same number.

Null and empty texts, and texts without letters, score as a text without any positive unit. Repeated rows score alike.
Without labelled rows of both kinds the score of every text is 0.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.text import ChunkTable, grouped, text_column, worker_state

LAMBDA, SPAN, SYMBOLS = 0.6, 6, 32
TRAIN_DOCS, TRAIN_UNITS, LANDMARKS = 8_000, 8_000, 320
THRESHOLD = 0.7
#: Training runs on the driver. Units whose kernel values are worked out at once (each takes a row of landmarks for every
#: subsequence), and bytes of the table of chunks while the curve is fitted; neither changes a result.
KERNEL_ROWS, CURVE_BYTES = 25, 16 << 20
#: Margins below this say nothing more about a text.
FLOOR = 0.0
#: Units are taken in stretches of this many symbols, which overlap by SPAN.
STRETCH = 48
_GAPPED = re.compile(r"(?<!\w)[a-z](?:[\s._*-]{1,3}[a-z](?!\w)){2,40}")
_PARTED = re.compile(r"[\s._*-]+")
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


#: Symbols of code points below 128: letters 1-26, 27 the mark of a word's start, digits 28-31, 0 anything else.
_ASCII = np.zeros(128, np.int32)
_ASCII[97:123] = np.arange(1, 27)
_ASCII[94] = 27
_ASCII[48:58] = 28 + np.arange(48, 58) % 4


def symbols(text: str) -> np.ndarray:
    """A symbol for each character; characters beyond ASCII share four."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(codes < 128, _ASCII[codes & 127], 28 + (codes & 3)).astype(np.int32)


def stretches(chunk: str) -> list[str]:
    """The units of a lower-case chunk: the word with its start marked, as a whole or in overlapping stretches."""
    word = "^" + chunk.strip(".,;:!?\"'()[]|#$%&*")
    if len(word) <= STRETCH:
        return [word]
    return [word[i : i + STRETCH] for i in range(0, len(word) - SPAN, STRETCH - SPAN)]


def chunks(text: str) -> list[str]:
    """The words of a text in lower case, and its runs of single letters as words."""
    lowered = text.lower()
    return [*lowered.split(), *(_PARTED.sub("", m.group()) for m in _GAPPED.finditer(lowered))]


def units(text: str) -> list[str]:
    return [u for c in chunks(text) for u in stretches(c)]


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (0 where a symbol is missing) and weights of all three-symbol subsequences of padded symbol rows."""
    codes, weights = [], []
    n = rows.shape[1]
    for last in range(2, SPAN):
        if last >= n:
            break
        a, c = rows[:, : n - last], rows[:, last:]
        for mid in range(1, last):
            b = rows[:, mid : mid + n - last]
            codes.append(np.where((a > 0) & (b > 0) & (c > 0), (a * SYMBOLS + b) * SYMBOLS + c, 0))
            weights.append(np.full(n - last, LAMBDA ** (last + 1)))
    if not codes:
        return np.zeros((len(rows), 1), np.int64), np.zeros(1)
    return np.concatenate(codes, 1), np.concatenate(weights)


def _padded(found: list[str]) -> np.ndarray:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    rows = np.zeros((len(found), max(3, int(sizes.max(initial=0)))), np.int32)
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = symbols("".join(found))
    return rows


def _features(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each row with their summed weights, normalised; padding is code 0 with weight 0."""
    codes, weights = subsequences(rows)
    order = np.argsort(codes.astype(np.int16), axis=1, kind="stable")
    codes = np.take_along_axis(codes, order, 1)
    summed = np.cumsum(np.where(codes > 0, weights[order], 0), axis=1)
    ends = np.concatenate([codes[:, 1:] != codes[:, :-1], np.ones((len(codes), 1), bool)], 1)
    total = np.where(ends, summed, 0)
    before = np.concatenate([np.zeros((len(codes), 1)), np.maximum.accumulate(total, 1)[:, :-1]], 1)
    value = np.where(ends & (codes > 0), total - before, 0)
    norm = np.sqrt((value**2).sum(1, keepdims=True))
    return codes, np.divide(value, norm, out=np.zeros_like(value), where=norm > 0)


#: Letters that are worked through at once, padding included.
CELLS = 40_000


@dataclass
class Model:
    weight: np.ndarray  # of each subsequence
    bias: float
    curve: np.ndarray  # intercept, strongest margin, log(1 + positive units), log(1 + 10 * their sum)

    def margins(self, found: list[str]) -> np.ndarray:
        """Of each unit, but not less than FLOOR.

        A norm is at least that of the same subsequences if no two were equal. Units that this bound keeps below FLOOR
        are not normalised exactly.
        """
        out = np.full(len(found), FLOOR)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        by_length = np.argsort(-sizes, kind="stable")
        at = 0
        while at < len(by_length):
            # longest first, so that the first of a part says how wide its rows are
            part = by_length[at : at + max(1, min(2000, CELLS // max(1, int(sizes[by_length[at]]))))]
            at += len(part)
            rows = _padded([found[i] for i in part])
            codes, weights = subsequences(rows)
            weights = np.where(codes > 0, weights.astype(np.float32), np.float32(0))
            sums, least = (self.weight[codes] * weights).sum(1), np.sqrt((weights**2).sum(1))
            near = np.flatnonzero(sums > (FLOOR - self.bias - 1e-4) * least) if self.bias <= FLOOR else np.arange(len(part))
            if len(near):
                codes, values = _features(rows[near])
                out[part[near]] = np.maximum((self.weight[codes] * values).sum(1) + self.bias, FLOOR)
        return out

    def of_chunks(self, found: list[str]) -> list[np.ndarray]:
        """The margins of each chunk's units."""
        own = [stretches(c) for c in found]
        margins = self.margins([u for us in own for u in us]).astype(np.float32)
        return np.split(margins, np.cumsum([len(us) for us in own])[:-1]) if own else []

    def score(self, strongest: np.ndarray, positive: np.ndarray, total: np.ndarray) -> np.ndarray:
        x = _curve_inputs(strongest, positive, total) @ self.curve
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _curve_inputs(strongest: np.ndarray, positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(strongest)), strongest, np.log1p(positive), np.log1p(10 * total)], 1)


def _summary(texts: list, table: ChunkTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strongest margin, number of positive units and the sum of their margins of each text."""
    strongest, positive, total = np.full(len(texts), FLOOR), np.zeros(len(texts)), np.zeros(len(texts))
    for group in grouped(texts):
        found = [chunks(piece) for _, piece in group]
        codes = table.codes([c for f in found for c in f])
        held, margins = table.sizes(codes), table.gather(codes)
        ends = np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], np.cumsum([len(f) for f in found])])]
        sizes = np.diff(ends).tolist()
        at = 0
        for (i, _), size in zip(group, sizes, strict=True):
            own = margins[at : at + size]
            at += size
            if size:
                strongest[i] = max(strongest[i], own.max())
                positive[i] += (own > 0).sum()
                total[i] += own[own > 0].sum()
    return strongest, positive, total


def _fit_machine(z: np.ndarray, weight: np.ndarray, reg: float = 1e-6) -> np.ndarray:
    """Linear machine with squared hinge loss by damped Newton steps; `weight` holds each row's weight as label 0 and 1.

    The last column of z is 1.
    """
    weight = weight / weight.sum()
    ridge = reg * np.eye(z.shape[1])

    def loss(w: np.ndarray) -> float:
        m = z @ w
        return reg * w @ w + weight[:, 0] @ np.maximum(0, 1 + m) ** 2 + weight[:, 1] @ np.maximum(0, 1 - m) ** 2

    w = np.zeros(z.shape[1])
    now = loss(w)
    for _ in range(40):
        m = z @ w
        clean, toxic = weight[:, 0] * (m > -1), weight[:, 1] * (m < 1)
        step = np.linalg.solve(ridge + z.T @ (z * (clean + toxic)[:, None]), z.T @ (toxic - clean)) - w
        share, was = 1.0, now
        while share > 1e-4 and (now := loss(w + share * step)) > was:
            share /= 2
        if now > was * (1 - 1e-6):
            break
        w = w + share * step
    return w


def _fit_curve(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(x.shape[1]), x.T @ (toxic - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """text, toxic of at most `most` labelled documents, the smallest by hash of their id."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # at most `most` ids


def _landmark_table(units: list[str]) -> np.ndarray:
    """The features of each unit as a column over all subsequences."""
    table = np.zeros((SYMBOLS**3, len(units)), np.float32)
    for j, (codes, values) in enumerate(zip(*_features(_padded(units)), strict=True)):
        np.add.at(table[:, j], codes, values)
    return table


def train(rows: list[tuple[str | None, int]], keep: int = TRAIN_UNITS, landmarks: int = LANDMARKS) -> Model | None:
    """Fits the machine to a bounded list of (text, toxic)."""
    toxic = np.array([y for _, y in rows], float)
    if not len(rows) or toxic.min() == toxic.max():
        return None
    found, counts = (Counter(), Counter()), (Counter(), Counter())  # sentences with a chunk and with a unit, by label
    for text, y in rows:
        for sentence in _SENTENCE.split(text or ""):
            found[y].update(set(chunks(sentence)))
    for of_chunks, of_units in zip(found, counts, strict=True):
        while of_chunks:
            chunk, times = of_chunks.popitem()
            for unit in stretches(chunk):
                of_units[unit] += times
    names = sorted(counts[0].keys() | counts[1].keys())
    n = np.array([[c[u] for c in counts] for u in names], float).reshape(-1, 2)
    del counts
    if not len(names):
        return None
    lean = (n[:, 1] + 0.5) / (n.sum(1) + 1) - n[:, 1].sum() / n.sum()
    informative = np.abs(lean) * np.sqrt(n.sum(1))
    chosen = np.union1d(np.argsort(-informative, kind="stable")[: keep // 2], np.argsort(-n.sum(1), kind="stable")[: keep // 2])
    names, n, lean, informative = [names[i] for i in chosen], n[chosen], lean[chosen], informative[chosen]
    up = np.argsort(np.where(lean > 0, -informative, 1), kind="stable")[: landmarks // 2]
    often = np.argsort(-n[:, 0], kind="stable")[:landmarks]
    marks = list(dict.fromkeys([*up.tolist(), *often.tolist()]))[:landmarks]

    table = _landmark_table([names[i] for i in marks])
    kernel = np.empty((len(names), len(marks)))
    for first in range(0, len(names), 200):
        codes, values = _features(_padded(names[first : first + 200]))
        for at in range(0, len(codes), KERNEL_ROWS):
            part = slice(at, at + KERNEL_ROWS)
            rows_of = np.einsum("nk,nkm->nm", values[part], table[codes[part]], optimize=True)
            kernel[first + at : first + at + len(rows_of)] = rows_of
    del table  # made again below: it is the largest
    among = kernel[marks]
    eigenvalues, vectors = np.linalg.eigh((among + among.T) / 2)
    good = eigenvalues > 1e-6 * eigenvalues.max()
    root = vectors[:, good] / np.sqrt(eigenvalues[good])
    z = np.concatenate([kernel @ root, np.ones((len(names), 1))], 1)
    del kernel
    w = _fit_machine(z, n)
    del z
    table = _landmark_table([names[i] for i in marks])
    folded = root @ w[:-1]
    weight = np.concatenate([part @ folded for part in np.split(table, 32)])  # in parts: each is widened to doubles
    model = Model(weight.astype(np.float32), float(w[-1]), np.zeros(4))
    model.weight[0] = 0
    del table  # the texts are gone through once more
    summary = _summary([t for t, _ in rows], ChunkTable(model.of_chunks, kind=np.float32, most_bytes=CURVE_BYTES))
    model.curve = _fit_curve(_curve_inputs(*summary), toxic)
    return model


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model | None:
    return train([(r["text"], r["toxic"]) for r in labelled(docs, labels, most).collect()])


def scorer(docs: DataFrame, model: Model | None):
    """A column function: text -> struct<score double, strongest double, positive int>."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # one table of SYMBOLS**3 values
    key = f"model {uuid.uuid4().hex}"

    def of_texts(texts: list) -> dict:
        m = held.value
        if m is None:
            return {"score": [0.0] * len(texts), "strongest": [FLOOR] * len(texts), "positive": [0] * len(texts)}
        table = worker_state("toxicity", key, lambda: ChunkTable(m.of_chunks, most=200_000, kind=np.float32, most_bytes=40 << 20))
        strongest, positive, total = _summary(texts, table)
        return {"score": m.score(strongest, positive, total), "strongest": strongest, "positive": positive.astype(np.int32)}

    return text_column(of_texts, "score double, strongest double, positive int", "toxicity")
