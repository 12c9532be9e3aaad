"""Shared helpers: whole texts in bounded groups, tables of distinct chunks, per-text columns, shared folders.

Texts reach Python in Arrow batches. A batch is worked through in groups of about `GROUP` characters; a longer text is
cut into slices, only where white space follows other text, and put together again by the caller. Memory therefore
depends on neither the number of documents nor their lengths (beyond the text itself).
"""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = 1 << 20
#: Unicode White_Space, which is what "white space" means to the tokenizers; fixed values.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(f"(?<=[^{SPACE}])(?=[ \t\n])")
_STATE: dict = {}


def slices(text: str, size: int = GROUP) -> Iterator[str]:
    """The text in pieces of about `size` characters; a piece that finds no white space goes on to the next one."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def grouped(texts: Iterable[str | None], size: int = GROUP) -> Iterator[list[tuple[int, str]]]:
    """(position, slice) pairs of all texts in order, in groups of about `size` characters. None counts as empty."""
    group: list[tuple[int, str]] = []
    held = 0
    for i, text in enumerate(texts):
        for piece in slices(text or "", size):
            group.append((i, piece))
            held += len(piece)
            if held >= size:
                yield group
                group, held = [], 0
    if group:
        yield group


class Codes(dict):
    """Numbers keys in order of arrival."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n

    def keep(self, most: int) -> None:
        """Forgets the latest keys beyond `most`."""
        while len(self) > most:
            self.popitem()


class ChunkTable:
    """Values of distinct chunks, worked out once each and held as one array with starts.

    `work(chunks)` returns an array of integers or floats for each chunk. The chunks first met stay from call to call, at most
    `most` of them and about `most_bytes`; later ones are worked out again when they return. This bounds memory by bytes,
    whatever comes, and changes no result.
    """

    #: What a chunk takes beside its bytes and values: dictionary entry, objects, starts.
    ENTRY = 200

    def __init__(self, work: Callable[[list], list[np.ndarray]], most: int = 300_000, kind=np.int64, most_bytes: int = 64 << 20):
        self.work, self.most, self.most_bytes = work, most, most_bytes
        self.codes_of = Codes()
        self.values = np.zeros(0, kind)
        self.starts = np.zeros(1, np.int64)
        self.kept, self.held, self.full = 0, 0, False

    def codes(self, chunks: list) -> np.ndarray:
        """The chunks' numbers. They hold until the next call."""
        known = self.kept
        self.codes_of.keep(known)
        codes = np.fromiter(map(self.codes_of.__getitem__, chunks), np.int64, len(chunks))
        if len(self.codes_of) > known:
            fresh = list(islice(self.codes_of, known, None))
            rows = self.work(fresh)
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            new = np.fromiter(chain.from_iterable(rows), self.values.dtype, int(sizes.sum()))
            self.starts = np.concatenate([self.starts[: known + 1], self.starts[known] + np.cumsum(sizes)])
            self.values = np.concatenate([self.values[: self.starts[known]], new])
            if not self.full:
                taken = np.fromiter(map(len, fresh), np.int64, len(fresh)) + self.ENTRY + sizes * self.values.itemsize
                held = self.held + np.cumsum(taken)
                n = min(int(np.searchsorted(held, self.most_bytes, "right")), self.most - known)
                self.full, self.kept = n < len(fresh), known + n
                self.held = int(held[n - 1]) if n else self.held
        return codes

    def sizes(self, codes: np.ndarray) -> np.ndarray:
        return self.starts[codes + 1] - self.starts[codes]

    def gather(self, codes: np.ndarray) -> np.ndarray:
        """The values of all chunks one after another."""
        sizes = self.sizes(codes)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.repeat(self.starts[codes] - (ends - sizes), sizes) + np.arange(total)]


def drop_other_state(kind: str) -> None:
    """Drops what this worker process holds for another kind of work; for work that holds nothing itself."""
    if next(iter(_STATE), (kind,))[0] != kind:
        _STATE.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def worker_state(kind: str, key: str, build: Callable):
    """What `build` makes, kept by this worker process for one `key` of a kind. A worker that goes on to another kind of work
    drops what it held for the last."""
    drop_other_state(kind)
    if (kind, key) not in _STATE:
        for other in [k for k in _STATE if k[1].split(" ")[0] == key.split(" ")[0]]:
            del _STATE[other]
        _STATE[kind, key] = build()
    return _STATE[kind, key]


def text_column(of_texts: Callable[[list], dict], schema: str, name: str) -> Callable[[Column], Column]:
    """A column function over texts: `of_texts(list of texts or None)` gives a dict of lists, one struct field each.

    Marked non-deterministic so that Spark never evaluates it twice for one row (a filter on it is not pushed below).
    """

    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(of_texts([None if t is None or t is pd.NA else t for t in batch]))

    column.__name__ = name
    column.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(column, schema).asNondeterministic()


def fresh_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session without one gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = found.get() if found.isDefined() else None
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    folder = "file://" + tempfile.mkdtemp(prefix="tallyworks-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """A name for a new folder inside the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, "llm")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Lets Spark delete the shuffle files of tables that nothing refers to any more; it does so after a collection."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
