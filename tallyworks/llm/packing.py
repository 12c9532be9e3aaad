"""Best-two-fit packing of tokenised documents into sequences (operator 7).

Documents are tokenised and cut into pieces of at most `capacity` ids. Pieces meet in groups of about `group_rows`
documents, dealt by a hash of (document, piece), so neither a hot source nor a long document makes a group large.
Inside a group a sequence is filled greedily with the largest piece that fits; then its smallest piece is replaced by
the two unpacked pieces that fill the widened gap most closely, if they fill it better.

Null and empty texts are one piece with the end id alone. Repeated rows are packed each on its own. Ties between pieces
of a length are settled by (doc_id, piece). An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.text import ChunkTable, grouped, worker_state

CAPACITY = 2048
GROUP_ROWS = 16_384
#: Bytes of the table of chunks in each worker.
TABLE_BYTES = 160 << 20


#: Chunks encoded in one call. Plain ones have only ASCII and Latin-1 letters and ASCII signs but "'" and "|" (contractions,
#: special tokens): the known pattern makes each run of letters and each run of signs a word, and normalising moves no border.
LOT = 256
_LETTER, _SIGN, _OTHER = 1, 2, 3
_KIND = np.full(257, _OTHER, np.int8)  # of a code point; the last entry is all beyond Latin-1
_KIND[32] = 0
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'|"]] = _SIGN
_KIND[[c for c in range(65, 256) if chr(c).isalpha() and (c < 128 or c >= 0xC0)]] = _LETTER
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def _marked_ends(path: str) -> np.ndarray | None:
    """Which ids end a word, for tokenizers that cut words by the known pattern and mark the last id of each; else None."""
    made = json.loads(Path(path).read_text(encoding="utf-8"))
    model, suffix = made["model"], made["model"].get("end_of_word_suffix")
    cuts = [p.get("pattern", {}).get("Regex") for p in (made.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    known = cuts == [_WORDS, None] and (made.get("normalizer") or {}).get("normalizers") == _NORMAL
    if not (known and suffix and model["type"] == "BPE" and not model.get("dropout")):
        return None
    ends = np.zeros(max(model["vocab"].values()) + 1 + len(made["added_tokens"]), bool)
    ends[[i for word, i in model["vocab"].items() if word.endswith(suffix)]] = True
    return ends


def _encoder(path: str) -> Callable[[list[bytes]], list[list[int]]]:
    """The ids of each chunk as if it were encoded alone. Plain chunks go many in a call, parted by a space and told apart
    by the ids that end words, since a call and its result cost as much as the words of a chunk."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer, ends = Tokenizer.from_file(path), _marked_ends(path)

    def alone(chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def together(chunks: list[str], words: np.ndarray) -> list[list[int]]:
        (ids,) = alone([" ".join(chunks)])
        last = np.flatnonzero(ends[ids]) + 1
        if len(last) != words.sum() or (len(ids) and last[-1] != len(ids)):
            return alone(chunks)
        cuts = [0, *last[np.cumsum(words) - 1].tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def work(chunks: list[bytes]) -> list[list[int]]:
        text = b" ".join(chunks).decode()
        texts = text.split(" ")
        if ends is None or not all(chunks):
            return alone(texts) if chunks else []
        kinds = _KIND[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 256)]
        starts = np.concatenate([[0], np.flatnonzero(kinds == 0) + 1])
        begins = np.concatenate([[True], kinds[1:] != kinds[:-1]]) & (kinds != 0)
        words = np.add.reduceat(begins, starts, dtype=np.int64)
        odd = np.logical_or.reduceat(kinds == _OTHER, starts)
        out: list = [None] * len(texts)
        other, plain = np.flatnonzero(odd).tolist(), np.flatnonzero(~odd)
        for i, ids in zip(other, alone([texts[i] for i in other]), strict=True):
            out[i] = ids
        for at in range(0, len(plain), LOT):
            lot = plain[at : at + LOT]
            places = lot.tolist()
            for i, ids in zip(places, together([texts[i] for i in places], words[lot]), strict=True):
                out[i] = ids
        return out

    return work


def _token_table(path: str, most_bytes: int = TABLE_BYTES) -> ChunkTable:
    return ChunkTable(_encoder(path), most=600_000, kind=np.uint32, most_bytes=most_bytes)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every document's pieces.

    The tokenizer must drop white space and never join what white space parts: distinct chunks are then encoded once,
    as long as their table has room: `table_bytes` bounds it in each worker and changes no result.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_state("packing", f"tokens {tokenizer} {table_bytes}", lambda: _token_table(tokenizer, table_bytes))
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            out: tuple[list, ...] = ([], [], [], [], [])
            held: list[np.ndarray] = []
            last = 0

            def close(i: int) -> None:
                ids = np.concatenate([*held, np.array([end_id], np.uint32)]).astype("<u4")
                held.clear()
                for n, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    for column, value in zip(out, (i, n, start, len(part), part.tobytes()), strict=True):
                        column.append(value)

            def flush() -> pa.RecordBatch:
                columns = [pa.array(c) for c in out[1:4]]
                taken = keys.take(pa.array(out[0], pa.int64()))
                done = pa.RecordBatch.from_arrays(
                    [taken, columns[0].cast(pa.int32()), columns[1].cast(pa.int64()), columns[2].cast(pa.int64()), pa.array(out[4], pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )
                for column in out:
                    column.clear()
                return done

            for group in grouped(t.as_py() for t in texts):
                split = [piece.encode("utf-8", "replace").split() for _, piece in group]
                codes = table.codes([c for chunks in split for c in chunks])
                ids = table.gather(codes)
                sizes = np.concatenate([[0], np.cumsum(table.sizes(codes))])
                at = 0
                for (i, _), chunks in zip(group, split, strict=True):
                    if i != last:
                        close(last)
                        last = i
                    held.append(ids[sizes[at] : sizes[at + len(chunks)]])
                    at += len(chunks)
                if out[0]:
                    yield flush()
            if batch.num_rows:
                close(last)
                yield flush()

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        pieces, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece. Pieces of a length are taken in the order given."""
    order = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[order], np.arange(capacity + 2))
    left = np.diff(first)
    sizes = np.arange(capacity + 1)
    fits = np.maximum.accumulate(np.where(left > 0, sizes, 0))  # the largest unpacked length up to each
    used = np.zeros(capacity + 1, np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)

    def take(size: int, by: int) -> None:
        nonlocal fits
        was = left[size] > 0
        left[size] += by
        if was != (left[size] > 0):
            fits = np.maximum.accumulate(np.where(left > 0, sizes, 0))

    n, unpacked = 0, len(lengths)
    while unpacked:
        chosen: list[int] = []
        gap = capacity
        while gap and (size := int(fits[gap])):
            take(size, -1)
            chosen.append(size)
            gap -= size
        if gap and len(chosen) > 1:
            smallest, room = chosen[-1], gap + chosen[-1]
            ones = np.flatnonzero(left[: room // 2 + 1])  # the smaller of the two
            twos = fits[room - ones]
            ok = (twos >= ones) & ((twos != ones) | (left[ones] > 1))
            sums = np.where(ok, ones + twos, 0)
            if len(sums) and (best := int(sums.argmax())) >= 0 and sums[best] > smallest:
                one, two = int(ones[best]), int(twos[best])
                take(smallest, 1)
                take(one, -1)
                take(two, -1)
                chosen[-1:] = [two, one]
        offset = 0
        for size in chosen:
            row = order[first[size] + used[size]]
            used[size] += 1
            bins[row], offsets[row] = n, offset
            offset += size
        n, unpacked = n + 1, unpacked - len(chosen)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, documents: int = 0) -> DataFrame:
    """The pieces (doc_id, piece, length and any further columns) with sequence_id and offset.

    `documents` is the number of documents, which sets the number of groups: one piece of each is shorter than full.
    """
    groups = max(1, -(-documents // group_rows))

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = best_two_fit(rows["length"].to_numpy().astype(np.int64), capacity)
        ids = pa.array(key[0].as_py() * (1 << 40) + bins)
        return rows.drop_columns(["packing_group"]).append_column("sequence_id", ids).append_column("offset", pa.array(offsets))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return (
        pieces.withColumn("packing_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
        .groupBy("packing_group")
        .applyInArrow(packed, f"{schema}, sequence_id long, offset long")
    )
