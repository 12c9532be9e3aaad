"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding (operator 8).

The tokens that BPE gives a prefix end in one last token, and a sequence of tokens is what BPE gives exactly if each two
neighbours are what BPE gives for their joined bytes. So reading a byte adds one last token, found among the tokens
that end there; which it is follows from the last tokens at their starts. A state of the transducer is the last token
that was emitted and the bytes since. A token is emitted once all places where a longer token may still begin lie
behind it on one path; the lookahead is therefore bounded by the longest token. A transition and its state are made when
they have been met a few times; until then words that meet them are run undetermined. At a bound of states all but the
one that is read from are dropped and made again as they are met, so what is held follows the data.

As in the public encoders, a match of the pattern that is itself a token is that token. The pattern never joins a
character with white space that follows it, so a text falls into chunks (white space, then other text); distinct chunks
are encoded once. Null and empty texts have no ids. Decoding turns ids back into bytes; `Utf8` gives the text of a
stream of byte pieces that may end inside a character.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.text import SPACE, ChunkTable, grouped, worker_state

_CHUNK = re.compile(f"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++")
#: So many states are held at once.
MOST_STATES = 30_000
#: A transition is made when it is met so often.
MEETINGS = 4
#: Ids of so many matches of the pattern, each of at most so many characters, are kept for chunks that are met later.
MOST_MATCHES, LONGEST_MATCH = 180_000, 32


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


_NEVER = 1 << 60


class Transducer:
    """States and transitions over bytes. `ranks` are the merges: a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        # bytes that are a token or begin a longer one -> (token or -1, whether a longer one begins so)
        self.known: dict[bytes, tuple[int, bool]] = {t: (i, False) for t, i in ranks.items()}
        for t in ranks:
            for n in range(1, len(t)):
                self.known[t[:n]] = (ranks.get(t[:n], -1), True)
        # the same by byte: byte -> (what may come next or None, token or -1)
        self.tree: dict[int, tuple[dict | None, int]] = {}
        below = {t: {} for t, (_, longer) in self.known.items() if longer} | {b"": self.tree}
        for t, (token, _) in self.known.items():
            below[t[:-1]][t[-1]] = (below.get(t), token)
        self._pairs: dict[tuple[int, int], bool] = {}
        self._edges: dict[int, tuple | None] = {}
        self.reset()

    def reset(self) -> None:
        self.keys: dict[tuple, int] = {}
        # of each state: root token, bytes since, places where a token may begin, and the way there: place -> last
        # token, place where that begins
        self.held: list[tuple[int, bytes, list[int], dict[int, tuple[int, int]]]] = []
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}  # by 256 * state + byte
        self.ends: dict[int, tuple[int, ...]] = {}
        self.met: dict[int, int] = {}  # how often transitions were asked for that are not made
        self._state(-1, b"", [0], {})

    def _state(self, root: int, tail: bytes, opens: list[int], lasts: dict[int, tuple[int, int]]) -> int:
        key = (root, tail)
        found = self.keys.get(key)
        if found is None:
            found = self.keys[key] = len(self.held)
            self.held.append((root, tail, opens, lasts))
        return found

    def merged(self, data: bytes) -> list[bytes]:
        """BPE by its definition: join the neighbours of the least rank, the leftmost first, until none can be."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == _NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _edge(self, token: int) -> tuple | None:
        """What stands at the token's left and right edge while it is built, outermost last.

        None if BPE does not build the token, or not by ever greater ranks: then pairs are tried by `merged`.
        """
        if token not in self._edges:
            data = self.bytes_of[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            left, right, last = [parts[0]], [parts[-1]], -1
            while len(parts) > 1:
                rank, i = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == _NEVER or rank < last:
                    break
                last = rank
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                if i == 0:
                    left.append(parts[0])
                if i == len(parts) - 1:
                    right.append(parts[-1])
            self._edges[token] = (left, right) if len(parts) == 1 else None
        return self._edges[token]

    def _follows(self, first: int, second: int) -> bool:
        """Whether BPE of the joined bytes gives the two tokens."""
        known = self._pairs.get((first, second))
        if known is None:
            if len(self._pairs) > 1 << 18:
                self._pairs.clear()
            known = self._pairs[first, second] = self._tried(first, second)
        return known

    def _tried(self, first: int, second: int) -> bool:
        if first < 0:
            return self._edge(second) is not None or self.merged(self.bytes_of[second]) == [self.bytes_of[second]]
        one, two = self._edge(first), self._edge(second)
        if one is None or two is None:
            a, b = self.bytes_of[first], self.bytes_of[second]
            return self.merged(a + b) == [a, b]
        # both sides grow in order of rank; they stay apart if no pair at the border is due before its own sides are
        lefts, rights, i, j = one[1], two[0], 0, 0
        rank = self.ranks.get
        while True:
            across = rank(lefts[i] + rights[j], _NEVER)
            grow_left = rank(lefts[i + 1]) if i + 1 < len(lefts) else _NEVER
            grow_right = rank(rights[j + 1]) if j + 1 < len(rights) else _NEVER
            if across < grow_left and across <= grow_right and across < _NEVER:
                return False
            if grow_left == grow_right == _NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state and the tokens emitted on the way."""
        root, tail, opens, lasts = self.held[state]
        tail += bytes((byte,))
        n, known, last = len(tail), self.known, None
        heads = []  # places where a longer token may begin, and the end: all later bytes follow one of their ways
        for j in opens:
            found = known.get(tail[j:])
            if found is None:
                continue
            if found[1]:
                heads.append(j)
            if last is None and found[0] >= 0 and self._follows(lasts[j][0] if j else root, found[0]):
                last = (found[0], j)
        heads.append(n)
        way = {n: last}
        ahead = list(heads)
        while len(ahead) > 1:  # go back from the farthest until the ways meet
            far = ahead.pop()
            step = way[far] = way.get(far) or lasts[far]
            if step[1] not in ahead:
                ahead.append(step[1])
                ahead.sort()
        base = ahead[0]
        emitted: tuple[int, ...] = ()
        if base:
            place, out = base, []
            while place:
                token, place = last if place == n else lasts[place]
                out.append(token)
            emitted = tuple(reversed(out))
            root, tail = emitted[-1], tail[base:]
            heads = [j - base for j in heads]
            way = {p - base: (t, b - base) for p, (t, b) in way.items() if p > base}
        move = self.moves[state << 8 | byte] = (self._state(root, tail, heads, way), emitted)
        return move

    def finish(self, state: int) -> tuple[int, ...]:
        """The tokens left at the end of the input."""
        done = self.ends.get(state)
        if done is None:
            _, tail, _, lasts = self.held[state]
            place, out = len(tail), []
            while place:
                token, place = lasts[place]
                out.append(token)
            done = self.ends[state] = tuple(reversed(out))
        return done

    def encode(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, moves = 0, self.moves
        for byte in data:
            move = moves.get(state << 8 | byte)
            if move is None:
                key = state << 8 | byte
                times = self.met.get(key, 0) + 1
                if times < MEETINGS:
                    if len(self.met) >= 4 * MOST_STATES:
                        self.met.clear()
                    self.met[key] = times
                    return self.simulated(data)
                if len(self.held) >= MOST_STATES:
                    here = self.held[state]
                    self.reset()
                    state, moves = self._state(*here), self.moves
                move = self.step(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        return [*out, *self.finish(state)]

    def simulated(self, data: bytes) -> list[int]:
        """The same ids without states: all places where a token may begin are followed, one after another.

        Of the tokens that end at a place the longest that follows counts, so the first one found from the left.
        """
        pairs, follows = self._pairs, self._follows
        size = len(data)
        lasts: list[tuple[int, int] | None] = [(-1, 0)] + [None] * size
        for j in range(size):
            before, node, n = lasts[j][0], self.tree, j
            while node and n < size:
                found = node.get(data[n])
                if found is None:
                    break
                node, token = found
                n += 1
                if token >= 0 and lasts[n] is None:
                    fits = pairs.get((before, token))
                    if follows(before, token) if fits is None else fits:
                        lasts[n] = (token, j)
        out, place = [], size
        while place:
            token, place = lasts[place]
            out.append(token)
        return out[::-1]


class Encoder:
    """Ids of whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        # white space as the public encoders have it: the Unicode property
        self.pattern = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.table = ChunkTable(self._chunks, most=450_000, kind=np.int32, most_bytes=112 << 20)

        # tuples, since they take less than lists and the garbage collector leaves them alone
        self.matches: dict[str, tuple[int, ...]] = {}

    def _chunks(self, chunks: list[str]) -> list[list[int]]:
        known, find = self.matches.get, self.pattern.findall
        return [[i for m in find(c) for i in known(m) or self._match(m)] for c in chunks]

    def _match(self, match: str) -> list[int]:
        ids = self.transducer.encode(match.encode("utf-8", "replace"))
        if len(self.matches) < MOST_MATCHES and len(match) <= LONGEST_MATCH:
            self.matches[match] = tuple(ids)
        return ids

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(position, ids) of the texts' slices, in order."""
        for group in grouped(texts):
            found = [_CHUNK.findall(piece) for _, piece in group]
            codes = self.table.codes([c for chunks in found for c in chunks])
            ids = self.table.gather(codes)
            ends = np.concatenate([[0], np.cumsum(self.table.sizes(codes))])
            at = 0
            for (i, _), chunks in zip(group, found, strict=True):
                yield i, ids[ends[at] : ends[at + len(chunks)]]
                at += len(chunks)


class Utf8:
    """Incremental UTF-8 decoding as a state machine: feed byte pieces, get the characters completed so far.

    The state is the number of bytes that a character still needs, the range of the next one, and the bits so far. A byte
    that fits nowhere gives U+FFFD; if it broke off a character, it is read again from the start.
    """

    def __init__(self) -> None:
        self.need, self.low, self.high, self.bits = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        for byte in data:
            if self.need and not self.low <= byte <= self.high:
                out.append("�")
                self.need = 0
            if not self.need:
                self._begin(byte, out)
                continue
            self.bits, self.need, self.low, self.high = self.bits << 6 | byte & 0x3F, self.need - 1, 0x80, 0xBF
            if not self.need:
                out.append(chr(self.bits))
        return "".join(out)

    def _begin(self, byte: int, out: list[str]) -> None:
        self.low, self.high = 0x80, 0xBF
        if byte < 0x80:
            out.append(chr(byte))
        elif 0xC2 <= byte <= 0xDF:
            self.need, self.bits = 1, byte & 0x1F
        elif 0xE0 <= byte <= 0xEF:
            self.need, self.bits = 2, byte & 0x0F
            self.low, self.high = (0xA0 if byte == 0xE0 else 0x80), (0x9F if byte == 0xED else 0xBF)
        elif 0xF0 <= byte <= 0xF4:
            self.need, self.bits = 3, byte & 0x07
            self.low, self.high = (0x90 if byte == 0xF0 else 0x80), (0x8F if byte == 0xF4 else 0xBF)
        else:
            out.append("�")

    def close(self) -> str:
        left, self.need = "�" * bool(self.need), 0
        return left


class Decoder:
    """Text of a stream of ids. Tokens that are whole characters are taken from a table; others go through `Utf8`."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        self.text_of: list[str | None] = [None] * size
        self.parted = np.zeros(size, bool)  # tokens that begin or end inside a character
        for token, i in ranks.items():
            self.bytes_of[i] = token
            try:
                self.text_of[i] = token.decode()
            except UnicodeDecodeError:
                self.parted[i] = True

    def data(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def text(self, ids: np.ndarray, machine: Utf8 | None = None) -> str:
        """The ids' text; with a machine given, what it holds from earlier ids goes in and the rest stays in it."""
        stream = machine or Utf8()
        out: list[str] = []
        at = 0
        values = ids.tolist()
        if stream.need and values and not self.parted[values[0]]:
            out.append(stream.close())
        for place in np.flatnonzero(self.parted[ids]).tolist():
            if place > at:
                if stream.need:
                    out.append(stream.close())
                out += map(self.text_of.__getitem__, values[at:place])
            out.append(stream.feed(self.bytes_of[values[place]]))
            at = place + 1
        if at < len(values):
            if stream.need:
                out.append(stream.close())
            out += map(self.text_of.__getitem__, values[at:])
        if machine is None:
            out.append(stream.close())
        return "".join(out)


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, part, ids (little-endian 32-bit) of every document; only texts beyond 2**20 characters have many parts."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state("bytebpe", f"encoder {ranks} {pattern}", lambda: Encoder(read_ranks(ranks), pattern))
        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            held, last, part = 0, -1, 0

            def flush() -> pa.RecordBatch:
                keys = batch.column(0).take(pa.array(rows[0], pa.int64()))
                out = pa.RecordBatch.from_arrays([keys, pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary())], names=["doc_id", "part", "ids"])
                for column in rows:
                    column.clear()
                return out

            for i, ids in encoder.encode_batch(t.as_py() for t in batch.column(1)):
                part, last = (part + 1 if i == last else 0), i
                for column, value in zip(rows, (i, part, ids.astype("<i4").tobytes()), strict=True):
                    column.append(value)
                held += len(ids)
                if held > 1 << 20:
                    yield flush()
                    held = 0
            if rows[0]:
                yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(encoded, f"doc_id {kind}, part int, ids binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: encoded, then decoded from the ids."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_state("bytebpe", f"decoder {ranks}", lambda: Decoder(read_ranks(ranks)))
        digits = worker_state("bytebpe", f"digits {len(decoder.bytes_of)}", lambda: [b"%d" % i for i in range(len(decoder.bytes_of))])
        held: list | None = None

        def row(h: list) -> tuple:
            return h[0], h[1], h[2].hexdigest(), h[3].hexdigest()

        def made(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (kind, pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        for batch in batches:
            kind = batch.column(0).type
            done: list[tuple] = []
            for doc_id, part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids = np.frombuffer(data.as_buffer(), "<i4")
                if part == 0:
                    if held:
                        done.append(row(held))
                    held = [doc_id, 0, hashlib.sha256(), hashlib.sha256(), Utf8()]
                if len(ids):
                    held[2].update(b"," * bool(held[1]) + b",".join(map(digits.__getitem__, ids.tolist())))
                    held[1] += len(ids)
                    # the text comes out of the state machine; what it has not completed yet waits in it
                    held[3].update(decoder.text(ids, held[4]).encode())
            yield made(done)
        if held:
            left = held[4].close()
            if left:
                held[3].update(left.encode())
            yield made([row(held)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return encode(docs, ranks, pattern).mapInArrow(checked, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
