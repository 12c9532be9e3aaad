"""N-gram Jaccard join by parity sketches (operator 9).

A document's set holds its distinct five-word shingles. Two documents link when 5 * |intersection| >= 4 * |union|, which
bounds the symmetric difference of sets of a and b shingles by (a + b) / 9.

Sketches. Each shingle is XORed into one word of a sketch of B words, chosen by its hash. A differing shingle changes one
word, so the number of differing words is at most the symmetric difference: with more words than the largest difference
at least one word agrees. Sets fall into bands by size; B follows from the band's largest set. A document emits the words
of its own band, and those of the next band if it is large enough to have a partner there. Words without a shingle say
nothing and are left out; B has spare words (`SLACK` and a share of B) beyond those needed, so that a pair still agrees in
a word that is not empty unless both have more empty words than that, and documents with that many emit their empty words
too. What is left of the spare words pays for frequent ones: every document ranks its words in one order (empty ones
first, then by the number of documents that have them) and leaves out as many as are spare. A pair agrees in at least one
word more than that, and the last of those in this order is among the words that both keep.
Sets below `SMALL` shingles would have too few per word: they emit the XOR of each two shingles of a prefix in hash order
that any partner shares at least two of.

Verification. Documents with equal sets are one class from the start. Classes that agree in a word form groups; groups
with the same members count once. Members are compared in blocks of at most `BLOCK` by one-bit parity sketches, whose
Hamming distance also bounds the symmetric difference. The classes that pass, in connected families, are compared in
blocks by their sets, exactly. Comparison of two blocks gives a spanning forest of their links, not all pairs. A family
of many blocks is first compared with its first block and within blocks; then only blocks that still hold different
components meet.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. Null texts and texts without words have an empty set and link with
nothing; with fewer than five words the whole sequence is the one shingle. Classes and shingles are told apart by 64-bit
hashes. Repeated rows of an id are rows of their own and get the same component. Rows without an id keep a null
component unless they link with one that has an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.text import Codes, drop_other_state, fresh_name, grouped, release, stored, worker_state

WORDS = 5
SMALL, GROWTH = 24, 1.6
SLACK = 3
BLOCK = 128
#: Ids of at most this many documents are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_A, _B, _C = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_SHIFT, _BAND = np.uint64(32), np.uint64(63)
#: Pieces of more bytes are hashed word by word.
LONGEST = 1 << 22
#: Edges for each task that writes a table of the contraction.
TASK_EDGES = 100_000
#: Members of one sketch word that a task holds at a time; a word of more is compared all the same.
WIDE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(33))) * _B
    return x ^ (x >> np.uint64(33))


_BASE = 0x5851F42D4C957F2D
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _C)


def _powers(base: int, count: int) -> np.ndarray:
    """The first `count` powers of an odd base, out of one table for each base that grows as needed."""
    held = worker_state("jaccard", "powers", dict)
    if len(held.get(base, ())) < count:
        held[base] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(count - 1, base, np.uint64))])
    return held[base][:count]


def _long_word(word: bytes) -> int:
    """The same hash for a word of any length, in parts."""
    total = 0
    for at in range(0, len(word), LONGEST):
        part = np.frombuffer(word[at : at + LONGEST], np.uint8)
        total += int((_BYTE[part] * _powers(_BASE, LONGEST)[: len(part)]).sum()) * pow(_BASE, at, 1 << 64)
    return int(mixed(np.array([(total + len(word) * int(_C)) % (1 << 64)], np.uint64))[0])


def word_hashes(pieces: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of each piece's words: a value for each byte times a power of its place, from one prefix sum."""
    short = [p if len(p) <= LONGEST else b"" for p in pieces]
    buffer = np.frombuffer(b" " + b" ".join(short) + b" ", np.uint8)
    space = (buffer == 32) | ((buffer >= 9) & (buffer <= 13))
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    room = 1 << max(20, len(buffer).bit_length())
    sums = np.cumsum(_BYTE[buffer] * _powers(_BASE, room)[: len(buffer)])
    values = (sums[ends - 1] - sums[starts - 1]) * _powers(pow(_BASE, -1, 1 << 64), room)[starts]
    values = mixed(values + (ends - starts).astype(np.uint64) * _C)
    cuts = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in short])[:-1])
    return [
        h if len(p) <= LONGEST else np.array([_long_word(w) for w in p.split()], np.uint64)
        for h, p in zip(np.split(values, cuts), pieces, strict=True)
    ]


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    width = min(WORDS, n)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = mixed(out + words[j : j + len(out)] * _C)
    return np.unique(out)


def sets_of(texts: Iterator[str | None]) -> Iterator[np.ndarray]:
    """The set of each text, in order."""
    held: list[np.ndarray] = []
    last = 0
    for group in grouped(texts):
        for (i, _), words in zip(group, word_hashes([piece.encode("utf-8", "replace").lower() for _, piece in group]), strict=True):
            if i != last:
                yield shingle_hashes(np.concatenate(held) if len(held) != 1 else held[0])
                held, last = [], i
            held.append(words)
    if held:
        yield shingle_hashes(np.concatenate(held))


def class_of(shingles: np.ndarray) -> int:
    """A 64-bit hash of the set; 0 stands for the empty set."""
    if not len(shingles):
        return 0
    parts = np.array([np.bitwise_xor.reduce(mixed(shingles + _C)), mixed(shingles).sum(), len(shingles)], np.uint64)
    return int(mixed(np.add.reduce(mixed(parts) * np.array([1, 3, 5], np.uint64), keepdims=True)).view(np.int64)[0]) or 1


def band_start(band: int) -> int:
    return int(SMALL * GROWTH**band)


def band_of(size: int) -> int:
    band = max(0, int(np.log(size / SMALL) / np.log(GROWTH)) - 1)
    while band_start(band + 1) <= size:
        band += 1
    return band


def words_of(band: int) -> tuple[int, int]:
    """(number of sketch words, how many more than the largest difference need) of a band."""
    largest = band_start(band + 1) - 1
    needed = 2 * largest // 9 + 1
    slack = SLACK + needed // 8
    return needed + slack, slack


def keys_of(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set's join keys, whose last six bits tell the band, and how many of a band's keys it may leave out."""
    n = len(shingles)
    out, spare = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def emit(keys: np.ndarray, band: int, left: int) -> None:
        out.append(keys & ~_BAND | np.uint64(band))
        spare.append(np.full(len(keys), left))

    if 4 <= n < SMALL:
        # partners share at least ceil(0.8 n) shingles, so two of this many first ones in hash order
        prefix = shingles[: n - -(-4 * n // 5) + 2]
        one, two = np.triu_indices(len(prefix), 1)
        emit(mixed(prefix[one] ^ mixed(prefix[two] + _C)), 63, 0)
    if 5 * n >= 4 * SMALL:
        bands = [band_of(n)] if n >= SMALL else []
        nxt = bands[0] + 1 if bands else 0
        if 5 * n >= 4 * band_start(nxt):
            bands.append(nxt)
        spread = mixed(shingles ^ _C)
        for band in bands:
            count, slack = words_of(band)
            place = ((spread >> _SHIFT) * np.uint64(count) >> _SHIFT).astype(np.int64)
            sketch = np.zeros(count, np.uint64)
            np.bitwise_xor.at(sketch, place, shingles)
            full = np.bincount(place, minlength=count) > 0
            left = slack - int(count - full.sum())
            if left < 0:
                full[:], left = True, 0
            emit(mixed(sketch[full] ^ mixed(np.flatnonzero(full).astype(np.uint64) + np.uint64((band + 1) << 32))), band, left)
    return np.concatenate(out), np.concatenate(spare)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles by bit: a power of two of bits, one or two for each; halves fold by XOR."""
    words = 1 << int(len(shingles) // 64).bit_length()
    bits = np.bincount((mixed(shingles + _A) & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


_FIRST = -(1 << 63)


def _batch(names: str, kinds: tuple, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names.split())


def sketch_keys(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: (key, cls, -1 - spare, null) for the join keys; (key, cls, n, doc_id) once for every document."""
    names, kinds = "key cls n doc_id", (pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_other_state("jaccard")
        seen: set[int] = set()  # copies of a set in this task emit its keys once; forgetting some does no harm
        for batch in batches:
            rows: list[tuple] = []
            keys: list[np.ndarray] = []
            ids: list[np.ndarray] = []
            spare: list[np.ndarray] = []
            held = 0

            def flush() -> Iterator[pa.RecordBatch]:
                if rows:
                    yield _batch(names, kinds, list(zip(*rows, strict=True)))
                    rows.clear()
                if keys:
                    key = np.concatenate(keys).view(np.int64)
                    yield _batch(names, kinds, [key, np.concatenate(ids), -1 - np.concatenate(spare), pa.nulls(len(key), pa.int64())])
                    for column in (keys, ids, spare):
                        column.clear()

            doc_ids = batch.column(0).to_pylist()
            for place, s in enumerate(sets_of(t.as_py() for t in batch.column(1))):
                own = class_of(s)
                rows.append((hash((own, place)) & 0x7FFFFFFFFFFFFFFF, own, len(s), doc_ids[place]))  # dealt evenly
                if own in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(own)
                k, left = keys_of(s)
                if len(k):
                    keys.append(k)
                    spare.append(left)
                    ids.append(np.full(len(k), own, np.int64))
                    held += len(k)
                if held > 100_000:
                    yield from flush()
                    held = 0
            yield from flush()

    return _columns(docs).mapInArrow(found, "key long, cls long, n long, doc_id long")


def _named(cls: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name, size) of runs of distinct classes: equal members, equal name."""
    own = cls.view(np.uint64)
    names = mixed(np.add.reduceat(mixed(own + _A), starts) + _C * np.bitwise_xor.reduceat(mixed(own + _B), starts))
    return names.view(np.int64), np.diff(np.append(starts, len(cls)))


def rows_and_groups(docs: DataFrame, most: int = WIDE) -> DataFrame:
    """(cls, n, doc_id) of every document, and (grp, cls, band, size, spare) of the classes that agree in a key.

    Keys meet in one shuffle; a sorted run of equal keys with several classes is a group, named by its members' hash.
    Of a run that goes on through batches about `most` members are held; a wider one is named by its key and passes
    through.
    """
    names = "grp cls n doc_id band size spare"
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def members(grp: np.ndarray, size: np.ndarray, key: np.ndarray, cls: np.ndarray, spare: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(cls), pa.int64())
        return _batch(names, kinds, [grp, cls, none, none, key & 63, size, spare])

    def wide(key: np.ndarray, cls: np.ndarray, spare: np.ndarray) -> pa.RecordBatch:
        return members(mixed(key.view(np.uint64)).view(np.int64), np.full(len(cls), most), key, cls, spare)

    def narrow(key: np.ndarray, cls: np.ndarray, spare: np.ndarray) -> pa.RecordBatch:
        """Whole runs, of which those with several members are groups."""
        new = np.append(True, key[1:] != key[:-1])
        sizes = np.diff(np.append(np.flatnonzero(new), len(key)))
        several = np.repeat(sizes > 1, sizes)
        key, cls, spare, sizes = key[several], cls[several], spare[several], sizes[sizes > 1]
        if not len(key):
            return members(key, key, key, cls, spare)
        grp, _ = _named(cls, np.cumsum(sizes) - sizes)
        return members(np.repeat(grp, sizes), np.repeat(sizes, sizes), key, cls, spare)

    def grouped_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_other_state("jaccard")
        held: list[tuple[np.ndarray, ...]] = []  # the last run, which may go on in the next batch
        count, last, is_wide = 0, (None, None), False
        for batch in batches:
            n = batch.column(2).to_numpy()
            rows = batch.filter(pa.array(n >= 0))
            if rows.num_rows:
                none = pa.nulls(rows.num_rows, pa.int64())
                yield _batch(names, kinds, [none, *rows.columns[1:], none, none, none])
            at = np.flatnonzero(n < 0)
            key, cls = batch.column(0).to_numpy()[at], batch.column(1).to_numpy()[at]
            if not len(key):
                continue
            new = np.append((key[0], cls[0]) != last, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))
            key, cls, spare = key[new], cls[new], -1 - n[at][new]
            if not len(key):
                continue
            goes_on = int(np.searchsorted(key, last[0], "right")) if key[0] == last[0] else 0
            tail = int(np.searchsorted(key, key[-1]))
            last = (key[-1], cls[-1])
            if goes_on:
                held.append((key[:goes_on], cls[:goes_on], spare[:goes_on]))
                count += goes_on
                tail = max(tail, goes_on)
            if goes_on < len(key):  # the run at hand has ended
                if held:
                    done = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                    yield wide(*done) if is_wide else narrow(*done)
                held, count, is_wide = [], 0, False
            if goes_on < tail:
                yield narrow(key[goes_on:tail], cls[goes_on:tail], spare[goes_on:tail])
            if tail < len(key):
                held.append((key[tail:], cls[tail:], spare[tail:]))
                count += len(key) - tail
            if count >= most:
                is_wide = True
            if is_wide:
                for part in held:
                    yield wide(*part)
                held = []
        if held:
            done = tuple(np.concatenate(c) for c in zip(*held, strict=True))
            yield narrow(*done)

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        sketch_keys(docs)
        .repartition(partitions, "key")
        .sortWithinPartitions("key", "cls")
        .mapInArrow(grouped_rows, "grp long, cls long, n long, doc_id long, band long, size long, spare long")
    )


def _several(groups: DataFrame) -> DataFrame:
    """grp, cls, count of the groups that have several members."""
    return groups.join(groups.groupBy("grp").count().where("count > 1"), "grp")


def kept_groups(found: DataFrame) -> DataFrame:
    """grp, cls, count: every class without its most frequent words, as many as its band can spare.

    Groups go over to their least member, and those with the same one are one group: a passage in many documents makes a
    group of each word it fills, and most of their members are the same. What met before still meets.
    """
    rank = F.row_number().over(Window.partitionBy("cls", "band").orderBy(F.desc("size"), "grp"))
    kept = found.where("grp is not null").withColumn("rank", rank).where("rank > spare")
    places = stored(kept.select("grp", "cls").distinct())
    least = places.groupBy("grp").agg(F.min("cls").alias("least"), F.count(F.lit(1)).alias("count")).where("count > 1")
    merged = places.join(least.select("grp", "least"), "grp").select(F.col("least").alias("grp"), "cls").distinct()
    return _several(stored(merged))


def sketches(docs: DataFrame, chosen: DataFrame, with_sets: bool) -> DataFrame:
    """cls, n, sketch (and shingles) of the chosen rows (place, cls)."""
    few = chosen.count() <= BROADCAST_IDS
    wanted = docs.select(F.coalesce("doc_id", F.lit(_FIRST)).alias("place"), "text").join(F.broadcast(chosen) if few else chosen, "place")
    names = "cls n sketch" + " shingles" * with_sets
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())[: 3 + with_sets]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_other_state("jaccard")
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            wanted_classes = batch.column(1).to_pylist()
            for place, s in enumerate(sets_of((t.as_py() for t in batch.column(0)))):
                if class_of(s) != wanted_classes[place]:  # another row of the same id
                    continue
                rows.append((wanted_classes[place], len(s), bit_sketch(s).tobytes(), s.tobytes())[: 3 + with_sets])
                held += len(s)
                if held > 500_000:
                    yield _batch(names, kinds, list(zip(*rows, strict=True)))
                    rows, held = [], 0
            if rows:
                yield _batch(names, kinds, list(zip(*rows, strict=True)))

    return wanted.select("text", "cls").mapInArrow(found, "cls long, n long, sketch binary" + ", shingles binary" * with_sets)


def forest_edges(pairs: DataFrame, exact: bool) -> DataFrame:
    """u, v: a spanning forest of the links between the members of two blocks, or within one.

    `exact` compares sets; otherwise bit sketches, which let every link pass. Members that already have one component
    in common are not compared.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_other_state("jaccard")
        for batch in batches:
            us, vs = [], []
            for r in range(batch.num_rows):
                a, b = batch.column(0)[r].values, batch.column(1)[r].values
                rows = pa.concat_arrays([a, b]) if len(b) else a
                for u, v in _links(rows, len(a) if len(b) else 0, exact):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return pairs.select("a", "b").mapInArrow(compared, "u long, v long")


def _close(bits: np.ndarray, n: np.ndarray, apart: int) -> list[tuple[int, int, int]]:
    """(distance, i, j) of the pairs whose bit sketches let them link; nearest first. The first `apart` rows meet the others."""
    found = [np.zeros((3, 0), np.int64)]
    step = max(1, (1 << 20) // bits.size)
    for start in range(0, apart or len(n), step):
        at = np.arange(start, min(start + step, apart or len(n)))
        low = apart or start + 1
        far = np.bitwise_count(bits[at, None] ^ bits[None, low:]).sum(2, dtype=np.int32)
        one, two = n[at, None], n[None, low:]
        i, j = np.nonzero((9 * far <= one + two) & (5 * np.minimum(one, two) >= 4 * np.maximum(one, two)))
        pairs = np.stack([far[i, j].astype(np.int64), at[i], j + low])
        found.append(pairs[:, pairs[1] < pairs[2]])
    pairs = np.concatenate(found, 1)
    return pairs[:, np.lexsort(pairs[::-1])].T.tolist()


def _links(rows: pa.StructArray, apart: int, exact: bool) -> list[tuple[int, int]]:
    """Links that join different components, best candidates first: of the first `apart` rows to the others, or (0) of all."""
    if len(rows) < 2:
        return []
    cls, n, label = (rows.field(c).to_numpy() for c in ("cls", "n", "label"))
    own = [np.frombuffer(s, np.uint64) for s in rows.field("sketch").to_pylist()]
    words = min(map(len, own))
    bits = np.stack([folded(s, words) for s in own])
    # one node for each label (0: not known yet)
    _, first, at = np.unique(np.where(label == 0, cls, label), return_index=True, return_inverse=True)
    root = first[at].tolist()
    sets: dict[int, np.ndarray] = {}

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    out = []
    for _, i, j in _close(bits, n, apart):
        x, y = top(i), top(j)
        if x == y:
            continue
        if exact:
            for k in (i, j):
                if k not in sets:
                    sets[k] = np.frombuffer(rows.field("shingles")[k].as_py(), np.uint64)
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 9 * common < 4 * (n[i] + n[j]):  # 5 * common >= 4 * (n + m - common)
                continue
        root[y] = x
        out.append((int(cls[i]), int(cls[j])))
    return out


def _blocks(members: DataFrame) -> DataFrame:
    """grp, blk, low, high (labels), rows: the members of each group in blocks of about `BLOCK`, dealt by hash.

    A label with enough members fills blocks of its own; the others share blocks.
    """
    sizes = members.groupBy("grp", "label").count()
    kinds = sizes.withColumn("kind", F.when(F.col("count") >= BLOCK, F.col("label")).otherwise(0))
    many = kinds.groupBy("grp", "kind").agg(F.ceil(F.sum("count") / BLOCK).alias("blocks"))
    dealt = kinds.join(many, ["grp", "kind"]).select("grp", "label", "kind", "blocks")
    kept = [c for c in members.columns if c != "grp"]
    return (
        members.join(dealt, ["grp", "label"])
        .withColumn("blk", F.xxhash64("kind", F.pmod(F.xxhash64("cls"), "blocks")))
        .groupBy("grp", "blk")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.collect_list(F.struct(*kept)).alias("rows"))
    )


def _within(blocks: DataFrame) -> DataFrame:
    return blocks.select(F.col("rows").alias("a"), F.array().cast(blocks.schema["rows"].dataType).alias("b"))


def _across(blocks: DataFrame, met) -> DataFrame:
    a = blocks.select("grp", F.col("blk").alias("i"), F.col("low").alias("a_low"), F.col("high").alias("a_high"), F.col("rows").alias("a"))
    b = blocks.select("grp", F.col("blk").alias("j"), F.col("low").alias("b_low"), F.col("high").alias("b_high"), F.col("rows").alias("b"))
    return a.join(b, "grp").where((F.col("i") < F.col("j")) & met).select("a", "b")


def linked(groups: DataFrame, payload: DataFrame, exact: bool) -> DataFrame:
    """cls, label of the classes that links connect: groups (grp, cls, count), payload (cls, n, sketch and, if exact, shingles).

    Equal labels: connected. Groups of one block are compared whole. In larger ones, whose rows alone meet others, each
    block is first compared within itself and with the first block; then they are dealt into blocks anew, and blocks that
    still hold different labels meet, those of several labels also within themselves.
    """
    large = groups.where(F.col("count") > BLOCK)

    def blocks_of(chosen: DataFrame) -> DataFrame:
        members = chosen.join(payload, "cls").withColumn("label", F.lit(0).cast("long"))
        kept = [c for c in members.columns if c not in ("grp", "count")]
        return (
            members.withColumn("blk", F.pmod(F.xxhash64("cls"), F.ceil(F.col("count") / BLOCK)))
            .groupBy("grp", "blk")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.collect_list(F.struct(*kept)).alias("rows"))
        )

    edges = stored(forest_edges(_within(blocks_of(groups)), exact))
    release(edges)
    if large.isEmpty():
        return components(edges)
    lead = stored(forest_edges(_across(blocks_of(large), F.col("i") == 0), exact))
    release(lead)
    edges = edges.unionByName(lead)
    labels = components(edges)
    # labels go to the classes, of which there are no more than documents, not to their places in groups
    marked = payload.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    rest = large.select("grp", "cls").join(marked, "cls")
    mixed_labels = (F.col("a_low") != F.col("a_high")) | (F.col("b_low") != F.col("b_high")) | (F.col("a_low") != F.col("b_low"))
    blocks = _blocks(rest)
    # these blocks are drawn anew, so one may hold members that have not met yet
    unmet = _across(blocks, mixed_labels).unionByName(_within(blocks.where("low <> high")))
    more = stored(forest_edges(unmet, exact))
    return labels if more.isEmpty() else components(edges.unionByName(more))


def components(edges: DataFrame) -> DataFrame:
    """cls, label: the connected components of an edge table (u, v), by repeated contraction.

    Every node goes over to its least neighbour (or itself); edges are drawn anew between what their ends went over to.
    The few rounds' maps, kept in the shared folder, are then followed from the last to the first. Every table is
    written by as many tasks as the number of edges asks for, as no round makes more rows than two for each edge.
    """
    maps: list[DataFrame] = []
    tasks = 1 + edges.count() // TASK_EDGES
    rest = stored(edges.where("u <> v").distinct().coalesce(tasks))
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p")).select(F.col("u").alias("cls"), "p").coalesce(tasks))
        maps.append(to)
        x = to.select(F.col("cls").alias("u"), F.col("p").alias("pu"))
        y = to.select(F.col("cls").alias("v"), F.col("p").alias("pv"))
        moved = rest.join(x, "u").join(y, "v").where("pu <> pv")
        rest = stored(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct().coalesce(tasks))
    if not maps:
        return edges.sparkSession.createDataFrame([], "cls long, label long")
    labels = maps[-1].select("cls", F.col("p").alias("label"))
    for to in reversed(maps[:-1]):
        later = labels.select(F.col("cls").alias("p"), "label")
        labels = to.join(later, "p", "left").select("cls", F.coalesce("label", "p").alias("label"))
    return stored(labels.coalesce(tasks))


def near_duplicates(docs: DataFrame, most: int = WIDE) -> DataFrame:
    """doc_id, n_shingles, cls, component_id of every row."""
    docs = _columns(docs)
    both = stored(rows_and_groups(docs, most))
    release(docs)
    rows = both.where("grp is null").select("doc_id", F.col("n").alias("n_shingles"), "cls")
    groups = stored(kept_groups(both))
    release(docs)
    first = rows.where("cls <> 0").groupBy("cls").agg(F.min(F.coalesce("doc_id", F.lit(_FIRST))).alias("place"))
    chosen = stored(groups.select("cls").distinct().join(first, "cls").select("place", "cls"))
    families = linked(groups, stored(sketches(docs, chosen, with_sets=False)), exact=False)
    release(docs)
    members = stored(chosen.join(families, "cls").select("place", "cls"))
    sets = stored(sketches(docs, members, with_sets=True))
    labels = linked(stored(_several(families.select(F.col("label").alias("grp"), "cls"))), sets, exact=True)
    release(docs)
    smallest = rows.where("cls <> 0").groupBy("cls").agg(F.min("doc_id").alias("low"))
    joined = smallest.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    lowest = joined.groupBy("label").agg(F.min("low").alias("component_id"))
    of_class = joined.join(lowest, "label").select("cls", "component_id")
    return rows.join(of_class, "cls", "left").select(
        "doc_id", "n_shingles", "cls", F.when(F.col("cls") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows that stay: one of every component, and all rows without words.

    Least by (doc_id, nulls last; class; row) stays. Rows are told apart by a number stored with them, since ids may be
    null or stand for several texts.
    """
    row = fresh_name(docs, "row_number_here")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).where("cls <> 0")
    own = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id"))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "cls", "row")
    members = stored(found.withColumnRenamed("doc_id", "row").join(own, "row").select("component_id", order.alias("order")))
    stays = members.groupBy("component_id").agg(F.min("order").alias("least")).select(F.col("least.row").alias(row))
    goes = stored(members.select(F.col("order.row").alias(row)).join(stays, row, "left_anti"))
    goes = F.broadcast(goes) if goes.count() <= BROADCAST_IDS else goes
    return rows.join(goes, row, "left_anti").drop(row)
