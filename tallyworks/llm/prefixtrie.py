"""Conversation prefix trie by vertical bitmaps (operator 12).

A node is a distinct sequence of first turns; its members are the conversations that start with it. Conversations are cut
by id into shards of bounded size. Each shard holds an index from (position, turn) to the bitset of its conversations with
that turn there. From the root on, depth first, the bitset of a node is intersected with the postings of its lowest
remaining member's next turn; each intersection is a child, its popcount the child's members, and what remains of the
node's bitset with the bitset of conversations of that length is its list of ends. So a turn that a third of all
conversations open with is spread over all shards, and no task sees more than one shard.

Spark then adds the shards up by the digest of a node's path. Sums over subtrees need every distinct node once: each node
is owned by the first of the shards that know it. A shard that owns a node also knows all nodes above it, so the owned
nodes are summed inside the shards, along the depth-first order, and the sums are added by path.

Turns travel as 128-bit digests of role and text, with the number of words. Turns of one conversation are ordered by turn
(null first), then by digest. Null roles and texts are empty. Rows without a conversation id belong to no conversation and
take no part. Repeated rows are turns of their own. An empty table gives the root alone, without members, and null as its
conversation. Only the columns conv_id, turn, role and text are read. A conversation is one path and is worked in one
task, its turns as digests, however many they are. `prefix_nodes` writes tables to the shared folder (runs jobs).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.text import stored

#: A shard ends when it has this many conversations, or this many turns.
CONVERSATIONS = 4096
TURNS = 65_536
ROOT = b"\0" * 16
_LOCAL = (
    "shard long, pre long, size long, node binary, parent binary, depth long, words long, members long, conv_id long, ends array<long>"
)


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns: one row per conversation, its turns in order as (turn, digest, words)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The length of the role keeps apart what the concatenation would join.
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), F.unhex(digest).alias("digest"), word_count(text).alias("words")).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def regrown(conversed: DataFrame, base: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % base before its own turns after its first h,
    where h = crc32(c as text) % heads."""
    opening = conversed.where(F.col("conv_id") % base == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, heads - 1).alias("opening")
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)).cast("int")
    joined = conversed.withColumns({"base_id": F.col("conv_id") - F.col("conv_id") % base, "h": h}).join(opening, "base_id", "left")
    none = F.slice("turns", 1, 0)
    first = F.slice(F.coalesce("opening", none), F.lit(1), F.col("h"))
    own = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    return joined.select("conv_id", F.concat(first, own).alias("turns"))


class Shard:
    """The bitmap index of some conversations, given as (id, digests, words) in ascending order of their ids."""

    def __init__(self, conversations: list[tuple[int, list[bytes], list[int]]]):
        self.conversations = conversations
        self.postings: dict[tuple[int, bytes], int] = {}
        self.ended: dict[int, int] = {}
        for i, (_, digests, _) in enumerate(conversations):
            bit = 1 << i
            for at in enumerate(digests):
                self.postings[at] = self.postings.get(at, 0) | bit
            self.ended[len(digests)] = self.ended.get(len(digests), 0) | bit

    def nodes(self) -> Iterator[tuple]:
        """(parent's place, node, parent, depth, words, members, least id, ends), depth first: the root, then each child
        of a node followed by its own subtree."""
        everyone = (1 << len(self.conversations)) - 1
        stack = [(-1, ROOT, ROOT, 0, 0, everyone)]
        place = 0
        while stack:
            above, node, parent, depth, words, members = stack.pop()
            ends = members & self.ended.get(depth, 0)
            ids = []
            rest = ends
            while rest:
                low = rest & -rest
                ids.append(self.conversations[low.bit_length() - 1][0])
                rest ^= low
            yield above, node, parent, depth, words, members.bit_count(), self.conversations[(members & -members).bit_length() - 1][0], ids
            rest = members ^ ends
            while rest:
                _, digests, counts = self.conversations[(rest & -rest).bit_length() - 1]
                turn = digests[depth]
                child = rest & self.postings[depth, turn]
                path = hashlib.md5(node + turn, usedforsecurity=False).digest()
                stack.append((place, path, node, depth + 1, counts[depth], child))
                rest ^= child
            place += 1


def _shard_rows(conversations: list[tuple[int, list[bytes], list[int]]]) -> pa.RecordBatch:
    nodes = list(Shard(conversations).nodes())
    size = [1] * len(nodes)
    for place in range(len(nodes) - 1, 0, -1):
        size[nodes[place][0]] += size[place]
    _, node, parent, depth, words, members, least, ends = zip(*nodes, strict=True)
    long, binary = pa.int64(), pa.binary()
    columns = [
        pa.array([conversations[0][0]] * len(nodes), long), pa.array(range(len(nodes)), long), pa.array(size, long), pa.array(node, binary),
        pa.array(parent, binary), pa.array(depth, long), pa.array(words, long), pa.array(members, long), pa.array(least, long),
        pa.array(ends, pa.list_(long)),
    ]
    return pa.record_batch(columns, names=[c.split()[0] for c in _LOCAL.split(", ")])


def _in_shards(most: int):
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nodes of each shard. Rows come in ascending order of conversation ids; a shard is known by its first."""
        shard, turns = [], 0
        for batch in batches:
            for conv, digests, words in zip(*(batch.column(k) for k in range(3)), strict=True):
                shard.append((conv.as_py(), digests.as_py(), words.as_py()))
                turns += len(shard[-1][1])
                if len(shard) >= most or turns >= TURNS:
                    yield _shard_rows(shard)
                    shard, turns = [], 0
        if shard:
            yield _shard_rows(shard)

    return nodes


def shard_nodes(regrown: DataFrame, most: int = CONVERSATIONS) -> DataFrame:
    """The nodes of all shards (columns of `_LOCAL`): `pre` is a node's place in its shard's depth-first order, its subtree
    being the `size` places from there on."""
    spark = regrown.sparkSession
    narrow = regrown.select(
        "conv_id", F.transform("turns", lambda t: t["digest"]).alias("digests"), F.transform("turns", lambda t: t["words"]).alias("words")
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return narrow.repartitionByRange(ranges, "conv_id").sortWithinPartitions("conv_id").mapInArrow(_in_shards(most), _LOCAL)


def _subtree_sums(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("pre")
    out = {"node": shard["node"]}
    last = (shard["pre"] + shard["size"]).to_numpy()
    for c in ("leaves", "saved"):
        sums = [0]
        for v in shard[c]:  # whole numbers of any size
            sums.append(sums[-1] + int(v))
        out[c] = [sums[end] - sums[start] for start, end in enumerate(last)]
    return pd.DataFrame(out)


def _hash_of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids joined by commas. Lists come by node, in ascending order; none is held whole."""
    node, running = None, None
    for batch in batches:
        done = []
        for each, ids in zip(batch.column(0), batch.column(1), strict=True):
            key = each.as_py()
            if key != node:
                if running is not None:
                    done.append((node, running.hexdigest()))
                node, running, comma = key, hashlib.sha256(), b""
            running.update(comma + ",".join(map(str, ids.as_py())).encode())
            comma = b","
        if done:
            yield pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["node", "ends_sha256"])
    if running is not None:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], names=["node", "ends_sha256"])


def prefix_nodes(regrown: DataFrame, most: int = CONVERSATIONS) -> DataFrame:
    """One row per node, worked out in shards of at most `most` conversations: node, parent (path digests; null above the root), conv_id (least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = regrown.sparkSession
    local = stored(shard_nodes(regrown, most))
    merged = local.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"),
        F.sum("members").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("shard").alias("shard"),
    )
    merged = stored(merged)
    kids = merged.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(merged.join(kids, "node", "left").fillna(0, ["n_children"]))

    # Every node once, in the shard that owns it; summed there along the depth-first order.
    owned = nodes.select(
        "node", "shard", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    valued = local.select("shard", "pre", "size", "node").join(owned, ["node", "shard"], "left").fillna(0, ["leaves", "saved"])
    sums = valued.groupBy("shard").applyInPandas(_subtree_sums, "node binary, leaves long, saved long")
    sums = sums.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    ends = local.where(F.size("ends") > 0).select("node", "shard", "ends")
    by_node = ends.repartition("node").sortWithinPartitions("node", "shard").select("node", "ends")
    hashes = by_node.mapInArrow(_hash_of_ends, "node binary, ends_sha256 string")

    # Many nodes may share a parent, so its conversation is looked up under one of a few salts.
    salts = 8
    above = nodes.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    below = nodes.where("depth > 0").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    parents = below.join(above, ["parent", "salt"]).select("node", "parent_conv_id")

    nothing = F.sha2(F.lit(""), 256)
    found = nodes.join(sums, "node").join(hashes, "node", "left").join(parents, "node", "left")
    found = found.select(
        "node", F.when(F.col("depth") > 0, F.col("parent")).alias("parent"), "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    # The root is there even where there is no conversation.
    root = spark.range(1).select(F.lit(ROOT).alias("root"))
    alone = root.join(merged.select(F.col("node").alias("root")), "root", "left_anti").select(
        F.col("root").alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(0).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        nothing.alias("ends_sha256"),
    )
    return found.unionByName(alone)


ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), each_crc AS (
  SELECT conv_id, list_reduce(list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda p: CAST(ascii(CAST(conv_id AS VARCHAR)[p]) AS BIGINT)),
      lambda c, b: list_reduce(range(0, 8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b)),
      4294967295) AS c
  FROM (SELECT DISTINCT conv_id FROM turns)
), heads AS (
  SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM each_crc
), rebuilt AS (
  SELECT h.conv_id, 0 AS part, t.pos, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.pos <= h.h
  UNION ALL SELECT h.conv_id, 1, t.pos, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.pos > h.h
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d,
    len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
  FROM rebuilt
), paths AS (
  SELECT conv_id, 0 AS d, 0 AS words, '' AS path FROM heads
  UNION ALL
  SELECT conv_id, d, words, md5(string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY d)) FROM numbered
), sized AS (
  SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM paths
), nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE last = d), '')) AS ends_sha256
  FROM sized GROUP BY d, path
), above AS (
  SELECT n.d, n.path, p.d AS up, p.path AS up_path, n.words, n.n_convs
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.d <= n.d
), kids AS (
  SELECT up AS d, up_path AS path, count(*) AS n_children FROM above WHERE up = d - 1 GROUP BY ALL
), sums AS (
  SELECT a.up AS d, a.up_path AS path, count(*) FILTER (WHERE k.path IS NULL) AS n_leaves, sum((a.n_convs - 1) * a.words) AS saved_tokens
  FROM above a LEFT JOIN kids k ON a.d = k.d AND a.path = k.path GROUP BY a.up, a.up_path
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.path = n.path LEFT JOIN kids k ON k.d = n.d AND k.path = n.path
  LEFT JOIN above a ON a.d = n.d AND a.path = n.path AND a.up = n.d - 1 LEFT JOIN nodes p ON p.d = a.up AND p.path = a.up_path
"""
