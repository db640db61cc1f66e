"""Conversation prefix trie: which turns a set of conversations shares, as balanced parentheses.

A conversation is the sequence of its turns, each known by a digest of (role, text).  Equal sequences become one row
with the digest and number of their conversations.  The different sequences are range-sorted into shards;
a shard's trie is written as balanced parentheses, in the order in which the sorted sequences open and close nodes.
Running excess with range minima by block (:func:`find_close`) delimits every subtree; ranks of ``()`` pairs count its
leaves, and cumulative arrays in preorder give its members and savings.

Sequences with a common prefix stand together, so only nodes on the path of a shard's first or last sequence can
go on in another shard.  These spines are merged by the digest of their prefix: counts are added, a node is a
leaf if it has no child in any shard, and what spine nodes add to the nodes above them is summed along the
paths, each node on the first path that holds it.

Conversations with the number c use the first h turns of conversation c - c % 5, h = crc32(c) % 9
(:func:`rebuilt`); :func:`prefix_trie` takes any sequences.

Size: a conversation's turns are one row of 16 bytes and a length for each turn, no texts; a shard holds about
``SHARD_BYTES`` of sequences, or one sequence if that is longer.

Cases: rows without conv_id belong to no conversation and are left out; a null role or text is empty; null
turns come first and turns of the same number are ordered by digest; repeated rows are turns of their own; a conversation
whose turns are all cut away is a member of the root; an empty table has no nodes; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clauselens.llm.common import stored

# digits of a turn's digest: md5
STEP = 16
SHARD_BYTES = 8 << 20
# positions in a block of the range minima
BLOCK = 64
# conversations are listed in pieces of ids that agree but for so many last bits
ID_BITS = 12
SALTS = 16
FAMILY, MOST_SHARED = 5, 9
SCHEMA = {
    "key": pa.binary(), "parent_key": pa.binary(), "depth": pa.int64(), "n_bytes": pa.int64(), "path": pa.int64(),
    "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved": pa.int64(), "ends_sha256": pa.string(),
}
NOBODY = hashlib.sha256().hexdigest()


# --- sequences ---------------------------------------------------------------

def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, digests, sizes): the turns of each conversation in order; texts are not shuffled."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(
        F.col("turn").isNotNull().alias("numbered"), F.col("turn"), digest.alias("digest"), F.octet_length(text).alias("size"))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, digests, sizes): every conversation's own turns behind the first ones of the head of its family."""
    own = sequences(turns)
    h = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("head"), *[F.slice(c, 1, MOST_SHARED).alias(f"head_{c}") for c in ("digests", "sizes")])
    both = own.withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "head", "left")

    def joined(column: str):
        none = F.array().cast(own.schema[column].dataType)
        shared = F.coalesce(F.slice(f"head_{column}", F.lit(1), h), none)
        return F.concat(shared, F.slice(column, h + 1, F.size(column))).alias(column)

    return both.select("conv_id", joined("digests"), joined("sizes"))


def different(convs: DataFrame) -> DataFrame:
    """(sequence, piece, sizes, n, least, ids): each different sequence, its conversations in pieces of near ids.

    A piece holds at most 2**ID_BITS ids, so a sequence that very many conversations have is no large row.
    """
    sequence = F.unhex(F.array_join("digests", "")).alias("sequence")
    piece = F.shiftright("conv_id", ID_BITS).alias("piece")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    return convs.select(sequence, piece, "sizes", "conv_id").groupBy("sequence", "piece").agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("least"), listed.alias("ids"))


# --- balanced parentheses ----------------------------------------------------

def find_close(excess: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """For each opening place the first later place with an excess one below its own: its closing parenthesis.

    The rest of the own block is searched, then a tree of block minima leads to the block that holds it.
    """
    high = np.iinfo(np.int64).max
    blocks = np.full(-(-len(excess) // BLOCK) * BLOCK, high)
    blocks[:len(excess)] = excess
    blocks = blocks.reshape(-1, BLOCK)
    levels = [blocks.min(axis=1)]
    while len(levels[-1]) > 1:
        padded = np.append(levels[-1], [high] * (2 + len(levels[-1]) % 2))
        levels[-1] = padded
        levels.append(padded.reshape(-1, 2).min(axis=1)[:-1])
    wanted, close = excess[opens] - 1, np.full(len(opens), -1)
    rest = np.arange(len(opens))
    for step in range(1, BLOCK):
        at = opens[rest] + step
        rest = rest[at % BLOCK != 0]
        at = opens[rest] + step
        hit = blocks[at // BLOCK, at % BLOCK] <= wanted[rest]
        close[rest[hit]] = at[hit]
        rest = rest[~hit]
    rest = np.flatnonzero(close < 0)
    node, level = opens[rest] // BLOCK + 1, np.full(len(rest), -1)
    for number, minima in enumerate(levels):
        todo = np.flatnonzero(level < 0)
        for sibling in (False, True):
            todo = todo[(node[todo] % 2 == 0) | ~np.bool_(sibling)]
            hit = minima[node[todo] + sibling] <= wanted[rest[todo]]
            node[todo[hit]] += sibling
            level[todo[hit]] = number
            todo = todo[~hit]
        todo = np.flatnonzero(level < 0)
        node[todo] = node[todo] // 2 + 1
    for number in range(len(levels) - 1, 0, -1):
        down = np.flatnonzero(level >= number)
        node[down] *= 2
        node[down] += levels[number - 1][node[down]] > wanted[rest[down]]
    for part in np.array_split(np.arange(len(rest)), len(rest) // 65_536 + 1):
        inside = (blocks[node[part]] <= wanted[rest[part], None]).argmax(axis=1)
        close[rest[part]] = node[part] * BLOCK + inside
    return close


class Shard:
    """The trie of sorted sequences as parentheses, with one entry for each node in preorder."""

    def __init__(self) -> None:
        self.bits = bytearray([1])
        self.path, self.hashes, self.last = [0], [hashlib.md5()], b""
        self.parent, self.depth, self.n_bytes = [-1], [0], [0]
        self.keys = [self.hashes[0].digest()]
        self.ends: dict[int, tuple[int, int, str]] = {}
        self.first_path: list[int] | None = None

    def add(self, sequence: bytes, sizes: list[int], n: int, least: int, sha: str) -> None:
        shared, most = 0, min(len(sequence), len(self.last))
        while shared < most and sequence[shared:shared + STEP] == self.last[shared:shared + STEP]:
            shared += STEP
        keep = shared // STEP
        self.bits.extend(bytes(len(self.path) - 1 - keep))
        del self.path[keep + 1:], self.hashes[keep + 1:]
        for turn in range(keep, len(sequence) // STEP):
            chain = self.hashes[-1].copy()
            chain.update(sequence[turn * STEP:(turn + 1) * STEP])
            self.bits.append(1)
            self.parent.append(self.path[-1])
            self.path.append(len(self.depth))
            self.hashes.append(chain)
            self.keys.append(chain.digest())
            self.depth.append(turn + 1)
            self.n_bytes.append(sizes[turn])
        self.ends[self.path[-1]] = (n, least, sha)
        self.last = sequence
        if self.first_path is None:
            self.first_path = list(self.path)

    def rows(self, number: int) -> dict[str, list]:
        """Whole nodes, and the nodes of the first and the last path with what this shard knows of them."""
        bits = np.frombuffer(bytes(self.bits) + bytes(len(self.path)), dtype=np.uint8).astype(np.int64)
        opens, count = np.flatnonzero(bits), len(self.depth)
        close = find_close(np.cumsum(2 * bits - 1), opens)
        behind = np.arange(count) + (close - opens + 1) // 2  # the first node in preorder behind the subtree
        spine = np.zeros(count, dtype=bool)
        spine[self.first_path], spine[self.path] = True, True

        def below(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[behind] - sums[:count]

        n_ends = np.zeros(count, dtype=np.int64)
        n_ends[list(self.ends)] = [n for n, _, _ in self.ends.values()]
        n_convs = below(n_ends)
        # leaves: pairs () by their rank; those of a spine are judged when all shards are known
        pairs = np.zeros(len(bits), dtype=np.int64)
        pairs[opens] = (close == opens + 1) & ~spine
        rank = np.cumsum(pairs)
        leaves = rank[close] - rank[opens] + pairs[opens]
        n_bytes = np.array(self.n_bytes, dtype=np.int64)
        saved = below(np.where(spine, 0, (n_convs - 1) * n_bytes))
        parent = np.array(self.parent)
        children = np.bincount(parent[1:][~spine[1:]], minlength=count)
        least = [self.ends[v][1] if v in self.ends else None for v in range(count)]
        for v in range(count - 1, 0, -1):
            p = self.parent[v]
            if least[p] is None or least[v] < least[p]:
                least[p] = least[v]
        out: dict[str, list] = {c: [] for c in SCHEMA}

        def emit(nodes: list[int], path: int | None, known: bool) -> None:
            for v in nodes:
                p = self.parent[v]
                end = self.ends.get(v) if known else None
                row = (
                    self.keys[v], self.keys[p] if p >= 0 else None, self.depth[v], self.n_bytes[v], path,
                    least[v] if known else None, least[p] if path is None and not spine[p] else None,
                    *[int(x[v]) if known else 0 for x in (n_convs, children, leaves, saved)], end[2] if end else None)
                for column, value in zip(out.values(), row):
                    column.append(value)

        emit(np.flatnonzero(~spine).tolist(), None, True)
        emit(self.first_path, 2 * number, True)
        first = set(self.first_path)
        emit([v for v in self.path if v not in first], 2 * number + 1, True)
        emit([v for v in self.path if v in first], 2 * number + 1, False)
        return out


def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one shard from its rows in order; the ids of a sequence's pieces are hashed as they come."""
    shard, current = Shard(), None

    def finish() -> None:
        sequence, sizes, n, least, sha = current
        shard.add(sequence, sizes, n, least, sha.hexdigest())

    for batch in batches:
        for row in batch.to_pylist():
            if current and current[0] == row["sequence"]:
                current[2] += row["n"]
                current[3] = min(current[3], row["least"])
                current[4].update(b"," + row["ids"].encode())
                continue
            if current:
                finish()
            current = [row["sequence"], row["sizes"], row["n"], row["least"], hashlib.sha256(row["ids"].encode())]
    if current:
        finish()
        out = shard.rows(TaskContext.get().partitionId())
        for at in range(0, len(out["key"]), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(out[c][at:at + 4096], t) for c, t in SCHEMA.items()], names=list(SCHEMA))


# --- spines ------------------------------------------------------------------

def merged_spines(spine: DataFrame) -> DataFrame:
    """Whole nodes from what the shards know of the nodes on their first and last paths."""
    nodes = stored(spine.groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("parent_key", "depth", "n_bytes")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max("ends_sha256").alias("ends_sha256"),
        F.min("path").alias("owner")))
    more = nodes.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    nodes = nodes.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    own = nodes.select(
        "key", "owner", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saving"))
    # along each path from its end upwards, a node counts on the first path that holds it
    upwards = W.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, W.currentRow)
    mine = F.col("owner") == F.col("path")
    along = spine.select("path", "key", "depth").join(own, "key").select("key", *[
        F.sum(F.when(mine, F.col(c)).otherwise(0)).over(upwards).alias(c) for c in ("leaf", "saving")])
    sums = along.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    whole = nodes.join(sums, "key").withColumns({
        "n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") + F.col("saving")})
    above = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(above, "parent_key", "left")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row for each node: (key, parent_key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved,
    ends_sha256); ``convs`` has (conv_id, digests, sizes), ids once each.  The key is the md5 of the digests down to the node."""
    rows = stored(different(convs))
    size = rows.agg(F.sum(F.length("sequence") + F.length("ids")).alias("size")).first()["size"] or 0
    shards = max(size // SHARD_BYTES + 1, int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(shards, "sequence").sortWithinPartitions("sequence", "piece")
    types = ", ".join(f"{c} {'binary' if t == pa.binary() else 'string' if t == pa.string() else 'long'}" for c, t in SCHEMA.items())
    nodes = stored(dealt.mapInArrow(encoded, types))
    spines = stored(merged_spines(nodes.where("path is not null")))
    whole = nodes.where("path is null")
    # many nodes may hang on one node of a spine: its row is repeated, its children are salted
    salted = spines.select(
        F.col("key").alias("parent_key"), F.col("conv_id").alias("above"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hanging = whole.where("parent_conv_id is null").withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(
        salted, ["parent_key", "salt"]).withColumn("parent_conv_id", F.col("above"))
    columns = ["key", "parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    sha = F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256")
    parts = [part.select(*columns, sha) for part in (whole.where("parent_conv_id is not null"), hanging, spines)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
