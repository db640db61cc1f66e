"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items in documents.

Patterns are windows of ``width`` consecutive words of an item (an item of fewer words is one
window).  Words of the patterns are numbered; a word of a document that no pattern holds is 0.
Shift tables over blocks of two words tell how far a search position may jump, buckets by the last
block of a window select the patterns to test, and all their words are compared directly.

Cases: a null or empty text has no words; an item without words has no window; a null item id takes
part in the hits but in no id list; repeated rows are judged one by one; tables may be empty; other
columns of the documents are left alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauselens.llm.common import in_chunks, mix64, stored, text_bytes

WIDTH = 13
# bytes of benchmark text that are sent to the executors at once; a larger benchmark is searched in several rounds
ROUND_BYTES = 16_000_000
# blocks that are searched in one pass, which bounds the tables of a worker
BLOCKS = 4
CHUNK_BYTES = 4_000_000
# everything but digits, letters and non-ASCII bytes separates words; A-Z becomes lower case
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class Group:
    """Patterns of one length: places of the windows in the items' words, by their last block, and a jump for each block."""

    length: int
    starts: np.ndarray  # where the window of each pattern begins
    owners: np.ndarray  # item numbers, pattern after pattern
    owned: np.ndarray  # where those of each pattern begin, and the end
    tails: np.ndarray  # sorted distinct last blocks
    first: np.ndarray  # first pattern of each last block
    count: np.ndarray
    blocks: np.ndarray  # sorted distinct blocks of all patterns
    shift: np.ndarray


class Patterns:
    """Vocabulary and Wu-Manber tables of some benchmark items, in arrays of a few numbers for each word."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int = WIDTH):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        parts = [np.array([number(w, len(self.vocabulary) + 1) for w in words(text)], dtype=np.int32) for _, text in items]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.words = np.concatenate([*parts, np.zeros(0, dtype=np.int32)])
        begins = np.cumsum(sizes) - sizes
        lengths = np.minimum(sizes, width)
        self.groups = []
        for length in np.unique(lengths[lengths > 0]).tolist():
            mine = np.flatnonzero(lengths == length)
            counts = sizes[mine] - length + 1
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            self.groups.append(self._group(length, np.repeat(begins[mine], counts) + within, np.repeat(mine, counts)))

    def block(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) * (len(self.vocabulary) + 1) + right

    def _group(self, length: int, starts: np.ndarray, items: np.ndarray) -> Group:
        # equal windows are one pattern with several owners
        digest = np.zeros(len(starts), dtype=np.uint64)
        for k in range(length):
            digest = mix64(digest + self.words[starts + k].astype(np.uint64))
        _, first, pattern = np.unique(digest, return_index=True, return_inverse=True)
        held = np.unique(pattern.astype(np.int64) * len(self.ids) + items)
        starts = starts[first]
        end = starts + length - 1
        last = self.block(self.words[end - 1], self.words[end]) if length > 1 else self.words[end].astype(np.int64)
        order = np.argsort(last, kind="stable")
        tails, first, count = np.unique(last[order], return_index=True, return_counts=True)
        blocks, shift = tails, np.zeros(len(tails), dtype=np.int64)
        if length > 1:
            # a block that ends at word j may be moved to the end of its window; the nearest end counts
            blocks, shift = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            for jump in range(length - 1):
                every = np.unique(self.block(self.words[end - jump - 1], self.words[end - jump]))
                place = np.minimum(np.searchsorted(blocks, every), max(0, len(blocks) - 1))
                new = every[blocks[place] != every] if len(blocks) else every
                by = np.argsort(np.concatenate([blocks, new]), kind="stable")
                blocks = np.concatenate([blocks, new])[by]
                shift = np.concatenate([shift, np.full(len(new), jump)])[by]
        # owners in the order of the patterns
        of, owner = held // len(self.ids), held % len(self.ids)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        by = np.argsort(rank[of], kind="stable")
        owned = np.searchsorted(rank[of][by], np.arange(len(order) + 1))
        return Group(length, starts[order], owner[by], owned, tails, first, count, blocks, shift)

    def codes(self, found: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in found), dtype=np.int32, count=len(found))

    def search(self, codes: np.ndarray) -> Iterator[tuple[Group, np.ndarray, np.ndarray]]:
        """(group, end positions, pattern numbers) of all occurrences; 0 matches nothing."""
        for group in self.groups:
            yield group, *self._scan(group, codes)

    def _scan(self, group: Group, codes: np.ndarray, lanes: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Many cursors walk over their own stretch of the words at the same time."""
        n, m = len(codes), group.length
        stretch = max(256, -(-n // lanes))
        at = np.arange(m - 1, n, stretch, dtype=np.int64)
        stop = np.minimum(at + stretch, n)
        ends, patterns = [], []
        while len(at):
            if m > 1:
                left, right = codes[at - 1], codes[at]
                block = self.block(left, right)
                place = np.minimum(np.searchsorted(group.blocks, block), len(group.blocks) - 1)
                known = group.blocks[place] == block
                jump = np.where(known, group.shift[place], m - 1)
                jump = np.where(right == 0, m, jump)
            else:
                block = codes[at].astype(np.int64)
                jump = np.where(block == 0, 1, 0)
            there = jump == 0
            if there.any():
                hit, which = self._compare(group, codes, at[there], block[there])
                ends.append(hit)
                patterns.append(which)
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        none = np.zeros(0, dtype=np.int64)
        return (np.concatenate(ends), np.concatenate(patterns)) if ends else (none, none)

    def _compare(self, group: Group, codes: np.ndarray, at: np.ndarray, block: np.ndarray):
        place = np.minimum(np.searchsorted(group.tails, block), len(group.tails) - 1)
        kept = group.tails[place] == block
        at, place = at[kept], place[kept]
        number = group.count[place]
        position = np.repeat(at, number)
        pattern = np.repeat(group.first[place], number) + np.arange(number.sum()) - np.repeat(
            np.cumsum(number) - number, number)
        for k in range(group.length):  # the first words rule out nearly all
            same = codes[position - (group.length - 1) + k] == self.words[group.starts[pattern] + k]
            position, pattern = position[same], pattern[same]
            if not len(position):
                break
        return position, pattern


def scan_texts(texts: list[bytes], patterns: Patterns) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(is each word hit, ids of the items with an occurring window) for each text, in order."""
    gap = max([g.length for g in patterns.groups], default=1)
    for lo, hi in in_chunks(texts, CHUNK_BYTES):
        found = [words(t) for t in texts[lo:hi]]
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        starts = np.cumsum(sizes + gap) - (sizes + gap)
        codes = np.zeros(int((sizes + gap).sum()), dtype=np.int32)
        for start, size, f in zip(starts, sizes, found):
            codes[start:start + size] = patterns.codes(f)
        edges = np.zeros(len(codes) + 1, dtype=np.int64)
        items: list[set[int]] = [set() for _ in found]
        for group, ends, which in patterns.search(codes):
            np.add.at(edges, ends - group.length + 1, 1)
            np.add.at(edges, ends + 1, -1)
            owners = np.searchsorted(starts, ends, side="right") - 1
            for owner, pattern in set(zip(owners.tolist(), which.tolist())):
                items[owner].update(group.owners[group.owned[pattern]:group.owned[pattern + 1]].tolist())
        hit = np.cumsum(edges) > 0
        for start, size, owned in zip(starts.tolist(), sizes.tolist(), items):
            yield hit[start:start + size], [patterns.ids[i] for i in owned if patterns.ids[i] is not None]


def _rounds(benchmark: DataFrame, item_id: str, text: str, most: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark in blocks of bounded size, in the order of its ids."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    held, size = [], 0
    for row in rows.orderBy("i", "t").toLocalIterator(prefetchPartitions=False):
        data = row.t.encode()
        if held and size + len(data) > most:
            yield held
            held, size = [], 0
        held.append((row.i, data))
        size += len(data)
    yield held


# tables of the blocks that this worker process searches; a process that runs many tasks builds them once
_TABLES: dict[str, list[Patterns]] = {}


def _tables(name: str, blocks: list[Broadcast], width: int) -> list[Patterns]:
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = [Patterns(b.value, width) for b in blocks]
    return _TABLES[name]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    keep: list[str] | None = None, width: int = WIDTH, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """(doc, n_words, n_hit, item_ids): doc holds the kept columns (default all), ids are sorted as strings.

    The benchmark is a stated query set: it is sent to the executors in blocks of at most ``round_bytes`` (one item
    may be longer).  Up to ``BLOCKS`` of them are searched in a pass over the documents, with tables that a worker
    builds once; a larger benchmark takes several passes, which hand on what they have found.  Nothing is shuffled.
    """
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in _rounds(benchmark, item_id, item_text, round_bytes)]
    kept = docs.columns if keep is None else keep
    doc = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    rows = docs.select(doc, F.col(f"`{text}`").alias("text"), F.lit(None).cast("binary").alias("marks"), F.lit(None).cast(
        "array<string>").alias("item_ids"))
    shape = f"doc {rows.schema['doc'].dataType.simpleString()}"
    for first in range(0, len(blocks), BLOCKS):
        part, more = blocks[first:first + BLOCKS], first + BLOCKS < len(blocks)
        rows = rows.mapInArrow(_pass(part, width, more), f"{shape}, text string, marks binary, item_ids array<string>" if more else
                               f"{shape}, n_words long, n_hit long, item_ids array<string>")
        rows = stored(rows) if more else rows
    return rows


def _pass(blocks: list[Broadcast], width: int, more: bool):
    """Search the blocks in every text; marks are bits of the words hit so far."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(name, blocks, width)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            before = [(m, i) for m, i in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            hits: list[np.ndarray | None] = [None] * len(texts)
            ids: list[set[str]] = [set(i or ()) for _, i in before]
            for patterns in tables:
                for i, (marks, found) in enumerate(scan_texts(texts, patterns)):
                    hits[i] = marks if hits[i] is None else hits[i] | marks
                    ids[i].update(found)
            for i, (marks, _) in enumerate(before):
                if marks:
                    hits[i] |= np.unpackbits(np.frombuffer(marks, dtype=np.uint8), count=len(hits[i])).astype(bool)
            named = pa.array([sorted(i) for i in ids], pa.list_(pa.string()))
            if more:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([np.packbits(h).tobytes() for h in hits], pa.binary()), named],
                    names=["doc", "text", "marks", "item_ids"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(h) for h in hits], pa.int64()),
                     pa.array([int(h.sum()) for h in hits], pa.int64()), named],
                    names=["doc", "n_words", "n_hit", "item_ids"])

    return run


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """A document is contaminated if at least a twentieth of its words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
