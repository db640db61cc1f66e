"""Substring deduplication with collection Burrows-Wheeler transforms.

Every byte covered by a string of ``width`` bytes that also starts in a document with a smaller id is
removed.  Strings are dealt out by content: a string's *anchor* is the smallest hash among its
substrings of ``ANCHOR`` bytes, so equal strings have equal anchors wherever they are.  Stretches of a document
whose strings share an anchor (a few bytes more than ``width``) travel together to the anchor's bucket.

1. Documents are hashed into groups of a few megabytes.  Each group sends its sorted anchors, shortened
   to 32 bits, to their buckets.
2. A bucket answers each group with two bits for each anchor: does another group have it too, and do more than
   ``HOT_GROUPS`` have it?
3. Each group sends the stretches whose anchors are shared; of equal ones only those of the smallest id.  Strings
   of a hot anchor, as a phrase in a template makes one, go one by one to the buckets of their own hashes: equal strings
   still meet, and no bucket gets all that share the anchor.
4. In a bucket, equal stretches become one, and the rest are a collection of short documents: its
   Burrows-Wheeler transform and common prefixes are built column by column from the right.  Every
   round inserts one symbol of each stretch into the transform, in one sequential pass over it.  The
   passes' sequential files are arrays, because a collection is bounded; between the steps they are
   Spark's shuffle files.  Neighbouring suffixes with a common prefix of ``width`` bytes start with the same
   string, and the smallest id among them decides.
5. The spans go back to the groups, where they are cut out.

The documents are shuffled once, by group, for steps 1, 3 and 5.

Cases: a null text is empty; a text shorter than ``width`` is kept whole; a document without an id has no place
in the order, is kept whole and does not count for others; repeated rows of one id do not count against
each other and share their spans, cut to their length; tables may be empty; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauselens.llm.common import BYTE_CODES, FACTOR, mix64

WIDTH = 50
ANCHOR = 24  # bytes of the substrings that anchors are chosen from; long enough to be rare in text
RUN = WIDTH - ANCHOR + 1  # strings in one stretch at most; only in periodic texts do more share an anchor
BLOCK = 1 << 16  # positions that are hashed at once
GROUP_BYTES = 2_000_000  # text of the documents in one group
BUCKET_BYTES = 16_000_000  # text for each bucket, at most
HOT_GROUPS = 256  # groups that may share an anchor whose stretches travel together
COLLECTION = 8_000  # stretches in one collection, but for a larger group of one anchor


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each position on, by doubling; shorter by width - 1."""
    with np.errstate(over="ignore"):
        total, done, factor = None, 0, FACTOR
        part, size = BYTE_CODES[data], 1
        while True:
            if width & size:
                if total is None:
                    total = part
                else:
                    power = np.uint64(pow(int(FACTOR), size, 1 << 64))
                    n = min(len(total), len(part) - done)
                    total = total[:n] * power + part[done:done + n]
                done += size
            if size * 2 > width:
                return total[:max(0, len(data) - width + 1)]
            part = part[:max(0, len(part) - size)] * factor + part[size:]
            factor = np.uint64(int(factor) * int(factor) & 0xFFFFFFFFFFFFFFFF)
            size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    part, size = values, 1
    while size * 2 <= width:
        part = np.minimum(part[:len(part) - size], part[size:])
        size *= 2
    rest = width - size
    return np.minimum(part[:len(part) - rest], part[rest:]) if rest else part


def in_blocks(function, data: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first position, values) of a function of ``reach`` bytes at each position; blocks stay in the CPU's cache."""
    for lo in range(0, len(data) - reach + 1, BLOCK):
        yield lo, function(data[lo:lo + BLOCK + reach - 1])


def picked(function, data: np.ndarray, reach: int, at: np.ndarray) -> np.ndarray:
    """Values of a function of ``reach`` bytes at some ascending positions."""
    out = np.empty(len(at), dtype=np.uint64)
    for lo, values in in_blocks(function, data, reach):
        a, b = np.searchsorted(at, (lo, lo + len(values)))
        out[a:b] = values[at[a:b] - lo]
    return out


def anchors(data: np.ndarray, width: int) -> np.ndarray:
    """Anchor of the string of ``width`` bytes at each position."""
    return sliding_min(mix64(rolling(data, ANCHOR)), width - ANCHOR + 1)


def stretches(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(joined bytes, anchor, text number, start in the joined bytes, strings) of the stretches of some texts."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    found, values, before = [], [], None
    for lo, anchor in in_blocks(lambda part: anchors(part, width), data, width):
        new = np.empty(len(anchor), dtype=bool)
        new[0] = before is None or anchor[0] != before
        np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
        borders = ends[np.searchsorted(ends, lo):np.searchsorted(ends, lo + len(anchor))] - lo
        new[borders] = True
        at = np.flatnonzero(new)
        found.append(at + lo)
        values.append(anchor[at])
        before = anchor[-1]
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return data, none.astype(np.uint64), none, none, none
    begin, anchor = np.concatenate(found), np.concatenate(values)
    # a stretch ends before the next one, or with its text's last whole string; long ones are cut
    owner = np.searchsorted(ends, begin, side="right")
    strings = np.minimum(np.append(begin[1:], len(data)), ends[owner] - width + 1) - begin
    parts = np.maximum(-(-strings // RUN), 0)
    first = np.repeat(np.cumsum(parts) - parts, parts)
    shift = (np.arange(len(first)) - first) * RUN
    anchor, owner, begin, strings = (np.repeat(v, parts) for v in (anchor, owner, begin, strings))
    return data, anchor, owner, begin + shift, np.minimum(strings - shift, RUN)


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of some stretches, one after the other."""
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    return data[shift + np.arange(int(length.sum()))]


def content_hash(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Hash of whole stretches, in ascending order: their first and last string cover them."""
    strings = lambda part: rolling(part, width)
    with np.errstate(over="ignore"):
        total = mix64(length.astype(np.uint64) * FACTOR + picked(strings, data, width, start))
        return mix64(total * FACTOR + picked(strings, data, width, start + length - width))


class Collection:
    """Burrows-Wheeler transform and common prefixes of short documents, built one column a round."""

    def __init__(self, texts: np.ndarray, start: np.ndarray, length: np.ndarray, width: int):
        self.count, self.width = len(start), width
        self.texts, self.end, self.length = texts, start + length, length
        # round 0: the empty suffixes, in the order of the documents; a symbol is a byte + 1, 0 ends a document
        self.symbol = texts[self.end - 1].astype(np.uint16) + 1
        self.prefix = np.zeros(self.count, dtype=np.uint8)  # common prefix with the suffix before, at most width
        self.owner = np.arange(self.count, dtype=np.int32)
        self.size = np.zeros(self.count, dtype=np.uint8)  # length of the suffix
        self.fresh = np.ones(self.count, dtype=bool)  # inserted by the last round
        for column in range(1, int(length.max(initial=0)) + 1):
            self._insert(column)

    def _insert(self, column: int) -> None:
        """Insert the suffixes of ``column`` bytes: each goes where its last symbol leads."""
        order = np.argsort(self.symbol, kind="stable")
        order = order[np.searchsorted(self.symbol[order], 1):]  # nothing follows the end of a document
        new = self.fresh[order]
        owner = self.owner[order[new]]
        n = self.count + len(order)
        at = np.flatnonzero(new) + self.count
        old = np.ones(n, dtype=bool)
        old[at] = False
        prefix = self._merged(self.prefix, old, at, 0)
        # a new suffix, and the one after it, differ from the one before where the shorter suffixes do
        touched = np.zeros(len(order) + 1, dtype=bool)
        touched[:-1] = new
        touched[1:] |= new
        touched = np.flatnonzero(touched[:-1])
        after = touched[touched > 0]
        same = self.symbol[order[after]] == self.symbol[order[after - 1]]
        prefix[self.count + touched] = 0
        both = after[same]
        least = self._least(order[both - 1] + 1, order[both])
        prefix[self.count + both] = np.minimum(least + 1, self.width)
        left = self.length[owner] - column
        following = np.where(left > 0, self.texts[np.maximum(self.end[owner] - column - 1, 0)].astype(np.uint16) + 1, 0)
        self.symbol = self._merged(self.symbol, old, at, following)
        self.owner = self._merged(self.owner, old, at, owner)
        self.size = self._merged(self.size, old, at, column)
        self.prefix, self.fresh = prefix, ~old

    @staticmethod
    def _merged(values: np.ndarray, old: np.ndarray, at: np.ndarray, new) -> np.ndarray:
        out = np.empty(len(old), dtype=values.dtype)
        out[old] = values
        out[at] = new
        return out

    def _least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Smallest common prefix in each range first..last: two overlapping powers of two cover it."""
        out = np.zeros(len(first), dtype=np.uint8)
        level = np.frexp(last - first + 1)[1] - 1
        table = self.prefix
        for k in range(int(level.max(initial=-1)) + 1):
            if k:
                table = np.minimum(table[:-(1 << (k - 1))], table[1 << (k - 1):])
            now = level == k
            out[now] = np.minimum(table[first[now]], table[last[now] - (1 << k) + 1])
        return out

    def smallest(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, smallest id) of every string of ``width`` bytes."""
        long = self.size >= self.width
        owner, size = self.owner[long], self.size[long]
        # suffixes too short for a string lie between groups only
        border = np.flatnonzero(self.prefix[long] < self.width)
        if not len(owner):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        border = np.unique(np.append(0, border))
        least = np.minimum.reduceat(ids[owner], border)
        group = np.repeat(least, np.diff(np.append(border, len(owner))))
        return owner.astype(np.int64), self.length[owner] - size, group


def smallest_ids(texts: np.ndarray, start: np.ndarray, strings: np.ndarray, ids: np.ndarray, group: np.ndarray,
                 width: int = WIDTH) -> np.ndarray:
    """Smallest id of each string of different stretches, in order; stretches of one group lie together.

    Different stretches of one string each, as those of a hot anchor, have no string in common.
    """
    out = np.repeat(ids, strings)
    first = np.cumsum(strings) - strings
    edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.append(edges, len(group)))
    most = np.maximum.reduceat(strings, edges) if len(edges) else edges
    lo = 0
    while lo < len(edges):
        hi, held = lo, 0
        while hi < len(edges) and (held == 0 or held + sizes[hi] <= COLLECTION):
            held += sizes[hi]
            hi += 1
        at = np.concatenate([np.arange(e, e + s) for e, s, m in zip(edges[lo:hi], sizes[lo:hi], most[lo:hi]) if s > 1 and m > 1] or [
            np.zeros(0, dtype=np.int64)])
        if len(at):
            built = Collection(texts, start[at], strings[at] + width - 1, width)
            owner, place, least = built.smallest(ids[at])
            out[first[at][owner] + place] = least
        lo = hi
    return out


def runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


def spans_of(ids: np.ndarray, start: np.ndarray, strings: np.ndarray, least: np.ndarray, width: int):
    """(number of the occurrence, begin, end) of the runs of strings that a smaller id has; least: for every string."""
    number = np.repeat(np.arange(len(ids)), strings)
    place = np.arange(len(number)) - np.repeat(np.cumsum(strings) - strings, strings)
    gone = least < ids[number]
    # the runs may not reach over the border of two occurrences
    begin = gone & np.append(True, ~gone[:-1] | (number[1:] != number[:-1]))[:len(gone)]
    end = gone & np.append(~gone[1:] | (number[1:] != number[:-1]), True)[:len(gone)]
    b, e = np.flatnonzero(begin), np.flatnonzero(end)
    return number[b], start[number[b]] + place[b], start[number[b]] + place[e] + width


PACK, UNPACK = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    return PACK.compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(UNPACK.decompress(data), dtype=kind)


BUCKETS_A_PARTITION = 2
DEALT = "g long, bucket int, texts binary, strings binary, ids binary, place binary, done binary"
KINDS = [pa.int64(), pa.int32()] + [pa.binary()] * 5


def codes(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of an anchor and its 32 bits there, as one number."""
    bits = mix64(anchor)
    return (bits % np.uint64(buckets)) << np.uint64(32) | bits >> np.uint64(32)


def sorted_anchors(texts: list[bytes], buckets: int, width: int = WIDTH) -> Iterator[tuple[int, bytes]]:
    """(bucket, sorted 32-bit anchors) of the documents of a group."""
    every = np.unique(codes(stretches(texts, width)[1], buckets))
    edges = np.searchsorted(every, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
    for b in np.flatnonzero(np.diff(edges)):
        part = (every[edges[b]:edges[b + 1]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        yield int(b), pack(np.diff(part, prepend=np.uint32(0)))


def shared_bits(groups: list[bytes], hot: int = HOT_GROUPS) -> list[bytes]:
    """For the anchors of each group in a bucket: has another group the same, and have more than ``hot``?"""
    parts = [np.cumsum(unpack(g, np.uint32), dtype=np.uint32) for g in groups]
    _, inverse, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    edges = np.cumsum([len(p) for p in parts])[:-1]
    return [np.packbits(n > 1).tobytes() + np.packbits(n > hot).tobytes() for n in np.split(count[inverse], edges)]


def known_bits(bits: dict[int, bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shared, hot) for all anchors of a group, bucket after bucket."""
    out: tuple[list, list] = ([], [])
    for b in np.flatnonzero(size).tolist():
        half = -(-int(size[b]) // 8)
        for part, data in zip(out, (bits[b][:half], bits[b][half:])):
            part.append(np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=size[b]).astype(bool))
    return np.concatenate(out[0]), np.concatenate(out[1])


def dealt(texts: list[bytes], ids: np.ndarray, bits: dict[int, bytes], buckets: int, width: int = WIDTH) -> Iterator[tuple]:
    """(bucket, texts, strings, ids, places, spans) of the stretches of a group with shared anchors.

    Of equal stretches only those of the smallest id go on; the others' strings are gone already, and
    only their spans are sent.  So a passage that all documents share is sent once for each group.
    """
    data, anchor, owner, begin, strings = stretches(texts, width)
    if not len(anchor):
        return
    every, inverse = np.unique(codes(anchor, buckets), return_inverse=True)
    size = np.bincount((every >> np.uint64(32)).astype(np.int64), minlength=buckets)
    shared, hot = known_bits(bits, size)
    own = ids[owner]
    low, high = np.full(len(every), np.iinfo(np.int64).max), np.full(len(every), np.iinfo(np.int64).min)
    np.minimum.at(low, inverse, own)
    np.maximum.at(high, inverse, own)
    take = np.flatnonzero((shared | (low != high))[inverse])
    base = np.cumsum([0] + [len(t) for t in texts])
    bucket = (every >> np.uint64(32)).astype(np.int64)[inverse[take]]
    # stretches of hot anchors become single strings
    single = hot[inverse[take]]
    parts = np.where(single, strings[take], 1)
    take = np.repeat(take, parts)
    shift = np.arange(len(take)) - np.repeat(np.cumsum(parts) - parts, parts)
    bucket, single = np.repeat(bucket, parts), np.repeat(single, parts)
    begin, strings, own = begin[take] + shift, np.where(single, 1, strings[take]), own[take]
    place = begin - base[owner[take]]
    length = strings + width - 1
    content = content_hash(data, begin, length, width)
    bucket = np.where(single, (mix64(content) % np.uint64(buckets)).astype(np.int64), bucket)
    order = np.lexsort((own, content))
    first = np.append(True, content[order][1:] != content[order][:-1])[:len(order)]
    least = np.empty(len(order), dtype=np.int64)
    least[order] = own[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    gone = np.flatnonzero(own > least)
    spans = merged(own[gone], place[gone], place[gone] + length[gone])
    home = int(mix64(ids[:1].view(np.uint64))[0] % np.uint64(buckets))  # the spans may take any way
    bucket[gone] = -1
    by = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
    for b in range(buckets):
        at = by[edges[b]:edges[b + 1]]
        sent = spans if b == home else [s[:0] for s in spans]
        if len(at) or len(sent[0]):
            yield (b, pack(gathered(data, begin[at], length[at])), pack(strings[at].astype(np.uint8)),
                   pack(np.diff(own[at], prepend=0)), pack(place[at].astype(np.uint32)), pack(np.stack(sent)))


def resolve(texts: np.ndarray, strings: np.ndarray, ids: np.ndarray, place: np.ndarray, width: int = WIDTH):
    """(number of the stretch, begin, end) of removed runs among the stretches of one bucket."""
    length = strings + width - 1
    start = np.cumsum(length) - length
    anchor = picked(lambda part: anchors(part, width), texts, width, start)
    # equal stretches become one with the smallest id; anchors lie together
    content = content_hash(texts, start, length, width)
    order = np.lexsort((ids, content, anchor))
    start, length, strings, anchor, content = (v[order] for v in (start, length, strings, anchor, content))
    new = np.append(True, (content[1:] != content[:-1]) | (anchor[1:] != anchor[:-1]))
    first, which = np.flatnonzero(new), np.cumsum(new) - 1
    least = smallest_ids(texts, start[first], strings[first], ids[order][first], anchor[first], width)
    offset = np.cumsum(strings[first]) - strings[first]
    every = least[np.repeat(offset[which] - (np.cumsum(strings) - strings), strings) + np.arange(int(strings.sum()))]
    number, begin, end = spans_of(ids[order], place[order], strings, every, width)
    return order[number], begin, end


def merged(ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of one document become one."""
    order = np.lexsort((begin, ids))
    ids, begin, end = ids[order], begin[order], end[order]
    if not len(ids):
        return ids, begin, end
    number = np.cumsum(np.append(False, ids[1:] != ids[:-1]))
    shift = number * (int(end.max()) + 1)  # a running maximum that starts anew with each document
    far = np.maximum.accumulate(end + shift) - shift
    new = np.append(True, (ids[1:] != ids[:-1]) | (begin[1:] > far[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(ids) - 1)
    return ids[new], begin[new], far[last]


def cut_out(data: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[bytes, int]:
    """(what is left, number of removed runs) of a text and its merged spans."""
    kept, at, number = [], 0, 0
    for b, e in zip(begin.tolist(), end.tolist()):
        if b < len(data):
            kept.append(data[at:b])
            at, number = e, number + 1
    return b"".join([*kept, data[at:]]), number


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, width: int = WIDTH,
    kept_text: bool = True, hot_groups: int = HOT_GROUPS, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept_sha256[, kept]): doc holds the kept columns (default all)."""
    spark = docs.sparkSession
    doc = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("doc")
    rows = docs.select(doc, F.col(f"`{doc_id}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    buckets = max(BUCKETS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    named = rows.where("id is not null").withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)))
    grouped = named.groupBy("g")
    result = f"doc {rows.schema['doc'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    result += ", kept binary" if kept_text else ""

    def numbers(table: pa.Table) -> tuple[int, list[bytes], np.ndarray]:
        return table.column("g")[0].as_py(), table.column("text").to_pylist(), table.column("id").to_numpy()

    def anchors_of(table: pa.Table) -> pa.Table:
        g, texts, _ = numbers(table)
        found = list(sorted_anchors(texts, buckets, width))
        return pa.table({"g": pa.array([g] * len(found), pa.int64()), "bucket": pa.array([b for b, _ in found], pa.int32()),
                         "anchors": pa.array([a for _, a in found], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        return pa.table({"g": table.column("g"), "bucket": table.column("bucket"), "bits": pa.array(
            shared_bits(table.column("anchors").to_pylist(), hot_groups), pa.binary())})

    def deal(table: pa.Table, bits: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({f.split()[0]: pa.array([], k) for f, k in zip(DEALT.split(", "), KINDS)})
        g, texts, ids = numbers(table)
        known = dict(zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist()))
        found = list(dealt(texts, ids, known, buckets, width))
        columns = [[g] * len(found), *([r[k] for r in found] for k in range(6))]
        return pa.table({f.split()[0]: pa.array(c, k) for f, c, k in zip(DEALT.split(", "), columns, KINDS)})

    def settle(table: pa.Table) -> pa.Table:
        columns = {c: [unpack(b, kind) for b in table.column(c).to_pylist()] for c, kind in (
            ("texts", np.uint8), ("strings", np.uint8), ("ids", np.int64), ("place", np.uint32), ("done", np.int64))}
        group = np.repeat(table.column("g").to_numpy(), [len(x) for x in columns["ids"]])
        ids = np.concatenate([np.cumsum(x) for x in columns["ids"]])
        strings, place = (np.concatenate(columns[c]).astype(np.int64) for c in ("strings", "place"))
        number, begin, end = (np.zeros(0, np.int64),) * 3
        if len(ids):
            number, begin, end = resolve(np.concatenate(columns["texts"]), strings, ids, place, width)
        done = np.concatenate([x.reshape(3, -1) for x in columns["done"]], axis=1)
        home = np.repeat(table.column("g").to_numpy(), [len(x) // 3 for x in columns["done"]])
        group = np.concatenate([group[number], home])
        spans = np.stack([np.concatenate([a, b]) for a, b in zip((ids[number], begin, end), done)])
        order = np.argsort(group, kind="stable")
        found, edges = np.unique(group[order], return_index=True)
        parts = [np.stack(merged(*spans[:, at])) for at in np.split(order, edges[1:])] if len(found) else []
        return pa.table({"g": pa.array(found, pa.int64()), "spans": pa.array([pack(p) for p in parts], pa.binary())})

    def finish(table: pa.Table, spans: pa.Table) -> pa.Table:
        parts = [unpack(b, np.int64).reshape(3, -1) for b in spans.column("spans").to_pylist()]
        owner, begin, end = merged(*np.concatenate(parts, axis=1)) if parts else (np.zeros(0, np.int64),) * 3
        ids = table.column("id").to_numpy() if len(table) else np.zeros(0, np.int64)
        lo, hi = np.searchsorted(owner, ids, "left"), np.searchsorted(owner, ids, "right")
        out: list[list] = [[] for _ in range(5)]
        for data, a, b in zip(table.column("text").to_pylist(), lo.tolist(), hi.tolist()):
            kept, number = cut_out(data, begin[a:b], end[a:b])
            for o, v in zip(out, (len(data), len(data) - len(kept), number, hashlib.sha256(kept).hexdigest(), kept)):
                o.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
        columns = {n: pa.array(o, k) for n, o, k in zip(names, out, kinds)}
        if not kept_text:
            del columns["kept"]
        return pa.table({"doc": table.column("doc"), **columns})

    answers = grouped.applyInArrow(anchors_of, "g long, bucket int, anchors binary").groupBy("bucket").applyInArrow(
        answer, "g long, bucket int, bits binary")
    sent = grouped.cogroup(answers.groupBy("g")).applyInArrow(deal, DEALT)
    spans = sent.groupBy("bucket").applyInArrow(settle, "g long, spans binary")
    changed = grouped.cogroup(spans.groupBy("g")).applyInArrow(finish, result)
    unnamed = rows.where("id is null").select(
        "doc", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
        *([F.col("text").alias("kept")] if kept_text else []))
    return changed.unionByName(unnamed)
