"""Near-duplicate join: MinHash candidates, Bayesian pruning, exact verification.

Documents are sets of five-word shingles (words are lower-case runs of letters, digits and non-ASCII
bytes; fewer than five words make one shingle).  Texts with equal sets are one class representative
with its copies.  Representatives that agree in a band of MinHash values are candidates.  Candidates of a band
are compared MinHash by MinHash: after every few values, pairs whose posterior probability of reaching the
threshold has fallen below the tolerance are dropped.  This takes a byte of each value, no texts, and no more of the
pairs that stay than connect them.  Only documents that still have a partner send their text: their connected groups are
compared in tiles of bounded size, pruned again, and the shingles of the rest are compared exactly.  So pages
that share a template, and are less alike than the threshold, make no group and send nothing.

``n_links`` counts the other documents whose similarity is at least the threshold, copies included;
``class_id`` is the smallest id that links, direct or over others, lead to.

Cases: a text without words links to nothing; a null id cannot be linked and gives class null with no
links; repeated rows of one id are one document (the copy with the smallest text digest); tables may be
empty; texts of any length are read whole; other columns are not needed and left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from clauselens.llm.common import BYTE_CODES, FACTOR, in_chunks, mix64, preselected, slot_of, stored, text_bytes, word_hashes, word_spans
from clauselens.llm.decontaminate import FOLD

SHINGLE = 5
THRESHOLD = 0.8
# 25 bands of 5 values: a pair at the threshold is missed with probability (1 - 0.8 ** 5) ** 25 = 5e-5
BANDS, ROWS = 25, 5
VALUES = 128
STEP = 16
TOLERANCE = 1e-5
TILE = 256  # documents on each side of a tile
TILE_WORDS = 1_000_000
CHUNK_BYTES = 1_000_000
BAND_TILE = 4096  # members of a band on each side of a comparison
BAND_ROWS = 50_000  # members of small bands that are compared in one call
HOT_NODE, SALTS = 256, 64  # neighbours from which a node's rows are spread


@lru_cache
def multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(97)
    odd = rng.integers(0, 2 ** 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 2 ** 63, VALUES, dtype=np.uint64)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    out: list[np.ndarray] = []
    for lo, hi in in_chunks(texts, CHUNK_BYTES):
        data = np.frombuffer(b" ".join([*texts[lo:hi], b""]).translate(FOLD), dtype=np.uint8)
        inside = data != 32
        begin, end = word_spans(data, inside)
        h = word_hashes(data, inside, begin, end, BYTE_CODES)
        borders = np.searchsorted(begin, np.cumsum([0] + [len(t) + 1 for t in texts[lo:hi]]))
        full = _joined(h, SHINGLE)
        for first, last in zip(borders[:-1].tolist(), borders[1:].tolist()):
            if last - first >= SHINGLE:
                out.append(np.unique(full[first:last - SHINGLE + 1]))
            else:
                out.append(_joined(h[first:last], last - first)[:last - first and 1])
    return out


def _joined(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    size = max(0, len(h) - n + 1)
    total = np.zeros(size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            total = total * FACTOR + mix64(h[k:k + size] + np.uint64(k))
    return mix64(total)


def set_digest(shingles: np.ndarray) -> str:
    """Equal for equal sets."""
    return hashlib.md5(shingles.tobytes()).hexdigest()


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """VALUES MinHash values of one set."""
    odd, add = multipliers()
    out = np.full(VALUES, 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for lo in range(0, len(shingles), 2048):
            h = shingles[lo:lo + 2048, None] * odd + add
            out = np.minimum(out, (h >> np.uint64(32)).astype(np.uint32).min(0))
    return out


@lru_cache
def least_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest equal values out of ``compared`` with which a pair stays.

    Under a uniform prior the similarity's posterior after m matches is Beta(m + 1, compared - m + 1).
    """
    grid = (np.arange(4000) + 0.5) / 4000
    for m in range(compared + 1):
        a, b = m + 1, compared - m + 1
        density = np.exp((a - 1) * np.log(grid) + (b - 1) * np.log1p(-grid) + lgamma(a + b) - lgamma(a) - lgamma(b))
        if density[grid >= threshold].sum() / density.sum() >= tolerance:
            return m
    return compared


def pruned_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) that survive the incremental comparison; each pair once if same."""
    agree = np.zeros((len(left), len(right)), dtype=np.int32)
    for k in range(STEP):
        agree += left[:, None, k] == right[None, :, k]
    alive = agree >= least_matches(STEP)
    if same:
        alive &= np.tri(len(left), k=-1, dtype=bool).T
    a, b = np.nonzero(alive)
    matches = agree[a, b]
    for done in range(STEP, VALUES, STEP):
        matches = matches + (left[a, done:done + STEP] == right[b, done:done + STEP]).sum(1)
        stay = matches >= least_matches(done + STEP)
        a, b, matches = a[stay], b[stay], matches[stay]
    return a, b


def verified(a: np.ndarray, b: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs reach the threshold: exact intersections of shingle sets."""
    keep = np.zeros(len(a), dtype=bool)
    for i in np.unique(a):
        at = np.flatnonzero(a == i)
        sets = [right[j] for j in b[at]]
        sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        place = np.minimum(np.searchsorted(left[i], every), len(left[i]) - 1)
        shared = np.add.reduceat((left[i][place] == every).astype(np.int64), np.cumsum(sizes) - sizes)
        keep[at] = shared >= np.ceil(np.round(threshold * (sizes + len(left[i])) / (1 + threshold), 9))
    return keep


def compare(ids: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], side: np.ndarray, threshold: float):
    """(links of each document in this tile, edges of a spanning forest).  side 0 and 1 are compared with each other;
    with one side only, its documents among themselves."""
    values = np.stack([minhashes(s) for s in sets]) if sets else np.zeros((0, VALUES), np.uint32)
    rows = [np.flatnonzero(side == k) for k in (0, 1)]
    same = len(rows[1]) == 0
    left, right = rows[0], rows[0] if same else rows[1]
    links = np.zeros(len(ids), dtype=np.int64)
    root = np.arange(len(ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges: list[tuple[int, int]] = []
    a, b = pruned_pairs(values[left], values[right], same)
    good = verified(a, b, [sets[i] for i in left], [sets[i] for i in right], threshold)
    a, b = left[a[good]], right[b[good]]
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[rx] = ry
            edges.append((int(ids[x]), int(ids[y])))
    return links, edges


def fingerprints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, same, n, bands, sketch): digest of the shingle set, number of shingles, a hash for each band, and the last
    byte of every MinHash value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(text_bytes(batch.column(1)))
            bands, same, sizes, sketches = [], [], [], []
            for s in sets:
                every = minhashes(s)
                sketches.append((every & np.uint32(255)).astype(np.uint8).tobytes())
                values = every[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
                code = np.arange(BANDS, dtype=np.uint64)
                for k in range(ROWS):
                    code = mix64(code * np.uint64(0x100000001B3) + values[:, k])
                bands.append(code.view(np.int64))
                same.append(set_digest(s))
                sizes.append(len(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(same), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())],
                names=["id", "same", "n", "bands", "sketch"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where("id is not null")
    return rows.mapInArrow(run, "id long, same string, n long, bands array<long>, sketch binary")


def stays(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which rows of sketches are not dropped on the way, compared with one sketch or row by row."""
    agree = (others == one).reshape(len(others), VALUES // STEP, STEP).sum(2).cumsum(1)
    return (agree >= [least_matches(done) for done in range(STEP, VALUES + 1, STEP)]).all(1)


def connected(sketches: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the pairs that stay connect, found from node to node: a node is compared with those that
    nothing has reached yet, on the other side if there are two."""
    two = side.any()
    left = np.ones(len(side), dtype=bool)
    edges: list[tuple[int, int]] = []
    for start in range(len(side)):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            node = todo.pop()
            rest = np.flatnonzero(left & (side != side[node]) if two else left)
            if len(rest):
                near = rest[stays(sketches[node], sketches[rest])].tolist()
                left[near] = False
                todo.extend(near)
                edges.extend((node, n) for n in near)
    return edges


def compare_bands(rows: pa.Table) -> pa.Table:
    """(a, b): connections within each band of a table of (code, side, id, sketch)."""
    order = np.lexsort((rows.column("id").to_numpy(), rows.column("code").to_numpy()))
    code, ids, side = (rows.column(c).to_numpy()[order] for c in ("code", "id", "side"))
    sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, VALUES)[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    size = np.diff(np.append(first, len(code)))
    leader = np.repeat(first, size)
    # most bands are connected by their first member alone
    near = np.concatenate([stays(sketches[leader[i:i + 8192]], sketches[i:i + 8192]) for i in range(0, len(code), 8192)])
    whole = (np.add.reduceat(near, first) == size) & ~np.maximum.reduceat(side, first).astype(bool)
    simple = np.repeat(whole, size)
    simple[first] = False
    a, b = [ids[leader[simple]]], [ids[simple]]
    for lo, n in zip(first[~whole].tolist(), size[~whole].tolist()):
        if n > 1:
            found = connected(sketches[lo:lo + n], side[lo:lo + n])
            a.append(ids[lo:lo + n][[x for x, _ in found]])
            b.append(ids[lo:lo + n][[y for _, y in found]])
    return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})


def surviving(reps: DataFrame) -> DataFrame:
    """(a, b): connections between representatives whose comparison by sketches is not broken off in some band."""
    banded = reps.select("id", F.posexplode("bands").alias("band", "code")).select(
        "id", F.xxhash64("band", "code").alias("code"))
    shared = stored(banded.groupBy("code").agg(F.count("*").alias("members")).where("members > 1"))
    total = shared.agg(F.sum("members").alias("n")).first()["n"] or 0
    calls = max(1, -(-total // BAND_ROWS))
    met = banded.join(shared, "code").join(reps.select("id", "sketch"), "id")
    parts = F.ceil(F.col("members") / BAND_TILE).cast("int")
    met = met.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    # small bands travel together; a large one is cut into tiles, each compared with itself and each other once
    spread = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    large = F.col("parts") > 1
    rows = spread.select(
        F.when(large, F.col("code")).otherwise(F.pmod("code", F.lit(calls))).alias("call"),
        F.when(large, F.least("own", "other")).otherwise(-1).alias("t0"), F.when(large, F.greatest("own", "other")).otherwise(-1).alias("t1"),
        "code", (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "sketch")
    return rows.groupBy("call", "t0", "t1").applyInArrow(compare_bands, "a long, b long")


def with_least(rows: DataFrame, degree: DataFrame, most: int) -> DataFrame:
    """(a, b, m): every row with the least neighbour of its node, from (a, b) and (a, m, n); ``most`` is the largest n.

    Without a hot node that is a join on the node.  The rows of hot nodes, those with more than ``HOT_NODE`` neighbours, are
    spread by salt; which nodes may be hot is told by a broadcast of at most ``FILTER_SLOTS`` hash slots.
    """
    if most <= HOT_NODE:
        return rows.join(degree, "a").select("a", "b", "m")
    hot = F.broadcast(degree.where(F.col("n") > HOT_NODE).select(slot_of(F.col("a")).alias("slot")).distinct().withColumn("hot", F.lit(True)))

    def marked(side: DataFrame) -> DataFrame:
        return side.withColumn("slot", slot_of(F.col("a"))).join(hot, "slot", "left").drop("slot")

    salted = marked(rows).withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("b"), F.lit(SALTS))).otherwise(0).cast("int"))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = marked(degree).select("a", "m", F.explode(salts).alias("salt"))
    return salted.join(repeated, ["a", "salt"]).select("a", "b", "m")


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(id, component) of every end of an edge (a, b): the smallest id it is connected with.

    Alternating steps of the large-star and small-star kind: every node points its neighbours to the smallest id it
    knows, so long chains shrink by halves.  The rows of a node that has gathered many neighbours are spread by salt.
    The rounds end when number and digest of the pairs stay the same.
    """
    def state(rows: DataFrame) -> Row:
        return rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest")).first()

    pairs = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = state(pairs)
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"))
        most = degree.agg(F.max("n").alias("n")).first()["n"] or 0
        # large star: larger neighbours move to the least neighbour
        large = with_least(both, degree, most).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and the node itself move to the least neighbour
        small = large.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b"))))
        pairs = stored(small.select(ends.alias("x")).select("x.*").where("a != b").distinct())
        after = state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, class_id, n_links), one row for each row of the documents.

    Texts are read twice, and shuffled once: only those of candidates, to their tiles.
    """
    prints = stored(fingerprints(docs, doc_id, text))
    # one row for each id, then one representative for each shingle set
    once = prints.groupBy("id").agg(F.min_by(F.struct("same", "n", "bands", "sketch"), "same").alias("p")).select("id", "p.*")
    wordy = once.where("n > 0")
    # stored, so that the join back is between two exchanges, which AQE can split where many texts are the same
    sets = stored(wordy.groupBy("same").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    reps = stored(wordy.join(sets.select(F.col("rep").alias("id"), "copies"), "id").select("id", "n", "bands", "sketch", "copies"))
    blocks = stored(components(surviving(reps)).join(reps.select("id", "n", "copies"), "id"))
    size = blocks.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("words"))
    size = size.select("component", F.greatest(
        F.ceil(F.col("members") / TILE), F.ceil(F.col("words") / TILE_WORDS)).cast("int").alias("tiles"))
    placed = blocks.join(size, "component").withColumn("tile", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    # a document meets every tile of its group; a tile is compared with itself and with each other tile once
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "id", "copies", "component", F.least("tile", "other").alias("t0"), F.greatest("tile", "other").alias("t1"),
        (F.col("tile") > F.col("other")).cast("int").alias("side"))
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    candidates = preselected(texts, F.col("id"), blocks.select("id"))
    met = stored(spread.join(candidates, "id").groupBy("component", "t0", "t1").applyInArrow(
        _tile(threshold), "id long, links long, other long"))
    links = met.where("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    classes = components(met.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    settled = stored(
        sets.join(links.withColumnRenamed("id", "rep"), "rep", "left")
        .join(classes.withColumnRenamed("id", "rep"), "rep", "left")
        .select("same", F.coalesce("component", "rep").alias("class_id"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    found = wordy.select("id", "same").join(settled, "same").drop("same")
    ids = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"))
    return ids.join(found, "id", "left").select(
        F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _tile(threshold: float):
    """Compare the documents of one tile; rows (id, links, null) and (id, null, other end of a forest edge)."""
    def run(rows: pa.Table) -> pa.Table:
        ids, copies, side = (rows.column(c).to_numpy() for c in ("id", "copies", "side"))
        sets = shingle_sets(text_bytes(rows.column("text").combine_chunks()))
        if len(np.unique(ids)) < len(ids):  # repeated rows of an id: the one that stands for it
            order = sorted(range(len(ids)), key=lambda i: (ids[i], set_digest(sets[i])))
            first = [i for k, i in enumerate(order) if k == 0 or ids[order[k - 1]] != ids[i]]
            ids, copies, side, sets = ids[first], copies[first], side[first], [sets[i] for i in first]
        links, edges = compare(ids, copies, sets, side, threshold)
        none = [None] * len(edges)
        return pa.table({
            "id": pa.array([*ids.tolist(), *[a for a, _ in edges]], pa.int64()),
            "links": pa.array([*links.tolist(), *none], pa.int64()),
            "other": pa.array([*[None] * len(ids), *[b for _, b in edges]], pa.int64())})

    return run
