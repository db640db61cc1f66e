"""Quality classifier: random-indexing vectors, pooled per document, and a two-layer network.

Every word gives two tokens: its letters in lower case, and its shape (case, symbol signs, length,
whether it repeats the word before).  Tokens are numbered by hash, so the vocabulary has a fixed number
of slots.  Each slot has a sparse random index vector; its context vector is the sum of the index vectors
of its neighbours over all documents.  A document is the mean of its tokens' vectors, and a
network of two layers, trained here with a temperature fitted on rows set aside, turns it into a probability.

The network is fitted on at most ``MOST_LABELS`` labelled rows, chosen by a digest of their id; context
vectors are counted over all documents, and all are scored.

Cases: a null or empty text is scored as an average document; without labelled rows of both
classes every score is the share of label 1, or 0.5 without any row; repeated rows of the labels count
once each, null labels and ids not at all; new columns sit beside a struct of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauselens.llm.common import BYTE_CODES, in_chunks, mix64, text_bytes, text_column, with_text, word_hashes, word_spans

MOST_LABELS = 20_000
SLOTS = 1 << 14
SHAPES = 1 << 9  # the first slots belong to shapes
DIM = 48
NONZERO = 4
HIDDEN = 24
PRIOR_WORDS = 25
CHUNK_BYTES = 1_000_000
SEED = 20_240

_BYTE = np.arange(256)
SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
UPPER = (_BYTE >= 65) & (_BYTE <= 90)
LETTER = UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
SYMBOL = np.isin(_BYTE, list(b"#*$%&|<>{}[]\\^~=+_@/"))
STOP = np.isin(_BYTE, list(b".,;:?!\"'()-"))
LOWERED = np.where(UPPER, _BYTE + 32, _BYTE)
# only letters count, whatever their case
LETTER_CODES = np.where(LETTER, BYTE_CODES[LOWERED], np.uint64(0))


def index_vectors() -> np.ndarray:
    """Sparse random vectors of all slots: a few places with 1 or -1."""
    rng = np.random.default_rng(SEED)
    vectors = np.zeros((SLOTS, DIM), dtype=np.float32)
    places = rng.integers(0, DIM, (SLOTS, NONZERO))
    signs = rng.choice(np.array([-1.0, 1.0], dtype=np.float32), (SLOTS, NONZERO))
    np.add.at(vectors, (np.arange(SLOTS)[:, None], places), signs)
    return vectors


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters slot, shape slot, document) of every word of some texts."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    solid = ~SPACE[data]
    begin, end = word_spans(data, solid)
    none = np.zeros(0, dtype=np.int64)
    if not len(begin):
        return none, none, none
    ends = np.cumsum([len(t) + 1 for t in texts])
    document = np.searchsorted(ends, begin, side="right")

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[data])])
        return total[end] - total[begin]

    letters, upper, symbols, stops = map(within, (LETTER, UPPER, SYMBOL, STOP))
    letter_hash = word_hashes(data, solid, begin, end, LETTER_CODES)
    same = np.zeros(len(begin), dtype=np.int64)
    same[1:] = (letter_hash[1:] == letter_hash[:-1]) & (document[1:] == document[:-1])
    length = end - begin
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, 2))
    shape = case + 3 * (
        np.minimum(symbols, 2) + 3 * (
            np.minimum(stops, 2) + 3 * (
                same + 2 * (np.minimum(length // 8, 2) + 3 * (letters == 0)))))
    slot = SHAPES + (mix64(letter_hash) % np.uint64(SLOTS - SHAPES)).astype(np.int64)
    return slot, shape.astype(np.int64) % SHAPES, document


def count_contexts(texts: list[bytes], index: np.ndarray, sums: np.ndarray) -> None:
    """Add the index vectors of every token's neighbours to its context."""
    word, shape, document = tokens(texts)
    if not len(word):
        return
    near = document[1:] == document[:-1]
    a, b = word[:-1][near], word[1:][near]
    for token, neighbour in ((a, b), (b, a), (word, shape), (shape, word), (shape[:-1][near], shape[1:][near])):
        # neighbours of one kind of token, counted as pairs first
        pairs, times = np.unique(token * SLOTS + neighbour, return_counts=True)
        token, neighbour = pairs // SLOTS, pairs % SLOTS
        for column in range(DIM):
            sums[:, column] += np.bincount(token, index[neighbour, column] * times, SLOTS)


def token_vectors(docs: DataFrame, text: str) -> np.ndarray:
    """Vectors of all slots, counted over all documents.

    Every task sends its sums of at most ``SLOTS`` slots, and Spark adds them up by slot.  They are whole numbers, so
    the order does not matter.
    """
    index = docs.sparkSession.sparkContext.broadcast(index_vectors())
    columns = [f"c{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((SLOTS, DIM), dtype=np.float64)
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for lo, hi in in_chunks(texts, CHUNK_BYTES):
                count_contexts(texts[lo:hi], index.value, sums)
        used = np.flatnonzero(np.abs(sums).sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *[pa.array(c.astype(np.int64)) for c in sums[used].T]],
            names=["slot", *columns])

    partial = docs.select(F.col(f"`{text}`")).mapInArrow(run, "slot int, " + ", ".join(f"{c} long" for c in columns))
    table = partial.groupBy("slot").agg(*[F.sum(c).cast("double").alias(c) for c in columns]).collect()
    contexts = np.zeros((SLOTS, DIM), dtype=np.float64)
    for r in table:  # at most SLOTS rows
        contexts[r[0]] = r[1:]
    length = np.linalg.norm(contexts, axis=1, keepdims=True)
    own = index.value / np.sqrt(NONZERO)
    return (own + 0.5 * contexts / np.maximum(length, 1e-9)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(means of the vectors of letters and of shapes side by side, number of words) of each text."""
    out = np.zeros((len(texts), 2 * DIM))
    words = np.zeros(len(texts), dtype=np.int64)
    for lo, hi in in_chunks(texts, CHUNK_BYTES):
        word, shape, document = tokens(texts[lo:hi])
        if not len(word):
            continue
        present, first, number = np.unique(document, return_index=True, return_counts=True)
        words[lo + present] = number
        for part, slots in ((0, word), (1, shape)):
            sums = np.add.reduceat(vectors[slots], first)
            out[lo + present, part * DIM:(part + 1) * DIM] = sums / number[:, None]
    return out, words


def shrunk(means: np.ndarray, words: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """A few words say little: they count against ``PRIOR_WORDS`` average ones."""
    share = (words / (words + PRIOR_WORDS))[:, None]
    return means * share + prior * (1 - share)


@dataclass
class Network:
    """Standardised inputs, one hidden layer, one output; the temperature divides the output."""

    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.02, decay: float = 1e-4) -> Network:
    """Adam on all rows at once, classes weighted equally; every fifth row is set aside for the temperature."""
    x = x.astype(np.float64)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        zero = np.zeros((x.shape[1], 1))
        return Network(zero[:, 0], zero[:, 0] + 1, zero, np.zeros(1), np.zeros(1),
                       float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    aside = np.arange(len(y)) % 5 == 4
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside[:] = False
    rng = np.random.default_rng(SEED)
    centre, spread = x[~aside].mean(0), x[~aside].std(0) + 1e-3
    net = Network(centre, spread, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0)
    inputs, target = (x[~aside] - centre) / spread, y[~aside].astype(np.float64)
    weight = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean())) / len(target)
    parameters = [net.w1, net.b1, net.w2, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    for step in range(1, steps + 1):
        hidden = np.tanh(inputs @ parameters[0] + parameters[1])
        error = (sigmoid(hidden @ parameters[2] + parameters[3]) - target) * weight
        back = np.outer(error, parameters[2]) * (1 - hidden ** 2)
        gradients = [inputs.T @ back + decay * parameters[0], back.sum(0), hidden.T @ error + decay * parameters[2],
                     np.array([error.sum()])]
        for p, g, (m, v) in zip(parameters, gradients, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net = Network(centre, spread, parameters[0], parameters[1], parameters[2], float(parameters[3][0]))
    check = aside if aside.any() else np.ones(len(y), dtype=bool)
    logit, truth = net.logit(x[check]), y[check]

    def loss(t: float) -> float:
        p = np.clip(sigmoid(logit / t), 1e-9, 1 - 1e-9)
        return float(-(truth * np.log(p) + (1 - truth) * np.log(1 - p)).mean())

    net.temperature = min((float(t) for t in np.geomspace(0.5, 8.0, 41)), key=loss)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id",
    most: int = MOST_LABELS,
) -> tuple[np.ndarray, np.ndarray, Network]:
    """Token vectors, average document and the network.  Only the ``most`` sampled labels are broadcast and brought to the driver.

    Of the documents with one id the text with the smallest digest is learnt from, so neither repeated rows nor their order
    matter.
    """
    vectors = token_vectors(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    ids = F.col(f"`{doc_id}`")
    known = labels.select(ids.alias("__id"), F.col(f"`{label}`").cast("int").alias("__y")).where(
        F.col("__id").isNotNull() & F.col("__y").isin(0, 1))
    sample = known.where(~held_out(F.col("__id"))).orderBy(F.xxhash64("__id"), "__id", "__y").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words = pooled(text_bytes(batch.column(2)), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words), pa.array(list(rows), pa.list_(pa.float64()))],
                names=["id", "y", "n", "x"])

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    chosen = docs.select(ids.alias("__id"), body.alias("__text")).join(F.broadcast(sample), "__id").groupBy("__id", "__y").agg(
        F.min_by("__text", F.md5("__text")).alias("__text"))
    rows = chosen.select(F.col("__id").cast("string"), "__y", "__text").mapInArrow(
        run, "id string, y int, n long, x array<double>").collect()  # at most one row for each sampled label
    rows.sort(key=lambda r: (r["id"], r["y"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), 2 * DIM)
    n = np.array([r["n"] for r in rows], dtype=np.int64)
    prior = n @ x / max(1, n.sum())
    return vectors, prior, train(shrunk(x, n, prior), np.array([r["y"] for r in rows], dtype=np.int64))


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id",
    keep: list[str] | None = None, most: int = MOST_LABELS,
) -> DataFrame:
    """(doc, score): doc holds the kept columns (default all); two passes over the documents, no shuffle of texts."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, text, doc_id, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, prior, network = model.value
        for batch in batches:
            scores = network.score(shrunk(*pooled(text_bytes(text_column(batch, text)), vectors), prior))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc", "score"])

    carried = with_text(docs, text, keep)
    return carried.mapInArrow(run, f"doc {carried.schema['doc'].dataType.simpleString()}, score double")
