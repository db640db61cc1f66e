"""Session settings, stored intermediate results and byte-level word tools shared by the operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# rows per Arrow batch: bounds what a Python worker holds, also with long texts
BATCH_ROWS = 256
# a word, as the contracts of most operators define it: a run without ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators of this package want in the session."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        # columns of long texts: a reader's vectors hold so many rows at once
        "spark.sql.parquet.columnarReaderBatchSize": str(BATCH_ROWS),
    }.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; an own one only in local mode, where all tasks share the machine."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="clauselens-shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared checkpoint folder and read from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null has none.  Every word becomes one letter, so no array of words is made."""
    marks = F.regexp_replace(F.regexp_replace(text, r"^[\x20\x09-\x0D]++", ""), r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "w")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


# hash slots of a preselection: the proven bound of its broadcast
FILTER_SLOTS = 1 << 20


def slot_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_SLOTS)).cast("int")


def preselected(rows: DataFrame, key: Column, wanted: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key may be among the wanted keys (one column), or, with left_anti, those whose key is not.

    Keys are compared by hash slot, so at most ``FILTER_SLOTS`` small rows are broadcast whatever the size
    of either side.  An exact join has to follow for the rows that may be among them.
    """
    slots = F.broadcast(wanted.select(slot_of(F.col(f"`{wanted.columns[0]}`")).alias("__slot")).distinct())
    return rows.withColumn("__slot", slot_of(key)).join(slots, "__slot", how).drop("__slot")


def with_text(docs: DataFrame, text: str, keep: list[str] | None) -> DataFrame:
    """(doc[, text]): the kept columns (default all) as one struct, so that no result column can clash with
    them; the text stands beside it only if it is not kept."""
    kept = docs.columns if keep is None else keep
    beside = [] if text in kept else [F.col(f"`{text}`").alias("text")]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), *beside)


def text_column(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The texts of a batch of ``with_text``."""
    return batch.column(1) if batch.num_columns > 1 else batch.column(0).field(text)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    filled = column.cast(pa.large_binary())
    return [v or b"" for v in filled.to_pylist()]


def in_chunks(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` bytes together; a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix64(np.arange(256))
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of bytes for which ``inside`` holds."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, inside: np.ndarray, begin: np.ndarray, end: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A polynomial hash of the bytes of each word, from its end; bytes with code 0 are skipped."""
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        worth = codes[data]
        counted = np.concatenate([[0], np.cumsum(worth != 0)])
        place = np.repeat(counted[end], end - begin) - counted[1:][inside]
        powers = np.multiply.accumulate(np.full(int(place.max()) + 2, FACTOR, dtype=np.uint64))
        worth = worth[inside] * powers[np.maximum(place, 0)]
        return np.add.reduceat(worth, np.concatenate([[0], np.cumsum(end - begin)[:-1]]))
