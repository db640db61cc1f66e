"""Source divergence: how far the word use of a language's sources lies apart, on run-length columns.

Every (language, source) group has a column of counts, one cell for each kept term of the language.  The
vocabulary is reordered so that terms with the same counts in all groups stand together, then terms with the
same counts in the first groups; so each column becomes runs of equal counts.  A pair of groups is
compared by the intersection of its run boundaries: f of the two shares, times the length of the
run.  The columns are cut into chunks of a bounded number of terms; every chunk of every block of
``BLOCK`` groups is a task's work, and the sums of the chunks are added up.

Shares are whole numbers, p = 1 + floor(10**9 * (count + 2) / (N + 2 V)), and f = floor((p - q)**2 / (p + q)),
so all arithmetic is exact.  The result itself has all pairs of the sources of a language; nothing else
grows with the square of anything.

Cases: a null text, language or source is the empty text; repeated rows are documents of their own; equal
values are ranked by name; a language without kept terms has pairs with the value 0; an empty table has no
groups; columns besides the three named ones are not read, so none can clash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clauselens.llm.common import stored, text_bytes

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 10**9
# different terms that a task counts before it hands its counts on
HELD_TERMS = 200_000
# clusters of terms in a chunk, and groups in a block of first sides
CHUNK, BLOCK = 8192, 64
# letters and all characters beyond ASCII stay, in lower case where they are from A to Z; the rest parts terms
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences and documents of each term; one row without a term for each group.

    Tasks add up what they have read before anything is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences: dict[tuple[str, str], Counter] = defaultdict(Counter)
        holders: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def handed_on() -> pa.RecordBatch:
            rows = [(lang_, source_, None, 0, 0) for lang_, source_ in occurrences]
            for (lang_, source_), found in occurrences.items():
                docs_with = holders[lang_, source_]
                rows.extend((lang_, source_, term.decode(), n, docs_with[term]) for term, n in found.items())
            occurrences.clear()
            holders.clear()
            names, types = ["lang", "source", "term", "n", "n_docs"], [pa.string()] * 3 + [pa.int64()] * 2
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=names)

        for batch in batches:
            groups = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            for group, data in zip(groups, text_bytes(batch.column(0))):
                terms = data.translate(LETTERS).split()
                occurrences[group].update(terms)
                holders[group].update(set(terms))
            if sum(map(len, occurrences.values())) > HELD_TERMS:
                yield handed_on()
        yield handed_on()

    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(f"c{i}") for i, c in enumerate([text, lang, source])]
    counted = docs.select(*cells).mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """The share in billionths, smoothed, rounded down; exact for any counts."""
    numerator = ((n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)")
    return F.when(total + 2 * kept > 0, 1 + F.call_function("div", numerator, (total + 2 * kept).cast("decimal(38,0)")))


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """:func:`share` of an array of counts, computed once for each different count."""
    different, back = np.unique(n, return_inverse=True)
    return np.array([1 + SCALE * (int(x) + 2) // (total + 2 * kept) for x in different], dtype=np.int64)[back]


def runs(places: np.ndarray, values: np.ndarray, rest: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Run-length column of ``size`` cells: (begin, value) of runs, from the cells that differ from ``rest``."""
    begin = np.unique(np.concatenate([[0], places, places + 1]))
    begin = begin[begin < size]
    held = np.full(len(begin), rest, dtype=np.int64)
    held[np.searchsorted(begin, places)] = values
    new = np.concatenate([[True], held[1:] != held[:-1]]) if size else np.zeros(0, dtype=bool)
    return begin[new], held[new]


def compared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], before: np.ndarray) -> int:
    """Sum of f over two columns, run by run; ``before[i]`` is the number of terms in front of cell i."""
    both = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], both, side="right") - 1]
    q = b[1][np.searchsorted(b[0], both, side="right") - 1]
    length = np.diff(before[np.append(both, len(before) - 1)])
    return int(((p - q) * (p - q) // (p + q) * length).sum())


def chunk_sums(key: tuple, clusters: pa.Table, groups: pa.Table) -> pa.Table:
    """(lang, source, item, value) of the pairs whose first side lies in a block, over one chunk of terms."""
    lang, _, block = (k.as_py() for k in key)
    size = clusters.num_rows
    before = np.concatenate([[0], np.cumsum(clusters.column("length").to_numpy())]) if size else np.zeros(1, dtype=np.int64)
    profile = clusters.column("profile").combine_chunks()
    cells = profile.flatten() if size else None
    rows = np.repeat(np.arange(size), profile.value_lengths().to_numpy(zero_copy_only=False)) if size else None
    known = sorted(zip(*(groups.column(c).to_pylist() for c in ("source", "number", "total", "kept"))))
    columns = {}
    if size:
        names = {name: i for i, (name, *_) in enumerate(known)}
        owner = np.array([names[s] for s in cells.field(0).to_pylist()])
        n = cells.field(1).to_numpy(zero_copy_only=False)
        order = np.lexsort([rows, owner])
        edges = np.searchsorted(owner[order], np.arange(len(known) + 1))
        for i, (name, _, total, kept) in enumerate(known):
            mine = order[edges[i]:edges[i + 1]]
            none = 1 + SCALE * 2 // (total + 2 * kept)
            columns[name] = runs(rows[mine], shares(n[mine], total, kept) if len(mine) else n[mine], none, size)
    out = [(lang, a, b, compared(columns[a], columns[b], before) if size else 0)
           for a, number, *_ in known if number // BLOCK == block for b, other, *_ in known if other > number]
    types = [pa.string()] * 3 + [pa.int64()]
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, types)], names=["lang", "source", "item", "value"])


def pair_sums(vocabulary: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language, once."""
    clusters = stored(vocabulary.groupBy("lang", "profile").agg(F.count("*").alias("length")))
    chunks = max(1, -(-clusters.count() // CHUNK))
    # in order of language and profile: equal counts stand together, in the first groups above all
    ordered = clusters.repartitionByRange(chunks, "lang", "profile").sortWithinPartitions("lang", "profile")
    ordered = ordered.withColumn("chunk", F.spark_partition_id())
    last = groups.groupBy("lang").agg(F.floor(F.max("number") / BLOCK).cast("int").alias("last"))
    blocks = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("block")
    work = stored(ordered)
    left = work.join(last, "lang").select("lang", "chunk", blocks, "profile", "length")
    # a chunk without terms gives every pair its row, also in languages without kept terms
    every = work.select("lang", "chunk").distinct().unionByName(last.select("lang", F.lit(-1).alias("chunk")))
    right = every.join(last, "lang").select("lang", "chunk", blocks).join(groups, "lang")
    keys = ["lang", "chunk", "block"]
    right = right.toDF(*right.columns)  # new column ids: both sides come from the same table
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        chunk_sums, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    rows = rows.withColumn("rank", place)
    return rows if most is None else rows.where(F.col("rank") <= most)


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of a language by its divergence (``pair``), and
    the terms that a source uses above all (``term``)."""
    counts = stored(count_terms(docs, text, lang, source))
    profile = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("profile")
    vocabulary = stored(counts.where("term is not null").groupBy("lang", "term").agg(
        profile, F.sum("n").alias("n_lang"), F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= min_docs).drop("n_docs"))
    cells = vocabulary.select("lang", "term", "n_lang", F.explode("profile").alias("x")).select("lang", "term", "n_lang", "x.*")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = vocabulary.groupBy("lang").agg(F.sum("n_lang").alias("lang_total"), F.count("*").alias("kept"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    number = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    groups = stored(groups.fillna(0, ["total", "lang_total", "kept"]).withColumn("number", number))

    sums = pair_sums(vocabulary, groups)
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = sums.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("n_lang"), F.col("lang_total"), F.col("kept"))
    used = cells.where("n > 0").join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q"))
    terms = used.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    return ranked(pairs).unionByName(ranked(terms, top))
