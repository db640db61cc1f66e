"""Mixing sources to target weights by weighted fair queueing.

Every source has a queue of its documents in a shuffled order that a digest of the document decides.
Documents are served in packets of up to ``QUANTUM`` words.  A packet's virtual finish time is the number of its source's
words up to its end, divided by the source's target.  All packets are range-sorted by it, the ranges' sums give
running totals, and the mix is cut where they reach the total budget.  Past the end of its queue a source is served
again, up to ``most_passes`` times.

Targets: the budget (all words) is shared out by weight; no source gets more than ``most_passes``
times its words, and what it cannot use is shared out again by weight among the others.

Cases: a null text has no words and takes no time; a null source is a source of its own and comes
last; rows that agree in all of id, source and text are interchangeable, and each is served for
itself; without any word all targets are 0; an empty table gives an empty mix; new columns sit beside a struct
of the document, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clauselens.llm.common import stored, word_count

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
# words of a packet: a source is at most so many words behind its share, so that no long document displaces others
QUANTUM = 16
# a source's queue is summed in so many pieces, so that no task holds all of a large source
PIECES = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """The rows with ``target``, from (source, source_size): one row for each source.

    Sources are taken in the order of their limit for each unit of weight.  If the words left, shared
    by weight among the sources left, reach a source's limit, it gets its limit, and so do all before it.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    known = (
        sizes.withColumn("nth", F.row_number().over(in_order) - 1)
        .withColumn("weight", F.element_at(
            F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("limit", F.col("source_size") * most_passes)
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(onwards))
        .withColumn("full", F.col("left") * F.col("weight") >= F.col("limit") * F.col("weight_left"))
        # a source that is not full decides the level of all that are not
        .withColumn("level", F.min(F.when(
            ~F.col("full"), F.struct(F.col("limit") / F.col("weight"), "nth", "left", "weight_left"))).over(everything))
    )
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        F.col("weight") * F.col("level.left") / F.col("level.weight_left"))
    return known.select(*sizes.columns, target.alias("target"))


def shuffle_key(*columns: Column) -> Column:
    """Digest that orders a queue; equal rows have equal digests."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x1e")) for c in columns]))


def queues(
    docs: DataFrame, text: str, source: str, doc_id: str, keep: list[str] | None, weights: tuple[int, ...], most_passes: int, seed: int,
) -> tuple[DataFrame, DataFrame]:
    """(doc, id, queue, size, source_size, target, start): every document at its place in its source's queue; and the same
    without the documents, for the packets, from sizes that are counted once and stored.

    Sums of pieces and of documents within a piece replace one long running sum, so a source with a third of all rows
    is spread over ``PIECES`` groups, and the join brings each piece one row.  The documents are shuffled once.
    """
    key, name, words = F.col(f"`{doc_id}`"), F.col(f"`{source}`"), F.col(f"`{text}`")
    doc = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    queued = docs.select(
        doc.alias("doc"), key.alias("id"), word_count(words).alias("size"), shuffle_key(F.lit(seed), key).alias("key"),
        F.xxhash64(words).alias("tie"), F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("queue"),
    ).withColumn("piece", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    counted = stored(queued.drop("doc", "id"))
    pieces = counted.groupBy("queue", "piece").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("queue").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
    sizes = pieces.groupBy("queue").agg(F.sum("words").alias("source_size")).withColumn(
        "source", F.when(F.col("queue") != "", F.substring("queue", 2, 1 << 30)))
    targets = source_targets(sizes, weights, most_passes)
    placed = offsets.join(targets, "queue").select("queue", "piece", "offset", "source_size", "target")
    inside = Window.partitionBy("queue", "piece").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)

    def located(rows: DataFrame, *columns: str) -> DataFrame:
        joined = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(placed, ["queue", "piece"])
        return joined.select(*columns, "queue", "size", "source_size", "target", (F.col("offset") + F.col("inside")).alias("start"))

    return located(queued, "doc", "id"), located(counted)


def served_packets(placed: DataFrame, most_passes: int, budget_share: float) -> DataFrame:
    """(queue, start, pass, words): what is served of each document in each pass, by virtual finish time.

    While the budget lasts, every source is at most a packet behind its share, so packets that finish later than
    1 + sources * ``QUANTUM`` / budget cannot be reached and are not made; the range sort and the running totals
    decide about all others.
    """
    rows = stored(placed.where("size > 0 and target > 0"))
    sums = rows.groupBy("queue").agg(F.first("source_size").alias("words")).groupBy().agg(
        F.sum("words").alias("words"), F.count("*").alias("queues"))
    known = sums.select((F.round(F.col("words") * budget_share)).cast("long").alias("budget"), (
        budget_share + F.col("queues") * QUANTUM / F.col("words") + 1e-9).alias("latest")).first()
    budget, latest = (known["budget"] or 0, known["latest"] or 0.0) if known else (0, 0.0)
    begin = F.col("pass") * F.col("source_size") + F.col("start")
    # the packets of a document in a pass that may still be reached
    reach = F.least(F.ceil(F.col("size") / QUANTUM), F.ceil((latest * F.col("target") - begin) / QUANTUM) + 1).cast("int")
    passes = rows.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most_passes - 1)))).withColumn("reach", reach).where("reach > 0")
    packets = passes.withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)))
    end = F.least((F.col("nth") + 1) * QUANTUM, F.col("size"))
    finish = ((begin + end) / F.col("target")).alias("finish")
    order = ["finish", "queue", "start", "pass", "nth"]
    sized = packets.select(finish, "queue", "start", "pass", "nth", (end - F.col("nth") * QUANTUM).cast("long").alias("words")).where(
        F.col("finish") <= latest)
    # stored, because the ranges that are summed must be those that are cut
    ranged = stored(sized.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(F.sum("words").alias("held")).withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0)))
    within = ranged.join(F.broadcast(totals), "range")  # a row for each partition
    whole = within.where(F.col("offset") + F.col("held") <= budget)
    running = F.sum("words").over(Window.partitionBy("range").orderBy(*order))
    last = within.where((F.col("offset") < budget) & (F.col("offset") + F.col("held") > budget)).withColumn("words", F.least(
        F.col("words"), F.greatest(F.lit(0), budget - (F.col("offset") + running - F.col("words")))).cast("long"))
    both = whole.unionByName(last).where("words > 0")
    return both.groupBy("queue", "start", "pass").agg(F.sum("words").alias("words"))


def serve(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES, seed: int = 0,
) -> DataFrame:
    """(doc, id, size, source_size, target, start_words, taken): doc holds the kept columns (default all).

    ``start_words`` is the place in the source's queue and ``taken`` the number of words that the mix takes, over all
    passes.
    """
    placed, sizes = queues(docs, text, source, doc_id, keep, weights, most_passes, seed)
    taken = served_packets(sizes, most_passes, 1.0).groupBy("queue", "start").agg(F.sum("words").alias("taken"))
    # documents without words share their place with the next one
    place = F.when(F.col("size") > 0, F.col("start"))
    joined = placed.withColumn("place", place).join(taken.withColumnRenamed("start", "place"), ["queue", "place"], "left")
    return joined.select(
        "doc", "id", "size", "source_size", "target", F.col("start").alias("start_words"), F.coalesce("taken", F.lit(0)).alias("taken"))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES, seed: int = 0, budget_share: float = 1.0,
) -> DataFrame:
    """The mixed stream: (doc, size, pass, virtual_finish, words), a row for every time a document is served.

    It is range-partitioned and sorted by the virtual finish time of the whole document, and holds ``budget_share`` of the
    budget; ``words`` says how much of the document is within it.
    """
    placed, sizes = queues(docs, text, source, doc_id, keep, weights, most_passes, seed)
    served = served_packets(sizes, most_passes, budget_share)
    joined = placed.where("size > 0").join(served, ["queue", "start"])
    finish = (F.col("pass") * F.col("source_size") + F.col("start") + F.col("size")) / F.col("target")
    stream = joined.select("doc", "id", "size", "pass", finish.alias("virtual_finish"), "words")
    return stream.repartitionByRange("virtual_finish", "id").sortWithinPartitions("virtual_finish", "id").drop("id")
