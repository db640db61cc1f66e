"""A corpus pipeline of five stages over a table of documents.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns them as the
next one's documents; ``run`` writes every result to the shared checkpoint folder as Parquet and
reads it again.  All stages but the last return the columns of the documents.

Cases: null and empty texts, repeated rows, ties, empty tables and extra columns are treated as the
operators' docstrings say; rows without an id pass the near-duplicate stage, since they have no class.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from clauselens.llm import decontaminate, minhash_join, mixing, quality_classifier, sharding
from clauselens.llm.common import prepare, preselected, shared_dir, stored, table
from clauselens.llm.queries import SHARD_NAMES

# every stage calls operators that SQL cannot express; tests compare with brute-force versions
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, does not reject."""
    scored = quality_classifier.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("score >= 0.5").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id.

    Of the rows of one id the one with the smallest text digest stays, and of these the first by its other columns.
    Documents that neither go nor share their id are not shuffled.
    """
    ids = docs.where("doc_id is not null").select("doc_id")
    gone = stored(minhash_join.near_duplicates(docs).where("doc_id != class_id").select("doc_id").distinct())
    doubtful = gone.unionByName(ids.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    plain = [F.col(f"`{f.name}`").cast("string") for f in docs.schema if isinstance(f.dataType, AtomicType)]
    order = F.struct(F.md5(F.coalesce("text", F.lit(""))).alias("digest"), *[c.alias(f"c{i}") for i, c in enumerate(plain)])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = preselected(docs, F.col("doc_id"), doubtful).join(gone, "doc_id", "left_anti").groupBy("doc_id").agg(
        F.min_by(row, order).alias("row")).select("row.*")
    clear = preselected(docs.where("doc_id is not null"), F.col("doc_id"), doubtful, "left_anti")
    return clear.unionByName(rest.where("doc_id is not null")).unionByName(docs.where("doc_id is null")).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in windows of benchmark items."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated(F.col("n_words"), F.col("n_hit"))).select("doc.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed stream: a document as often as the mix serves it.

    A document that is in service at the cut stays if most of it has been served.
    """
    return mixing.mix(docs).where("2 * words > size").select("doc.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its slot and shard, which replace columns of these names."""
    placed = sharding.place(docs, "doc_id", SHARD_NAMES)
    return placed.select(*[f"doc.`{c}`" for c in docs.columns if c not in ("slot", "shard")], "slot", "shard")


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("source mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    prepare(spark)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
