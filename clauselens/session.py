"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a few bytes of an order become a text that takes long to read: partitions are not joined to large ones, or a
    # cluster gets one task for each core, and waits for the longest
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # the JVM never compiles methods beyond 8000 bytes of bytecode; split them instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # plain JVM lower-casing has a fast path for ASCII text
    "spark.sql.icu.caseMappings.enabled": "false",
    # call sites are not recorded for every column, which makes large plans slow to write down
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # many folders are listed by some tasks, not by one task for each
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # a repeated key in a model answer keeps its last value instead of rejecting the answer
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that can change at run time to an existing session, for good.

    Answers are parsed by these settings: in a session without them a repeated key rejects an answer.
    """
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", name: str = "clauselens") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        # small files are split over all cores; a large table has more splits anyway
        .config("spark.sql.files.minPartitionNum", "8")
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by their keys to as many tasks as the cluster has use for, for work that is large for each row.

    Adaptive execution joins partitions by their bytes, and a file is read by row groups; so rows of a few bytes each
    would all be worked on by a handful of tasks.  A count that is given is kept.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *keys)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; without one a stream could not survive its driver."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate results: as :func:`checkpoint_dir`; an own one only where none is named and all
    tasks run on this machine anyway."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            return checkpoint_dir(spark)
        folder = tempfile.mkdtemp(prefix="clauselens-shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared folder once and read from there, also by later plans."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
