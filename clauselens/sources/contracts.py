"""Reading contracts and saved records, writing records and extractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILE_GLOB = "*.{md,txt}"


def with_contract_id(files: DataFrame) -> DataFrame:
    """(contract_id, text): file name without its suffix, dashes as underscores."""
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return files.select(F.replace(stem, F.lit("-"), F.lit("_")).alias("contract_id"), F.col("value").alias("text"))


def read_contract(spark: SparkSession, path: str) -> DataFrame:
    """One file as a contract; fails when the file does not exist."""
    return with_contract_id(spark.read.text(path, wholetext=True))


def read_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """All ``.md`` and ``.txt`` files directly inside a folder, one row each."""
    return with_contract_id(spark.read.option("pathGlobFilter", FILE_GLOB).text(folder, wholetext=True))


def write_contracts(contracts: DataFrame, folder: str) -> None:
    """Texts as files, one folder named after each contract's file; a contract that is written again replaces its own."""
    name = F.concat(F.replace("contract_id", F.lit("_"), F.lit("-")), F.lit(".txt"))
    contracts.select(name.alias("file"), F.col("text").alias("value")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("file").text(folder)


def read_contract_store(spark: SparkSession, folder: str) -> DataFrame:
    """(contract_id, text) of the files of :func:`write_contracts`, without the final line end."""
    files = spark.read.schema("value string, file string").text(folder, wholetext=True)
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    return files.select(
        F.replace(stem, F.lit("-"), F.lit("_")).alias("contract_id"), F.regexp_replace("value", r"\n\z", "").alias("text"))


def fan_out(contracts: DataFrame, models: list[str]) -> DataFrame:
    """One row per contract and model."""
    return contracts.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def _write_lines(rows: DataFrame, path: str, mode: str, partition: str | None) -> None:
    writer = rows.write.mode(mode).option("ignoreNullFields", "false")
    if partition is not None:
        # with overwriting, only the partitions at hand are replaced, so a job that runs again leaves no second copy
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.json(path)


def write_records(records: DataFrame, path: str, mode: str = "errorifexists", partition: str | None = None) -> None:
    """Classification records as JSON lines, nulls kept; ``partition`` names a column to lay them out by."""
    _write_lines(records, path, mode, partition)


def write_extractions(extractions: DataFrame, path: str, mode: str = "errorifexists", partition: str | None = None) -> None:
    """Extraction results as JSON lines, nulls kept; ``partition`` as in :func:`write_records`."""
    _write_lines(extractions, path, mode, partition)


def read_records(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """Saved records with a fixed schema; ``multi_line`` reads indented JSON arrays."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
