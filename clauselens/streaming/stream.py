"""The same jobs over a folder that keeps receiving contracts.

Extraction and scoring are row-local, so the batch plans run unchanged on a stream:
no state, no watermark, append output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clauselens.plans.extraction import extract_contracts
from clauselens.session import checkpoint_dir
from clauselens.sources.contracts import FILE_GLOB, with_contract_id


def contract_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """(contract_id, text) of every contract file as it arrives."""
    reader = spark.readStream.option("pathGlobFilter", FILE_GLOB).option("maxFilesPerTrigger", files_per_batch)
    return with_contract_id(reader.text(folder, wholetext=True))


def extract_stream(contracts: DataFrame) -> DataFrame:
    """Extraction records of a contract stream, from the text alone."""
    return extract_contracts(contracts)


def write_stream(records: DataFrame, path: str, name: str, available_now: bool = False) -> StreamingQuery:
    """Append records as JSON lines; progress is kept in the shared checkpoint folder."""
    writer = (
        records.writeStream.format("json")
        .option("ignoreNullFields", "false")
        .option("checkpointLocation", f"{checkpoint_dir(records.sparkSession)}/{name}")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
