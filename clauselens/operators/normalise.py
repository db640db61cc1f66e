"""Normalising raw candidate text, with a count of what could not be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauselens.functions.parse import currency_code, law_category, parse_date, parse_number
from clauselens.operators.prepare import ID

READERS = {
    "date": parse_date,
    "number": lambda c: parse_number(c).cast("string"),
    "currency": currency_code,
}


def normalise(raw: DataFrame) -> DataFrame:
    """Add ``value`` to (contract_id, field, kind, raw); null where the text is rejected."""
    value = F.lit(None).cast("string")
    for name, reader in READERS.items():
        value = F.when(F.col("kind") == name, reader(F.col("raw"))).otherwise(value)
    return raw.select(ID, "field", "kind", "raw", value.alias("value"))


def reject_report(normalised: DataFrame) -> DataFrame:
    """Per field: rows read, rows rejected."""
    rejected = (F.col("raw").isNotNull() & F.col("value").isNull()).cast("int")
    return normalised.groupBy("field").agg(F.count("*").alias("rows"), F.sum(rejected).alias("rejected"))


def law_report(vectors: DataFrame) -> DataFrame:
    """Contracts per governing-law category."""
    category = law_category(F.col("governing_law")).alias("category")
    return vectors.groupBy(category).agg(F.count("*").alias("contracts"))
