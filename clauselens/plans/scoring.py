"""From responses and claims to scored records, and reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauselens.operators.prepare import ID
from clauselens.operators.responses import merge_calls
from clauselens.operators.risk import Weights, enrich, score_records
from clauselens.sources.contracts import fan_out

SCORE_COLUMNS = ["vector", "score", "flags", "explanation"]


def classify(contracts: DataFrame, models: list[str], responses: DataFrame, texts: bool = True) -> DataFrame:
    """One merged classification record per contract and model, with the raw texts unless they are not wanted."""
    return merge_calls(fan_out(contracts.select(ID), models), responses, texts)


def score_contracts(records: DataFrame, claims: DataFrame | None = None, weights: Weights | None = None) -> DataFrame:
    """Records with clause signals (when claims are given), vector, score, flags, explanation."""
    return score_records(records if claims is None else enrich(records, claims), weights)


def model_consensus(records: DataFrame, field: str = "contract_type_primary") -> DataFrame:
    """Per contract: the most frequent value over models, its votes and the number of values.

    Values are counted per (contract, value) first, so no group grows with its rows.
    Ties go to the smaller value.
    """
    votes = records.filter(F.col(field).isNotNull()).groupBy(ID, field).agg(F.count("*").alias("votes"))
    return votes.groupBy(ID).agg(
        F.min(F.struct((-F.col("votes")).alias("rank"), F.col(field).alias("value"))).alias("top"),
        F.count("*").alias("distinct_values"),
    ).select(ID, F.col("top.value").alias("consensus"), (-F.col("top.rank")).alias("votes"), "distinct_values")


def jurisdiction_counts(records: DataFrame) -> DataFrame:
    """Records per country, court type and city."""
    keys = ["jurisdiction_country", "jurisdiction_court_type", "jurisdiction_city"]
    return records.groupBy(*keys).agg(F.count("*").alias("records"))
