"""Work that is large for each row is dealt to all tasks, and done once for each row."""

import pytest
from pyspark.sql import functions as F

from clauselens.operators import responses as S
from clauselens.operators import risk as K
from clauselens.operators import similar as M
from clauselens.session import configure
from clauselens.sources import derived as D


def tasks(frame):
    return frame.select(F.spark_partition_id().alias("p")).distinct().count()


def test_rejected_responses_are_judged_once(spark):
    rows = [(i, "m", "sector", t, 1.0) for i, t in enumerate(['{"regulated_sectors": []}', "none", None, "none"])]
    frame = S.reject_reasons(spark.createDataFrame(rows, "contract_id long, model string, call string, content string, elapsed_s double"))
    top = frame._jdf.queryExecution().optimizedPlan()
    assert [top.nodeName(), top.children().apply(0).nodeName()] == ["Filter", "Aggregate"]
    assert sorted(r.responses for r in frame.collect()) == [1, 2]


@pytest.mark.parametrize("rows", [D.classification_responses])
def test_rows_are_dealt_to_many_tasks(spark, sf, rows):
    assert tasks(rows(spark, sf)) >= 8


def test_orders_are_dealt_to_many_tasks(spark):
    """Their few bytes do not make few tasks of long texts."""
    contracts = D.contracts(configure(spark), "/root/testdata/sf0.1")
    assert tasks(contracts.where("length(text) > 0")) >= 6


def test_suppliers_are_dealt_to_many_tasks(spark, sf):
    assert tasks(D.supplier_contracts(spark, sf)) >= 4


def test_texts_are_found_without_a_second_judgement(spark, sf, monkeypatch):
    """The pass that brings the chosen texts back finds objects, but checks no answer again."""
    responses = D.classification_responses(spark, sf)
    judged, passes = S._recovered, []
    monkeypatch.setattr(S, "_recovered", lambda *given: passes.append(given) or judged(*given))
    S.merge_calls(responses.select("contract_id", "model").distinct(), responses, texts=True)
    assert len(passes) == 1


@pytest.mark.parametrize("content, raw", [
    ('{"a": 1} {', '{"a": 1}'), ('{"a": 1}{"b": 2}', '{"a": 1}'), ('{"b": {"c": 2}, "a": 5} }', '{"b": {"c": 2}, "a": 5}'),
    ('<THINK>}</Think> ```JSON {"a": {}}```', '{"a": {}}'), ("{}", "{}"), ('{"a": 1', None),
])
def test_raw_text_of_the_first_object(spark, content, raw):
    frame = spark.createDataFrame([(content,)], "c string").select(S.first_object(F.col("c")).alias("x"))
    assert frame.select("x.raw").first()[0] == raw


def test_vectors_are_computed_once(spark, sf):
    """No map is read key by key, and lengths are not computed again for each element or for a filter."""
    rows = K.similarity_array(K.assemble(D.claims(spark, sf))).select(
        F.col("contract_id").alias("id"), F.col("governing_law_category").alias("category"), "vector")
    plan = M.unit_vectors(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("SQRT("), plan.count("map_from_entries(")) == (1, 0)
