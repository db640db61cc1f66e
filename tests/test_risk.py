import pytest
from pyspark.sql import functions as F

from clauselens.functions import vocab as V
from clauselens.operators import risk as K
from clauselens.sources import derived as D

NAMES = {"counterparty_leverage": "string", "ip_ownership_risk": "string", "confidentiality_scope": "string"}


def record(spark, kinds="int", **values):
    scores = {f: values.get(f) for f in (
        "termination_risk", "data_sensitivity", "payment_risk", "auto_renewal_risk", "liability_cap_adequacy", *NAMES)}
    signals = {k: v for k, v in values.items() if k.startswith("_det_")}
    types = {"bool": "boolean", "float": "double", "int": "int"}
    fields = [f"risk_vector_{f} {NAMES.get(f, kinds)}" for f in scores]
    fields += [f"`{k}` {types[type(v).__name__]}" for k, v in signals.items()]
    return spark.createDataFrame([(1, *scores.values(), *signals.values())], "contract_id int, " + ", ".join(fields))


def test_empty_record(spark):
    row = K.score_records(record(spark)).first()
    assert list(row.vector) == [.5, .5, .5, 0, .5, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0, 0, 1] + [0] * 10
    assert row.score == 0.38 and row.flags == []


def test_worst_record(spark):
    row = K.score_records(record(
        spark, termination_risk=5, data_sensitivity=5, payment_risk=5, auto_renewal_risk=5, liability_cap_adequacy=1,
        counterparty_leverage="SUPPLIER", ip_ownership_risk="CUSTOMER", confidentiality_scope="NONE",
        _det_indemnity_uncapped=True, _det_payment_due_days=90.0, _det_auto_renewal=True, _det_cap_present=False,
        _det_late_interest=False)).first()
    assert row.score == 0.97 and len(row.flags) == 12
    assert row.flags[-1].startswith("Composite risk score 0.97")


def test_scores_as_text(spark):
    row = K.score_records(record(spark, kinds="string", termination_risk="9", data_sensitivity="x", auto_renewal_risk="x")).first()
    assert list(row.vector)[:5] == [1.0, 0.5, 0.5, 0.5, 0.5] and row.flags == []


def test_labels_fold_in_the_vector_but_not_in_flags(spark):
    row = K.score_records(record(spark, counterparty_leverage=" supplier ")).first()
    assert row.vector[5] == 1.0 and row.flags == []


def test_vector_properties(spark, sf):
    rows = K.score_records(D.records(spark, sf)).collect()
    for r in rows:
        v = list(r.vector)
        assert len(v) == 28 == len(V.VECTOR_LABELS) and all(0 <= x <= 1 for x in v)
        assert sum(v[5:9]) == sum(v[9:13]) == sum(v[13:18]) == 1.0
        assert 0 <= r.score <= 0.97
        parts = {k: x for k, x in r.explanation.items() if not k.startswith("_")}
        assert abs(sum(parts.values()) - r.score) < 1e-4 and len(parts) == 13


def test_weights_per_row(spark):
    rows = record(spark, termination_risk=5).withColumn("w", F.create_map(F.lit("termination_risk"), F.lit(0.5)))
    vector = K.with_vector(rows)
    by_row = K.with_score(vector, K.weight_columns(F.col("w"))).first().score
    assert by_row == K.with_score(vector, {"termination_risk": 0.5}).first().score == pytest.approx(0.38 - 0.09 + 0.5)


def test_heavy_weights_clamp_the_score_only(spark):
    row = K.score_records(record(spark, termination_risk=5), {"termination_risk": 3.0}).first()
    assert row.score == 1.0 and row.explanation["_composite_score"] > 3


def claim(family, seq, confidence, **projection):
    return (1, seq, family, confidence, {k: str(v).lower() for k, v in projection.items()})


CLAIM = "contract_id long, seq int, clause_family string, family_confidence double, family_projection map<string,string>"


def test_last_claim_wins_entirely(spark):
    rows = spark.createDataFrame([
        claim("liability_cap", 1, 0.9, cap_amount=100, mutual_cap=True, carveout_fraud=True), claim("liability_cap", 2, 0.5, cap_currency="eur"),
        claim("governing_law", 1, 0.9, governing_law="French law")], CLAIM)
    row = K.assemble(rows).first()
    assert row.cap_present and row.cap_amount_raw is None and not row.cap_mutual and row.cap_carveout_count == 0
    assert row.confidence == {"cap": "MEDIUM", "governing_law": "HIGH"} and row.governing_law_category == "french"
    assert row.source_clauses == {"cap": "liability_cap"} and not row.liability_cap_absent


def test_contract_without_claims(spark):
    rows = spark.createDataFrame([claim("warranty", 1, 0.9)], CLAIM)
    both = spark.createDataFrame([(1,), (2,)], "contract_id long")
    got = {r.contract_id: r for r in K.assemble(rows, both).collect()}
    assert got[2].liability_cap_absent and got[2].confidence == {"cap": "ABSENT"} and got[2].source_clauses == {}
    features = K.similarity_vector(K.assemble(rows, both)).filter("contract_id = 2").first().features
    assert set(features) == set(K.SIMILARITY_KEYS)
    assert (features["cap_level"], features["notice_period_norm"], features["renewal_notice_norm"]) == (0.5, 0.5, 0.5)


@pytest.mark.parametrize("projection, value, level", [
    ({"cap_formula_fees_paid": True, "cap_formula_multiplier_value": 1.0}, None, 0.5),
    ({"cap_formula_fees_paid": True, "cap_formula_multiplier_value": 2.0}, None, 0.6667),
    ({"cap_amount": 500.0}, 1000.0, 0.3333),
    ({}, None, 0.5),
    ({"cap_amount": 500.0}, 0.0, 0.5),
])
def test_cap_level(spark, projection, value, level):
    rows = K.assemble(spark.createDataFrame([claim("liability_cap", 1, 0.9, **projection)], CLAIM))
    got = K.similarity_vector(rows, F.lit(value).cast("double")).first().features["cap_level"]
    assert round(got, 4) == level


def test_best_claim_prefers_confidence_then_order(spark):
    rows = spark.createDataFrame([
        claim("indemnity", 1, 0.8, indemnity_direction="a"), claim("indemnity", 2, 0.8, indemnity_direction="b"),
        claim("auto_renewal", 1, 0.2, auto_renewal=True, nonrenewal_notice_normalized_days=0, nonrenewal_notice_value=3)], CLAIM)
    row = K.enrich(spark.createDataFrame([(1,)], "contract_id long"), rows).first()
    assert row["_det_indemnity_direction"] == "a" and row["_det_nonrenewal_notice_days"] == 3.0
    assert row["_det_cap_present"] is False and row["_det_carveout_count"] == 0


def test_two_decimals_like_print(spark):
    scores = [k / 10000 for k in range(6500, 9999, 5)]
    frame = spark.createDataFrame([(s,) for s in scores], "score double")
    got = [r[0] for r in frame.select(K._two_decimals(F.col("score"))).collect()]
    assert got == [f"{s:.2f}" for s in scores]
