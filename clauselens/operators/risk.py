"""Risk: claims to vectors, records to 28 numbers, a score, flags and an explanation."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NumericType, StringType

from clauselens.functions import vocab as V
from clauselens.functions.parse import law_category, round_exact, round_exact_ref
from clauselens.functions.text import strip
from clauselens.operators.prepare import ID

# vector column -> (clause family, projection key, type); the fixed layout of the wide vector
VECTOR_FIELDS = {
    "cap_amount_raw": ("liability_cap", "cap_amount", "double"),
    "cap_currency": ("liability_cap", "cap_currency", "string"),
    "cap_is_fees_multiple": ("liability_cap", "cap_formula_fees_paid", "boolean"),
    "cap_multiplier": ("liability_cap", "cap_formula_multiplier_value", "double"),
    "cap_mutual": ("liability_cap", "mutual_cap", "boolean"),
    "cap_carveout_fraud": ("liability_cap", "carveout_fraud", "boolean"),
    "cap_carveout_gross_negligence": ("liability_cap", "carveout_gross_negligence", "boolean"),
    "cap_carveout_wilful_misconduct": ("liability_cap", "carveout_wilful_misconduct", "boolean"),
    "consequential_loss_excluded": ("liability_cap", "excludes_indirect_damages", "boolean"),
    "termination_for_convenience": ("termination_notice", "termination_for_convenience", "boolean"),
    "convenience_notice_days": ("termination_notice", "notice_period_normalized_days", "double"),
    "termination_for_breach": ("termination_notice", "termination_for_breach", "boolean"),
    "cure_period_days": ("termination_notice", "cure_period_normalized_days", "double"),
    "insolvency_trigger": ("termination_notice", "insolvency_trigger", "boolean"),
    "payment_days": ("payment_terms", "payment_due_normalized_days", "double"),
    "late_interest": ("payment_terms", "late_interest", "boolean"),
    "ip_ownership_assigned": ("ip_licence", "ip_ownership_assigned", "boolean"),
    "ip_licence_exclusive": ("ip_licence", "exclusive", "boolean"),
    "ip_sublicence_permitted": ("ip_licence", "sublicence_permitted", "boolean"),
    "ip_perpetual": ("ip_licence", "perpetual_licence", "boolean"),
    "auto_renewal": ("auto_renewal", "auto_renewal", "boolean"),
    "renewal_term_months": ("auto_renewal", "renewal_term_normalized_months", "double"),
    "non_renewal_notice_days": ("auto_renewal", "nonrenewal_notice_normalized_days", "double"),
    "fr_mandatory_notice_risk": ("auto_renewal", "fr_mandatory_notice_risk", "boolean"),
    "dpa_present": ("data_retention", "dpa_present", "boolean"),
    "cross_border_transfer": ("data_retention", "cross_border_transfer_mentioned", "boolean"),
    "retention_period_days": ("data_retention", "retention_period_normalized_days", "double"),
    "dispute_mechanism": ("dispute_resolution", "dispute_resolution_type", "string"),
    "arbitration_institution": ("dispute_resolution", "arbitration_institution", "string"),
    "governing_law": ("governing_law", "governing_law", "string"),
    "agreement_term_months": ("agreement_term", "initial_term_normalized_months", "double"),
    "indefinite_term": ("agreement_term", "indefinite_term", "boolean"),
    "warranty_given": ("warranty", "warranty_given", "boolean"),
    "as_is_disclaimer": ("warranty", "disclaimer_present", "boolean"),
    "warranty_period_days": ("warranty", "warranty_period_normalized_days", "double"),
}
CONFIDENCE_KEYS = {
    "liability_cap": "cap", "termination_notice": "termination", "payment_terms": "payment", "ip_licence": "ip",
    "auto_renewal": "auto_renewal", "data_retention": "data", "dispute_resolution": "dispute",
    "governing_law": "governing_law", "agreement_term": "term", "warranty": "warranty",
}
LATER_DIMENSIONS = {  # filled by no rule here; they stay empty
    "cap_risk_score": "double", "indemnity_risk_score": "double", "ip_risk_score": "double",
    "overall_balance_score": "double", "indemnity_uncapped_risk": "boolean", "ai_training_permitted": "boolean",
    "broad_audit_rights": "boolean",
}
# clause signals on records: column -> (family, key, type)
SIGNALS = {
    "_det_cap_present": ("liability_cap", "cap_present", "boolean"),
    "_det_cap_amount": ("liability_cap", "cap_amount", "double"),
    "_det_cap_currency": ("liability_cap", "cap_currency", "string"),
    "_det_cap_multiplier": ("liability_cap", "cap_formula_multiplier_value", "double"),
    "_det_mutual_cap": ("liability_cap", "mutual_cap", "boolean"),
    "_det_carveout_count": ("liability_cap", "carveout_count", "int"),
    "_det_indemnity_uncapped": ("indemnity", "indemnity_uncapped", "boolean"),
    "_det_mutual_indemnity": ("indemnity", "mutual_indemnity", "boolean"),
    "_det_indemnity_direction": ("indemnity", "indemnity_direction", "string"),
    "_det_payment_due_days": ("payment_terms", "payment_due_normalized_days", "double"),
    "_det_late_interest": ("payment_terms", "late_interest", "boolean"),
    "_det_invoice_trigger": ("payment_terms", "invoice_trigger", "boolean"),
    "_det_auto_renewal": ("auto_renewal", "auto_renewal", "boolean"),
    "_det_nonrenewal_notice_days": ("auto_renewal", "nonrenewal_notice_normalized_days", "double"),
}


def _key(claims: DataFrame, key: str, kind: str) -> Column:
    """A projection value, null when the projection has no such key."""
    schema = claims.schema["family_projection"].dataType
    if not isinstance(schema, MapType) and key not in schema.names:
        return F.lit(None).cast(kind)
    return F.col("family_projection")[key].cast(kind)


def _chosen(claims: DataFrame, fields: dict, choose: Callable, order: Column, extra: Column) -> list[Column]:
    """Per family, the projection of the claim ``choose`` picks by ``order``, as one aggregate.

    Claims of other families have a null order, which the aggregate ignores.
    """
    families = dict.fromkeys(family for family, _, _ in fields.values())
    aggregates = []
    for family in families:
        parts = {k: _key(claims, k, t).alias(k) for f, k, t in fields.values() if f == family}
        parts["_extra"] = extra.alias("_extra")
        mine = F.col("clause_family") == family
        aggregates.append(choose(F.struct(*parts.values()), F.when(mine, order)).alias(family))
    return aggregates


def assemble(claims: DataFrame, contracts: DataFrame | None = None) -> DataFrame:
    """One wide risk vector per contract; the last claim of a family sets all its fields.

    ``claims`` has (contract_id, seq, clause_family, family_confidence, family_projection);
    ``seq`` may be of any type that orders the claims of a contract.  Pass ``contracts`` to get a row for
    contracts without any claim.
    """
    high = F.when(F.col("family_confidence") > 0.7, "HIGH").otherwise("MEDIUM")
    last = claims.groupBy(ID).agg(*_chosen(claims, VECTOR_FIELDS, F.max_by, F.col("seq"), high))
    if contracts is not None:
        last = contracts.select(ID).join(last, ID, "left")
    flag = {n for n, (_, _, kind) in VECTOR_FIELDS.items() if kind == "boolean"}
    columns = {n: F.col(f"{family}.{key}") for n, (family, key, _) in VECTOR_FIELDS.items()}
    columns = {n: F.coalesce(c, F.lit(False)) if n in flag else c for n, c in columns.items()}
    carveouts = ["cap_carveout_fraud", "cap_carveout_gross_negligence", "cap_carveout_wilful_misconduct"]
    count = sum((columns[c].cast("int") for c in carveouts), F.lit(0))
    present = F.col("liability_cap").isNotNull()
    grades = F.array(*[
        F.struct(
            F.lit(name).alias("key"),
            (F.coalesce(F.col(f"{family}._extra"), F.lit("ABSENT")) if family == "liability_cap"
             else F.col(f"{family}._extra")).alias("value"),
        )
        for family, name in CONFIDENCE_KEYS.items()
    ])
    confidence = F.map_from_entries(F.filter(grades, lambda g: g["value"].isNotNull()))
    source = F.when(present, F.create_map(F.lit("cap"), F.lit("liability_cap"))).otherwise(
        F.create_map().cast("map<string,string>"))
    return last.select(
        ID,
        present.alias("cap_present"),
        *[c.alias(n) for n, c in columns.items()],
        count.alias("cap_carveout_count"),
        law_category(columns["governing_law"]).alias("governing_law_category"),
        (~present).alias("liability_cap_absent"),
        *[(F.lit(False) if n == "indemnity_uncapped_risk" else F.lit(None).cast(t)).alias(n)
          for n, t in LATER_DIMENSIONS.items()],
        confidence.alias("confidence"),
        source.alias("source_clauses"),
    )


def cap_level(contract_value: Column) -> Column:
    """Cap size on 0..1: fee multiple, else share of the contract value, else 0.5."""
    multiplier = F.col("cap_multiplier")
    ratio = F.col("cap_amount_raw") / contract_value
    return (
        F.when(F.col("cap_is_fees_multiple") & multiplier.isNotNull(), multiplier / (multiplier + 1))
        .when(F.col("cap_amount_raw").isNotNull() & (contract_value > 0), F.least(ratio / (ratio + 1), F.lit(1.0)))
        .otherwise(0.5)
    )


SIMILARITY_FLAGS = {
    "cap_present": "cap_present", "cap_mutual": "cap_mutual", "consequential_excluded": "consequential_loss_excluded",
    "termination_convenience": "termination_for_convenience", "insolvency_trigger": "insolvency_trigger",
    "ip_assigned": "ip_ownership_assigned", "ip_exclusive": "ip_licence_exclusive", "ip_perpetual": "ip_perpetual",
    "auto_renewal": "auto_renewal", "fr_notice_risk": "fr_mandatory_notice_risk", "dpa_present": "dpa_present",
    "cross_border": "cross_border_transfer", "warranty_given": "warranty_given", "as_is_disclaimer": "as_is_disclaimer",
}
SIMILARITY_KEYS = [
    "cap_present", "cap_level", "cap_mutual", "carveout_count_norm", "consequential_excluded",
    "termination_convenience", "notice_period_norm", "insolvency_trigger", "ip_assigned", "ip_exclusive",
    "ip_perpetual", "auto_renewal", "renewal_notice_norm", "fr_notice_risk", "dpa_present", "cross_border",
    "warranty_given", "as_is_disclaimer", "dispute_arbitration", "dispute_litigation",
]
SIMILARITY_OPTIONAL = {
    "cap_risk_score": "cap_risk_score", "indemnity_risk_score": "indemnity_risk_score",
    "overall_balance": "overall_balance_score",
}


def similarity_columns(contract_value: Column) -> dict[str, Column]:
    def share(name: str, whole: float) -> Column:
        return F.when(F.col(name).isNotNull(), F.least(F.col(name) / whole, F.lit(1.0))).otherwise(0.5)

    columns = {k: F.when(F.col(c), 1.0).otherwise(0.0) for k, c in SIMILARITY_FLAGS.items()}
    columns |= {
        "cap_level": cap_level(contract_value),
        "carveout_count_norm": F.least(F.col("cap_carveout_count") / 3.0, F.lit(1.0)),
        "notice_period_norm": share("convenience_notice_days", 365.0),
        "renewal_notice_norm": share("non_renewal_notice_days", 90.0),
    }
    for mechanism in ("arbitration", "litigation"):
        columns[f"dispute_{mechanism}"] = F.when(F.col("dispute_mechanism") == mechanism, 1.0).otherwise(0.0)
    return {k: columns[k] for k in SIMILARITY_KEYS}


def similarity_vector(vectors: DataFrame, contract_value: Column | None = None) -> DataFrame:
    """(contract_id, governing_law_category, features): 20 keys, up to 3 more when scored.

    The governing-law category is no feature; it filters before a comparison.
    """
    value = F.lit(None).cast("double") if contract_value is None else contract_value
    columns = similarity_columns(value) | {k: F.col(c) for k, c in SIMILARITY_OPTIONAL.items()}
    entries = F.array(*[F.struct(F.lit(k).alias("key"), c.alias("value")) for k, c in columns.items()])
    features = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return vectors.select(ID, "governing_law_category", features.alias("features"))


def similarity_array(vectors: DataFrame, contract_value: Column | None = None) -> DataFrame:
    """(contract_id, governing_law_category, vector): the 20 features of :func:`similarity_vector` in the order of their keys.

    No map is built: reading features from one again would build it for each of them.
    """
    value = F.lit(None).cast("double") if contract_value is None else contract_value
    return vectors.select(ID, "governing_law_category", F.array(*similarity_columns(value).values()).alias("vector"))


# features that are filled where a contract says nothing
FILLED = ["cap_level", "notice_period_norm", "renewal_notice_norm"]
# relative rank error of a median is at most one part in so many
MEDIAN_ACCURACY = 10_000


def median_filled(vectors: DataFrame, contract_value: Column | None = None, by: str = "governing_law_category") -> DataFrame:
    """(contract_id, category, 20 features, imputed): unknown features filled with the median of their category.

    Not the default: :func:`similarity_vector` fills with 0.5, as the vectors are specified.  The medians come from
    mergeable sketches, one row for each category, whose rank error is at most 1 / ``MEDIAN_ACCURACY``; a category in
    which nobody knows a feature takes 0.5.  ``imputed`` names the features that were filled.
    """
    value = F.lit(None).cast("double") if contract_value is None else contract_value
    known = {
        "cap_level": (F.col("cap_is_fees_multiple") & F.col("cap_multiplier").isNotNull()) | (
            F.col("cap_amount_raw").isNotNull() & (value > 0)),
        "notice_period_norm": F.col("convenience_notice_days").isNotNull(),
        "renewal_notice_norm": F.col("non_renewal_notice_days").isNotNull(),
    }
    columns = similarity_columns(value)
    rows = vectors.select(ID, F.col(by).alias("category"), *[
        (F.when(known[k], c) if k in FILLED else c).alias(k) for k, c in columns.items()])
    medians = rows.groupBy(F.col("category").alias("of")).agg(*[
        F.percentile_approx(k, 0.5, MEDIAN_ACCURACY).alias(f"median_{k}") for k in FILLED])
    joined = rows.join(medians, F.col("category").eqNullSafe(F.col("of")), "left")
    imputed = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in FILLED]))
    return joined.select(ID, "category", *[
        F.coalesce(k, f"median_{k}", F.lit(0.5)).alias(k) if k in FILLED else F.col(k) for k in SIMILARITY_KEYS], imputed.alias("imputed"))


# --- clause signals on records -----------------------------------------------

def best_claims(claims: DataFrame) -> DataFrame:
    """Per contract, the most confident claim of each signal family, the earlier on ties.

    A claim without a confidence comes after all others.
    """
    wanted = list(dict.fromkeys(family for family, _, _ in SIGNALS.values()))
    fields = SIGNALS | {"_raw_notice": ("auto_renewal", "nonrenewal_notice_value", "double")}
    order = F.struct(F.coalesce(-F.col("family_confidence"), F.lit(float("inf"))).alias("rank"), F.col("seq"))
    return claims.filter(F.col("clause_family").isin(*wanted)).groupBy(ID).agg(
        *_chosen(claims, fields, F.min_by, order, F.col("family_confidence")))


def signal_columns() -> dict[str, Column]:
    columns = {}
    for name, (family, key, kind) in SIGNALS.items():
        c = F.col(f"{family}.{key}")
        columns[name] = F.coalesce(c, F.lit(False)) if kind == "boolean" else c
    columns["_det_carveout_count"] = F.coalesce(columns["_det_carveout_count"], F.lit(0))
    notice = columns["_det_nonrenewal_notice_days"]
    columns["_det_nonrenewal_notice_days"] = F.coalesce(
        F.when(notice != 0, notice), F.col("auto_renewal.nonrenewal_notice_value"))
    return columns


def enrich(records: DataFrame, claims: DataFrame) -> DataFrame:
    """Add the 14 clause signals to every record; no claim means false, 0 or null."""
    kept = [c for c in records.columns if c not in SIGNALS]
    joined = records.select(*kept).join(best_claims(claims), ID, "left")
    return joined.select(*kept, *[c.alias(n) for n, c in signal_columns().items()])


# --- the 28-number vector ----------------------------------------------------

def _column(records: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in records.columns else F.lit(None).cast(kind)


def norm_score(raw: Column, missing: int = 3) -> Column:
    """1..5 to 0..1; null takes ``missing``, anything that is no number takes 3."""
    whole = F.when(raw.isNull(), missing).otherwise(F.coalesce(raw.try_cast("int"), F.lit(3)))
    return (F.greatest(F.lit(1), F.least(F.lit(5), whole)) - 1) / 4.0


def one_hot(raw: Column, labels: list[str]) -> Column:
    label = F.upper(strip(F.coalesce(raw.cast("string"), F.lit("UNCLEAR"))))
    known = F.when(label.isin(*labels), label).otherwise("UNCLEAR")
    return F.array(*[F.when(known == o, 1.0).otherwise(0.0) for o in labels])


def _flag(c: Column) -> Column:
    return F.when(c.cast("boolean"), 1.0).otherwise(0.0)


def _multiplier(c: Column) -> Column:
    v = c.try_cast("double")
    return F.when(v > 0, v / (v + 4.0)).otherwise(0.0)


def _days(c: Column, whole: float = 90.0) -> Column:
    v = c.try_cast("double")
    return F.when(v > 0, F.least(v / whole, F.lit(1.0))).otherwise(0.0)


def _carveouts(c: Column) -> Column:
    # least() skips nulls, so the default goes inside
    return F.least(F.coalesce(c.try_cast("int"), F.lit(0)) / 3.0, F.lit(1.0))


def with_vector(records: DataFrame) -> DataFrame:
    """Add ``vector``: 28 doubles in the order of the layout, never null."""
    def risk(name: str) -> Column:
        return _column(records, f"risk_vector_{name}", "int")

    def signal(name: str) -> Column:
        return _column(records, f"_det_{name}", "double")

    scores = F.array(
        norm_score(risk("termination_risk")), norm_score(risk("data_sensitivity")), norm_score(risk("payment_risk")),
        norm_score(risk("auto_renewal_risk"), 1), 1.0 - norm_score(risk("liability_cap_adequacy")),
    )
    signals = F.array(
        _flag(signal("cap_present")), _multiplier(signal("cap_multiplier")), _flag(signal("mutual_cap")),
        _carveouts(signal("carveout_count")), _flag(signal("indemnity_uncapped")), _flag(signal("mutual_indemnity")),
        _days(signal("payment_due_days")), _flag(signal("late_interest")), _flag(signal("auto_renewal")),
        _days(signal("nonrenewal_notice_days")),
    )
    vector = F.concat(
        scores,
        one_hot(risk("counterparty_leverage"), V.LEVERAGE_LABELS),
        one_hot(risk("ip_ownership_risk"), V.OWNERSHIP_LABELS),
        one_hot(risk("confidentiality_scope"), V.SCOPE_LABELS),
        signals,
    )
    return records.withColumn("vector", vector)


# --- score, explanation, flags -----------------------------------------------

FLAG_BORDER = "\x1f"  # no flag text holds it

Weights = Mapping[str, float | Column]


def _terms(weights: Weights | None) -> dict[str, Column]:
    """Contribution of each term to the score."""
    table = {**V.DEFAULT_WEIGHTS, **(weights or {})}
    terms = {}
    for term, weight, label, inverted in V.SCORE_TERMS:
        x = F.element_at("vector", V.VECTOR_LABELS.index(label) + 1)
        w = table[weight]
        terms[term] = (1.0 - x if inverted else x) * (w if isinstance(w, Column) else F.lit(float(w)))
    return terms


def weight_columns(weights: Column) -> Weights:
    """Weights from a MAP<STRING,DOUBLE> column; names it lacks keep their default."""
    return {n: F.coalesce(F.try_element_at(weights, F.lit(n)), F.lit(w)) for n, w in V.DEFAULT_WEIGHTS.items()}


def with_score(scored: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Add ``score``: weighted risk in 0..1, four decimals; needs ``vector``."""
    total = sum(_terms(weights).values(), F.lit(0.0))
    summed = scored.withColumn("_total", F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))
    return summed.withColumn("score", round_exact_ref(F.col("_total"), 4)).drop("_total")


def with_explanation(scored: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Add ``explanation``: six-decimal contribution per term and their unclamped sum."""
    parts = {name: round_exact(c, 6) for name, c in _terms(weights).items()}
    listed = scored.withColumn("parts", F.array(*parts.values()))
    cells = [(F.lit(n), F.element_at("parts", i)) for i, n in enumerate(parts, start=1)]
    total = round_exact(sum((c for _, c in cells), F.lit(0.0)), 4)
    mapped = F.create_map(*[x for pair in cells for x in pair], F.lit("_composite_score"), total)
    return listed.withColumn("explanation", mapped).drop("parts")


# halves of a cent that lie below their decimal spelling and so print rounded down
_PRINTS_DOWN = [h for h in (k / 1000 for k in range(5, 1000, 10)) if float(f"{h:.2f}") < h]


def _two_decimals(score: Column) -> Column:
    down = F.format_string("%.2f", score - 0.001)
    return F.when(score.isin(*_PRINTS_DOWN), down).otherwise(F.format_string("%.2f", score))


def with_flags(scored: DataFrame) -> DataFrame:
    """Add ``flags``: review texts in fixed order; needs ``score``.

    Flags look at raw scores: a score stored as text sets none, and labels must match
    exactly.
    """
    def number(name: str) -> Column:
        column = f"risk_vector_{name}"
        kind = scored.schema[column].dataType if column in scored.columns else None
        return F.col(column) if isinstance(kind, NumericType) else F.lit(None).cast("int")

    def label(name: str) -> Column:
        column = f"risk_vector_{name}"
        kind = scored.schema[column].dataType if column in scored.columns else None
        return F.col(column) if isinstance(kind, StringType) else F.lit(None).cast("string")

    def signal(name: str) -> Column:
        return _column(scored, f"_det_{name}", "double")

    def scored_flag(name: str, text: str, low: bool = False) -> Column:
        n = number(name)
        return F.when(n <= V.LOW_CAP_SCORE if low else n >= V.HIGH_SCORE, F.format_string(text, n.cast("string")))

    days, notice = signal("payment_due_days").try_cast("double"), signal("nonrenewal_notice_days").try_cast("double")
    scope = label("confidentiality_scope")
    flags = F.array(
        scored_flag("termination_risk", V.FLAG_TERMINATION),
        scored_flag("liability_cap_adequacy", V.FLAG_CAP, low=True),
        scored_flag("data_sensitivity", V.FLAG_DATA),
        scored_flag("payment_risk", V.FLAG_PAYMENT),
        scored_flag("auto_renewal_risk", V.FLAG_RENEWAL),
        F.when(label("counterparty_leverage") == "SUPPLIER", V.FLAG_LEVERAGE),
        F.when(label("ip_ownership_risk") == "CUSTOMER", V.FLAG_IP),
        F.when(scope == "NONE", V.FLAG_SCOPE_NONE).when(scope == "UNILATERAL_SUPPLIER", V.FLAG_SCOPE_SUPPLIER),
        F.when(signal("indemnity_uncapped").cast("boolean"), V.FLAG_INDEMNITY),
        F.when(days >= V.LONG_PAYMENT_DAYS, F.format_string(V.FLAG_PAYMENT_DAYS, days.cast("bigint").cast("string"))),
        F.when(signal("auto_renewal").cast("boolean") & (notice.isNull() | (notice == 0)), V.FLAG_RENEWAL_NO_NOTICE),
        F.when(F.col("score") >= V.HIGH_COMPOSITE, F.format_string(V.FLAG_COMPOSITE, _two_decimals(F.col("score")))),
    )
    # joined and split again, which drops the nulls and stays in generated code
    joined = scored.withColumn("_flags", F.concat_ws(FLAG_BORDER, flags))
    none = F.array().cast("array<string>")
    return joined.withColumn("flags", F.when(F.col("_flags") == "", none).otherwise(
        F.split("_flags", FLAG_BORDER))).drop("_flags")


def score_records(records: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Vector, score, flags and explanation of every record in one projection chain."""
    return with_explanation(with_flags(with_score(with_vector(records), weights)), weights)


def explanation_rows(scored: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Long explanation (contract_id, term, contribution), the sum included; needs ``vector``."""
    parts = {name: round_exact(c, 6) for name, c in _terms(weights).items()}
    listed = scored.select(ID, F.array(*parts.values()).alias("parts"))
    cells = {n: F.element_at("parts", i) for i, n in enumerate(parts, start=1)}
    cells["_composite_score"] = round_exact(sum(cells.values(), F.lit(0.0)), 4)
    rows = F.array(*[F.struct(F.lit(n).alias("term"), c.alias("contribution")) for n, c in cells.items()])
    return listed.select(ID, F.explode(rows).alias("x")).select(ID, "x.*")


def average_contributions(scored: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Fleet view: mean contribution per term over all records."""
    rows = explanation_rows(scored, weights)
    return rows.groupBy("term").agg(F.avg("contribution").alias("mean_contribution"), F.count("*").alias("records"))
