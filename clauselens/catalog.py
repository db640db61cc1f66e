"""Named queries over the given tables; each takes (spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauselens.functions import vocab as V
from clauselens.functions.text import fold, is_ascii, quote
from clauselens.operators import extract as X
from clauselens.operators import normalise as N
from clauselens.operators import prepare as P
from clauselens.operators import resolve as R
from clauselens.operators import responses as S
from clauselens.operators import risk as K
from clauselens.operators import similar as M
from clauselens.plans import extraction as E
from clauselens.plans import scoring as C
from clauselens.session import configure, shared_dir
from clauselens.sources import derived as D
from clauselens.sources.contracts import fan_out, read_contract_store, read_records, write_contracts, write_extractions

Query = Callable[[SparkSession, str], DataFrame]
ID = P.ID
CUSTOM_WEIGHTS = {"termination_risk": 0.30, "data_sensitivity": 0.25}
SNIPPET_FIELDS = ["contract_term", "total_contract_value", "currency", "payment_periodicity", "indexation"]


def _field(name: str, source=D.contracts) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = X.extract_field(source(spark, sf_dir), name)
        return found.select(ID, "candidate.value", "candidate.quote", "candidate.note", "candidate.confidence")

    return run


def _documents(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(D.documents(spark, sf_dir))


def _contracts(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(D.contracts(spark, sf_dir))


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.answered_contracts(D.contracts(spark, sf_dir), D.extraction_answers(spark, sf_dir))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(ID))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify(_customers(spark, sf_dir), D.MODELS, D.classification_responses(spark, sf_dir), texts=False)


def total_value(contracts: DataFrame) -> DataFrame:
    t = F.col("total_contract_value")
    return X.extract_total_value(contracts).select(
        ID, t["value"].cast("double").alias("value"), F.col("currency.value").alias("currency"),
        t["quote"].alias("quote"), t["note"].alias("note"), t["derived"].alias("derived"))


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = _answered(spark, sf_dir)
    return R.resolve(S.candidates_long(answered)).select(ID, "field", "value", "confidence", "source", "warning")


def snippets(documents: DataFrame) -> DataFrame:
    requested = F.array(*[F.lit(f) for f in SNIPPET_FIELDS])
    return R.with_snippets(P.with_lines(documents), requested, SNIPPET_FIELDS).select(ID, "snippets")


def snippet_parts(documents: DataFrame) -> DataFrame:
    """Snippets in small parts, joined again, and whether every part of several lines fits."""
    requested = F.array(*[F.lit(f) for f in SNIPPET_FIELDS])
    parts = R.with_snippets(P.with_lines(documents), requested, SNIPPET_FIELDS).select(ID, R.in_parts(F.col("snippets"), 500).alias("parts"))
    fits = F.forall("parts", lambda p: (F.length(p) <= 500) | ~F.contains(p, F.lit("\n")))
    return parts.select(ID, F.array_join("parts", "\n").alias("snippets"), fits.alias("fits"))


def edge_snippets(documents: DataFrame) -> DataFrame:
    """Snippets for a field that needs both edges of a document, whose middle is left out."""
    requested = F.array(F.lit("internal_entity"))
    return R.with_snippets(P.with_lines(documents), requested, ["internal_entity"]).select(ID, "snippets")


VARIANT_FIELDS = [
    "counterparty_signatory", "contract_term", "payment_terms_days", "termination_notice_days", "auto_renewal",
    "renewal_notice_days", "payment_periodicity",
]


def rule_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values found in the other wordings of the rules."""
    wide = X.extract_wide(D.variants(spark, sf_dir), keep=["text", "clauses"])
    # texts are composed and cut once, so the total is read beside the other fields and not joined to them
    staged = wide.select(ID, "text", X.term_years(F.col("clauses")).alias("term"), *[F.col(f"{f}.value").alias(f) for f in VARIANT_FIELDS])
    total = X.total_value(F.col("text"), is_ascii(F.col("text")), F.col("term"))
    return staged.select(ID, *VARIANT_FIELDS, total.alias("t")).select(
        ID, *VARIANT_FIELDS, F.col("t.total.value").cast("double").alias("total_contract_value"), F.col("t.currency.value").alias("currency"))


def requests(contracts: DataFrame) -> DataFrame:
    return R.extraction_requests(contracts).select(
        ID, "part", "parts", F.array_join("requested", ",").alias("requested"), "snippets", "prompt")


def missing_fields(contracts: DataFrame) -> DataFrame:
    routed = R.with_routing(X.extract_wide(contracts)).withColumn("locked_json", R.locked_json(V.TEXT_FIRST_FIELDS))
    return routed.select(ID, F.array_join("missing", ",").alias("missing"), "locked_json")


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = E.merged_candidates(_answered(spark, sf_dir))
    return X.to_long(wide, V.ALL_FIELDS).select(ID, "field", "value", "source")


def final_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = E.extract_contracts(D.contracts(spark, sf_dir), D.extraction_answers(spark, sf_dir))
    return final.select(
        ID, *V.ALL_FIELDS,
        F.col("evidence.counterparty_name.quote").alias("name_quote"),
        F.col("evidence.internal_entity.quote").alias("entity_quote"),
        F.col("evidence.payment_terms_days.quote").alias("terms_quote"),
        F.array_join("warnings", " | ").alias("warnings"))


def recovered_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the answer that counts for each part of a request holds."""
    settled = S.parsed_answers(D.extraction_answers(spark, sf_dir)).groupBy(ID, "part").agg(F.max_by("answer", "rank").alias("answer"))
    fields = F.col("answer.fields")
    return settled.select(
        ID, "part", F.coalesce(F.col("answer.failure") != V.NO_OBJECT, F.lit(True)).alias("recovered"),
        fields["internal_entity"]["value"].alias("internal_entity"),
        fields["total_contract_value"]["value"].cast("double").alias("total_contract_value"))


def _call(call: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = S.CALLS[call][0]
        checked = S.validate_call(D.classification_responses(spark, sf_dir), call, texts=False)
        flat = [F.array_join(f, "; ").alias(f) if t == S.STRINGS else F.col(f) for f, t in fields.items()]
        return checked.select(ID, "model", *flat, "error")

    return run


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw texts that the merged records keep."""
    records = C.classify(_customers(spark, sf_dir), D.MODELS, D.classification_responses(spark, sf_dir))
    return records.select(ID, "model", *[F.md5(f"{p}raw_response").alias(f"{p}raw_response") for p in ("", "sector_", "risk_vector_")])


def call_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.reject_reasons(D.classification_responses(spark, sf_dir))


ROUND_TRIP = ["primary_contract_type", "counterparty_name", "payment_terms_days", "termination_notice_days", "currency", "auto_renewal"]


def file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts to files, files to contracts, contracts to records, records to files and back, each written twice."""
    folder = f"{shared_dir(spark)}/round-trip-{uuid.uuid4().hex}"
    contracts = D.supplier_contracts(spark, sf_dir)
    write_contracts(contracts, f"{folder}/texts")
    write_contracts(contracts.where(F.crc32(ID) % 2 == 0), f"{folder}/texts")  # again: the same files
    records = E.extract_contracts(read_contract_store(spark, f"{folder}/texts"))
    bucketed = records.withColumn("bucket", F.right(ID, F.lit(6)).cast("int") % 4)
    for part in (bucketed, bucketed.where("bucket = 1")):
        write_extractions(part, f"{folder}/records", mode="overwrite", partition="bucket")
    back = read_records(spark, f"{folder}/records", bucketed.schema)
    return back.select(ID, "bucket", *ROUND_TRIP, F.col("evidence.counterparty_name.quote").alias("name_quote"), F.array_join(
        "warnings", " | ").alias("warnings"))


def merged_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(
        ID, "model", "contract_type_primary", "governing_law", "jurisdiction_country",
        F.array_join("regulated_sectors", "; ").alias("regulated_sectors"), "risk_vector_termination_risk",
        "error", "sector_error", "risk_vector_error", "elapsed_total_s")


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = K.assemble(D.claims(spark, sf_dir))
    grades = [F.try_element_at("confidence", F.lit(n)).alias(f"{n}_grade") for n in K.CONFIDENCE_KEYS.values()]
    return vectors.select(
        ID, "cap_present", *K.VECTOR_FIELDS, "cap_carveout_count", "governing_law_category", "liability_cap_absent", *grades,
        F.try_element_at("source_clauses", F.lit("cap")).alias("cap_source"))


def similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity features against a contract value that grows with the order key."""
    value = (F.col(ID) % 50 + 1) * 1000.0
    vectors = K.similarity_vector(K.assemble(D.claims(spark, sf_dir)), value)
    return vectors.select(
        ID, "governing_law_category", *[F.round(F.element_at("features", k), 9).alias(k) for k in K.SIMILARITY_KEYS])


NEIGHBOURS = 5


def similar_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contracts most similar to every twentieth one, among all under the same category of law."""
    value = (F.col(ID) % 50 + 1) * 1000.0
    vectors = K.similarity_array(K.assemble(D.claims(spark, sf_dir)), value)
    rows = vectors.select(F.col(ID).alias("id"), F.col("governing_law_category").alias("category"), "vector")
    return M.similar(rows, NEIGHBOURS, F.col("id") % 20 == 0).withColumnRenamed("id", ID)


def similar_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search over the embeddings, filtered by their label."""
    rows = D.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("category"), F.col("embedding").cast("array<double>").alias("vector"))
    return M.similar(rows, NEIGHBOURS, F.col("id") % 20 == 0)


def median_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (F.col(ID) % 50 + 1) * 1000.0
    filled = K.median_filled(K.assemble(D.claims(spark, sf_dir)), value)
    return filled.select(ID, "category", *[F.round(k, 9).alias(k) for k in K.SIMILARITY_KEYS], F.array_join("imputed", ",").alias("imputed"))


def best_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = K.best_claims(D.claims(spark, sf_dir))
    families = list(dict.fromkeys(f for f, _, _ in K.SIGNALS.values()))
    return best.select(ID, *[F.col(f"{f}._extra").alias(f"{f}_confidence") for f in families])


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.enrich(D.records(spark, sf_dir), D.claims(spark, sf_dir)).select(ID, *K.SIGNALS)


def numeric_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = K.with_vector(D.records(spark, sf_dir))
    return records.select(ID, *[
        F.round(F.element_at("vector", i), 9).alias(n) for i, n in enumerate(V.VECTOR_LABELS, start=1)])


def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.with_score(K.with_vector(D.records(spark, sf_dir))).select(ID, "score")


def custom_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.with_score(K.with_vector(D.records(spark, sf_dir)), CUSTOM_WEIGHTS).select(ID, "score")


def party_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores under the weights of each party: a table of weights joined by the party's nation."""
    nation = F.col("n_nationkey")
    weights = D.table(spark, sf_dir, "nation").select(nation.alias("c_nationkey"), F.when(nation % 3 != 0, F.create_map(
        F.lit("termination_risk"), 0.1 + nation / 100, F.lit("payment_risk"), 0.2 - nation / 200)).alias("weights"))
    party = D.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(ID), "c_nationkey")
    scored = K.with_vector(D.records(spark, sf_dir)).join(party.join(weights, "c_nationkey", "left"), ID, "left")
    return K.with_score(scored, K.weight_columns(F.col("weights"))).select(ID, "score")


def triage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = K.with_flags(K.with_score(K.with_vector(D.records(spark, sf_dir))))
    return flagged.select(ID, F.size("flags").alias("n_flags"), F.array_join("flags", "\n").alias("flags"))


def explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.explanation_rows(K.with_vector(D.records(spark, sf_dir)))


def mean_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = K.average_contributions(K.with_vector(D.records(spark, sf_dir)))
    return means.select("term", F.round("mean_contribution", 6).alias("mean_contribution"), "records")


def scored_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of records whose clause signals come from the claims table."""
    scored = C.score_contracts(D.records(spark, sf_dir), D.claims(spark, sf_dir))
    return scored.select(ID, "score", F.size("flags").alias("n_flags"))


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalise(D.raw_values(spark, sf_dir))


def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.reject_report(normalised(spark, sf_dir))


def law_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.law_report(K.assemble(D.claims(spark, sf_dir)))


def fanned_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fan_out(_customers(spark, sf_dir), D.MODELS)
    return pairs.groupBy("model").agg(F.count("*").alias("contracts"), F.sum(ID).alias("id_sum"))


def folded(documents: DataFrame) -> DataFrame:
    return documents.select(ID, fold(F.col("text")).alias("folded"))


def quotes(documents: DataFrame) -> DataFrame:
    return documents.select(ID, quote(F.col("text")).alias("quote"))


def header(documents: DataFrame) -> DataFrame:
    return P.with_header(P.with_lines(documents)).select(ID, "header", "folded_header")


def classification_requests(documents: DataFrame) -> DataFrame:
    return R.classification_requests(documents)


def candidates(contracts: DataFrame) -> DataFrame:
    return X.extract_candidates(contracts).select(ID, "field", "value", "confidence", "derived", "source")


def locked(contracts: DataFrame) -> DataFrame:
    return R.with_lock(X.extract_candidates(contracts)).select(ID, "field", "value", "locked", "emitted")


QUERIES: dict[str, Query] = {
    "clean_text": _documents(P.clean),
    "clauses": _documents(P.to_clauses),
    "lines": _documents(P.to_lines),
    "header": _documents(header),
    "paragraphs": _contracts(P.to_paragraphs),
    "fold": _documents(folded),
    "quotes": _documents(quotes),
    "language": _documents(X.detect_language),
    "document_currency": _field("currency", D.documents),
    "document_email": _field("counterparty_contact_email", D.documents),
    "normalise": normalised,
    "reject_report": reject_report,
    "law_report": law_report,
    "contract_type": _field("primary_contract_type"),
    "counterparty_name": _field("counterparty_name"),
    "counterparty_signatory": _field("counterparty_signatory"),
    "signature_date": _field("signature_date"),
    "effective_date": _field("effective_date"),
    "start_date": _field("start_date"),
    "end_date": _field("end_date"),
    "auto_renewal": _field("auto_renewal"),
    "renewal_notice": _field("renewal_notice_days"),
    "termination_notice": _field("termination_notice_days"),
    "contract_term": _field("contract_term"),
    "payment_terms": _field("payment_terms_days"),
    "payment_periodicity": _field("payment_periodicity"),
    "currency": _field("currency"),
    "contact_email": _field("counterparty_contact_email"),
    "indexation": _field("indexation"),
    "total_value": _contracts(total_value),
    "term_years": _contracts(X.extract_term_years),
    "candidates": _contracts(candidates),
    "locked": _contracts(locked),
    "resolve": resolved,
    "missing_fields": _contracts(missing_fields),
    "snippets": _documents(snippets),
    "snippet_parts": _documents(snippet_parts),
    "edge_snippets": _documents(edge_snippets),
    "rule_variants": rule_variants,
    "extraction_requests": _contracts(requests),
    "classification_requests": _documents(classification_requests),
    "json_recover": recovered_json,
    "merge_answers": merged,
    "final_record": final_record,
    "fan_out": fanned_out,
    "type_answers": _call("type"),
    "sector_answers": _call("sector"),
    "risk_answers": _call("risk"),
    "merged_record": merged_record,
    "raw_responses": raw_responses,
    "call_rejects": call_rejects,
    "file_round_trip": file_round_trip,
    "model_consensus": lambda spark, sf_dir: C.model_consensus(_records(spark, sf_dir)),
    "jurisdiction_counts": lambda spark, sf_dir: C.jurisdiction_counts(_records(spark, sf_dir)),
    "assemble_vector": assembled,
    "similarity_vector": similarity,
    "similar_contracts": similar_contracts,
    "similar_embeddings": similar_embeddings,
    "median_filled": median_filled,
    "best_claim": best_claim,
    "enriched": enriched,
    "numeric_vector": numeric_vector,
    "composite_score": composite_score,
    "custom_weights": custom_weights,
    "party_weights": party_weights,
    "triage_flags": triage_flags,
    "explain": explain,
    "mean_contributions": mean_contributions,
    "scored_enriched": scored_enriched,
}


def configured(query: Query) -> Query:
    """Run a query under the settings the library relies on."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run
