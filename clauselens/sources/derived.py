"""Contracts, claims, records and model answers derived from the star-schema tables.

The text of a derived contract is composed from columns of its order, so the value
each extraction rule must find is known from those columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clauselens.session import spread
from clauselens.sources.contracts import fan_out

FRENCH_MONTHS = [
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
]
MODELS = ["model-a", "model-b"]
FAMILIES = [
    "liability_cap", "termination_notice", "payment_terms", "ip_licence", "auto_renewal", "data_retention",
    "dispute_resolution", "governing_law", "agreement_term", "warranty", "indemnity",
]
GOVERNING_LAWS = ["French law", "Laws of England", "State of Delaware", "German law", "Dutch law", "Swiss law"]
FENCE = "```"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # both tables grow together, so the join shuffles their few columns; the texts are composed after it
    joined = orders.join(customer.hint("shuffle_hash"), orders.o_custkey == customer.c_custkey, "left")
    return joined.select(
        F.col("o_orderkey").alias("k"), "c_name", "o_totalprice", F.to_date("o_orderdate").alias("day"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, text): one bilingual contract per order."""
    k, day = F.col("k"), F.col("day")
    start = F.date_add(day, 30)
    money = F.format_number("o_totalprice", 2)

    def line(template: str, *values: Column) -> Column:
        return F.format_string(template, *values)

    lines = [
        _pick(k % 4, ["SERVICES AGREEMENT", "LEASE AGREEMENT", "LOAN AGREEMENT", "AMENDMENT TO SERVICES AGREEMENT"]),
        F.lit(""),
        F.when(k % 5 == 0, F.lit("This agreement is made between Alpha Ltd and Beta Corp (the parties)."))
        .otherwise(F.concat(F.lit("Customer: "), F.col("c_name"))),
        line("Effective Date: %s", F.date_format(day, "yyyy-MM-dd")),
        F.when(k % 2 == 0, line("Signed on: %s", F.date_format(day, "MMMM d, yyyy"))),
        F.when(k % 7 == 0, line(
            "Date de début : %d %s %d", F.dayofmonth(start), _pick(F.month(start) - 1, FRENCH_MONTHS), F.year(start))),
        line("End Date: %s", F.date_format(F.date_add(day, 365), "dd/MM/yyyy")),
        F.lit(""),
        F.when(k % 3 == 0, line("The initial term is %d months from Effective Date.", 12 * (1 + k % 5)))
        .when(k % 3 == 1, F.lit("The term is 12 months from the Effective Date."))
        .otherwise(F.lit("This Agreement is of indefinite term.")),
        _pick(k % 4, [
            "Fees are billed monthly.", "Fees are billed quarterly.", "Fees are billed annually.",
            "Fees are billed monthly and billed annually.",
        ]),
        line("Fees are payable within %d days.", 15 + k % 76),
        F.when(k % 8 == 1, line("Minimum annual commitment: EUR %s", money)).otherwise(line("Total Fees: EUR %s", money)),
        F.when(k % 10 == 9, F.lit("Travel costs are limited to USD 500.")),
        F.when(k % 6 == 0, F.lit("Amounts follow the Syntec index."))
        .when(k % 6 == 1, F.lit("Amounts follow the ILC."))
        .when(k % 6 == 2, F.lit("Amounts follow the CPI."))
        .when(k % 6 == 3, F.lit("Amounts follow inflation."))
        .when(k % 6 == 4, line("Amounts increase by %d,5%% each year.", 1 + k % 9)),
        F.lit(""),
        line("Either party may terminate on %d days notice.", 30 + k % 61),
        F.when(k % 3 == 0, line(
            "This Agreement is subject to automatic renewal unless %d days notice is given.", 20 + k % 80))
        .when(k % 3 == 1, F.lit("No automatic renewal applies.")),
        F.lit(""),
        line("Customer contact email: c%d@example.com", k),
        F.lit("Signed for and on behalf of Customer"),
        line("Name: Signatory N%d", k),
    ]
    return _order_facts(spark, sf_dir).select(k.alias("contract_id"), F.concat_ws("\n", *lines).alias("text"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, text): contracts in the other wordings of the rules, with long clauses and many lines."""
    k, day = F.col("k"), F.col("day")

    def line(template: str, *values: Column) -> Column:
        return F.format_string(template, *values)

    days = 10 + k % 80
    filler = F.array_join(F.transform(F.sequence(F.lit(1), 130 + k % 40), lambda i: F.concat(
        F.lit("Article "), i.cast("string"), F.lit(" is here for its number."))), "\n")
    lines = [
        F.lit("Second wording"),
        F.when(k % 3 == 0, F.lit("Supplier: ACME\nPlace: Paris")).when(k % 3 == 1, F.lit("Pour le compte de Client\n")),
        F.when(k % 3 == 0, line("By: Ann L%d", k)).when(k % 3 == 1, line("Nom: Jean D%d", k)),
        F.when(k % 2 == 0, filler),
        F.when(k % 6 == 0, line("Fees: net %d.", days))
        .when(k % 6 == 1, F.lit("Fees are payable within thirty (30) days."))
        .when(k % 6 == 2, line("Le loyer est dû dans un délai de %d jours.", days))
        .when(k % 6 == 3, line("Paiement sous %d jours.", days))
        .when(k % 6 == 4, F.concat(F.lit("Fees"), F.repeat(F.lit(" and costs"), 60), line(" are due within %d days.", days))),
        _pick(k % 8, [
            "Le tarif est mensuel.", "Le tarif est trimestriel.", "Fees are invoiced semi-annually.", "Le tarif est annuel.",
            "Fees follow each milestone.", "Fees are usage-based.", "Fees are due on delivery.", "Fees are a lump sum.",
        ]),
        F.when(k % 5 == 0, line("The agreement has a duration of %d years from start date.", 1 + k % 9))
        .when(k % 5 == 1, line("La durée est de %d mois à compter de la date d'effet.", 6 + k % 30))
        .when(k % 5 == 2, line("The term runs until %s.", F.date_format(day, "yyyy-MM-dd")))
        .when(k % 5 == 3, F.lit("The term is until terminated.")),
        F.when(k % 4 == 0, line("Either party may terminate with %d calendar days of warning.", days))
        .when(k % 4 == 1, line("La résiliation exige un préavis de %d jours.", days))
        .when(k % 4 == 2, line("Termination needs a warning of %d months.", 1 + k % 6)),
        F.when(k % 6 == 0, F.lit("Ce contrat est sans reconduction tacite."))
        .when(k % 6 == 1, line("Le contrat suit une tacite reconduction avec un préavis de %d jours.", days))
        .when(k % 6 == 2, F.lit("The agreement is evergreen."))
        .when(k % 6 == 3, F.lit("It will not renew automatically."))
        .when(k % 6 == 4, F.lit("Renouvellement automatique.")),
        line("Montant total : %s EUR", F.format_number("o_totalprice", 2)),
        F.lit("End of the contract"),
    ]
    return _order_facts(spark, sf_dir).select(k.alias("contract_id"), F.concat_ws("\n", *lines).alias("text"))


def supplier_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, text): a short contract per supplier, for files."""
    k = F.col("s_suppkey")
    lines = [
        F.lit("SERVICES AGREEMENT"),
        F.format_string("Customer: Northwind %d", k),
        F.when(k % 3 != 0, F.format_string("Fees are payable within %d days.", 15 + k % 76)),
        F.when(k % 4 != 0, F.format_string("Either party may terminate on %d days notice.", 30 + k % 61)),
        F.when(k % 5 == 0, F.lit("No automatic renewal applies.")),
    ]
    suppliers = spread(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    return suppliers.select(F.format_string("S_%06d", k).alias("contract_id"), F.concat_ws("\n", *lines).alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, text) of the raw document table."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("contract_id"), "text")
    return rows


def extraction_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, part, parts, attempt, response): chat envelopes per contract, about a tenth without any.

    By k % 7: 3 was asked in two parts, without a currency in the first answer; by k % 3: 0 has it in the second, 1 has
    another entity in the second as well, 2 has no second answer.
    The envelope that counts is attempt 2.  By k % 4: 1 has an earlier good answer with another entity, 2 a
    later one that was cut off, 3 the same one twice.
    By k % 10: 1 fenced, 2 with prose before it, 3 truncated, 4 with an unknown key,
    5 no answer, 6 content as a list of parts, otherwise plain.
    """
    k, day = F.col("k"), F.col("day")
    end = F.date_add(day, 365)
    always = F.lit(True)
    # field -> (is it requested, its JSON value)
    asked = {
        "internal_entity": (always, F.lit('"Alpha Holdings"')),
        "counterparty_contact_email": (always, line_json("c%d@example.com", k)),
        "total_contract_value": (always, F.when(k % 2 == 0, F.format_string("%.2f", "o_totalprice")).otherwise("null")),
        "indexation": (always, F.lit("null")),
        "currency": (always, F.lit('"EUR"')),
        "counterparty_name": (k % 5 == 0, F.lit('"Beta Corp Ltd"')),
        "signature_date": (k % 2 != 0, F.lit("null")),
        "start_date": (k % 7 != 0, F.lit("null")),
        "end_date": (F.dayofmonth(end) <= 12, line_json("%s", F.date_format(end, "yyyy-MM-dd"))),
        "auto_renewal": (k % 3 == 2, F.lit("false")),
        "renewal_notice_days": (k % 3 != 0, F.lit("null")),
        "contract_term": (k % 3 == 1, F.lit('"12 months from Effective Date"')),
        "payment_periodicity": (k % 4 == 3, F.lit('"MONTHLY"')),
    }
    quoted = '{"quote": "as stated", "note": null, "derived": false}'
    empty = '{"quote": null, "note": null, "derived": false}'

    def body(values: dict[str, Column], extra: Column, warning: str) -> Column:
        chosen = {f: (cond, values.get(f, F.lit("null"))) for f, (cond, _) in asked.items()}
        fields = F.concat_ws(", ", *[
            F.when(cond, F.concat(F.lit(f'"{f}": '), value)) for f, (cond, value) in chosen.items()])
        evidence = F.concat_ws(", ", *[
            F.when(cond, F.concat(F.lit(f'"{f}": '), F.when(value == "null", empty).otherwise(quoted)))
            for f, (cond, value) in chosen.items()])
        return F.concat(F.lit("{"), extra, fields, F.lit(', "evidence": {'), evidence, F.lit(f'}}, "warnings": ["{warning}"]}}'))

    def envelope_of(content: Column) -> Column:
        return F.concat(F.lit('{"choices": [{"message": {"content": '), content, F.lit("}}]}"))

    split = k % 7 == 3
    all_values = {f: value for f, (_, value) in asked.items()}
    first_values = {**all_values, "currency": F.when(split, "null").otherwise(all_values["currency"])}
    other_entity = F.when(k % 3 == 1, '"Beta Holdings"').otherwise("null")
    second = envelope_of(_json_string(body(
        {"currency": all_values["currency"], "internal_entity": other_entity}, F.lit(""), "second part")))
    body_1 = body(first_values, F.when(k % 10 == 4, F.lit('"surprise": 1, ')).otherwise(""), "checked")
    text = (
        F.when(k % 10 == 1, F.concat(F.lit(f"{FENCE}json\n"), body_1, F.lit(f"\n{FENCE}")))
        .when(k % 10 == 2, F.concat(F.lit("Here {is} the answer: "), body_1, F.lit(" Done.")))
        .when(k % 10 == 3, F.substring(body_1, 1, 60))
        .otherwise(body_1)
    )
    def attempt(number: int, response: Column, part: int = 1) -> Column:
        parts = F.when(split, 2).otherwise(1)
        return F.struct(F.lit(part).alias("part"), parts.alias("parts"), F.lit(number).alias("attempt"), response.alias("response"))

    usable = ~(k % 10).isin(3, 4)
    has_second = split & (k % 3 != 2)
    # the envelopes are columns of their own, so that all attempts share one composition
    composed = _order_facts(spark, sf_dir).filter(k % 10 != 5).select(
        k, text.alias("text"), F.when(has_second, second).alias("second")).select(k, envelope_of(F.when(
            k % 10 == 6, F.to_json(F.array(F.struct(F.lit("text").alias("type"), F.col("text")))),
        ).otherwise(_json_string(F.col("text")))).alias("envelope"), "second")
    envelope, second = F.col("envelope"), F.col("second")
    attempts = F.array_compact(F.array(
        attempt(2, envelope),
        F.when((k % 4 == 1) & usable, attempt(1, F.replace(envelope, F.lit("Alpha Holdings"), F.lit("Old Holdings")))),
        F.when((k % 4 == 2) & usable, attempt(3, F.substring(envelope, 1, 50))),
        F.when(k % 4 == 3, attempt(2, envelope)),
        F.when(has_second, attempt(1, second, 2)),
        F.when(has_second & (k % 4 == 2), attempt(2, F.substring(second, 1, 70), 2)),
    ))
    rows = composed.select(k.alias("contract_id"), F.explode(attempts).alias("x"))
    return rows.select("contract_id", "x.*")


def line_json(template: str, *values: Column) -> Column:
    return F.format_string('"' + template + '"', *values)


def _json_string(text: Column) -> Column:
    """A JSON string literal."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, seq, clause_family, family_confidence, family_projection): one claim per line item.

    The projection holds all keys of all families; a key a claim does not state is null.
    ``seq`` is the ordering struct itself: numbering would collect each order in one task.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("int")
    stated = F.col("l_suppkey") % 3 != 0
    odd, even = quantity % 2 == 1, quantity % 2 == 0
    third = quantity % 3 == 0
    projection = F.struct(
        F.when(stated, odd).alias("cap_present"),
        F.when(stated, F.round("l_extendedprice", 2)).alias("cap_amount"),
        F.when(stated, "EUR").alias("cap_currency"),
        F.when(stated, third).alias("cap_formula_fees_paid"),
        F.when(stated, F.col("l_suppkey") % 4 + 0.5).alias("cap_formula_multiplier_value"),
        F.when(stated, even).alias("mutual_cap"),
        F.when(stated, odd).alias("carveout_fraud"),
        F.when(stated, third).alias("carveout_gross_negligence"),
        F.when(stated, even).alias("carveout_wilful_misconduct"),
        F.when(stated, quantity % 5).alias("carveout_count"),
        F.when(stated, even).alias("excludes_indirect_damages"),
        odd.alias("termination_for_convenience"),
        F.when(stated, quantity * 10.0).alias("notice_period_normalized_days"),
        even.alias("termination_for_breach"),
        F.when(stated, quantity * 1.0).alias("cure_period_normalized_days"),
        third.alias("insolvency_trigger"),
        F.when(stated, quantity * 2.0).alias("payment_due_normalized_days"),
        F.when(stated, odd).alias("late_interest"),
        even.alias("invoice_trigger"),
        odd.alias("ip_ownership_assigned"),
        even.alias("exclusive"),
        third.alias("sublicence_permitted"),
        F.when(stated, odd).alias("perpetual_licence"),
        F.when(stated, odd).alias("auto_renewal"),
        F.when(stated, quantity * 1.0).alias("renewal_term_normalized_months"),
        F.when(stated, F.when(third, 0.0).otherwise(quantity * 3.0)).alias("nonrenewal_notice_normalized_days"),
        (quantity * 1.0).alias("nonrenewal_notice_value"),
        third.alias("fr_mandatory_notice_risk"),
        odd.alias("dpa_present"),
        F.when(stated, even).alias("cross_border_transfer_mentioned"),
        F.when(stated, quantity * 30.0).alias("retention_period_normalized_days"),
        F.when(stated, _pick(quantity % 3, ["arbitration", "mediation", "litigation"])).alias("dispute_resolution_type"),
        F.when(third, "icc").alias("arbitration_institution"),
        F.when(stated, _pick(quantity % 6, GOVERNING_LAWS)).alias("governing_law"),
        F.when(stated, quantity * 12.0).alias("initial_term_normalized_months"),
        third.alias("indefinite_term"),
        odd.alias("warranty_given"),
        F.when(stated, even).alias("disclaimer_present"),
        F.when(stated, quantity * 7.0).alias("warranty_period_normalized_days"),
        F.when(stated, odd).alias("indemnity_uncapped"),
        even.alias("mutual_indemnity"),
        F.when(stated, _pick(quantity % 2, ["supplier", "customer"])).alias("indemnity_direction"),
    )
    return lineitem.select(
        F.col("l_orderkey").alias("contract_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("seq"),
        _pick(F.col("l_partkey") % 11, FAMILIES).alias("clause_family"),
        F.round(F.col("l_discount") * 10, 2).alias("family_confidence"),
        projection.alias("family_projection"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification records with clause signals, one per customer."""
    c = F.col("c_custkey")

    def label(index: Column, values: list[str]) -> Column:
        picked = F.when(c % 11 == 0, F.lit(None)).when(c % 13 == 0, F.lit("SOMETHING")).otherwise(_pick(index, values))
        return picked.cast("string")

    enriched = c % 3 != 0
    return table(spark, sf_dir, "customer").select(
        c.alias("contract_id"),
        (1 + c % 6).cast("int").alias("risk_vector_termination_risk"),
        (1 + c % 4).cast("int").alias("risk_vector_data_sensitivity"),
        (c % 3 * 2).cast("int").alias("risk_vector_payment_risk"),
        F.when(c % 7 != 0, 1 + c % 5).cast("int").alias("risk_vector_auto_renewal_risk"),
        (1 + (c + 2) % 5).cast("int").alias("risk_vector_liability_cap_adequacy"),
        label(c % 4, ["SUPPLIER", "CUSTOMER", "BALANCED", "UNCLEAR"]).alias("risk_vector_counterparty_leverage"),
        label(c % 4, ["SUPPLIER", "CUSTOMER", "JOINT", "UNCLEAR"]).alias("risk_vector_ip_ownership_risk"),
        label(c % 5, ["MUTUAL", "UNILATERAL_SUPPLIER", "UNILATERAL_CUSTOMER", "NONE", "UNCLEAR"])
        .alias("risk_vector_confidentiality_scope"),
        F.when(enriched, c % 2 == 0).alias("_det_cap_present"),
        F.when(enriched, (c % 6).cast("double")).alias("_det_cap_multiplier"),
        F.when(enriched, c % 4 == 0).alias("_det_mutual_cap"),
        F.when(enriched, (c % 5).cast("int")).alias("_det_carveout_count"),
        F.when(enriched, c % 2 == 1).alias("_det_indemnity_uncapped"),
        F.when(enriched, c % 8 == 0).alias("_det_mutual_indemnity"),
        F.when(enriched, (10 + c % 100).cast("double")).alias("_det_payment_due_days"),
        F.when(enriched, c % 10 < 5).alias("_det_late_interest"),
        F.when(enriched, c % 5 < 3).alias("_det_auto_renewal"),
        F.when(enriched & (c % 4 != 1), (c % 40).cast("double")).alias("_det_nonrenewal_notice_days"),
    )


def classification_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, model, call, content, elapsed_s) for three calls per customer and model.

    By c % 10: 1 fenced, 2 after a think block, 3 truncated, 4 an unknown sector, 5 a
    country without a court, 6 a score that is no number, 7 a null content; the sector
    call is missing for c % 10 = 8.
    """
    c = F.col("c_custkey")
    base = fan_out(spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey"), MODELS)
    second = F.col("model") == MODELS[1]
    kind = F.to_json(F.struct(
        F.when(second & (c % 6 == 0), " SUPPLY_AND_TRADE ").otherwise(_pick(c % 3, ["SERVICES", "SUPPLY_AND_TRADE", "FINANCE_AND_TREASURY"]))
        .alias("contract_type_primary"),
        F.when(c % 4 != 0, F.array(F.lit("DATA_PRIVACY"))).alias("contract_type_secondary"),
        F.lit(" Real Estate & Facilities").alias("subject_matter"),
        _pick(c % 4, ["English law", "N/A", " null ", "French law"]).alias("governing_law"),
        F.when(c % 3 == 0, " Paris").otherwise("null").alias("jurisdiction_city"),
        F.when((c % 3 == 0) & (c % 9 != 0), "fr").when(c % 10 == 5, "gb").otherwise("").alias("jurisdiction_country"),
        F.when((c % 3 == 0) & (c % 9 != 0) & (c % 10 != 5), "commercial").otherwise("N/A").alias("jurisdiction_court_type"),
        F.lit("English ").alias("contract_language"),
    ), {"ignoreNullFields": "false"})
    sector = F.to_json(F.struct(
        F.when(c % 10 == 4, F.array(F.lit("Energy"), F.lit("Space Mining")))
        .when(c % 5 == 0, F.array(F.lit(" N/A ")))
        .when(c % 3 == 0, F.array(F.lit(" Energy "), F.lit("Transport"))).alias("regulated_sectors")))
    risk = F.concat(
        F.lit('{"counterparty_leverage": "'), _pick(c % 4, ["supplier", " Customer ", "BALANCED", "whoever"]),
        F.lit('", "termination_risk": '), _pick(c % 4, ["4", "9", '"2"', "null"]),
        F.lit(', "data_sensitivity": '), F.when(c % 10 == 6, '"high"').otherwise((c % 7).cast("string")),
        F.lit(', "ip_ownership_risk": null, "payment_risk": '), _pick(c % 3, ["3.9", "true", "-2"]),
        F.lit(', "confidentiality_scope": "mutual", "liability_cap_adequacy": '), (1 + c % 5).cast("string"),
        F.lit("}"),
    )
    calls = F.array(*[
        F.struct(F.lit(name).alias("call"), body.alias("body"), F.lit(seconds).alias("elapsed_s"))
        for name, body, seconds in (("type", kind, 2.41), ("sector", sector, 1.87), ("risk", risk, 0.5))
    ])
    rows = base.select("c_custkey", "model", F.explode(calls).alias("x")).select("c_custkey", "model", "x.*")
    rows = rows.filter(~((c % 10 == 8) & (F.col("call") == "sector")))
    content = (
        F.when(c % 10 == 1, F.concat(F.lit(f"{FENCE}json\n"), F.col("body"), F.lit(f"\n{FENCE}")))
        .when(c % 10 == 2, F.concat(F.lit("<think>is it {this}?</think> "), F.col("body"), F.lit(" Hope it helps.")))
        .when(c % 10 == 3, F.substring("body", 1, 1))
        .when(c % 10 == 7, F.lit(None))
        .otherwise(F.col("body"))
    )
    # every call of each fourth customer was tried again: an older answer, and a later one that broke off
    tries = rows.select(c.alias("contract_id"), "model", "call", content.alias("content"), "elapsed_s", F.lit(2).alias("attempt"))
    good = ~(c % 10).isin(3, 4, 5, 6, 7)
    return tries.unionByName(rows.where((c % 4 == 0) & good).select(
        c.alias("contract_id"), "model", "call", F.lit(None).cast("string").alias("content"),
        F.lit(9.0).alias("elapsed_s"), F.lit(3).alias("attempt")))


def raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contract_id, field, kind, raw): dates, amounts and currencies of orders in many spellings."""
    k, day = F.col("k"), F.col("day")
    spelled = _pick(k % 8, ["ymd", "dmy", "mdy", "d month y", "d mois y", "month d, y", "ordinal", "short"])
    date = (
        F.when(spelled == "ymd", F.date_format(day, "yyyy/M/d"))
        .when(spelled == "dmy", F.date_format(day, "dd/MM/yyyy"))
        .when(spelled == "mdy", F.date_format(day, "MM-dd-yyyy"))
        .when(spelled == "d month y", F.date_format(day, "d MMMM yyyy"))
        .when(spelled == "d mois y", F.concat_ws(
            " ", F.dayofmonth(day).cast("string"), _pick(F.month(day) - 1, FRENCH_MONTHS), F.year(day).cast("string")))
        .when(spelled == "month d, y", F.date_format(day, "(MMMM d, yyyy)."))
        .when(spelled == "ordinal", F.date_format(day, "d'th' MMMM  yyyy"))
        .otherwise(F.date_format(day, "MMMM yyyy"))
    )
    money = F.format_number("o_totalprice", 2)
    amount = (
        F.when(k % 5 == 0, F.concat(F.lit("EUR "), money))
        .when(k % 5 == 1, F.translate(money, ",.", ".,"))
        .when(k % 5 == 2, F.translate(money, ",", " "))
        .when(k % 5 == 3, F.format_number("o_totalprice", 0))
        .otherwise("to be agreed")
    )
    token = _pick(k % 12, ["EUR", "usd", "GBP", "CHF", "CAD", "AUD", "JPY", "US$", "C$", "€", "£", "$"])
    cells = F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(t).alias("kind"), raw.alias("raw"))
        for f, t, raw in (("order_date", "date", date), ("order_total", "number", amount), ("order_currency", "currency", token))
    ])
    rows = _order_facts(spark, sf_dir).select(k.alias("contract_id"), F.explode(cells).alias("x"))
    return rows.select("contract_id", "x.*")
