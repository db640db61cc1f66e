from clauselens.functions import vocab as V
from clauselens.operators import extract as X


def test_payment_terms(one):
    assert one("payment_terms_days", "Fees are payable within thirty (30) days.", "Net 45 from invoice",
               "The current deadline is within 9 days.", "Paiement sous 60 jours.", "Wait within 5 days.") == [
        "30", "45", "9", "60", None]


def test_notice_days(one):
    assert one("termination_notice_days", "Either party may terminate on thirty (30) days notice.",
               "Terminate on 30 days notice.", "Terminate after 2 months or 30 days.",
               "La résiliation requiert un préavis de 45 jours.") == [None, "30", None, "45"]
    assert one("renewal_notice_days", "Renewal: give 20 calendar days notice.") == "20"


def test_renewal(one):
    assert one("auto_renewal", "The term shall not automatically renew.", "Without automatic renewal.",
               "Renouvelé par tacite reconduction.", "Sans reconduction tacite.", "Nothing.") == [
        "true", "false", "true", "false", None]


def test_term(one):
    assert one("contract_term", "The initial term is 24 months from Effective Date.", "Term of 2 years from start date",
               "The term is 12 months from the Effective Date.", "Durée de 3 ans à compter de la date d'effet",
               "Term: until 31 December 2028.", "Term until 05/06/2028", "Indefinite term") == [
        "24 months from Effective Date", "2 years from Start Date", None, "3 years from Effective Date", "until 2028-12-31", None, "indefinite"]
    assert one("contract_term", "Durée de 36 mois à compter de prise d'effet") == "36 months from Effective Date"


def test_periodicity(one):
    assert one("payment_periodicity", "A semi-annual fee applies.", "Fees are billed monthly. Rent is paid monthly.",
               "Fees increase; billed annually.", "Annual fee increase of the annual fee.", "Loyer mensuel.") == [
        "OTHER", "MONTHLY", None, None, "MONTHLY"]


def test_party(one):
    assert one("counterparty_name", "Customer:\nAcme SA", "Between A Ltd and Bolt GmbH, agreed", "entre A et Beta SARL (B)",
               "Vendor - X\nSupplier: Long Name (UK)") == ["Acme SA", "Bolt GmbH", "Beta SARL", "Long Name (UK)"]


def test_signatory(one):
    assert one("counterparty_signatory", "On behalf of Customer\nName: Ada Lovelace\n", "on behalf of client\nNom : ada",
               "Customer: x\nBy: Grace Hopper", "no block") == ["Ada Lovelace", None, "Grace Hopper", None]


def test_dates(one):
    assert one("effective_date", "Effective Date: 1 January 2025", "Effective Date March 3, 2024", "Date d'effet : 15/08/2025",
               "effective date: 05/05/2025, effective date: 2025-06-01", "Entrée en vigueur : 2 août 2024") == [
        "2025-01-01", None, "2025-08-15", "2025-06-01", "2024-08-02"]


def test_type_priority_and_quote(one, spark):
    assert one("primary_contract_type", "Intro\nLease agreement\nThis may end by termination", "Avenant au bail",
               "Released", "Accord\nBail\ncommercial") == [
        "MODIFICATION_AND_CLOSURE", "MODIFICATION_AND_CLOSURE", None, "REAL_ESTATE_AND_FACILITIES"]
    rows = spark.createDataFrame([(1, "x\nThe  Lease here")], "contract_id long, text string")
    assert X.extract_field(rows, "primary_contract_type").first().candidate.quote == "The Lease here"


def test_unwired_fields(one, spark):
    assert one("counterparty_contact_email", "Customer: a@b.com", "Our legal contact x@y.org; client mail c@d.fr",
               "customer a@b.com and c@d.com") == ["a@b.com", "c@d.fr", None]
    assert one("indexation", "ILC applies", "consumer price index only", "Revision: 3,0% each year", "Increase by 2% annually") == [
        "ILC index", None, "Fixed 3 percent annual increase", "Fixed 2 percent annual increase"]
    rows = spark.createDataFrame(
        [(1, "Total fees: EUR 120000"), (2, "Total fees: 120000 EUR"), (3, "Minimum annual commitment: £ 1,000\nTerm: 3 years")],
        "contract_id long, text string")
    got = {r.contract_id: r for r in X.extract_total_value(rows).collect()}
    assert [got[i].total_contract_value.value for i in (1, 2, 3)] == ["120.0", "120000.0", "3000.0"]
    assert got[3].total_contract_value.derived and got[3].currency.value == "GBP"


def test_currency(one):
    assert one("currency", "EUR 5 and € 6", "EUR and USD", "eur", "US$ 5", "$5") == ["EUR", None, None, "USD", None]


def test_long_clauses_and_late_parties_are_read_whole(one):
    assert one("payment_terms_days", "fee " + "x " * 300 + "net 30") == "30"
    pair = "between Alphamax Limited and Betamax Corporation (the parties)"
    for lead in (0, 3_960, 4_100, 50_000):
        assert one("counterparty_name", "x " * (lead // 2) + pair) == "Betamax Corporation"


def test_signatory_work_grows_with_the_lines(spark, one):
    import time

    began = time.time()
    assert one("counterparty_signatory", "Customer: x" + "\n" * 10_000 + "name: Jane Doe") is None
    assert one("counterparty_signatory", "Customer: x\n" * 80_000 + "end, no label by hand name") is None
    assert one("counterparty_signatory", "Customer: x\n" * 20_000 + "Name: Jane Doe") == "Jane Doe"
    assert time.time() - began < 20
    assert one("counterparty_signatory", "Signed on behalf of\nClient ACME\nTitle\nName: John Q Public") == "John Q Public"
    assert one("counterparty_signatory", "Supplier: ACME\nDate\nBy: Ann Lee") == "Ann Lee"


def test_wide_agrees_with_single_fields(spark, sf):
    from clauselens.sources import derived as D

    contracts = D.contracts(spark, sf).filter("contract_id < 60")
    wide = {r.contract_id: r for r in X.extract_wide(contracts).collect()}
    for field in ("contract_term", "payment_periodicity", "start_date"):
        for r in X.extract_field(contracts, field).collect():
            a, b = wide[r.contract_id][field], r.candidate
            assert (a and a.value) == (b and b.value)
    assert set(V.TEXT_FIRST_FIELDS) < set(wide[0].asDict())


def test_partitioning_does_not_matter(spark, sf):
    from clauselens.sources import derived as D

    contracts = D.contracts(spark, sf).filter("contract_id < 40")
    first = X.extract_candidates(contracts.repartition(1)).collect()
    second = X.extract_candidates(contracts.repartition(7)).collect()
    assert sorted(map(str, first)) == sorted(map(str, second))
