"""DuckDB SQL with the expected result of each query.

Contract fields are expected straight from the order columns the derived text was
composed of, so no extraction rule is repeated here.
"""

from __future__ import annotations

from clauselens.functions import vocab as V
from clauselens.operators.risk import CONFIDENCE_KEYS, SIGNALS, VECTOR_FIELDS

NL = "chr(10)"
MONTHS_FR = (
    "['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre']")


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def strings(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def case(*branches: tuple[str, str], otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {otherwise} END"


# --- documents ---------------------------------------------------------------

def squeezed(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def stripped(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def folded(x: str) -> str:
    return f"lower(strip_accents({x}))"


CLEAN = "text"
for _pattern, _replacement in (
    (r"(?m)^#{1,6}\s+", ""), (r"(?m)^\s*[-*_]{3,}\s*$", ""), (r"(?s)\*\*(.+?)\*\*|__(.+?)__", r"\1\2"),
    (r"(?s)\*(.+?)\*|_(.+?)_", r"\1\2"), (r"\n{3,}", "\n\n"),
):
    CLEAN = f"regexp_replace({CLEAN}, {text(_pattern)}, {text(_replacement)}, 'g')"
CLEAN = stripped(CLEAN)

LINES = f"""lines AS (
  SELECT doc_id AS contract_id, CASE WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END AS lines
  FROM (SELECT doc_id, string_split(text, {NL}) AS parts FROM documents))"""
NUMBERED = f"""{LINES}, numbered AS (
  SELECT contract_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_idx FROM lines)"""
CLAUSES = f"""pieces AS (
  SELECT doc_id AS contract_id, list_filter(list_transform(
    string_split_regex(regexp_replace(text, '([.;])\\s+', '\\1' || {NL}, 'g'), '\\n{{1,2}}'),
    lambda x: {squeezed('x')}), lambda x: x <> '') AS clauses
  FROM documents), clauses AS (
  SELECT contract_id, generate_subscripts(clauses, 1) - 1 AS clause_idx, unnest(clauses) AS raw FROM pieces),
  whole AS (SELECT contract_id, clause_idx, raw AS clause FROM clauses)"""


def occurrences(column: str, cues: list[str]) -> str:
    return " + ".join(
        f"CAST((length({column}) - length(replace({column}, {text(c)}, ''))) / {len(c)} AS INTEGER)" for c in cues)


def contains_any(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {text(w)})" for w in words) + ")"


def snippet_hit(fields: list[str]) -> str:
    return contains_any("folded", [w for f in fields for w in V.SNIPPET_KEYWORDS[f] if w.isascii() or w in "€£"])


def snippets_sql(fields: list[str], edges: int = 0) -> str:
    """Lines with a keyword and their neighbours, and so many lines of both edges."""
    return f"""WITH {NUMBERED}, folded AS (
  SELECT *, {folded('line')} AS folded FROM numbered), hits AS (
  SELECT contract_id, line, line_idx, {snippet_hit(fields)} AS hit,
  count(*) OVER (PARTITION BY contract_id) AS n
  FROM folded), near AS (
  SELECT *, bool_or(hit) OVER (PARTITION BY contract_id ORDER BY line_idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
    OR line_idx < {edges} OR line_idx >= n - {edges} AS keep
  FROM hits), islands AS (
  SELECT *, line_idx - row_number() OVER (PARTITION BY contract_id ORDER BY line_idx) AS island FROM near WHERE keep),
  blocks AS (
  SELECT contract_id, island, string_agg((line_idx + 1) || ': ' || line, {NL} ORDER BY line_idx)
    FILTER (WHERE trim(line) <> '') AS block FROM islands GROUP BY contract_id, island),
  joined AS (
  SELECT contract_id, string_agg(block, {NL} || {NL} ORDER BY island) AS s FROM blocks WHERE block IS NOT NULL GROUP BY contract_id)
SELECT d.doc_id AS contract_id, CASE
  WHEN NOT EXISTS (SELECT 1 FROM islands i WHERE i.contract_id = d.doc_id) THEN d.text ELSE s END AS snippets
FROM documents d LEFT JOIN joined j ON j.contract_id = d.doc_id"""


SNIPPETS = snippets_sql(["contract_term", "total_contract_value", "currency", "payment_periodicity", "indexation"])

# --- contracts derived from orders -------------------------------------------

FACTS = """f AS (
  SELECT o_orderkey AS k, c_name, o_totalprice AS price, CAST(o_orderdate AS DATE) AS day,
    CAST(o_orderdate AS DATE) + 30 AS start, CAST(o_orderdate AS DATE) + 365 AS end_day,
    format('{:,.2f}', o_totalprice) AS money
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""
TITLE = strings(["SERVICES AGREEMENT", "LEASE AGREEMENT", "LOAN AGREEMENT", "AMENDMENT TO SERVICES AGREEMENT"]) + "[k % 4 + 1]"
PARTY_LINE = case(
    ("k % 5 = 0", "'This agreement is made between Alpha Ltd and Beta Corp (the parties).'"), otherwise="'Customer: ' || c_name")
SIGNED_LINE = case(("k % 2 = 0", "'Signed on: ' || strftime(day, '%B %-d, %Y')"))
START_LINE = case(("k % 7 = 0", f"'Date de début : ' || day(start) || ' ' || {MONTHS_FR}[month(start)] || ' ' || year(start)"))
END_LINE = "'End Date: ' || strftime(end_day, '%d/%m/%Y')"
TERM_LINE = case(
    ("k % 3 = 0", "'The initial term is ' || 12 * (1 + k % 5) || ' months from Effective Date.'"),
    ("k % 3 = 1", "'The term is 12 months from the Effective Date.'"), otherwise="'This Agreement is of indefinite term.'")
BILLING_LINE = strings([
    "Fees are billed monthly.", "Fees are billed quarterly.", "Fees are billed annually.",
    "Fees are billed monthly and billed annually."]) + "[k % 4 + 1]"
PAYMENT_LINE = "'Fees are payable within ' || (15 + k % 76) || ' days.'"
TOTAL_LINE = case(("k % 8 = 1", "'Minimum annual commitment: EUR ' || money"), otherwise="'Total Fees: EUR ' || money")
INDEX_LINE = case(
    ("k % 6 = 0", "'Amounts follow the Syntec index.'"), ("k % 6 = 1", "'Amounts follow the ILC.'"),
    ("k % 6 = 2", "'Amounts follow the CPI.'"), ("k % 6 = 3", "'Amounts follow inflation.'"),
    ("k % 6 = 4", "'Amounts increase by ' || (1 + k % 9) || ',5% each year.'"))
NOTICE_LINE = "'Either party may terminate on ' || (30 + k % 61) || ' days notice.'"
RENEWAL_LINE = case(
    ("k % 3 = 0", "'This Agreement is subject to automatic renewal unless ' || (20 + k % 80) || ' days notice is given.'"),
    ("k % 3 = 1", "'No automatic renewal applies.'"))
MAIL_LINE = "'Customer contact email: c' || k || '@example.com'"
TEXT = f"""concat_ws({NL}, {TITLE}, '', {PARTY_LINE}, 'Effective Date: ' || day, {SIGNED_LINE}, {START_LINE}, {END_LINE}, '',
  {TERM_LINE}, {BILLING_LINE}, {PAYMENT_LINE}, {TOTAL_LINE}, {case(("k % 10 = 9", "'Travel costs are limited to USD 500.'"))},
  {INDEX_LINE}, '', {NOTICE_LINE}, {RENEWAL_LINE}, '', {MAIL_LINE}, 'Signed for and on behalf of Customer', 'Name: Signatory N' || k)"""

# field -> (value, quote, confidence, note)
EXPECTED = {
    "primary_contract_type": (
        strings(["SERVICES", "REAL_ESTATE_AND_FACILITIES", "FINANCE_AND_TREASURY", "MODIFICATION_AND_CLOSURE"]) + "[k % 4 + 1]",
        TITLE, "0.88", "NULL"),
    "counterparty_name": (
        case(("k % 5 = 0", "'Beta Corp'"), otherwise="c_name"),
        case(("k % 5 = 0", "'between Alpha Ltd and Beta Corp ('"), otherwise=PARTY_LINE),
        case(("k % 5 = 0", "0.7"), otherwise="0.96"),
        case(("k % 5 = 0", text(V.PAIR_NOTE)), otherwise=text(V.ROLE_NOTE))),
    "counterparty_signatory": (
        "'Signatory N' || k", "'for and on behalf of Customer Name: Signatory N' || k", "0.95", "NULL"),
    "signature_date": (case(("k % 2 = 0", "CAST(day AS VARCHAR)")), SIGNED_LINE, "0.95", "NULL"),
    "effective_date": ("CAST(day AS VARCHAR)", "'Effective Date: ' || day", "0.95", "NULL"),
    "start_date": (case(("k % 7 = 0", "CAST(start AS VARCHAR)")), START_LINE, "0.95", "NULL"),
    "end_date": (case(("day(end_day) > 12", "CAST(end_day AS VARCHAR)")), END_LINE, "0.95", "NULL"),
    "auto_renewal": (case(("k % 3 = 0", "'true'"), ("k % 3 = 1", "'false'")), RENEWAL_LINE, "0.95", "NULL"),
    "renewal_notice_days": (case(("k % 3 = 0", "CAST(20 + k % 80 AS VARCHAR)")), RENEWAL_LINE, "0.9", "NULL"),
    "termination_notice_days": ("CAST(30 + k % 61 AS VARCHAR)", NOTICE_LINE, "0.9", "NULL"),
    "contract_term": (
        case(("k % 3 = 0", "12 * (1 + k % 5) || ' months from Effective Date'"), ("k % 3 = 2", "'indefinite'")),
        TERM_LINE, case(("k % 3 = 0", "0.9"), otherwise="0.92"), "NULL"),
    "currency": (case(("k % 10 <> 9", "'EUR'")), "'EUR'", "0.75", "NULL"),
    "payment_periodicity": (
        strings(["MONTHLY", "QUARTERLY", "ANNUAL", "OTHER"]) + "[k % 4 + 1]", BILLING_LINE,
        case(("k % 4 = 3", "0.7"), otherwise="0.92"), case(("k % 4 = 3", text(V.PERIODICITY_MIXED_NOTE)))),
    "payment_terms_days": ("CAST(15 + k % 76 AS VARCHAR)", PAYMENT_LINE, "0.95", "NULL"),
    "counterparty_contact_email": ("'c' || k || '@example.com'", MAIL_LINE, "0.96", "NULL"),
    "indexation": (
        case(("k % 6 = 0", "'Syntec index'"), ("k % 6 = 1", "'ILC index'"), ("k % 6 = 2", "'Annual CPI adjustment'"),
             ("k % 6 = 3", "'Annual inflation-linked adjustment'"),
             ("k % 6 = 4", "'Fixed ' || (1 + k % 9) || '.5 percent annual increase'")),
        INDEX_LINE, case(("k % 6 < 2", "0.95"), ("k % 6 = 2", "0.92"), otherwise="0.9"), "NULL"),
}


def field_oracle(field: str) -> str:
    value, quote, confidence, note = EXPECTED[field]
    shown = "CASE WHEN v IS NOT NULL THEN {} END"
    return f"""WITH {FACTS} SELECT k AS contract_id, v AS value, {shown.format(quote)} AS quote,
  {shown.format(note)}::VARCHAR AS note, {shown.format(f"CAST({confidence} AS DOUBLE)")} AS confidence
  FROM (SELECT *, {value} AS v FROM f)"""


def long_candidates(columns: str) -> str:
    parts = [
        f"SELECT k AS contract_id, '{f}' AS field, {value} AS value, CAST({confidence} AS DOUBLE) AS confidence, "
        f"{V.LOCK_THRESHOLDS[f]} AS lim FROM f"
        for f, (value, _, confidence, _) in EXPECTED.items() if f in V.TEXT_FIRST_FIELDS
    ]
    return f"WITH {FACTS}, c AS ({' UNION ALL '.join(parts)}) SELECT contract_id, field, value, {columns} FROM c WHERE value IS NOT NULL"


YEARS = case(("k % 3 = 0", "1 + k % 5"), ("k % 3 = 1", "1"))
TOTAL_VALUE = f"""WITH {FACTS}, t AS (
  SELECT *, {YEARS} AS years, k % 8 = 1 AS yearly, {TERM_LINE} AS term FROM f), v AS (
  SELECT *, CASE WHEN yearly THEN round(price, 2) * years ELSE round(price, 2) END AS value FROM t)
SELECT k AS contract_id, value, CASE WHEN value IS NOT NULL THEN 'EUR' END AS currency,
  CASE WHEN value IS NULL THEN NULL WHEN yearly THEN {TOTAL_LINE} || ' | ' || term ELSE {TOTAL_LINE} END AS quote,
  CASE WHEN value IS NOT NULL AND yearly THEN CASE WHEN years = 1 THEN {text(V.TOTAL_ONE_YEAR_NOTE)}
    ELSE replace({text(V.TOTAL_DERIVED_NOTE)}, '%s', term) END END AS note,
  CASE WHEN value IS NOT NULL THEN yearly AND years <> 1 END AS derived FROM v"""

# what the text leaves open, in routing order
_ASKED = {
    "counterparty_name": "k % 5 = 0", "signature_date": "k % 2 <> 0", "start_date": "k % 7 <> 0",
    "end_date": "day(end_day) <= 12", "auto_renewal": "k % 3 = 2", "renewal_notice_days": "k % 3 <> 0",
    "contract_term": "k % 3 = 1", "currency": "TRUE", "payment_periodicity": "k % 4 = 3",
    "internal_entity": "TRUE", "counterparty_contact_email": "TRUE", "total_contract_value": "TRUE", "indexation": "TRUE",
}
ASKED = {f: _ASKED[f] for f in V.ROUTED_FIELDS if f in _ASKED}


def joined_missing(sep: str) -> str:
    return f"concat_ws({text(sep)}, " + ", ".join(case((c, text(f))) for f, c in ASKED.items()) + ")"


_LOCK_ORDER = [
    "primary_contract_type", "counterparty_name", "counterparty_signatory", "signature_date", "effective_date",
    "start_date", "end_date", "contract_term", "payment_terms_days", "termination_notice_days", "auto_renewal",
    "renewal_notice_days", "payment_periodicity",
]


def locked_json() -> str:
    cells = []
    for f in _LOCK_ORDER:
        value, _, confidence, _ = EXPECTED[f]
        mark = "" if f in V.FIELD_TYPES else '"'
        cells.append(case((f"{value} IS NOT NULL AND {confidence} >= {V.LOCK_THRESHOLDS[f]}",
                           f"""'"{f}": {mark}' || {value} || '{mark}'""")))
    return "'{' || concat_ws(', ', " + ", ".join(cells) + ") || '}'"


def prompt() -> str:
    rules = f"concat_ws({NL}, " + ", ".join(
        case((c, text(f"- {f}: {V.REQUEST_RULES[f]}"))) for f, c in ASKED.items()) + ")"
    pieces = [text("\n\n".join(V.REQUEST_OPENING)),
              f"""'requested_fields: ["' || {joined_missing('", "')} || '"]'""", f"'locked_values: ' || {locked_json()}",
              f"'Field rules:' || {NL} || {rules}",
              f"'<contract_snippets>' || {NL} || snippets || {NL} || '</contract_snippets>'"]
    return f"concat_ws({NL} || {NL}, {', '.join(pieces)})"


REQUESTS = f"""WITH {FACTS}, texts AS (SELECT *, string_split({TEXT}, {NL}) AS lines FROM f), s AS (
  SELECT *, array_to_string(list_filter(list_transform(lines, lambda x, i: CASE WHEN x <> '' THEN i || ': ' || x END),
    lambda x: x IS NOT NULL), {NL}) AS snippets FROM texts)
SELECT k AS contract_id, 1 AS part, 1 AS parts, {joined_missing(',')} AS requested, snippets, {prompt()} AS prompt FROM s"""

# first answers: usable unless truncated, with an unknown key, or absent; some requests were asked in two parts
FIRST = "k % 10 NOT IN (3, 4, 5)"
SPLIT = "k % 7 = 3"
SECOND = f"({SPLIT} AND k % 3 <> 2 AND k % 10 <> 5)"
GOOD = f"({FIRST} OR {SECOND})"
ANSWERS = {
    "internal_entity": "'Alpha Holdings'", "counterparty_contact_email": "'c' || k || '@example.com'",
    "total_contract_value": case(("k % 2 = 0", "price")), "indexation": "NULL", "currency": "'EUR'",
    "counterparty_name": "'Beta Corp Ltd'", "signature_date": "NULL", "start_date": "NULL",
    "end_date": "CAST(end_day AS VARCHAR)", "auto_renewal": "'false'", "renewal_notice_days": "NULL",
    "contract_term": "'12 months from Effective Date'", "payment_periodicity": "'MONTHLY'",
}


def answered(field: str) -> str:
    """The model's value where it was asked and its answer is usable."""
    if field == "internal_entity":
        return case((f"{FIRST} AND {SECOND} AND k % 3 = 1", "NULL"), (FIRST, "'Alpha Holdings'"), (f"{SECOND} AND k % 3 = 1", "'Beta Holdings'"))
    if field == "currency":
        return case((f"{SECOND} OR ({FIRST} AND NOT {SPLIT})", "'EUR'"))
    value = ANSWERS[field] if field in ANSWERS else "NULL"
    return case((f"{FIRST} AND {ASKED.get(field, 'FALSE')}", value))


def local_locked(field: str) -> str:
    if field not in V.LOCK_THRESHOLDS:
        return "NULL"
    value, _, confidence, _ = EXPECTED[field]
    return case((f"{confidence} >= {V.LOCK_THRESHOLDS[field]}", value))


def final_value(field: str) -> str:
    types = {"boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE"}
    kind = types.get(V.FIELD_TYPES.get(field, ""), "VARCHAR")
    return f"CAST(coalesce(CAST({local_locked(field)} AS VARCHAR), CAST({answered(field)} AS VARCHAR)) AS {kind}) AS {field}"


def merged_rows() -> str:
    parts = []
    for f in V.ROUTED_FIELDS:
        local = EXPECTED[f][0] if f in V.TEXT_FIRST_FIELDS else "NULL"
        locked, answer = local_locked(f), f"CAST({answered(f)} AS VARCHAR)"
        # an unusable answer leaves weak local values in place; a usable one replaces or clears them
        value = case((f"{locked} IS NOT NULL", locked), (GOOD, answer), otherwise=local)
        source = case((f"{locked} IS NOT NULL OR NOT ({GOOD})", "'regex'"), otherwise="'llm'")
        parts.append(f"SELECT k AS contract_id, '{f}' AS field, {value} AS value, {source} AS source FROM f")
    return f"""WITH {FACTS}, m AS ({' UNION ALL '.join(parts)})
SELECT contract_id, field, CASE WHEN field = 'total_contract_value' THEN CAST(round(CAST(value AS DOUBLE), 2) AS VARCHAR) ELSE value END AS value, source
FROM m WHERE value IS NOT NULL"""


FINAL_WARNINGS = "concat_ws(' | ', " + ", ".join([
    case(("k % 4 = 3", text(V.PERIODICITY_MIXED_WARNING))),
    case(("k % 10 = 5", text(V.SKIPPED_WARNING)), ("k % 10 = 3", text(V.FAILED_WARNING % "ValueError")),
         ("k % 10 = 4", text(V.FAILED_WARNING % "ValidationError")), otherwise="'checked'"),
    case((SECOND, "'second part'")),
    case((f"{FIRST} AND {SECOND} AND k % 3 = 1", text(V.PART_CONFLICT_WARNING % "internal_entity"))),
    case((f"{SPLIT} AND k % 3 = 2 AND k % 10 <> 5", text(V.PART_MISSING_WARNING % (1, 2)))),
]) + ")"
FINAL = f"""WITH {FACTS} SELECT k AS contract_id,
  {', '.join(final_value(f) if f in V.ROUTED_FIELDS else f'CAST(NULL AS VARCHAR) AS {f}' for f in V.ALL_FIELDS)},
  {case(("k % 5 <> 0", PARTY_LINE), (FIRST, "'as stated'"))} AS name_quote,
  CASE WHEN {answered("internal_entity")} IS NOT NULL THEN 'as stated' END AS entity_quote,
  {PAYMENT_LINE} AS terms_quote, {FINAL_WARNINGS} AS warnings FROM f"""


def resolve_rows() -> str:
    parts = []
    for f in V.ROUTED_FIELDS:
        local, conf = (EXPECTED[f][0], EXPECTED[f][2]) if f in V.TEXT_FIRST_FIELDS else ("NULL", "NULL")
        parts.append(f"""SELECT k AS contract_id, '{f}' AS field, CAST({local} AS VARCHAR) AS l, CAST({conf} AS DOUBLE) AS lc,
          CAST({answered(f)} AS VARCHAR) AS a FROM f""")
    return f"""WITH {FACTS}, r AS ({' UNION ALL '.join(parts)}), pairs AS (
      SELECT *, l IS NOT NULL AND a IS NOT NULL AND l <> a AS conflict FROM r WHERE l IS NOT NULL OR a IS NOT NULL)
    SELECT contract_id, field, CASE WHEN NOT conflict THEN coalesce(l, a) END AS value,
      CASE WHEN NOT conflict THEN CASE WHEN l IS NOT NULL THEN lc ELSE 0.6 END END AS confidence,
      CASE WHEN NOT conflict THEN CASE WHEN l IS NOT NULL THEN 'regex' ELSE 'llm' END END AS source,
      CASE WHEN conflict THEN 'Conflicting local matches for ' || field || '; leaving it for LLM resolution.' END AS warning
    FROM pairs"""


RECOVER = f"""WITH {FACTS} SELECT k AS contract_id, 1 AS part, k % 10 <> 3 AS recovered,
  {case(("k % 10 <> 3", "'Alpha Holdings'"))} AS internal_entity,
  {case(("k % 10 <> 3 AND k % 2 = 0", "round(price, 2)"))} AS total_contract_value FROM f WHERE k % 10 <> 5
UNION ALL SELECT k, 2, TRUE, {case(("k % 3 = 1", "'Beta Holdings'"))}, NULL FROM f WHERE {SECOND}"""

# --- raw values --------------------------------------------------------------

RAW = f"""{FACTS}, raw AS (
  SELECT k AS contract_id, 'order_date' AS field, 'date' AS kind, {case(
    ("k % 8 = 0", "strftime(day, '%Y/%-m/%-d')"), ("k % 8 = 1", "strftime(day, '%d/%m/%Y')"),
    ("k % 8 = 2", "strftime(day, '%m-%d-%Y')"), ("k % 8 = 3", "strftime(day, '%-d %B %Y')"),
    ("k % 8 = 4", f"day(day) || ' ' || {MONTHS_FR}[month(day)] || ' ' || year(day)"),
    ("k % 8 = 5", "strftime(day, '(%B %-d, %Y).')"), ("k % 8 = 6", "strftime(day, '%-dth %B  %Y')"),
    otherwise="strftime(day, '%B %Y')")} AS raw,
    {case(("k % 8 = 7 OR (k % 8 IN (1, 2) AND day(day) <= 12)", "NULL"), otherwise="CAST(day AS VARCHAR)")} AS value FROM f
  UNION ALL SELECT k, 'order_total', 'number', {case(
    ("k % 5 = 0", "'EUR ' || money"), ("k % 5 = 1", "translate(money, ',.', '.,')"), ("k % 5 = 2", "replace(money, ',', ' ')"),
    ("k % 5 = 3", "format('{:,}', CAST(round_even(price, 0) AS BIGINT))"), otherwise="'to be agreed'")},
    {case(("k % 5 < 3", "CAST(round(price, 2) AS VARCHAR)"), ("k % 5 = 3", "CAST(CAST(round_even(price, 0) AS DOUBLE) AS VARCHAR)"))} FROM f
  UNION ALL SELECT k, 'order_currency', 'currency',
    ['EUR','usd','GBP','CHF','CAD','AUD','JPY','US$','C$','€','£','$'][k % 12 + 1],
    ['EUR','USD','GBP','CHF','CAD','AUD','JPY','USD','CAD','EUR','GBP',NULL][k % 12 + 1] FROM f)"""

# --- classification responses from customer ----------------------------------

PEOPLE = "p AS (SELECT c_custkey AS c, m.model FROM customer, (VALUES ('model-a'), ('model-b')) m(model))"
BROKEN = case(
    ("c % 10 = 3", text(V.ERR_UNBALANCED)), ("c % 10 = 7", text(V.ERR_NULL_CONTENT)))
PLACED = "(c % 3 = 0 AND c % 9 <> 0)"
# a country without a court: named country, court left out
HALF = f"(c % 10 = 5)"
TYPE_ERROR = f"coalesce({BROKEN}, {case((HALF, text('jurisdiction_country and jurisdiction_court_type must both be set or both be NULL.')))})"
TYPE_VALUES = {
    "contract_type_primary": case(
        ("model = 'model-b' AND c % 6 = 0", "'SUPPLY_AND_TRADE'"),
        otherwise="['SERVICES','SUPPLY_AND_TRADE','FINANCE_AND_TREASURY'][c % 3 + 1]"),
    "subject_matter": "'Real Estate & Facilities'",
    "governing_law": "['English law', NULL, NULL, 'French law'][c % 4 + 1]",
    "jurisdiction_city": case((PLACED, "'PARIS'")),
    "jurisdiction_country": case((PLACED, "'FR'")),
    "jurisdiction_court_type": case((PLACED, "'COMMERCIAL'")),
    "contract_language": "'English'",
}
TYPES = f"""{PEOPLE}, types AS (SELECT c, model, {TYPE_ERROR} AS error,
  {', '.join(f'CASE WHEN {TYPE_ERROR} IS NULL THEN {v} END AS {n}' for n, v in TYPE_VALUES.items())},
  CASE WHEN {TYPE_ERROR} IS NULL AND c % 4 <> 0 THEN 'DATA_PRIVACY' ELSE '' END AS contract_type_secondary FROM p)"""
SECTOR_ERROR = f"coalesce({BROKEN}, {case(('c % 10 = 4', text('Unrecognised sector label(s): Space Mining')))})"
SECTORS = f"""sectors AS (SELECT c, model, {SECTOR_ERROR} AS error,
  CASE WHEN {SECTOR_ERROR} IS NULL AND c % 5 <> 0 AND c % 3 = 0 THEN 'Energy; Transport' ELSE '' END AS regulated_sectors
  FROM p WHERE c % 10 <> 8)"""
RISK_ERROR = f"coalesce({BROKEN}, {case(('c % 10 = 6', text('data_sensitivity: a whole number is required')))})"
RISK_VALUES = {
    "counterparty_leverage": "['SUPPLIER','CUSTOMER','BALANCED','UNCLEAR'][c % 4 + 1]",
    "termination_risk": "[4, 5, 2, 3][c % 4 + 1]", "data_sensitivity": "CAST(greatest(1, least(5, c % 7)) AS INTEGER)",
    "ip_ownership_risk": "'UNCLEAR'", "payment_risk": "[3, 1, 1][c % 3 + 1]", "auto_renewal_risk": "1",
    "confidentiality_scope": "'MUTUAL'", "liability_cap_adequacy": "CAST(1 + c % 5 AS INTEGER)",
}
RISKS = f"""risks AS (SELECT c, model, {RISK_ERROR} AS error,
  {', '.join(f'CASE WHEN {RISK_ERROR} IS NULL THEN {v} END AS {n}' for n, v in RISK_VALUES.items())} FROM p)"""

REJECTS = f"""WITH {TYPES}, {SECTORS}, {RISKS}, tries AS (SELECT 'type' AS call, error AS reason, c FROM types
  UNION ALL SELECT 'sector', error, c FROM sectors UNION ALL SELECT 'risk', error, c FROM risks), again AS (SELECT call, reason FROM tries
  UNION ALL SELECT call, {text(V.ERR_NULL_CONTENT)} FROM tries WHERE c % 4 = 0 AND c % 10 NOT IN (3, 4, 5, 6, 7))
SELECT call, reason, count(*) AS responses FROM again WHERE reason IS NOT NULL GROUP BY call, reason"""
# the texts of the three answers, as they are composed
TYPE_RAW = """'{"contract_type_primary":"' || CASE WHEN model = 'model-b' AND c % 6 = 0 THEN ' SUPPLY_AND_TRADE '
    ELSE ['SERVICES','SUPPLY_AND_TRADE','FINANCE_AND_TREASURY'][c % 3 + 1] END || '","contract_type_secondary":'
  || CASE WHEN c % 4 <> 0 THEN '["DATA_PRIVACY"]' ELSE 'null' END || ',"subject_matter":" Real Estate & Facilities","governing_law":"'
  || ['English law', 'N/A', ' null ', 'French law'][c % 4 + 1] || '","jurisdiction_city":"' || CASE WHEN c % 3 = 0 THEN ' Paris' ELSE 'null' END
  || '","jurisdiction_country":"' || CASE WHEN c % 3 = 0 AND c % 9 <> 0 THEN 'fr' WHEN c % 10 = 5 THEN 'gb' ELSE '' END
  || '","jurisdiction_court_type":"' || CASE WHEN c % 3 = 0 AND c % 9 <> 0 AND c % 10 <> 5 THEN 'commercial' ELSE 'N/A' END
  || '","contract_language":"English "}'"""
SECTOR_RAW = """CASE WHEN c % 5 = 0 THEN '{"regulated_sectors":[" N/A "]}' WHEN c % 3 = 0 THEN '{"regulated_sectors":[" Energy ","Transport"]}' ELSE '{}' END"""
RISK_RAW = """'{"counterparty_leverage": "' || ['supplier', ' Customer ', 'BALANCED', 'whoever'][c % 4 + 1] || '", "termination_risk": '
  || ['4', '9', '"2"', 'null'][c % 4 + 1] || ', "data_sensitivity": ' || (c % 7) || ', "ip_ownership_risk": null, "payment_risk": '
  || ['3.9', 'true', '-2'][c % 3 + 1] || ', "confidentiality_scope": "mutual", "liability_cap_adequacy": ' || (1 + c % 5) || '}'"""
RAW_RESPONSES = f"""WITH {PEOPLE} SELECT c AS contract_id, model, CASE WHEN {TYPE_ERROR} IS NULL THEN md5({TYPE_RAW}) END AS raw_response,
  CASE WHEN {SECTOR_ERROR} IS NULL AND c % 10 <> 8 THEN md5({SECTOR_RAW}) END AS sector_raw_response,
  CASE WHEN {RISK_ERROR} IS NULL THEN md5({RISK_RAW}) END AS risk_vector_raw_response FROM p"""
ROUND_TRIP = f"""SELECT printf('S_%06d', k) AS contract_id, (k % 4)::INTEGER AS bucket, 'SERVICES' AS primary_contract_type,
  'Northwind ' || k AS counterparty_name, CASE WHEN k % 3 <> 0 THEN (15 + k % 76)::INTEGER END AS payment_terms_days,
  CASE WHEN k % 4 <> 0 THEN (30 + k % 61)::INTEGER END AS termination_notice_days, NULL::VARCHAR AS currency,
  CASE WHEN k % 5 = 0 THEN FALSE END AS auto_renewal, 'Customer: Northwind ' || k AS name_quote, {text(V.SKIPPED_WARNING)} AS warnings
FROM (SELECT s_suppkey AS k FROM supplier)"""

# --- claims from lineitem ----------------------------------------------------

FAMILIES = strings([
    "liability_cap", "termination_notice", "payment_terms", "ip_licence", "auto_renewal", "data_retention",
    "dispute_resolution", "governing_law", "agreement_term", "warranty", "indemnity"])
LAWS = strings(["French law", "Laws of England", "State of Delaware", "German law", "Dutch law", "Swiss law"])


def stated(value: str) -> str:
    return f"CASE WHEN st THEN {value} END"


PROJECTION = {
    "cap_present": stated("odd"), "cap_amount": stated("round(price, 2)"), "cap_currency": stated("'EUR'"),
    "cap_formula_fees_paid": stated("third"), "cap_formula_multiplier_value": stated("CAST(l_suppkey % 4 + 0.5 AS DOUBLE)"),
    "mutual_cap": stated("NOT odd"), "carveout_fraud": stated("odd"), "carveout_gross_negligence": stated("third"),
    "carveout_wilful_misconduct": stated("NOT odd"), "carveout_count": stated("q % 5"),
    "excludes_indirect_damages": stated("NOT odd"), "termination_for_convenience": "odd",
    "notice_period_normalized_days": stated("q * 10.0"), "termination_for_breach": "NOT odd",
    "cure_period_normalized_days": stated("q * 1.0"), "insolvency_trigger": "third",
    "payment_due_normalized_days": stated("q * 2.0"), "late_interest": stated("odd"), "invoice_trigger": "NOT odd",
    "ip_ownership_assigned": "odd", "exclusive": "NOT odd", "sublicence_permitted": "third", "perpetual_licence": stated("odd"),
    "auto_renewal": stated("odd"), "renewal_term_normalized_months": stated("q * 1.0"),
    "nonrenewal_notice_normalized_days": stated("CASE WHEN third THEN 0.0 ELSE q * 3.0 END"),
    "nonrenewal_notice_value": "q * 1.0", "fr_mandatory_notice_risk": "third", "dpa_present": "odd",
    "cross_border_transfer_mentioned": stated("NOT odd"), "retention_period_normalized_days": stated("q * 30.0"),
    "dispute_resolution_type": stated("['arbitration','mediation','litigation'][q % 3 + 1]"),
    "arbitration_institution": "CASE WHEN third THEN 'icc' END", "governing_law": stated(f"{LAWS}[q % 6 + 1]"),
    "initial_term_normalized_months": stated("q * 12.0"), "indefinite_term": "third", "warranty_given": "odd",
    "disclaimer_present": stated("NOT odd"), "warranty_period_normalized_days": stated("q * 7.0"),
    "indemnity_uncapped": stated("odd"), "mutual_indemnity": "NOT odd", "indemnity_direction": stated("['supplier','customer'][q % 2 + 1]"),
}
CLAIMS = f"""base AS (
  SELECT l_orderkey AS contract_id, l_suppkey, l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS q, l_suppkey % 3 <> 0 AS st,
    CAST(l_quantity AS INTEGER) % 2 = 1 AS odd, CAST(l_quantity AS INTEGER) % 3 = 0 AS third,
    round(l_discount * 10, 2) AS conf, {FAMILIES}[l_partkey % 11 + 1] AS family,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS seq
  FROM lineitem), claims AS (
  SELECT contract_id, seq, family, conf, {', '.join(f'{v} AS p_{k}' for k, v in PROJECTION.items())} FROM base)"""


def last(family: str, column: str) -> str:
    """Value of the last claim of a family, nulls included."""
    return f"arg_max_null({column}, seq) FILTER (WHERE family = '{family}')"


VECTOR_TYPES = {"boolean": "BOOLEAN", "double": "DOUBLE", "string": "VARCHAR"}
_CATEGORY = """CASE WHEN governing_law IS NULL THEN NULL WHEN contains(lower(governing_law), 'french') THEN 'french'
  WHEN contains(lower(governing_law), 'england') THEN 'english' WHEN contains(lower(governing_law), 'delaware') THEN 'us_ny'
  WHEN contains(lower(governing_law), 'german') THEN 'german' WHEN contains(lower(governing_law), 'dutch') THEN 'dutch' ELSE 'other' END"""
VECTORS = f"""{CLAIMS}, last AS (
  SELECT contract_id, count(*) FILTER (WHERE family = 'liability_cap') > 0 AS cap_present,
    {', '.join(
        (f"coalesce({last(f, 'p_' + k)}, FALSE)" if t == 'boolean' else f"CAST({last(f, 'p_' + k)} AS {VECTOR_TYPES[t]})") + f' AS {n}'
        for n, (f, k, t) in VECTOR_FIELDS.items())},
    {', '.join(f"{last(f, 'conf')} AS {n}_conf" for f, n in CONFIDENCE_KEYS.items())}
  FROM claims GROUP BY contract_id), vectors AS (
  SELECT *, CAST(cap_carveout_fraud AS INTEGER) + CAST(cap_carveout_gross_negligence AS INTEGER)
    + CAST(cap_carveout_wilful_misconduct AS INTEGER) AS cap_carveout_count, {_CATEGORY} AS governing_law_category FROM last)"""


def grade(column: str) -> str:
    return f"CASE WHEN {column} > 0.7 THEN 'HIGH' WHEN {column} IS NOT NULL THEN 'MEDIUM' END"


ASSEMBLE = f"""WITH {VECTORS} SELECT contract_id, cap_present, {', '.join(VECTOR_FIELDS)}, cap_carveout_count, governing_law_category,
  NOT cap_present AS liability_cap_absent, {', '.join(
    (f"coalesce({grade(f'{n}_conf')}, 'ABSENT')" if n == 'cap' else grade(f'{n}_conf')) + f' AS {n}_grade' for n in CONFIDENCE_KEYS.values())},
  CASE WHEN cap_present THEN 'liability_cap' END AS cap_source FROM vectors"""


def flag01(c: str) -> str:
    return f"CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


SIMILARITY = {
    "cap_present": flag01("cap_present"),
    "cap_level": """CASE WHEN cap_is_fees_multiple AND cap_multiplier IS NOT NULL THEN cap_multiplier / (cap_multiplier + 1)
      WHEN cap_amount_raw IS NOT NULL THEN least((cap_amount_raw / val) / ((cap_amount_raw / val) + 1), 1.0) ELSE 0.5 END""",
    "cap_mutual": flag01("cap_mutual"), "carveout_count_norm": "least(cap_carveout_count / 3.0::DOUBLE, 1.0)",
    "consequential_excluded": flag01("consequential_loss_excluded"),
    "termination_convenience": flag01("termination_for_convenience"),
    "notice_period_norm": "CASE WHEN convenience_notice_days IS NULL THEN 0.5 ELSE least(convenience_notice_days / 365.0::DOUBLE, 1.0) END",
    "insolvency_trigger": flag01("insolvency_trigger"), "ip_assigned": flag01("ip_ownership_assigned"),
    "ip_exclusive": flag01("ip_licence_exclusive"), "ip_perpetual": flag01("ip_perpetual"), "auto_renewal": flag01("auto_renewal"),
    "renewal_notice_norm": "CASE WHEN non_renewal_notice_days IS NULL THEN 0.5 ELSE least(non_renewal_notice_days / 90.0::DOUBLE, 1.0) END",
    "fr_notice_risk": flag01("fr_mandatory_notice_risk"), "dpa_present": flag01("dpa_present"),
    "cross_border": flag01("cross_border_transfer"), "warranty_given": flag01("warranty_given"),
    "as_is_disclaimer": flag01("as_is_disclaimer"), "dispute_arbitration": flag01("dispute_mechanism = 'arbitration'"),
    "dispute_litigation": flag01("dispute_mechanism = 'litigation'"),
}
SIMILARITY_SQL = f"""WITH {VECTORS}, x AS (SELECT *, (contract_id % 50 + 1) * 1000.0::DOUBLE AS val FROM vectors)
SELECT contract_id, governing_law_category, {', '.join(f'round(CAST({v} AS DOUBLE), 9) AS {k}' for k, v in SIMILARITY.items())} FROM x"""



def neighbours(rows: str, k: int) -> str:
    """The k most similar rows to every twentieth one in (id, category, v)."""
    return f"""{rows}, u AS (SELECT id, category, v, sqrt(list_dot_product(v, v)) AS len FROM r),
p AS (SELECT a.id, b.id AS similar_id, round(list_dot_product(a.v, b.v) / (a.len * b.len), 9) AS similarity
  FROM u a JOIN u b ON a.id % 20 = 0 AND a.category IS NOT DISTINCT FROM b.category AND a.id <> b.id WHERE a.len > 0 AND b.len > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, similar_id) AS rank FROM p)"""


SIMILAR_SQL = neighbours(f"""WITH {VECTORS}, x AS (SELECT *, (contract_id % 50 + 1) * 1000.0::DOUBLE AS val FROM vectors),
r AS (SELECT contract_id AS id, governing_law_category AS category, [{', '.join(f'CAST({v} AS DOUBLE)' for v in SIMILARITY.values())}] AS v FROM x)""", 5)
EMBEDDING_SQL = neighbours("WITH r AS (SELECT vec_id AS id, label AS category, embedding::DOUBLE[] AS v FROM embeddings)", 5)
UNKNOWN = {
    "cap_level": "NOT coalesce((cap_is_fees_multiple AND cap_multiplier IS NOT NULL) OR cap_amount_raw IS NOT NULL, FALSE)",
    "notice_period_norm": "convenience_notice_days IS NULL", "renewal_notice_norm": "non_renewal_notice_days IS NULL",
}
MEDIAN_SQL = f"""WITH {VECTORS}, x AS (SELECT *, (contract_id % 50 + 1) * 1000.0::DOUBLE AS val FROM vectors),
y AS (SELECT contract_id, governing_law_category AS category, {', '.join(
    f'CAST({v} AS DOUBLE) AS {k}' if k not in UNKNOWN else f'CASE WHEN NOT ({UNKNOWN[k]}) THEN CAST({v} AS DOUBLE) END AS {k}' for k, v in SIMILARITY.items())} FROM x),
m AS (SELECT category AS c, {', '.join(f'quantile_disc({k}, 0.5) AS m_{k}' for k in UNKNOWN)} FROM y GROUP BY category)
SELECT contract_id, category, {', '.join(f'round(coalesce({k}, m_{k}, 0.5), 9) AS {k}' if k in UNKNOWN else f'round({k}, 9) AS {k}' for k in SIMILARITY)},
  concat_ws(',', {', '.join(f"CASE WHEN {k} IS NULL THEN '{k}' END" for k in UNKNOWN)}) AS imputed FROM y JOIN m ON category IS NOT DISTINCT FROM c"""

SIGNAL_FAMILIES = list(dict.fromkeys(f for f, _, _ in SIGNALS.values()))
BEST = f"""{CLAIMS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY contract_id, family ORDER BY conf DESC, seq) AS rn FROM claims
  WHERE family IN ({', '.join(text(f) for f in SIGNAL_FAMILIES)})), best AS (SELECT * FROM ranked WHERE rn = 1)"""


def best_value(family: str, column: str) -> str:
    return f"max({column}) FILTER (WHERE family = '{family}')"


def signal_value(name: str) -> str:
    family, key, kind = SIGNALS[name]
    value = best_value(family, f"p_{key}")
    if kind == "boolean":
        return f"coalesce({best_value(family, f'CAST(p_{key} AS INTEGER)')}, 0) = 1"
    if name == "_det_carveout_count":
        return f"CAST(coalesce({value}, 0) AS INTEGER)"
    if name == "_det_nonrenewal_notice_days":
        return f"CAST(coalesce(nullif({value}, 0), {best_value(family, 'p_nonrenewal_notice_value')}) AS DOUBLE)"
    return f"CAST({value} AS {VECTOR_TYPES[kind]})"


SIGNAL_ROWS = f"""{BEST}, signals AS (
  SELECT c_custkey AS contract_id, {', '.join(f'{signal_value(n)} AS "{n}"' for n in SIGNALS)}
  FROM customer LEFT JOIN best ON best.contract_id = c_custkey GROUP BY c_custkey)"""

# --- records from customer ---------------------------------------------------


def picked(labels: list[str]) -> str:
    return case(("c % 11 = 0", "NULL"), ("c % 13 = 0", "'SOMETHING'"), otherwise=f"{strings(labels)}[c % {len(labels)} + 1]")


_SCOPES = ["MUTUAL", "UNILATERAL_SUPPLIER", "UNILATERAL_CUSTOMER", "NONE", "UNCLEAR"]
RECORDS = f"""rec AS (
  SELECT c_custkey AS c, c_custkey % 3 <> 0 AS en, 1 + c_custkey % 6 AS term, 1 + c_custkey % 4 AS data,
    c_custkey % 3 * 2 AS pay, CASE WHEN c_custkey % 7 <> 0 THEN 1 + c_custkey % 5 END AS ren, 1 + (c_custkey + 2) % 5 AS cap,
    {picked(["SUPPLIER", "CUSTOMER", "BALANCED", "UNCLEAR"]).replace("c %", "c_custkey %")} AS lev,
    {picked(["SUPPLIER", "CUSTOMER", "JOINT", "UNCLEAR"]).replace("c %", "c_custkey %")} AS ip,
    {picked(_SCOPES).replace("c %", "c_custkey %")} AS scope
  FROM customer), det AS (
  SELECT *, en AND c % 2 = 0 AS d_cap, CASE WHEN en THEN CAST(c % 6 AS DOUBLE) END AS d_mult, en AND c % 4 = 0 AS d_mutual,
    CASE WHEN en THEN c % 5 END AS d_carve, en AND c % 2 = 1 AS d_unc, en AND c % 8 = 0 AS d_mind,
    CASE WHEN en THEN CAST(10 + c % 100 AS DOUBLE) END AS d_days, en AND c % 10 < 5 AS d_late, en AND c % 5 < 3 AS d_auto,
    CASE WHEN en AND c % 4 <> 1 THEN CAST(c % 40 AS DOUBLE) END AS d_notice FROM rec)"""
# the same layout with clause signals taken from the claims
RECORDS_ENRICHED = RECORDS.split("), det AS (")[0] + f"""), {SIGNAL_ROWS}, det AS (
  SELECT rec.*, "_det_cap_present" AS d_cap, "_det_cap_multiplier" AS d_mult, "_det_mutual_cap" AS d_mutual,
    "_det_carveout_count" AS d_carve, "_det_indemnity_uncapped" AS d_unc, "_det_mutual_indemnity" AS d_mind,
    "_det_payment_due_days" AS d_days, "_det_late_interest" AS d_late, "_det_auto_renewal" AS d_auto,
    "_det_nonrenewal_notice_days" AS d_notice
  FROM rec JOIN signals ON signals.contract_id = rec.c)"""


def norm(c: str, missing: int = 3) -> str:
    return f"((greatest(1, least(5, coalesce({c}, {missing}))) - 1) / 4.0::DOUBLE)"


def hot(c: str, label: str, labels: list[str]) -> str:
    known = f"CASE WHEN {c} IN ({', '.join(text(x) for x in labels)}) THEN {c} ELSE 'UNCLEAR' END"
    return flag01(f"({known}) = {text(label)}")


VECTOR = [norm("term"), norm("data"), norm("pay"), norm("ren", 1), f"(1.0 - {norm('cap')})"]
VECTOR += [hot("lev", x, V.LEVERAGE_LABELS) for x in V.LEVERAGE_LABELS]
VECTOR += [hot("ip", x, V.OWNERSHIP_LABELS) for x in V.OWNERSHIP_LABELS]
VECTOR += [hot("scope", x, V.SCOPE_LABELS) for x in V.SCOPE_LABELS]
VECTOR += [
    flag01("d_cap"), "CASE WHEN d_mult > 0 THEN d_mult / (d_mult + 4.0) ELSE 0.0 END", flag01("d_mutual"),
    "least(coalesce(d_carve, 0) / 3.0::DOUBLE, 1.0)", flag01("d_unc"), flag01("d_mind"),
    "CASE WHEN d_days > 0 THEN least(d_days / 90.0, 1.0) ELSE 0.0 END", flag01("d_late"), flag01("d_auto"),
    "CASE WHEN d_notice > 0 THEN least(d_notice / 90.0, 1.0) ELSE 0.0 END",
]
WIDE = "vec AS (SELECT *, " + ", ".join(
    f"CAST({v} AS DOUBLE) AS v{i}" for i, v in enumerate(VECTOR)) + " FROM det)"


def term_columns(weights: dict[str, float]) -> dict[str, str]:
    columns = {}
    for term, weight, label, inverted in V.SCORE_TERMS:
        v = f"v{V.VECTOR_LABELS.index(label)}"
        columns[term] = f"({f'(1.0::DOUBLE - {v})' if inverted else v} * {weights[weight]}::DOUBLE)"
    return columns


def exactly(x: str, digits: int) -> str:
    """Rounding by the exact binary value, as printing does it."""
    return f"CAST(printf('%.{digits}f', CAST({x} AS DOUBLE)) AS DOUBLE)"


def scores(weights: dict[str, float], records: str = RECORDS) -> str:
    total = " + ".join(term_columns(weights).values())
    return f"{records}, {WIDE}, sc AS (SELECT *, {exactly("least(greatest(" + total + ", 0.0), 1.0)", 4)} AS score FROM vec)"


# weights that depend on the nation of the party, which keeps the default for every third
PARTY_RECORDS = RECORDS.replace(
    "SELECT c_custkey AS c,", "SELECT c_custkey AS c, c_nationkey AS nation,", 1)
PARTY_WEIGHTS = {**V.DEFAULT_WEIGHTS, **{
    name: f"(CASE WHEN nation % 3 <> 0 THEN {sql} ELSE {V.DEFAULT_WEIGHTS[name]} END)" for name, sql in (
        ("termination_risk", "0.1::DOUBLE + nation / 100.0::DOUBLE"), ("payment_risk", "0.2::DOUBLE - nation / 200.0::DOUBLE"))}}
EXPLAINED = term_columns(V.DEFAULT_WEIGHTS)
EXPLAIN = f"""{RECORDS}, {WIDE}, parts AS (
  SELECT c, {', '.join(f'{exactly(v, 6)} AS "{t}"' for t, v in EXPLAINED.items())} FROM vec), terms AS (
  {' UNION ALL '.join(f"""SELECT c AS contract_id, '{t}' AS term, "{t}" AS contribution FROM parts""" for t in EXPLAINED)}
  UNION ALL SELECT c, '_composite_score', {exactly(' + '.join(f'"{t}"' for t in EXPLAINED), 4)} FROM parts)"""


def scored_text(template: str, column: str) -> str:
    return f"replace({text(template)}, '%s', CAST({column} AS VARCHAR))"


FLAGS = [
    case(("term >= 4", scored_text(V.FLAG_TERMINATION, "term"))),
    case(("cap <= 2", scored_text(V.FLAG_CAP, "cap"))),
    case(("data >= 4", scored_text(V.FLAG_DATA, "data"))),
    case(("pay >= 4", scored_text(V.FLAG_PAYMENT, "pay"))),
    case(("ren >= 4", scored_text(V.FLAG_RENEWAL, "ren"))),
    case(("lev = 'SUPPLIER'", text(V.FLAG_LEVERAGE))),
    case(("ip = 'CUSTOMER'", text(V.FLAG_IP))),
    case(("scope = 'NONE'", text(V.FLAG_SCOPE_NONE)), ("scope = 'UNILATERAL_SUPPLIER'", text(V.FLAG_SCOPE_SUPPLIER))),
    case(("d_unc", text(V.FLAG_INDEMNITY))),
    case(("d_days >= 60", scored_text(V.FLAG_PAYMENT_DAYS, "CAST(d_days AS BIGINT)"))),
    case(("d_auto AND coalesce(d_notice, 0) = 0", text(V.FLAG_RENEWAL_NO_NOTICE))),
    case(("score >= 0.65", scored_text(V.FLAG_COMPOSITE, "printf('%.2f', score)"))),
]
FLAG_ROWS = f"SELECT c, score, list_filter([{', '.join(FLAGS)}], lambda x: x IS NOT NULL) AS flags FROM sc"

DAYS = "CAST(10 + k % 80 AS VARCHAR)"
VARIANTS = f"""WITH {FACTS} SELECT k AS contract_id,
  {case(("k % 3 = 0", "'Ann L' || k"), ("k % 3 = 1", "'Jean D' || k"))} AS counterparty_signatory,
  {case(("k % 5 = 0", "(1 + k % 9) || ' years from Start Date'"), ("k % 5 = 1", "(6 + k % 30) || ' months from Effective Date'"),
        ("k % 5 = 2", "'until ' || CAST(day AS VARCHAR)"), ("k % 5 = 3", "'indefinite'"))} AS contract_term,
  {case(("k % 6 = 1", "'30'"), ("k % 6 <> 5", DAYS))} AS payment_terms_days,
  {case(("k % 4 < 2", DAYS))} AS termination_notice_days,
  {case(("k % 6 IN (0, 3)", "'false'"), ("k % 6 <> 5", "'true'"))} AS auto_renewal,
  {case(("k % 6 = 1", DAYS))} AS renewal_notice_days,
  {strings(list(V.PERIODICITY_PATTERNS))}[k % 8 + 1] AS payment_periodicity,
  round(price, 2) AS total_contract_value, 'EUR' AS currency FROM f"""

ORACLES: dict[str, str] = {
    "clean_text": f"SELECT doc_id AS contract_id, {CLEAN} AS text FROM documents",
    "clauses": f"WITH {CLAUSES} SELECT contract_id, clause_idx, clause, {folded('clause')} AS folded FROM whole",
    "lines": f"WITH {NUMBERED} SELECT contract_id, line_idx, line, {folded('line')} AS folded FROM numbered",
    "header": f"""WITH {LINES}, h AS (SELECT contract_id, array_to_string(lines[1:40], {NL}) AS header FROM lines)
      SELECT contract_id, header, {folded('header')} AS folded_header FROM h""",
    "paragraphs": f"""WITH {FACTS}, p AS (
      SELECT k, list_filter(list_transform(string_split({TEXT}, {NL} || {NL}), lambda x: {stripped('x')}), lambda x: length(x) >= 30) AS ps FROM f)
      SELECT k AS contract_id, generate_subscripts(ps, 1) - 1 AS para_idx, unnest(ps) AS paragraph FROM p""",
    "fold": f"SELECT doc_id AS contract_id, {folded('text')} AS folded FROM documents",
    "quotes": f"SELECT doc_id AS contract_id, {squeezed('text')} AS quote FROM documents",
    "language": f"""WITH t AS (SELECT doc_id, {folded('text')} AS t FROM documents), n AS (
      SELECT doc_id, {occurrences('t', V.FRENCH_CUES)} AS fr, {occurrences('t', V.ENGLISH_CUES)} AS en FROM t)
      SELECT doc_id AS contract_id, fr AS french_cues, en AS english_cues, {case(
          ("fr = 0 AND en = 0", "NULL"), ("fr >= en * 1.5 AND fr >= 2", "'fr'"), ("en >= fr * 1.5 AND en >= 2", "'en'"),
          otherwise="'mixed'")} AS language FROM n""",
    "document_currency": """WITH t AS (
      SELECT doc_id, list_distinct(list_transform(regexp_extract_all(text, '\\b(?:USD|EUR|GBP|CHF|CAD|AUD|JPY)\\b|US\\$|C\\$|€|£'),
        lambda x: CASE x WHEN 'US$' THEN 'USD' WHEN 'C$' THEN 'CAD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' ELSE x END)) AS codes
      FROM documents) SELECT doc_id AS contract_id, CASE WHEN len(codes) = 1 THEN codes[1] END AS value,
      CASE WHEN len(codes) = 1 THEN codes[1] END AS quote, NULL::VARCHAR AS note,
      CASE WHEN len(codes) = 1 THEN 0.75::DOUBLE END AS confidence FROM t""",
    "document_email": f"""WITH {CLAUSES}, e AS (
      SELECT contract_id, clause_idx, clause, list_distinct(regexp_extract_all(clause, '(?i)\\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}\\b')) AS mails,
        {folded('clause')} AS t FROM whole), hits AS (
      SELECT contract_id, arg_min(mails[1], clause_idx) AS value, arg_min(clause, clause_idx) AS clause FROM e
      WHERE len(mails) = 1 AND {contains_any('t', V.EXTERNAL_CONTACT_CUES)} AND NOT {contains_any('t', V.INTERNAL_CONTACT_CUES)}
      GROUP BY contract_id) SELECT doc_id AS contract_id, value, clause AS quote, NULL::VARCHAR AS note,
      CASE WHEN value IS NOT NULL THEN 0.96::DOUBLE END AS confidence FROM documents LEFT JOIN hits ON contract_id = doc_id""",
    "normalise": f"WITH {RAW} SELECT * FROM raw",
    "reject_report": f"""WITH {RAW} SELECT field, count(*) AS rows, count(*) FILTER (WHERE value IS NULL) AS rejected
      FROM raw GROUP BY field""",
    "law_report": f"WITH {VECTORS} SELECT governing_law_category AS category, count(*) AS contracts FROM vectors GROUP BY 1",
    **{name: field_oracle(field) for name, field in {
        "contract_type": "primary_contract_type", "counterparty_name": "counterparty_name",
        "counterparty_signatory": "counterparty_signatory", "signature_date": "signature_date",
        "effective_date": "effective_date", "start_date": "start_date", "end_date": "end_date", "auto_renewal": "auto_renewal",
        "renewal_notice": "renewal_notice_days", "termination_notice": "termination_notice_days",
        "contract_term": "contract_term", "payment_terms": "payment_terms_days", "payment_periodicity": "payment_periodicity",
        "currency": "currency", "contact_email": "counterparty_contact_email", "indexation": "indexation"}.items()},
    "total_value": TOTAL_VALUE,
    "term_years": f"""WITH {FACTS} SELECT k AS contract_id, CAST({YEARS} AS DOUBLE) AS years,
      CASE WHEN k % 3 <> 2 THEN {TERM_LINE} END AS clause FROM f""",
    "candidates": long_candidates("confidence, FALSE AS derived, 'regex' AS source"),
    "locked": long_candidates("confidence >= lim AS locked, confidence >= lim AS emitted"),
    "resolve": resolve_rows(),
    "missing_fields": f"WITH {FACTS} SELECT k AS contract_id, {joined_missing(',')} AS missing, {locked_json()} AS locked_json FROM f",
    "snippets": SNIPPETS,
    "edge_snippets": snippets_sql(["internal_entity"], V.SNIPPET_EDGE_LINES),
    "rule_variants": VARIANTS,
    "snippet_parts": f"SELECT contract_id, snippets, TRUE AS fits FROM ({SNIPPETS})",
    "extraction_requests": REQUESTS,
    "classification_requests": f"""SELECT doc_id AS contract_id, {text(V.CLASSIFY_REQUEST_HEAD)} || {CLEAN}
      || {text(V.CLASSIFY_REQUEST_TAIL)} AS prompt FROM documents""",
    "json_recover": RECOVER,
    "merge_answers": merged_rows(),
    "final_record": FINAL,
    "fan_out": f"WITH {PEOPLE} SELECT model, count(*) AS contracts, sum(c) AS id_sum FROM p GROUP BY model",
    "call_rejects": REJECTS,
    "raw_responses": RAW_RESPONSES,
    "file_round_trip": ROUND_TRIP,
    "type_answers": f"WITH {TYPES} SELECT c AS contract_id, * EXCLUDE (c) FROM types",
    "sector_answers": f"WITH {PEOPLE}, {SECTORS} SELECT c AS contract_id, * EXCLUDE (c) FROM sectors",
    "risk_answers": f"WITH {PEOPLE}, {RISKS} SELECT c AS contract_id, * EXCLUDE (c) FROM risks",
    "merged_record": f"""WITH {TYPES}, {SECTORS}, {RISKS} SELECT t.c AS contract_id, t.model, t.contract_type_primary, t.governing_law,
      t.jurisdiction_country, coalesce(s.regulated_sectors, '') AS regulated_sectors, r.termination_risk AS risk_vector_termination_risk,
      t.error, CASE WHEN t.c % 10 = 8 THEN 'No response' ELSE s.error END AS sector_error, r.error AS risk_vector_error,
      CASE WHEN t.c % 10 = 8 THEN 2.91::DOUBLE ELSE 4.78::DOUBLE END AS elapsed_total_s
      FROM types t LEFT JOIN sectors s ON s.c = t.c AND s.model = t.model JOIN risks r ON r.c = t.c AND r.model = t.model""",
    "model_consensus": f"""WITH {TYPES}, v AS (SELECT c, contract_type_primary AS value, count(*) AS votes FROM types
      WHERE contract_type_primary IS NOT NULL GROUP BY 1, 2), n AS (
      SELECT *, row_number() OVER (PARTITION BY c ORDER BY votes DESC, value) AS rn, count(*) OVER (PARTITION BY c) AS distinct_values FROM v)
      SELECT c AS contract_id, value AS consensus, votes, distinct_values FROM n WHERE rn = 1""",
    "jurisdiction_counts": f"""WITH {TYPES} SELECT jurisdiction_country, jurisdiction_court_type, jurisdiction_city, count(*) AS records
      FROM types GROUP BY 1, 2, 3""",
    "assemble_vector": ASSEMBLE,
    "similarity_vector": SIMILARITY_SQL,
    "similar_contracts": SIMILAR_SQL + " SELECT id AS contract_id, rank::INTEGER AS rank, similar_id, similarity FROM n WHERE rank <= 5",
    "similar_embeddings": EMBEDDING_SQL + " SELECT id, rank::INTEGER AS rank, similar_id, similarity FROM n WHERE rank <= 5",
    "median_filled": MEDIAN_SQL,
    "best_claim": f"""WITH {BEST} SELECT contract_id, {', '.join(f"{best_value(f, 'conf')} AS {f}_confidence" for f in SIGNAL_FAMILIES)}
      FROM best GROUP BY contract_id""",
    "enriched": f"WITH {SIGNAL_ROWS} SELECT * FROM signals",
    "numeric_vector": f"""WITH {RECORDS}, {WIDE} SELECT c AS contract_id,
      {', '.join(f'round(v{i}, 9) AS "{n}"' for i, n in enumerate(V.VECTOR_LABELS))} FROM vec""",
    "composite_score": f"WITH {scores(V.DEFAULT_WEIGHTS)} SELECT c AS contract_id, score FROM sc",
    "custom_weights": f"""WITH {scores({**V.DEFAULT_WEIGHTS, 'termination_risk': 0.3, 'data_sensitivity': 0.25})}
      SELECT c AS contract_id, score FROM sc""",
    "party_weights": f"""WITH {scores(PARTY_WEIGHTS, PARTY_RECORDS)} SELECT c AS contract_id, score FROM sc""",
    "triage_flags": f"""WITH {scores(V.DEFAULT_WEIGHTS)}, fl AS ({FLAG_ROWS})
      SELECT c AS contract_id, CAST(len(flags) AS INTEGER) AS n_flags, array_to_string(flags, {NL}) AS flags FROM fl""",
    "explain": f"WITH {EXPLAIN} SELECT * FROM terms",
    "mean_contributions": f"""WITH {EXPLAIN} SELECT term, round(avg(contribution), 6) AS mean_contribution, count(*) AS records
      FROM terms GROUP BY term""",
    "scored_enriched": f"""WITH {scores(V.DEFAULT_WEIGHTS, RECORDS_ENRICHED)}, fl AS ({FLAG_ROWS})
      SELECT c AS contract_id, score, CAST(len(flags) AS INTEGER) AS n_flags FROM fl""",
}
