"""Rule-based extraction: documents to candidate values with evidence.

A candidate is a struct (value, quote, note, derived, confidence, source, pos);
``pos`` is the order in which a reader meets it.  Each rule is a column over one
prepared document: the first clause (or match) that yields a value wins, and
within a clause the order of the patterns decides.  No rule shuffles.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauselens.functions import vocab as V
from clauselens.functions.parse import currency_code, parse_date, parse_number
from clauselens.functions.text import (
    any_of, by_script, count_cues, cue_pattern, first, flags, fold, fold_ref, has_any, is_ascii, language_of, let, quote,
    squeeze, starting_with, word_start, one_of, may_say,
)
from clauselens.operators.prepare import ID, prepare, with_clauses, with_header, with_lines

CANDIDATE = (
    "struct<value:string,quote:string,note:string,derived:boolean,confidence:double,source:string,pos:int>"
)
CLAUSE_FIELDS = [
    "auto_renewal", "renewal_notice_days", "termination_notice_days", "contract_term",
    "payment_terms_days", "payment_periodicity",
]
_LATE = 1_000_000_000  # after every clause position


def candidate(value: Column, evidence: Column, confidence, pos, note=None, derived=False) -> Column:
    """Candidate struct, or null when there is no value."""
    def column(x):
        return x if isinstance(x, Column) else F.lit(x)

    built = F.struct(
        value.cast("string").alias("value"),
        evidence.alias("quote"),
        column(note).cast("string").alias("note"),
        column(derived).alias("derived"),
        column(confidence).cast("double").alias("confidence"),
        F.lit("regex").alias("source"),
        column(pos).cast("int").alias("pos"),
    )
    return F.when(value.isNotNull(), built)


def _group(text: Column, pattern: str, n: int = 1) -> Column:
    """Capture group of the first match, null when there is no match."""
    return let(F.regexp_extract(text, pattern, n), lambda found: F.when(found != "", found))


def _stem(pattern: str) -> str:
    """The longest fixed text that every match of a folded pattern contains."""
    fixed = re.sub(r".\?|\\[a-zA-Z]|\{[^}]*\}|[()+*]", "|", pattern.replace(r"\s+", "|"))
    return max(re.findall("[a-z ']+", fixed), key=len)


def _first_group(c: Column, patterns: list[str]) -> Column:
    """First capture group in a clause, in the order of the patterns; a pattern is tried where its fixed text stands."""
    return by_script(c["plain"], lambda plain: F.coalesce(
        *[F.when(c["folded"].contains(_stem(p)), _group(c["folded"], flags("", plain) + p)) for p in patterns]))


def _matches(c: Column, patterns: list[str]) -> Column:
    return by_script(c["plain"], lambda plain: c["folded"].rlike(word_start(patterns, plain)))


# --- whole-document rules ----------------------------------------------------

def type_keyword(folded_header: Column) -> Column:
    """(keyword, kind) of the first keyword, in rule order, that stands alone in the header.

    One pattern finds the longest keyword that stands alone at a place; those it begins with stand alone there as well
    if a sign other than a letter follows them.
    """
    order = [(word, name) for name, words in V.TYPE_KEYWORDS.items() for word in _folded(words)]
    words = list(dict.fromkeys(word for word, _ in order))
    # the place of the first rule that a keyword satisfies, with those that it holds at its beginning
    rank = {w: min(i for i, (o, _) in enumerate(order) if re.match(rf"{re.escape(o)}(?!\w)", w)) for w in words}
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    rules = F.array(*[F.struct(F.lit(word).alias("keyword"), F.lit(name).alias("kind")) for word, name in order])

    def alone(is_plain: bool) -> Column:
        pattern = flags("", is_plain) + rf"(?<!\w)(?=({one_of(words)}(?!\w)))"
        return F.regexp_extract_all(folded_header, F.lit(pattern), F.lit(1))

    found = F.array_distinct(by_script(is_ascii(folded_header), alone))
    return let(F.array_min(F.transform(found, lambda w: F.element_at(ranks, w))), lambda i: F.get(rules, i))


def contract_type(hit: Column, lines: Column, header: Column, folded_header: Column) -> Column:
    """Candidate of a keyword found by :func:`type_keyword`, quoting its first line.

    Only the header, the first lines of ``lines``, says what a contract is.  Folding changes no line end, so
    the line is known from the line ends before the keyword.
    """
    def place(is_plain: bool) -> Column:
        return F.regexp_instr(folded_header, F.concat(
            F.lit(flags("", is_plain) + r"(?<!\w)\Q"), hit["keyword"], F.lit(r"\E(?!\w)")))

    before = by_script(is_ascii(folded_header), lambda p: F.substr(folded_header, F.lit(1), place(p) - 1))
    line = F.octet_length(before) - F.octet_length(F.replace(before, F.lit("\n"), F.lit("")))
    shown = F.when(hit.isNotNull(), quote(F.coalesce(F.get(lines, line), header)))
    return candidate(hit["kind"], shown, V.TYPE_CONFIDENCE, 0)


def _folded(words: list[str]) -> list[str]:
    plain = ["".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)) for w in words]
    return list(dict.fromkeys(w.lower() for w in plain))


def labelled_date(text: Column, plain: Column, labels: list[str], pos: int) -> Column:
    """First date that parses and stands next to one of the labels."""
    def pattern(is_plain: bool) -> str:
        start = flags("s", is_plain) + starting_with("".join(label[0] for label in labels), is_plain)
        known = [label for label in labels if label.isascii() or not is_plain]
        return rf"{start}(?i)\b(?:{any_of(known)})\b[^\n\r:\d]{{0,40}}[:\-]?\s*({V.DATE_PATTERN})"

    matches = by_script(plain, lambda p: F.regexp_extract_all(text, F.lit(pattern(p)), F.lit(0)))
    parsed = F.transform(matches, lambda m: F.struct(
        m.alias("quote"), parse_date(F.regexp_extract(m, pattern(False), 1)).alias("value")))
    found = first(F.filter(parsed, lambda x: x["value"].isNotNull()))
    return F.when(may_say(text, plain, labels), let(found, lambda x: candidate(x["value"], quote(x["quote"]), V.DATE_CONFIDENCE, pos)))


def _party(raw: Column) -> Column:
    return F.btrim(squeeze(raw), F.lit(" -:"))


def counterparty_name(text: Column, plain: Column, pos: int = 1) -> Column:
    """Role-labelled party, else the second party of the first two-party definition in the whole text."""
    def role(is_plain: bool) -> str:
        labels = any_of(V.ROLE_LABELS)
        return flags("imd", is_plain) + rf"^\s*(?:{labels})\s*[:\-]\s*([^\n,;()]+(?:\([^)\n]+\))?)"

    matches = by_script(plain, lambda p: F.regexp_extract_all(text, F.lit(role(p)), F.lit(0)))
    named = F.transform(matches, lambda m: F.struct(
        m.alias("quote"), _party(F.regexp_extract(m, role(False), 1)).alias("name")))
    labelled = let(
        first(F.filter(named, lambda x: F.length(x["name"]) >= 3)),
        lambda x: candidate(x["name"], quote(x["quote"]), V.ROLE_CONFIDENCE, pos, note=V.ROLE_NOTE),
    )
    paired = [F.when(may_say(text, plain, V.ROLE_LABELS), labelled)]
    for cue, body in zip(("between", "entre"), V.PAIR_PATTERNS):
        def pattern(is_plain: bool) -> str:
            return flags("sd", is_plain) + starting_with(cue[0], is_plain) + "(?i)" + body

        def second_party(m: Column) -> Column:
            name = let(_party(F.regexp_extract(m, pattern(False), 2)), lambda n: F.when(F.length(n) >= 3, n))
            return let(name, lambda n: candidate(n, quote(m), V.PAIR_CONFIDENCE, pos, note=V.PAIR_NOTE))

        paired.append(F.when(may_say(text, plain, [cue]), let(
            by_script(plain, lambda p: F.regexp_extract(text, pattern(p), 0)), second_party)))
    return F.coalesce(*paired)


def counterparty_signatory(text: Column, plain: Column, pos: int = 2, block_lines: int = V.SIGNATORY_LINES) -> Column:
    """Name in the first signature block of either shape, two words at least.

    A block is a line with the role and the ``block_lines`` lines after it, for both shapes.  So
    the work grows with the lines of the text, whatever they hold.
    """
    def block_names(cue: str, letters: str, body: str) -> Column:
        def blocks(lines: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(cue))
            return F.transform(starts, lambda i: F.array_join(
                F.slice(lines, i + 1, F.lit(block_lines + 1)), "\n"))

        def pattern(is_plain: bool) -> str:
            return flags(letters, is_plain) + "(?i)" + body

        found = F.transform(let(F.split(text, "\n"), blocks), lambda b: by_script(
            plain, lambda p: F.regexp_extract(b, pattern(p), 0)))

        def person(m: Column) -> Column:
            name = let(_party(F.regexp_extract(m, pattern(False), 1)),
                       lambda n: F.when(F.size(F.split(n, " ")) >= 2, n))
            return let(name, lambda n: candidate(n, quote(m), V.SIGNATORY_CONFIDENCE, pos))

        return let(first(F.filter(found, lambda m: m != "")), person)

    def name_label(is_plain: bool) -> str:
        return flags("", is_plain) + starting_with("bn", is_plain) + r"(?i)\b(?:by|name|nom)\s*[:\-]"

    said = (["behalf of", "pour le compte de"], V.ROLE_LABELS)
    shapes = [F.when(may_say(text, plain, words), block_names(cue, letters, body)) for words, cue, letters, body in zip(
        said, V.SIGNATORY_CUES, ("s", "ismd"), V.SIGNATORY_PATTERNS)]
    labelled = may_say(text, plain, ["by", "name", "nom"]) & by_script(plain, lambda p: text.rlike(name_label(p)))
    return F.when(labelled, F.coalesce(*shapes))


def currency(text: Column, plain: Column, pos: int = _LATE + 1) -> Column:
    """The only currency of the document, null when there are several."""
    starts = "".join(dict.fromkeys(token[0] for token in V.CURRENCY_CODES))

    def tokens(is_plain: bool) -> Column:
        pattern = flags("", is_plain) + f"(?=[{starts}])(?:{V.CURRENCY_TOKENS})"
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    codes = F.array_distinct(F.transform(F.array_distinct(by_script(plain, tokens)), currency_code))
    code = let(codes, lambda x: F.when(F.size(x) == 1, first(x)))
    return let(code, lambda c: candidate(c, c, V.CURRENCY_CONFIDENCE, pos))


def contact_email(clauses: Column) -> Column:
    """First clause with exactly one address, an outside cue and no inside cue."""
    def address(c: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(c["clause"], F.lit("(?iU)" + V.EMAIL_PATTERN), F.lit(0)))
        only = let(found, lambda x: F.when(F.size(x) == 1, first(x)))
        outside = has_any(c["folded"], V.EXTERNAL_CONTACT_CUES) & ~has_any(c["folded"], V.INTERNAL_CONTACT_CUES)
        return F.struct(c["clause"].alias("clause"), F.when(c["clause"].contains("@") & outside, only).alias("email"))

    hit = first(F.filter(F.transform(clauses, address), lambda x: x["email"].isNotNull()))
    return let(hit, lambda x: candidate(x["email"], quote(x["clause"]), V.EMAIL_CONFIDENCE, 0))


def term_years(clauses: Column) -> Column:
    """(years, clause) of the first clause with a whole number of years."""
    def years(c: Column) -> Column:
        f = c["folded"]
        in_years = _group(f, "(?U)" + V.TERM_YEARS).try_cast("int")
        in_months = _group(f, "(?U)" + V.TERM_MONTHS).try_cast("int")
        value = F.coalesce(in_years.cast("double"), F.when(in_months % 12 == 0, in_months / 12))
        return F.struct(F.when(has_any(f, V.TERM_CUES), value).alias("years"), c["clause"].alias("clause"))

    return first(F.filter(F.transform(clauses, years), lambda x: x["years"].isNotNull()))


def total_value(text: Column, plain: Column, term: Column) -> Column:
    """(total, currency) candidates of an explicitly labelled total."""
    labels = any_of(V.TOTAL_LABELS)

    def read(m: Column, pattern: str, currency_group: int, amount_group: int) -> Column:
        amount = parse_number(F.regexp_extract(m, pattern, amount_group))
        yearly = fold(m).contains(V.TOTAL_ANNUAL_CUE)
        code = currency_code(F.regexp_extract(m, pattern, currency_group))
        facts = F.struct(m.alias("m"), amount.alias("amount"), yearly.alias("yearly"), code.alias("code"))
        return F.when(m != "", let(facts, built))

    def built(x: Column) -> Column:
        derived = F.coalesce(x["yearly"] & (term["years"] != 1), F.lit(False))
        note = F.when(derived, F.format_string(V.TOTAL_DERIVED_NOTE, term["clause"])).when(
            x["yearly"], F.lit(V.TOTAL_ONE_YEAR_NOTE))
        value = F.when(x["yearly"], x["amount"] * term["years"]).otherwise(x["amount"])
        evidence = quote(F.when(x["yearly"], F.concat(x["m"], F.lit(" | "), term["clause"])).otherwise(x["m"]))
        return F.when(value.isNotNull(), F.struct(
            candidate(value, evidence, V.TOTAL_CONFIDENCE, 0, note=note, derived=derived).alias("total"),
            candidate(x["code"], evidence, V.TOTAL_CURRENCY_CONFIDENCE, 1).alias("currency"),
        ))

    def patterns(is_plain: bool) -> list[tuple[str, int, int]]:
        start = (flags("s", is_plain) + starting_with("".join(label[0] for label in V.TOTAL_LABELS), is_plain)
                 + rf"(?i)\b(?:{labels})\b[^\n]{{0,30}}?")
        return [
            (rf"{start}({V.TOTAL_CURRENCY})\s*({V.TOTAL_AMOUNT})", 1, 2),
            (rf"{start}({V.TOTAL_AMOUNT})\s*({V.TOTAL_CURRENCY})", 2, 1),
        ]

    shapes = []
    for i, (pattern, currency_group, amount_group) in enumerate(patterns(False)):
        match = by_script(plain, lambda p: F.regexp_extract(text, patterns(p)[i][0], 0))
        shapes.append(let(match, lambda m: read(m, pattern, currency_group, amount_group)))
    return F.when(may_say(text, plain, V.TOTAL_LABELS), F.coalesce(*shapes))


def indexation(clauses: Column) -> Column:
    """First clause that names a price index or a fixed yearly percentage."""
    def mechanism(c: Column) -> Column:
        f = c["folded"]
        percent = F.regexp_replace(F.replace(_group(c["clause"], V.INDEXATION_PERCENT), F.lit(","), F.lit(".")), r"\.0\z", "")
        named = F.lit(None).cast("struct<value:string,confidence:double>")
        rule = None
        for name, words, confidence in V.INDEXATION_NAMES:
            built = F.struct(F.lit(name).alias("value"), F.lit(confidence).alias("confidence"))
            rule = F.when(has_any(f, words), built) if rule is None else rule.when(has_any(f, words), built)
        fixed = F.struct(
            F.concat(F.lit("Fixed "), percent, F.lit(" percent annual increase")).alias("value"),
            F.lit(V.INDEXATION_PERCENT_CONFIDENCE).alias("confidence"),
        )
        rule = rule.when(percent.isNotNull() & has_any(f, V.INDEXATION_YEARLY), fixed).otherwise(named)
        return F.struct(c["clause"].alias("clause"), F.when(has_any(f, V.INDEXATION_GATE), rule).alias("hit"))

    found = first(F.filter(F.transform(clauses, mechanism), lambda x: x["hit"].isNotNull()))
    return let(found, lambda x: candidate(x["hit"]["value"], x["clause"], x["hit"]["confidence"], 0))


# --- clause rules: one pass over the clauses for all requested fields --------

def clause_hits(clauses: Column, fields: Iterable[str] = CLAUSE_FIELDS) -> Column:
    """Per clause, the value each requested field would take from it."""
    wanted = set(fields)

    def notice(c: Column, cues: list[str]) -> Column:
        f = c["folded"]
        return F.when(has_any(f, cues) & ~has_any(f, V.MONTH_WORDS), _first_group(c, V.NOTICE_PATTERNS)).try_cast("int")

    def renewal(c: Column) -> Column:
        stated = F.when(_matches(c, V.RENEWAL_NEGATIVE), "false").when(_matches(c, V.RENEWAL_POSITIVE), "true")
        return F.when(has_any(c["folded"], V.RENEWAL_STEMS), stated)

    def term(c: Column) -> Column:
        f = c["folded"]

        def built(value: Column, confidence: float) -> Column:
            return F.when(value.isNotNull(), F.struct(value.alias("value"), F.lit(confidence).alias("confidence")))

        def span(pattern: str) -> Column:
            parts = by_script(c["plain"], lambda plain: F.struct(*[
                F.regexp_extract(f, flags("", plain) + pattern, n).alias(name)
                for n, name in enumerate(("number", "unit", "base"), start=1)]))
            return let(parts, lambda x: F.when(x["number"] != "", F.concat(
                x["number"].try_cast("int").cast("string"),
                F.when(x["unit"].startswith("month") | (x["unit"] == "mois"), " months from ").otherwise(" years from "),
                F.when(x["base"].contains("effe"), "Effective Date").otherwise("Start Date"),
            )))

        until = parse_date(F.regexp_extract(c["clause"], "(?iU)" + V.TERM_UNTIL, 1))
        return F.when(has_any(f, V.TERM_CUES), F.coalesce(
            F.when(has_any(f, V.TERM_INDEFINITE), built(F.lit("indefinite"), V.TERM_INDEFINITE_CONFIDENCE)),
            F.when(f.contains("from"), let(span(V.TERM_ENGLISH), lambda v: built(v, V.TERM_CONFIDENCE))),
            F.when(f.contains("duree"), let(span(V.TERM_FRENCH), lambda v: built(v, V.TERM_CONFIDENCE))),
            F.when(f.contains("until"), let(
                F.concat(F.lit("until "), until), lambda v: built(v, V.TERM_UNTIL_CONFIDENCE))),
        ))

    def periods(c: Column) -> Column:
        f = c["folded"]
        named = F.array_compact(F.array(*[
            F.when(has_any(f, V.PERIODICITY_STEMS[name]) & _matches(c, patterns), name)
            for name, patterns in V.PERIODICITY_PATTERNS.items()
        ]))
        usable = c["pay"] & ~has_any(f, V.PRICE_CHANGE_CUES)
        return F.when(usable, named).otherwise(F.array().cast("array<string>"))

    rules = {
        "auto_renewal": renewal,
        "renewal_notice_days": lambda c: notice(c, V.RENEWAL_NOTICE_CUES),
        "termination_notice_days": lambda c: notice(c, V.TERMINATION_NOTICE_CUES),
        "contract_term": term,
        "payment_terms_days": lambda c: F.when(c["pay"], _first_group(c, V.PAYMENT_TERMS)).try_cast("int"),
        "payment_periodicity": periods,
    }

    def hits(c: Column) -> Column:
        return F.struct(c["idx"], c["clause"], *[rules[f](c).alias(f) for f in CLAUSE_FIELDS if f in wanted])

    def facts(c: Column) -> Column:
        pay = has_any(c["folded"], V.PAYMENT_CUES)
        return F.struct(c["idx"], c["clause"], c["folded"], is_ascii(c["folded"]).alias("plain"), pay.alias("pay"))

    # every rule needs one of its cue words, so one cheap test drops most clauses
    cues = [cue for field in CLAUSE_FIELDS if field in wanted for cue in _GATES[field]]
    relevant = F.filter(clauses, lambda c: c["folded"].rlike(cue_pattern(cues)))
    return F.transform(F.transform(relevant, facts), hits)


_GATES = {
    "auto_renewal": V.RENEWAL_STEMS,
    "renewal_notice_days": V.RENEWAL_NOTICE_CUES,
    "termination_notice_days": V.TERMINATION_NOTICE_CUES,
    "contract_term": V.TERM_CUES,
    "payment_terms_days": V.PAYMENT_CUES,
    "payment_periodicity": V.PAYMENT_CUES,
}
_CLAUSE_CONFIDENCE = {
    "auto_renewal": V.RENEWAL_CONFIDENCE,
    "renewal_notice_days": V.NOTICE_CONFIDENCE,
    "termination_notice_days": V.NOTICE_CONFIDENCE,
    "payment_terms_days": V.PAYMENT_TERMS_CONFIDENCE,
}


def clause_candidate(hits: Column, field: str) -> Column:
    """Candidate of one clause field from the hits of :func:`clause_hits`."""
    rank = CLAUSE_FIELDS.index(field)
    if field == "payment_periodicity":
        return _periodicity(hits)
    found = first(F.filter(hits, lambda h: h[field].isNotNull()))

    def built(h: Column) -> Column:
        pos = (h["idx"] + 1) * 10 + rank
        if field == "contract_term":
            return candidate(h[field]["value"], h["clause"], h[field]["confidence"], pos)
        return candidate(h[field], h["clause"], _CLAUSE_CONFIDENCE[field], pos)

    return let(found, built)


def _periodicity(hits: Column) -> Column:
    """One cadence in the whole document is taken, several become OTHER."""
    named = F.filter(hits, lambda h: F.size(h["payment_periodicity"]) > 0)
    distinct = F.array_distinct(F.flatten(F.transform(hits, lambda h: h["payment_periodicity"])))

    def built(names: Column) -> Column:
        single = F.size(names) == 1
        value = F.when(single, first(names)).when(F.size(names) > 1, "OTHER")
        confidence = F.when(single, V.PERIODICITY_CONFIDENCE).otherwise(V.PERIODICITY_MIXED_CONFIDENCE)
        note = F.when(~single, V.PERIODICITY_MIXED_NOTE)
        return candidate(value, first(named)["clause"], confidence, _LATE, note=note)

    return let(distinct, built)


# --- jobs --------------------------------------------------------------------

def extract_wide(
    contracts: DataFrame, keep: Iterable[str] = (), header_lines: int = V.HEADER_LINES, block_lines: int = V.SIGNATORY_LINES,
) -> DataFrame:
    """One row per contract: a candidate column per text-first field, and ``warnings``.

    ``keep`` names further input columns to carry along (for example the lines), ``header_lines`` says how many lines are
    searched for the contract's type, ``block_lines`` how many belong to a signature block.
    """
    ready = prepare(contracts, header_lines).withColumn("hits", clause_hits(F.col("clauses")))
    ready = ready.withColumn("type_hit", type_keyword(F.col("folded_header")))
    text, plain = F.col("text"), F.col("plain")
    columns = {
        "primary_contract_type": contract_type(F.col("type_hit"), F.col("lines"), F.col("header"), F.col("folded_header")),
        "counterparty_name": counterparty_name(text, plain),
        "counterparty_signatory": counterparty_signatory(text, plain, block_lines=block_lines),
    }
    for pos, (field, labels) in enumerate(V.DATE_LABELS.items(), start=3):
        columns[field] = labelled_date(text, plain, labels, pos)
    for field in CLAUSE_FIELDS:
        columns[field] = clause_candidate(F.col("hits"), field)
    columns["currency"] = currency(text, plain)
    wide = ready.select(ID, *keep, *[columns[f].alias(f) for f in V.TEXT_FIRST_FIELDS])
    mixed = F.col("payment_periodicity.note") == V.PERIODICITY_MIXED_NOTE
    warning = F.when(mixed, F.array(F.lit(V.PERIODICITY_MIXED_WARNING))).otherwise(F.array().cast("array<string>"))
    return wide.withColumn("warnings", warning)


def to_long(wide: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Long candidate table (contract_id, field, value, quote, ...) of a wide one."""
    cells = [
        F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("field"), F.col(f).alias("c"))) for f in fields
    ]
    rows = wide.select(ID, F.explode(F.array_compact(F.array(*cells))).alias("x"))
    return rows.select(ID, "x.field", "x.c.*")


def extract_candidates(contracts: DataFrame, **limits: int) -> DataFrame:
    """Long candidate table of the text-first fields; ``limits`` as in :func:`extract_wide`."""
    return to_long(extract_wide(contracts, **limits), V.TEXT_FIRST_FIELDS)


def extract_field(contracts: DataFrame, field: str) -> DataFrame:
    """(contract_id, candidate) for one field, computing only what it needs."""
    text, plain, clauses = F.col("text"), F.col("plain"), F.col("clauses")
    whole_text = {
        "counterparty_name": counterparty_name,
        "counterparty_signatory": counterparty_signatory,
        "currency": currency,
    }
    if field == "primary_contract_type":
        ready = with_header(with_lines(contracts)).withColumn("type_hit", type_keyword(F.col("folded_header")))
        column = contract_type(F.col("type_hit"), F.col("lines"), F.col("header"), F.col("folded_header"))
    elif field in CLAUSE_FIELDS:
        ready = with_clauses(contracts).withColumn("hits", clause_hits(clauses, [field]))
        column = clause_candidate(F.col("hits"), field)
    elif field == "counterparty_contact_email":
        ready, column = with_clauses(contracts), contact_email(clauses)
    elif field == "indexation":
        ready, column = with_clauses(contracts), indexation(clauses)
    else:
        ready = contracts.withColumn("plain", is_ascii(text))
        if field in V.DATE_LABELS:
            column = labelled_date(text, plain, V.DATE_LABELS[field], 0)
        else:
            column = whole_text[field](text, plain)
    return ready.select(ID, column.alias("candidate"))


def extract_term_years(contracts: DataFrame) -> DataFrame:
    """(contract_id, years, clause); null years when no whole-year term is stated."""
    return with_clauses(contracts).select(ID, term_years(F.col("clauses")).alias("t")).select(ID, "t.years", "t.clause")


def extract_total_value(contracts: DataFrame) -> DataFrame:
    """(contract_id, total_contract_value, currency) candidates."""
    ready = with_clauses(contracts).select(ID, "text", term_years(F.col("clauses")).alias("term"))
    found = ready.select(ID, total_value(F.col("text"), is_ascii(F.col("text")), F.col("term")).alias("t"))
    return found.select(
        ID,
        F.col("t.total").alias("total_contract_value"),
        F.col("t.currency").alias("currency"),
    )


def detect_language(contracts: DataFrame) -> DataFrame:
    """(contract_id, french_cues, english_cues, language)."""
    folded = contracts.select(ID, fold(F.col("text")).alias("folded"))
    counted = folded.select(
        ID,
        count_cues(F.col("folded"), V.FRENCH_CUES).alias("french_cues"),
        count_cues(F.col("folded"), V.ENGLISH_CUES).alias("english_cues"),
    )
    return counted.withColumn("language", language_of(F.col("french_cues"), F.col("english_cues")))
