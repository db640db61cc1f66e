"""Byte searches before patterns: texts are read by a pattern only where it can match, with the same results."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clauselens.functions import text as T
from clauselens.functions import vocab as V
from clauselens.operators import extract as X


def column(spark, fn, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in frame.orderBy("i").select(fn(F.col("x"))).collect()]


def mixtures(pieces, most, count):
    rng = random.Random(7)
    return ["".join(rng.choices(pieces, k=rng.randint(0, most))) for _ in range(count)]


@pytest.mark.parametrize("field, searched", [
    ("effective_date", "prise d'effet"), ("counterparty_name", "between"), ("counterparty_signatory", "pour le compte de")])
def test_texts_without_a_cue_are_not_read_by_patterns(spark, field, searched):
    rows = spark.createDataFrame([(1, "x")], "contract_id long, text string")
    plan = X.extract_field(rows, field)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"Contains\(lower\(text#\d+\), {searched}\)", plan)


def test_lines_and_clauses_are_cut_without_patterns_where_they_can(spark):
    rows = spark.createDataFrame([(1, "x")], "contract_id long, text string")
    plan = rows.select(T.split_lines(F.col("text")), T.split_clauses(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(text" in plan


def test_case_variants_pass_the_byte_search(spark):
    letters = "abcdefghijklmnopqrstuvwxyzéè"
    frame = spark.createDataFrame([(chr(cp),) for cp in range(0x10000) if not 0xD800 <= cp < 0xE000], "x string")
    x = F.col("x")
    missed = [F.count_if(x.rlike(f"(?iU)^{ch}$") & ~T.may_say(x, T.is_ascii(x), [ch])).alias(f"c{i}") for i, ch in enumerate(letters)]
    found = F.count_if(x.rlike("(?iU)^s$")).alias("found")
    row = frame.agg(found, *missed).first()
    assert row[0] >= 3 and not any(row[1:])


def test_clauses_as_by_one_pattern(spark):
    texts = mixtures(["a", "Bc", "é", " ", " ", "\n", ".", ";", "  ", "\t", "\xa0", "\x1c", "\r", " "], 14, 3000)
    texts += mixtures(["a", "Bc", "é", " ", "\n", ".", ";"], 14, 3000)

    def expected(text):
        pieces = re.split(r"(?=\s)(?:\n{1,2}|(?<=[.;])\s+)", text)
        return [p for p in (" ".join(piece.split()) for piece in pieces) if p]

    assert column(spark, T.split_clauses, texts) == [expected(t) for t in texts]


def test_lines_as_python_cuts_them(spark):
    texts = mixtures(["a", "é", " ", "\n", "\n", "\r", "\x85", " ", "\x0b", "\x1e"], 10, 3000)
    texts += mixtures(["a", "é", " ", "\n", "\t"], 10, 2000)
    assert column(spark, T.split_lines, texts) == [t.splitlines() for t in texts]


def test_first_keyword_in_the_order_of_the_rules(spark):
    rules = [(word, name) for name, words in V.TYPE_KEYWORDS.items() for word in X._folded(words)]
    words = [w for w, _ in rules]
    heads = mixtures(words + [" ", " ", "\n", "x", "-", "é", "_"], 5, 3000)

    def expected(text):
        return next(((w, n) for w, n in rules if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", text)), None)

    got = column(spark, lambda c: X.type_keyword(c), heads)
    assert [g and tuple(g) for g in got] == [expected(h) for h in heads]


def test_type_is_quoted_from_its_first_line(one, spark):
    rows = spark.createDataFrame([(1, "unleased\nÉtat … x\nThe  Lease here\nLease"), (2, "a\r\nLEASE é\nb")], "contract_id long, text string")
    got = X.extract_field(rows, "primary_contract_type").orderBy("contract_id").collect()
    assert [r.candidate.quote for r in got] == ["The Lease here", "LEASE é"]


@pytest.mark.parametrize("pattern", [*V.NOTICE_PATTERNS, *V.PAYMENT_TERMS])
def test_stem_of_a_pattern_is_in_its_matches(pattern):
    said = ["net 5", "12 day x", "12 days", "12 calendar day", "preavis de 9 jours", "delai de preavis de 9 jours", "within ten (10) days",
            "within 3 days", "payable within 3 days", "dans un delai de 4 jours", "paiement sous 4 jours"]
    hits = [s for s in said if re.search(pattern, s)]
    assert hits and all(X._stem(pattern) in s for s in hits)
