"""Personal data against regular expressions, and disclosing terms in a planted corpus."""

import hashlib
import math
import re
import time
from collections import Counter

from clauselens.llm import pii as P
from clauselens.llm.queries import ORACLES, QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if passes(k, m[0])]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]


def test_query(spark, sf, texts):
    rows = {r.doc_id: r for r in QUERIES["op4_pii"](spark, sf).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base = brute(text)
        assert rows[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in BASE] == [sum(b.startswith(k) for b in base) for k in BASE]
        assert set(base) <= set(rows[i].spans.split(",")) | {""} and (bool(base) or rows[i].spans == "")
    assert sum(r.spans != "" for r in rows.values()) > 10


TEXTS = [
    None, "", "a@b.c_d@e.f-g.h", "a@b a@b. @c.d x.@y.z é@é.com ü.a@b.co,", "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.1.1 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112; 4111  1111", "0000000000000000000 00000000000000000000 000000000000",
    "+1 (555) 123-4567. +49.30 1234567-8) +12345678 +1234567890123456 +1 +", "😀 a@b.co 😀 1.1.1.1 +4915112345678\n+4",
    "5500005555555559", "1" * 5_000, "a@" * 3_000 + "b.c", "x" * 200_000 + "@", "1.2.3.4 " * 2_000,
]


def test_patterns_on_hostile_texts(spark):
    docs = spark.createDataFrame([(i, t, 1, "e") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_ip int, spans string")
    began = time.time()
    rows = P.find_personal_data(docs).select("doc", P.joined_spans(P.F.col("base")).alias("base")).collect()
    assert time.time() - began < 60 and len(rows) == len(TEXTS)
    for r in rows:
        assert r.base == ",".join(brute(r.doc.text)), r.doc.doc_id


def test_cases(odd_docs, no_docs):
    rows = P.find_personal_data(odd_docs).collect()
    assert len(rows) == 13
    assert P.find_personal_data(no_docs).collect() == []


def planted():
    """An address that a rare name goes with, among lines of common words."""
    lines = [f"the harbour report number w{i} was read on day {i % 7}." for i in range(300)]
    lines += [f"Write to Zebulon-Quark about quasar q{i} at boss@corp.example today." for i in range(6)]
    lines += ["A quasar was seen."] * 3
    lines += ["Write to nobody about anything today."] * 40
    lines += ["Only once here: Hapax and other@corp.example in one line."] * 9
    return [(i, "\n".join(lines[i::20])) for i in range(20)]


def marked_terms(docs):
    """The kind for each marked term, in lower case."""
    marked = {}
    for r in P.find_personal_data(docs).select("doc", P.joined_spans(P.F.col("spans")).alias("spans")).collect():
        for kind, start, end in (s.split(":") for s in filter(None, r.spans.split(","))):
            marked[r.doc.text[int(start):int(end)].lower()] = kind
    return marked


def plain_terms(lines):
    """The same marks by counting lines: every term beside every entity."""
    entities = [{f"{k}:{m[0].lower()}": m.span() for k, p in BASE.items() for m in re.finditer(p, x) if passes(k, m[0])} for x in lines]
    terms = [[(m[0].lower(), m.span()) for m in re.finditer(r"[^\W_]+(?:[-_.'][^\W_]+)*", x)] for x in lines]
    n_term = Counter(t for line in terms for t in {t for t, _ in line})
    n_entity = Counter(e for line in entities for e in line)
    total = sum(bool(x.split()) for x in lines)
    both = Counter((e, t) for es, ts in zip(entities, terms) for e, (a, b) in es.items()
                   for t in {t for t, (c, d) in ts if d <= a or b <= c})
    levels = {}
    for (e, t), n in both.items():
        if n_entity[e] * 2**P.MIN_BITS <= total:
            bits = math.log2((total * n / n_entity[e] + P.SHRINK) / (n_term[t] + P.SHRINK))
            share = bits / math.log2(total / n_entity[e])
            if bits >= P.MIN_BITS and share >= P.GENERALISE:
                levels[t] = max(levels.get(t, ""), "remove" if share >= P.REMOVE else "generalise")
    return levels


def test_terms_that_reveal_an_entity(spark):
    """Every entity counts: six lines, one line nine times, one line once; common words stay."""
    rows = planted() + [(20, "Call Wilhelmina about the harbour: +49 1512 3456789.")]
    marked = marked_terms(spark.createDataFrame(rows, "doc_id long, text string"))
    terms = {t: k for t, k in marked.items() if k in ("generalise", "remove")}
    assert terms == plain_terms([x for _, t in rows for x in t.split("\n")])
    assert terms["zebulon-quark"] == terms["hapax"] == "remove" and "wilhelmina" in terms
    assert not {"write", "harbour", "the", "about"} & terms.keys()
    assert {t for t, k in marked.items() if k == "email"} == {"boss@corp.example", "other@corp.example"}


def test_given_documents(spark, docs, texts):
    lines = [x for t in texts.values() for x in (t or "").split("\n")]
    levels = plain_terms(lines)
    marked = {t: k for t, k in marked_terms(docs).items() if k in ("generalise", "remove")}
    assert marked and marked.items() <= levels.items()


def test_ordinary_words_beside_a_frequent_address(spark):
    """An address in half of all lines has one bit to reveal; nothing beside it is marked."""
    lines = [f"word{i % 71} and more by desk@corp.example" if i % 2 else f"line {i} of the report" for i in range(600)]
    docs = spark.createDataFrame([(i, "\n".join(lines[i::6])) for i in range(6)], "doc_id long, text string")
    assert marked_terms(docs) == {"desk@corp.example": "email"}


def test_parts_of_the_entity_beside_it_are_marked(spark):
    lines = [f"the harbour report number w{i} was read on day {i % 7}." for i in range(300)]
    lines += [f"Ask Jane Doe of Corp for item z{i}: jane.doe@corp.example" for i in range(4)]
    docs = spark.createDataFrame([(i, "\n".join(lines[i::4])) for i in range(4)], "doc_id long, text string")
    marked = marked_terms(docs)
    assert {"jane", "doe", "corp"} <= marked.keys() and "jane.doe" not in marked


def test_entity_in_every_line(spark):
    docs = spark.createDataFrame([(1, "Ask Ann at a@b.co"), (2, "Ask Bob at a@b.co")], "doc_id long, text string")
    assert marked_terms(docs) == {"a@b.co": "email"}


def test_sql_agrees_on_marked_terms(spark):
    import duckdb
    import pandas as pd

    rows = planted() + [(100 + i, t) for i, t in enumerate(TEXTS[:10])]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("documents", documents)
    expected = {r[0]: r[-1] for r in con.execute(ORACLES["op4_pii"]).fetchall()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = P.find_personal_data(docs, keep=["doc_id"]).select("doc.doc_id", P.joined_spans(P.F.col("spans")).alias("spans"))
    assert {r.doc_id: r.spans for r in found.collect()} == expected
    assert any("remove" in s for s in expected.values()) and any("generalise" in s for s in expected.values())
