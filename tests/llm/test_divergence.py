"""Source divergence against direct sums, and odd inputs."""

import re
from collections import Counter

import numpy as np
import pytest

from clauselens.llm import divergence as D

SCALE = 10**9


def plain(rows, min_docs=10, top=10):
    """(lang, source, part, item, value, rank) by direct counting over (text, lang, source) rows."""
    upper = {i: i + 32 for i in range(65, 91)}
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(upper)))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        holders = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in holders.items() if n >= min_docs]
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in {d[1] for d in mine}}

        def shares(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + SCALE * (found[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) * (p - q) // (p + q)

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(order, 1) if part == "pair" or r <= top]
    return sorted(out)


def audited(frame, **options):
    return sorted(tuple(r) for r in D.audit(frame, **options).collect())


def test_table(spark, docs):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert audited(docs) == plain(rows)


def test_chunks_and_blocks(spark, monkeypatch):
    """Columns over many chunks, and more groups than a block holds."""
    monkeypatch.setattr(D, "CHUNK", 16)
    monkeypatch.setattr(D, "HELD_TERMS", 50)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [(" ".join(words[(i * 7 + j * j) % 120] for j in range(40)), "xy"[i % 11 == 0], f"s{i % 70:02d}") for i in range(700)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert audited(frame, min_docs=3) == plain(rows, min_docs=3)


def test_runs():
    begin, value = D.runs(np.array([1, 2, 5]), np.array([7, 7, 9]), 3, 7)
    assert begin.tolist() == [0, 1, 3, 5, 6] and value.tolist() == [3, 7, 3, 9, 3]
    begin, value = D.runs(np.array([0]), np.array([4]), 3, 1)
    assert begin.tolist() == [0] and value.tolist() == [4]
    before = np.array([0, 2, 3, 10])
    assert D.compared((np.array([0, 2]), np.array([5, 1])), (np.array([0]), np.array([3])), before) == 3 * (4 // 8) + 7 * (4 // 4)


@pytest.mark.parametrize("counts", [[0, 1, 10**10, 3 * 10**11]])
def test_exact_shares(spark, counts):
    total, kept = 10**12, 10**6
    frame = spark.createDataFrame([(n, total, kept) for n in counts], "n long, total long, kept long")
    got = [r.p for r in frame.select(D.share(frame.n, frame.total, frame.kept).alias("p")).collect()]
    assert got == D.shares(np.array(counts), total, kept).tolist() == [1 + SCALE * (n + 2) // (total + 2 * kept) for n in counts]


def test_cases(spark, odd_docs, no_docs):
    texts = ["Ä ä a A", "", None, "a" * 50_000 + " b", "1 2 3 ?!", "é-é é_é É"]
    rows = [(t, lang, source) for t in texts for lang in (None, "", "en") for source in (None, "s", "ö") for _ in range(2)]
    rows += [("only here", "fr", "s"), (None, "de", None), ("", "de", "t")]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "text string, lang string, source string, value long, rank string")
    assert audited(frame, min_docs=2) == plain(rows, min_docs=2)
    assert audited(frame, min_docs=10_000) == plain(rows, min_docs=10_000)
    odd = odd_docs.selectExpr("*", "same as lang")
    assert audited(odd.withColumn("lang", odd.lang.cast("string")), min_docs=1) == plain(
        [(r.text, str(r.lang), r.source) for r in odd.collect()], min_docs=1)
    assert audited(no_docs.selectExpr("*", "host as lang")) == []
