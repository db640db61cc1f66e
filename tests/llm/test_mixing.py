"""Mixing to target weights against a plain version."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from clauselens.llm import mixing as M
from clauselens.llm.queries import QUERIES


def brute_targets(sizes):
    """Weights 1, 2, 3 by source name, null last; limits of three times the size, the rest shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(sizes), Fraction(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] >= 3 * sizes[s] * total}
        if not over:
            return {**target, **{s: left * weight[s] / total for s in free}}
        for s in over:
            target[s] = Fraction(3 * sizes[s])
            left -= target[s]
        free -= over
        if not free:
            return target


def count(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def check(rows, given):
    """rows: (id, source, size, source_size, target, taken); given: (id, source, text)."""
    sizes = defaultdict(int)
    for _, source, text in given:
        sizes[source] += count(text)
    targets = brute_targets(sizes)
    assert len(rows) == len(given)
    taken = defaultdict(int)
    for _, source, size, source_size, target, words in rows:
        assert source_size == sizes[source] and target == pytest.approx(float(targets[source]), abs=1e-6)
        assert 0 <= words <= 3 * size
        taken[source] += words
    assert sum(taken.values()) == sum(sizes.values())
    for source in sizes:
        # a packet behind, or what all others are behind
        assert abs(taken[source] - targets[source]) <= M.QUANTUM * max(1, len(sizes))


def plain_mix(given, seed=0):
    """Words served in each pass of (id, source, text) rows with different ids, by sorting all packets."""
    queues = defaultdict(list)
    for i, source, text in given:
        queues[source].append((hashlib.md5(f"{seed}\x1f{i}".encode()).hexdigest(), i, count(text)))
    sizes = {s: sum(n for *_, n in q) for s, q in queues.items()}
    targets = brute_targets(sizes)
    packets = []
    for source, queue in queues.items():
        for turn in range(3):
            at = turn * sizes[source]
            for _, i, n in sorted(queue):
                for begin in range(0, n, M.QUANTUM):
                    end = min(begin + M.QUANTUM, n)
                    if targets[source]:
                        packets.append(((at + end) / float(targets[source]), source is not None, source or "", at, begin, i, turn, end - begin))
                at += n
    left, served = sum(sizes.values()), defaultdict(int)
    for *_, i, turn, words in sorted(packets):
        served[i, turn] += min(words, left)
        left -= min(words, left)
    return {k: n for k, n in served.items() if n}


def test_against_a_sort_of_all_packets(spark, docs):
    given = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    expected = plain_mix(given)
    got = {(r.doc.doc_id, r["pass"]): r.words for r in M.mix(docs, keep=["doc_id"]).collect()}
    assert got == expected


def test_query(spark, sf, docs):
    given = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    source = {i: s for i, s, _ in given}
    rows = QUERIES["op1_mixing"](spark, sf).collect()
    again = QUERIES["op1_mixing"](spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    check([(r.doc_id, source[r.doc_id], r.size, r.source_size, r.target, r.taken) for r in rows], given)


@pytest.mark.parametrize("sizes", [
    {"a": 100}, {"a": 1000, "b": 1, "c": 1}, {"a": 5, "b": 5, "c": 5, "d": 5}, {"a": 0, None: 10}, {"b": 7, "a": 900, None: 50},
    {"a": 0}, {f"s{i}": (i * 37) % 11 for i in range(40)},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in M.source_targets(rows).collect()}
    for source, target in brute_targets(sizes).items():
        assert found[source] == pytest.approx(float(target), abs=1e-9)


def test_cases(odd_docs, no_docs):
    given = [(r.doc_id, r.source, r.text) for r in odd_docs.collect()]
    rows = M.serve(odd_docs).collect()
    check([(r.doc.doc_id, r.doc.source, r.size, r.source_size, r.target, r.taken) for r in rows], given)
    assert M.serve(no_docs).collect() == [] and M.mix(no_docs).collect() == []


def test_stream_is_in_order_and_keeps_the_shares(spark):
    rows = [(i, "abc"[i % 3], "w " * (1 + i * 7 % 13)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    stream = M.mix(docs).collect()
    times = [r.virtual_finish for r in stream]
    assert times == sorted(times)
    served = {(r.doc.doc_id): r.taken for r in M.serve(docs).collect()}
    words, total = defaultdict(int), defaultdict(int)
    for r in stream:
        words[r.doc.doc_id] += r.words
    assert {i: w for i, w in served.items() if w} == dict(words)
    for r in stream[:len(stream) // 2]:
        total[r.doc.source] += r.words
    assert total["b"] / total["a"] == pytest.approx(2, rel=0.1) and total["c"] / total["a"] == pytest.approx(3, rel=0.1)


def test_queue_order_is_the_digest(spark):
    docs = spark.createDataFrame([(i, "a", "w") for i in range(50)], "doc_id long, source string, text string")
    rows = {r.doc.doc_id: r.start_words for r in M.serve(docs).collect()}
    order = sorted(range(50), key=lambda i: hashlib.md5(f"0\x1f{i}".encode()).hexdigest())
    assert [rows[i] for i in order] == list(range(50))
