"""Near-duplicate join and substring deduplication against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from clauselens.llm import minhash_join as J
from clauselens.llm import suffix_dedup as S
from clauselens.llm.queries import QUERIES

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids, links, root = sorted(sets), Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and both * 5 >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in ids}


def found(frame):
    return {r.doc_id: (r.class_id, r.n_links) for r in frame.collect() if r.doc_id is not None}


def test_join_query(spark, sf, texts):
    assert found(QUERIES["op3_minhash_join"](spark, sf)) == brute_classes(texts)


def varied(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(out)


def test_large_group_of_near_copies_is_compared_in_tiles(spark):
    rng = random.Random(5)
    base = [f"word{rng.randrange(5000)}" for _ in range(160)]
    texts = {i: varied(rng, base, i % 6) for i in range(3 * J.TILE)}
    texts |= {10_000 + i: varied(rng, [f"other{rng.randrange(9999)}" for _ in range(90)], 0) for i in range(50)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found(J.near_duplicates(docs)) == brute_classes(texts)


def test_join_cases(odd_docs, no_docs):
    rows = J.near_duplicates(odd_docs).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    expected = brute_classes(texts)
    assert len(rows) == 13 and sorted(r.doc_id for r in rows if r.doc_id is not None)[5:7] == [5, 5]
    for r in rows:
        assert (r.class_id, r.n_links) == ((None, 0) if r.doc_id is None else expected[r.doc_id])
    assert J.near_duplicates(no_docs).collect() == []


def test_chain_has_one_class(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, 1001), (1001, 1000), (2000, 2000)]
    rows = J.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in rows} == {**{i: 0 for i in range(401)}, 1000: 1000, 1001: 1000}


def test_pruning_keeps_pairs_above_the_threshold():
    rng = np.random.default_rng(1)
    lost = total = 0
    for _ in range(40):
        common = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 2 ** 63, k, dtype=np.uint64)])) for k in (20, 40, 45)]
        values = np.stack([J.minhashes(s) for s in sets])
        a, b = J.pruned_pairs(values, values, True)
        kept = set(zip(a.tolist(), b.tolist()))
        for x in range(3):
            for y in range(x + 1, 3):
                similar = 400 / (len(sets[x]) + len(sets[y]) - 400) >= 0.8
                total += similar
                lost += similar and (x, y) not in kept
    far = np.stack([J.minhashes(rng.integers(0, 2 ** 63, 300, dtype=np.uint64)) for _ in range(30)])
    assert total == 120 and lost == 0 and len(J.pruned_pairs(far, far, True)[0]) == 0
    assert J.least_matches(16) < J.least_matches(128) < 103


def brute_cut(texts, width=50):
    """{id: (bytes, removed, runs, digest)} by a table of all strings."""
    least = {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        for k in range(len(b) - width + 1):
            least.setdefault(b[k:k + width], i)
    out = {}
    for i, t in texts.items():
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if least[b[k:k + width]] < i:
                gone[k:k + width] = b"\1" * width
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def cut_rows(frame, doc="doc"):
    return [(r[doc].doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256), r) for r in frame.collect()]


def test_dedup_query(spark, sf, texts):
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op2_suffix_dedup"](spark, sf).collect()}
    assert rows == brute_cut(texts)


def test_dedup_of_shared_and_periodic_passages(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdeé ") for _ in range(300))
    texts = {}
    for i in range(80):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 200)))
        a, b = sorted(rng.randrange(300) for _ in range(2))
        texts[i * 7 % 80] = own + passage[a:b] + own[::-1]
    texts |= {100: "a" * 500, 101: "b" + "a" * 70 + "b", 102: "ab" * 200, 103: "ba" * 60 + "c", 104: "a" * 49, 105: "a" * 50}
    texts |= {200: passage, 201: passage + passage, 202: passage[:49], 203: "é" * 60, 204: "é" * 24 + "x" + "é" * 25}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    frame = S.remove_repeats(docs)
    rows = cut_rows(frame)
    assert {i: f for i, f, _ in rows} == brute_cut(texts)
    for _, figures, r in rows:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == figures[3]


def test_dedup_cases(odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    expected = brute_cut(texts)
    rows = cut_rows(S.remove_repeats(odd_docs, kept_text=False))
    assert len(rows) == 13
    for i, figures, r in rows:
        whole = (r.doc.text or "").encode()
        assert figures == (expected[i] if i is not None else (len(whole), 0, 0, hashlib.sha256(whole).hexdigest()))
    assert S.remove_repeats(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_collection_has_the_order_and_prefixes_of_its_suffixes(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab" if seed % 2 else "abcd") for _ in range(rng.randrange(1, 14))) for _ in range(30)]
    data = np.frombuffer("".join(parts).encode(), dtype=np.uint8)
    length = np.array([len(p) for p in parts])
    built = S.Collection(data, np.cumsum(length) - length, length, 6)
    suffixes = sorted((p[k:], n, len(p) - k) for n, p in enumerate(parts) for k in range(len(p) + 1))
    # ends of documents come before all symbols, in the order of the documents
    assert [(int(o), int(s)) for o, s in zip(built.owner, built.size)] == [(n, s) for _, n, s in suffixes]
    transform = [0 if s == len(parts[n]) else ord(parts[n][len(parts[n]) - s - 1]) + 1 for _, n, s in suffixes]
    assert built.symbol.tolist() == transform

    def common(x, y):
        n = 0
        while n < min(len(x), len(y), 6) and x[n] == y[n]:
            n += 1
        return n

    assert built.prefix.tolist()[1:] == [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]


def template_texts():
    """A phrase in every text with different surroundings, and a passage that some share."""
    rng = random.Random(8)
    phrase = "the terms of this standard notice apply"
    passage = "".join(rng.choice("abcdefgh ") for _ in range(130))
    return {i: f"{rng.random()} name {rng.random()}, {phrase} as of {rng.random()} and {i % 40} days after{' ' + passage if i % 9 == 0 else ''}"
            for i in range(700)}


@pytest.mark.parametrize("hot", [0, 2, 1000])
def test_hot_anchors_are_dealt_by_string(spark, hot):
    """One anchor that all texts share: whether its strings are spread or travel together, the result is the same."""
    texts = template_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = cut_rows(S.remove_repeats(docs, kept_text=False, hot_groups=hot, group_bytes=4_000))
    assert {i: f for i, f, _ in rows} == brute_cut(texts)


def test_strings_of_a_hot_anchor_go_to_many_buckets():
    """Every group sends a template's stretches to one bucket, its single strings to nearly all."""
    texts = [t.encode() for t in template_texts().values()]
    buckets, used = 16, {}
    for hot in (0, 10**6):
        held = dict(S.sorted_anchors(texts, buckets))
        bits = {b: S.shared_bits([a, a], hot)[0] for b, a in held.items()}
        sent = list(S.dealt(texts, np.arange(len(texts)), bits, buckets))
        used[hot] = [len(S.unpack(r[2], np.uint8)) for r in sent]
    assert max(used[0]) < 2 * sum(used[0]) / buckets and max(used[10**6]) > 2 * sum(used[10**6]) / buckets


def template_pages(n, shared):
    rng = random.Random(2)
    common = [f"menu{i}" for i in range(shared)]
    return {i: " ".join(common + [f"own{rng.randrange(10 ** 6)}" for _ in range(60)]) for i in range(n)}


def test_pages_of_a_template_make_no_group(spark):
    """Texts that share half of their words agree in bands, but no pair of them stays and no text is sent."""
    pages = template_pages(600, 62)
    copies = {10_000 + i: pages[i] + " more" for i in range(5)}
    docs = spark.createDataFrame(list((pages | copies).items()), "doc_id long, text string")
    prints = J.fingerprints(docs, "doc_id", "text")
    edges = {frozenset((r.a, r.b)) for r in J.surviving(prints).collect()}
    assert edges == {frozenset((i, 10_000 + i)) for i in range(5)}
    codes = Counter(c for r in prints.collect() for c in enumerate(r.bands))
    assert max(codes.values()) > 20  # the bands alone would chain them together
    assert found(J.near_duplicates(docs)) == brute_classes(pages | copies)


def test_large_bands_are_tiled(spark, monkeypatch):
    """More members of a band than a tile: the same connections from tiles, in one or in two sides."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (3, J.VALUES), dtype=np.uint8)
    rows = [(i, [7] * J.BANDS, bytes(np.where(rng.random(J.VALUES) < 0.08, rng.integers(0, 256, J.VALUES), base[i % 3]).astype(np.uint8)))
            for i in range(90)]
    reps = spark.createDataFrame(rows, "id long, bands array<long>, sketch binary")
    for size in (4096, 13):
        monkeypatch.setattr(J, "BAND_TILE", size)
        classes = J.components(J.surviving(reps)).collect()
        assert {r.id: r.component for r in classes} == {i: i % 3 for i in range(90)}


def test_connections_are_those_of_all_pairs():
    rng = np.random.default_rng(6)
    for two in (False, True):
        sketches = rng.integers(0, 256, (1, J.VALUES), dtype=np.uint8).repeat(70, 0)
        for row in sketches:
            at = rng.random(J.VALUES) < rng.choice([0.1, 0.2, 0.3])
            row[at] = rng.integers(0, 256, at.sum())
        side = rng.integers(0, 2, 70) if two else np.zeros(70, dtype=np.int64)

        def classes(edges):
            root = list(range(70))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for x, y in edges:
                root[find(x)] = find(y)
            return {frozenset(i for i in range(70) if find(i) == r) for r in {find(i) for i in range(70)}}

        every = [(x, y) for x in range(70) for y in range(x) if (not two or side[x] != side[y]) and J.stays(sketches[x], sketches[[y]])[0]]
        assert classes(J.connected(sketches, side)) == classes(every)


def test_a_hub_with_many_neighbours(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_NODE", 10)
    edges = [(0, i) for i in range(1, 300)] + [(299, 500), (500, 501), (900, 901)]
    rows = J.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in rows} == {**{i: 0 for i in range(300)}, 500: 0, 501: 0, 900: 900, 901: 900}
