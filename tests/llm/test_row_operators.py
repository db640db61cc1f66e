"""Decontamination, quality rules and sharding against plain versions."""

import hashlib
import re
from collections import Counter

from clauselens.llm import decontaminate as D
from clauselens.llm import quality_rules as R
from clauselens.llm import sharding as S
from clauselens.llm.queries import QUERIES

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_hits(text, items, width=13):
    words = WORDS.findall((text or "").translate(LOWER))
    hit, ids = [False] * len(words), set()
    for item_id, item in items:
        own = WORDS.findall((item or "").translate(LOWER))
        n = min(width, len(own))
        windows = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in windows:
                hit[i:i + n] = [True] * n
                ids.add(item_id)
    return len(words), sum(hit), sorted(str(i) for i in ids if i is not None)


def test_decontamination_query(spark, sf, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in QUERIES["op5_decontaminate"](spark, sf).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        n, hit, ids = brute_hits(text, items)
        r = rows[i]
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(ids))
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
    assert any(r.n_hit for r in rows.values())


def test_decontamination_cases(spark, odd_docs, no_docs):
    items = [(1, "met again on"), (2, "WATER"), (None, "the town"), (3, None), (4, "--"), (5, "w0x0 w1x1 w2x2"), (2, "WATER"),
             (10, " ".join(f"w{i % 997}x{i % 13}" for i in range(50, 70)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for most in (D.ROUND_BYTES, 10):  # one block, and one for each item
        found = D.find_contamination(odd_docs, benchmark, round_bytes=most).collect()
        assert len(found) == 13
        for r in found:
            assert (r.n_words, r.n_hit, r.item_ids) == brute_hits(r.doc.text, items), r.doc.doc_id
    assert D.find_contamination(no_docs, benchmark).collect() == []
    assert {r.n_hit for r in D.find_contamination(odd_docs, benchmark.limit(0)).collect()} == {0}


def test_decontamination_in_several_passes(spark, sf, docs, texts, monkeypatch):
    """A benchmark of many blocks over many batches, and names with dots."""
    monkeypatch.setattr(D, "BLOCKS", 2)
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    size = sum(len((t or "").encode()) for _, t in items)
    renamed = benchmark.withColumnsRenamed({"item_id": "an.id", "text": "its.text"})
    found = D.find_contamination(docs, renamed, item_id="an.id", item_text="its.text", keep=["doc_id"], round_bytes=size // 5)
    rows = {r.doc.doc_id: r for r in found.collect()}
    for i, text in texts.items():
        n, hit, ids = brute_hits(text, items)
        assert (rows[i].n_words, rows[i].n_hit, rows[i].item_ids) == (n, hit, ids)


def test_large_benchmark_in_bounded_memory():
    """Tables of 4 MB of benchmark text in well under 200 MB, every window found again."""
    import tracemalloc

    items = [(str(i), b" ".join(b"w%d" % (i * 7919 + j * j % 4001) for j in range(400))) for i in range(1200)]
    tracemalloc.start()
    patterns = D.Patterns(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(t) for _, t in items) > 3_000_000 and peak < 200_000_000
    text = b"x y z " + b" ".join(items[700][1].split()[100:140]) + b" q"
    marks, ids = next(D.scan_texts([text], patterns))
    assert "700" in ids and marks.tolist() == [False] * 3 + [True] * 40 + [False]


def test_wu_manber_finds_overlapping_windows():
    patterns = D.Patterns([("1", b"a a a a"), ("2", b"a b a b a"), ("3", b"b")], width=3)
    text = b"a a a a b a b a b b a a a"
    marks, ids = next(D.scan_texts([text], patterns))
    n, hit, expected = brute_hits(text.decode(), [(1, "a a a a"), (2, "a b a b a"), (3, "b")], 3)
    assert (len(marks), int(marks.sum()), sorted(set(ids))) == (n, hit, expected)


def brute_base(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            duplicates += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), duplicates, len(again), failed)


def figures(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_quality_rules_query(spark, sf, texts):
    rows = {r.doc_id: r for r in QUERIES["op10_quality_rules"](spark, sf).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        assert figures(rows[i]) == brute_base(text)
        assert not (rows[i].kept and rows[i].base_failed)


def test_quality_rules_keep_clean_documents(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op10_quality_rules"](spark, sf).collect()
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert good and all(r.kept for r in good)


def test_quality_rules_cases(odd_docs, no_docs):
    rows = R.clean_lines(odd_docs).collect()
    assert len(rows) == 13
    for r in rows:
        assert figures(r) == brute_base(r.doc.text)
    assert R.clean_lines(no_docs).collect() == []


def test_line_rules():
    body = "\n".join(" ".join(f"word{i}and{j}" for j in range(12)) + "." for i in range(8))
    menu = "Home | About | News | Contact | Login"
    judged = R.judge(f"{menu}\n{body}\nAll rights reserved".encode())
    assert judged["kept"] and judged["n_failed_lines"] == 2 and judged["cleaned"] == body
    table = "\n".join("alpha | beta | gamma | delta | epsilon | zeta" for _ in range(20))
    assert not R.judge(f"{body}\n{table}".encode())["kept"]


def failed(line):
    return R.line_fails(line.encode(), line.encode().split())


def test_notices_and_prose():
    body = "\n".join(" ".join(f"word{i}and{j}" for j in range(12)) + "." for i in range(8))
    notices = ["All rights reserved.", "Licensed under CC BY-NC 4.0.",
               "This work is licensed under the GNU General Public License, version 3."]
    prose = "She told him that the copyright of the song had passed to her aunt long before the war came to the town."
    judged = R.judge("\n".join([body, *notices, prose]).encode())
    assert judged["n_failed_lines"] == 3 and judged["cleaned"] == f"{body}\n{prose}" and judged["lost_share"] > 0
    for line in ["cookies are tasty and she baked them all afternoon", "We sign in blue ink, said the clerk.", "He has all the rights."]:
        assert failed(line) is None


def test_lines_without_an_end_mark():
    for line in ["Read more", "Contact us", "Home", "Share on Facebook Twitter", "Posted in News, Comments (0)", "of the same"]:
        assert failed(line) in ("punctuation", "navigation")
    assert failed("Home Products Services About Us Careers Press Investors Partners") == "navigation"
    for line in ["He came.", 'She said "no."', "(See below.)", "As follows:", "これは文です。", "क्या हाल है।", "هل هذا صحيح؟", "and so on…",
                 "a line of prose that was wrapped by an editor at some", "Der Hund und die Katze und das alte Pferd im Stall"]:
        assert failed(line) is None


def test_every_notice_goes(spark, sf, texts):
    """Lines that are notices in the given documents fail; lines of clean documents do not."""
    notice = re.compile("all rights reserved|licensed under", re.I)
    lines = {line for t in texts.values() if t for line in t.split("\n") if notice.search(line)}
    assert lines and all(failed(line) == "boilerplate" for line in lines)


def test_lookup_table_is_even_and_stable():
    names = [f"s{i}" for i in range(16)]
    full, fewer = S.fill_table(names, 4099), S.fill_table(names[:-1], 4099)
    shares = Counter(full)
    assert sum(shares.values()) == 4099 and max(shares.values()) - min(shares.values()) <= 1
    kept = sum(a == b for a, b in zip(full, fewer))
    assert kept > 0.8 * 4099
    # turn by turn, with the permutations written out
    preference = []
    for name in names:
        digest = hashlib.md5(name.encode()).hexdigest()
        offset, step = int(digest[:16], 16) % 4099, int(digest[16:], 16) % 4098 + 1
        preference.append(iter([(offset + step * j) % 4099 for j in range(4099)]))
    owner = {}
    while len(owner) < 4099:
        for shard, slots in enumerate(preference):
            if len(owner) < 4099:
                owner[next(s for s in slots if s not in owner)] = shard
    assert [owner[s] for s in range(4099)] == full


def test_placement(odd_docs, no_docs, spark, sf):
    names = ["a", "b", "c"]
    rows = S.place(odd_docs, "doc_id", names, 101).collect()
    owners = S.fill_table(names, 101)
    assert len(rows) == 13
    for r in rows:
        key = "" if r.doc.doc_id is None else str(r.doc.doc_id)
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101 and r.shard == names[owners[r.slot]]
    assert S.place(no_docs, "doc_id", names, 101).collect() == []
    sizes = Counter(r.shard for r in QUERIES["op9_sharding"](spark, sf).collect())
    assert sum(sizes.values()) == 200
