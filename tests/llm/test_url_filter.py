"""URL rules and the language-model ratio against a plain version."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from clauselens.llm import url_filter as U
from clauselens.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end].translate(LOWER), rest[end:]
    end = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return host, rest[:end]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def spell(host, path):
    return U.START * U.ORDER + host + path + U.END


def held(text):
    return hashlib.md5(text.encode()).hexdigest()[0] in U.HELD_OUT


def model(texts):
    """Shares by plain counting: n[k] counts stretches of k + 1 characters, kinds the different next characters."""
    n = [Counter() for _ in range(U.ORDER + 1)]
    total, kinds = Counter(), defaultdict(set)
    for t in texts:
        for end in range(U.ORDER, len(t)):
            for k in range(U.ORDER + 1):
                gram = t[end - k:end + 1]
                n[k][gram] += 1
                total[k, gram[:-1]] += 1
                kinds[k, gram[:-1]].add(gram[-1])

    def p(gram):
        share = U.UNSEEN
        for k in range(U.ORDER + 1):
            own = gram[U.ORDER - k:]
            seen, different = total[k, own[:-1]], len(kinds[k, own[:-1]])
            if seen:
                share = (n[k][own] + different * share) / (seen + different)
        return share

    return p


def scores(urls):
    split = [parts(u) for u in urls]
    rules = [rule(*s) for s in split]
    allow, block = (model([spell(*s) for s, r in zip(split, rules) if r[1] == v and not held(spell(*s))]) for v in ("allow", "block"))
    out = []
    for s in split:
        t = spell(*s)
        grams = [t[i:i + U.ORDER + 1] for i in range(len(t) - U.ORDER)]
        out.append(sum(math.log(allow(g) / block(g)) for g in grams) / len(grams))
    return split, rules, out


def expected(urls):
    split, rules, score = scores(urls)
    stats = {}
    for v in ("allow", "block"):
        own = [round(x * 1000) for x, r, s in zip(score, rules, split) if r[1] == v and held(spell(*s))]
        if not own:
            return split, rules, score, [r[1] or "allow" for r in rules], math.inf
        mean = sum(own) / len(own)
        stats[v] = mean, math.sqrt(max(0.0, sum(x * x for x in own) / len(own) - mean * mean)) + 1
    (ma, da), (mb, db) = stats["allow"], stats["block"]
    limit = (ma * db + mb * da) / (da + db) / 1000
    return split, rules, score, [r[1] or ("block" if x < limit else "allow") for x, r in zip(score, rules)], limit


def test_query(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").orderBy("page_id").collect()
    split, rules, score, verdicts, limit = expected([p.url for p in pages])
    rows = {r.page_id: r for r in QUERIES["op8_url_filter"](spark, sf).collect()}
    for p, (host, path), (name, _), x, verdict in zip(pages, split, rules, score, verdicts):
        r = rows[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict or abs(x - limit) < 1e-6
    assert len(rows) == len(pages) and {"allow", "block"} == {r.verdict for r in rows.values()}


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/A?x#y", "http://www.example.com/en/", "http://com", "http://a.com/",
    "http://xcom/", "https://b.net/es/1", "https://b.net/ES/1", "https://net/fr/", "http://u@h.net:80/fr/?q", "http://exämple.org/ü",
    "http://x.org/a://b.com/", "a://b.com#/", "http://b.com\n/en", "http://a.com/", "http://a.com/",
]


MANY = URLS + [f"http://shop{i}.com/offer/{i}" for i in range(20)] + [f"https://casino{i}.net/fr/win-{i}" for i in range(20)]


def test_cases(spark):
    rows = spark.createDataFrame([(i, u, "h", 1.0, None) for i, u in enumerate(MANY)],
                                 "page_id long, url string, host string, score double, text string")
    split, rules, score, verdicts, limit = expected(MANY)
    found = U.judge_urls(rows).collect()
    assert len(found) == len(MANY) and limit < math.inf
    for r in found:
        i = r.doc.page_id
        assert (r.host, r.path, r.rule) == (*split[i], rules[i][0])
        assert r.score == pytest.approx(score[i], abs=1e-6)
        assert r.verdict == verdicts[i] or abs(score[i] - limit) < 1e-6
    assert U.judge_urls(rows.limit(0)).collect() == []
    nothing = U.judge_urls(rows.where("page_id < 4")).collect()
    assert {r.verdict for r in nothing} == {"allow"}


def test_every_character_counts(spark):
    """Digits, signs and scripts are told apart, and long strings are learned."""
    known = [f"http://a{i}.com/x" for i in range(40)] + [f"http://казино{i}.net/fr/111" for i in range(40)]
    asked = ["http://казино.рф/777", "http://погода.рф/123", "http://news111.org/", "http://news987.org/", "http://x.org/fr/111"]
    rows = spark.createDataFrame(list(enumerate(known + asked)), "page_id long, url string")
    found = {r.doc.url: r for r in U.judge_urls(rows).collect()}
    scores_ = [found[u].score for u in asked]
    assert len(set(scores_)) == len(asked)
    assert scores_[0] < scores_[1] and scores_[2] < scores_[3] and found[asked[0]].verdict == "block"


def test_a_gram_in_all_urls(spark, monkeypatch):
    """Hot grams are joined apart, with the same result."""
    rows = spark.createDataFrame(list(enumerate(MANY)), "page_id long, url string")
    results = []
    for hot in (1, 50, 10**6):
        monkeypatch.setattr(U, "HOT", hot)
        results.append(sorted((r.doc.page_id, r.score, r.verdict) for r in U.judge_urls(rows).collect()))
    assert results[0] == results[1] == results[2]
