"""HTML extraction: the article of the given pages, and small pages with a known answer."""

import re
from html import escape, unescape

import pytest

from clauselens.llm import html_text as H
from clauselens.llm.queries import QUERIES

LONG = "This is the text of a paragraph that is long enough, and it has the words of the language in it."


def plain_article(html):
    """The blocks between the tags of the only article, by regular expressions."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1]
    blocks = (re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(t for t in (" ".join(unescape(b).split()) for b in blocks) if t)


def test_query(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op6_html_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.text == plain_article(pages[r.page_id].html)
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(("html", "text"), [
    (None, ""),
    ("", ""),
    ("   \n ", ""),
    ("just words &amp; &eacute;&#33;", "just words & é!"),
    ("<p>a<br>b\n\t c</p>", "a b c"),
    ("<article><h1>T</h1><p>One<p>Two<ul><li>x<li>y</ul></article><footer>f", "T\nOne\nTwo\nx\ny"),
    ("<article><p>a</p><aside>no</aside><nav>no</nav><form>no</form><p>b</p></article>", "a\nb"),
    ("<article><p>a</p><div class='ad-box ad'>no</div><p>b</p><section id=comments><article>c</article></section>", "a\nb"),
    ("<main><script>if (a < b) { x = '<p>no</p>' }</script><style>p{}</style><!-- <p>no</p> --><p>yes</p></main>", "yes"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<article hidden><p>no</p></article><article><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    ("<div class='cookie-notice'><p>" + LONG + "</p></div><div><p>" + LONG + "</p><p>Short.</p></div>", LONG + "\nShort."),
    ("<ul><li><a href=a>Home</a><li><a href=b>News</a></ul><h2>Head</h2><p>" + LONG + "</p><p><a href=c>More</a></p>",
     "Head\n" + LONG),
    ("<article><p>unclosed <b>bold <i>both<p>next</article>", "unclosed bold both\nnext"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ("<article><p title=\"a > b\">x</p></article>", "x"),
])
def test_pages(html, text):
    assert H.main_text(html) == text


CARD = "<article class=teaser><p><a href=x>Another page</a></p></article>"


@pytest.mark.parametrize(("html", "text"), [
    (f"<div id=content><p>{LONG}</p><p>Short.</p></div>{CARD}", f"{LONG}\nShort."),
    (f"<article><p>{LONG}</p><p><a href=x>a list of links to other pages</a></p></article>", LONG),
    ("<p>x</p><article><p>" + "zażółć gęślą jaźń " * 9 + "</p></article>", ("zażółć gęślą jaźń " * 9).strip()),
    ("<article><p title='the hidden cost'>a</p><p data-x=hidden>b</p><a href='/hidden-markov-models'>c</a> d e f</article>", "a\nb\nc d e f"),
    (f"<div data-x='/x?id=menu'><p>{LONG}</p></div><div><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
    (f"<div class='has-sidebar'><article><p>{LONG}</p></article><div class=sidebar>no</div></div>", LONG),
    (f"<div class='page with-footer'><p>{LONG}</p></div><p>b</p>", f"{LONG}\nb"),
    (f"<div class='navbar layout'><main><p>{LONG}</p></main></div><div class=comments><p>{LONG * 5}</p></div>", LONG),
])
def test_place_is_one_input(html, text):
    assert H.main_text(html) == text


RUSSIAN = "Это довольно длинный абзац текста, который написан на языке без перечисленных слов, и он здесь нужен."
CHINESE = "这是一个很长的段落，用来说明没有列出语言的网页也应该保留它的正文内容。" * 2


@pytest.mark.parametrize(("html", "text"), [
    # languages without listed stop words
    (f"<ul><li><a href=a>Дом</a><li><a href=b>Новости</a></ul><div id=content><h1>Тема</h1><p>{RUSSIAN}</p><p>{RUSSIAN}</p></div>",
     f"Тема\n{RUSSIAN}\n{RUSSIAN}"),
    (f"<div id=content><p>{CHINESE}</p></div>", CHINESE),
    (f"<article><p>{RUSSIAN}</p></article>", RUSSIAN),
    # a linked paragraph between content, and links at the end
    (f"<main><p>{LONG}</p><p><a href=x>{LONG}</a></p><p>{LONG}</p><p><a href=y>{LONG}</a></p></main>", f"{LONG}\n{LONG}\n{LONG}"),
    # headers of a text and of the page
    (f"<header class=article-header><h1>Title</h1><p>By Ann</p></header><article><p>{LONG}</p></article>", f"Title\nBy Ann\n{LONG}"),
    (f"<header class='entry header'><h1>Title</h1><p>By Ann</p></header><div><p>{LONG}</p></div>", f"Title\nBy Ann\n{LONG}"),
    (f"<header class=site-header><h1>Site</h1></header><div><p>{LONG}</p></div>", LONG),
    # a card without links beside the text
    (f"<div id=content><p>{LONG}</p><p>{LONG}</p></div><article class=teaser><h3>Other</h3><p>A few words.</p></article>", f"{LONG}\n{LONG}"),
])
def test_languages_links_headers_cards(html, text):
    assert H.main_text(html) == text


def two_passes(blocks):
    """The rules written out for pages without articles: (text, link share, is furniture, is heading) to kept texts."""
    def words(text):
        return [w.strip(".,;:!?\"'()") for w in text.lower().split()]

    labels = []
    long_ones = [words(t) for t, x, f, _ in blocks if not f and x <= 0.5 and len(t) >= 70]
    listed = sum(w in H.STOP_WORDS for ws in long_ones for w in ws) >= 0.06 * sum(map(len, long_ones))
    for text, link, furniture, _ in blocks:
        share = sum(w in H.STOP_WORDS for w in words(text)) / len(words(text))
        if furniture or link > 0.5:
            labels.append(False)
        elif len(text) < 70:
            labels.append(None)
        elif listed:
            labels.append(True if share >= 0.15 else None if share >= 0.06 else False)
        else:
            labels.append(True if link <= 0.25 else None)
    kept = []
    for i, (text, _, _, heading) in enumerate(blocks):
        label = labels[i]
        if label is None:
            left = [j for j in range(i) if labels[j] is not None][-1:]
            right = [j for j in range(i + 1, len(blocks)) if labels[j] is not None][:1]
            near = left + right
            if not near:
                label = True
            elif len({labels[j] for j in near}) == 1:
                label = labels[near[0]]
            elif heading:
                label = labels[right[0]]
            else:
                label = labels[min(near, key=lambda j: (abs(j - i), not labels[j]))]
        if label:
            kept.append(text)
    return "\n".join(kept)


def test_two_passes_without_articles(spark, sf):
    """The blocks of the given pages, dealt out anew on pages without articles, against the rules written out."""
    import random

    dice = random.Random(3)
    texts = [t for r in spark.read.parquet(f"{sf}/pages.parquet").collect() for t in H.main_text(r.html).split("\n") if t]
    for _ in range(300):
        blocks = []
        for _ in range(dice.randrange(1, 12)):
            text = dice.choice([LONG, LONG, dice.choice(texts), "A few words.", "zażółć gęślą jaźń " * 6 + "x", RUSSIAN])
            blocks.append((" ".join(text.split()), dice.choice([0, 0, 0, 0.4, 1]), dice.random() < 0.15, dice.random() < 0.15))
        html, seen = "", []
        for text, link, furniture, heading in blocks:
            cut = int(len(text) * link)
            cut = len(text) if link == 1 else text.rfind(" ", 0, cut) + 1
            tag, name = ("h2" if heading else "p"), (" class=nav" if furniture else "")
            html += f"<{tag}{name}><a href=x>{escape(text[:cut])}</a>{escape(text[cut:])}</{tag}>"
            seen.append((text, len(text[:cut].strip()) / len(text), furniture, heading))
        if sum(len(t) for t, _, f, _ in seen if f) * 2 < sum(len(t) for t, *_ in seen):
            assert H.main_text(html) == two_passes(seen)


def test_second_pass_uses_the_nearest_decided_block():
    furniture = "".join(f"<p><a href=x>link number {i} to another page of this site</a></p>" for i in range(3))
    page = f"{furniture}<p>Near the links.</p>{furniture}<p>{LONG}</p><p>Near the text.</p><p>{LONG}</p>"
    assert H.main_text(page) == f"{LONG}\nNear the text.\n{LONG}"


def test_long_and_hostile_pages():
    assert H.main_text("<article>" + "<p>word</p>" * 50_000) == "\n".join(["word"] * 50_000)
    assert H.main_text("<div>" * 20_000 + "deep") == "deep"
    assert H.main_text("<article>" + "<a " * 20_000) == ""


def test_cases(spark):
    rows = [(1, None, 5, "x"), (1, None, 5, "x"), (None, "<p>a</p>", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, n_chars int, text string")
    found = H.extract_text(pages).collect()
    assert sorted((r.text, r.n_chars, r.doc.n_chars or 0) for r in found) == [("", 0, 5), ("", 0, 5), ("a", 1, 0)]
    assert H.extract_text(pages.limit(0)).collect() == []
