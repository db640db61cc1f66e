"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags.  The first pass decides what it can from a block
alone: its place (menus, page headers, footers, sidebars, notices, adverts, forms and comments are
boilerplate), its link density, its length and its density of stop words, inside and outside articles.  The
second pass lets undecided blocks inherit the label of the nearest decided neighbours on the same side of
an article's border; without any, a block of an article is content, and one beside an article is not.
Stop words decide only on pages where they occur: in a language that is not listed, length and links do.
Articles that hold less text than what is found beside them are cards: only their long text counts.
A long linked paragraph of an article between two paragraphs of content is content as well.  A header that is named after an article or
post belongs to it, wherever it stands.  A furniture name on a wrapper counts for nothing if the page's main element or most of its text is below it.

Cases: null or empty html gives an empty text; unclosed tags end with their parent or the page; a page
without tags is one block; identical rows are judged alike; tables may be empty; other columns are
left alone.  White space inside a block becomes one space, references are decoded, and the blocks
kept are joined by a newline in page order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from clauselens.llm.common import text_column, with_text

# fixed values: names of the language's tags, by their role here
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - {"head", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SIBLINGS = {"li", "dt", "dd", "tr", "td", "th"}
HIDDEN = {"head", "noscript", "template", "svg", "math", "canvas", "object", "select", "button", "datalist", "audio", "video"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog"}
# fixed values: words in class or id names, and roles, of page furniture
NAMES = set(
    "ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar aside widget nav navbar "
    "navigation menu breadcrumb breadcrumbs masthead footer comment comments commentlist respond disqus reply replies "
    "share sharing social related recommended login signup search searchform pagination pager toolbar skip".split())
COMMENTS = {"comment", "comments", "commentlist", "respond", "disqus", "reply", "replies"}
LASTING = {"comment", "comments", "commentlist", "respond", "disqus", "replies", "sidebar", "aside", "footer"}
# fixed values: words in names of headers that belong to a text and not to the page
STORY = {"article", "entry", "headline", "post", "story", "title"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
# fixed values: frequent function words of the languages handled
STOP_WORDS = set((
    "the of and a to in is it that for on with as was be by are this from at or an not have has but they his her "
    "le la les de des du un une et en dans que qui est pour par sur avec au aux ce pas plus ne se il elle entre "
    "der die das und ist von mit für den dem ein eine zu im nicht auf als auch sich es an werden aus er sie dass "
    "el los las del y que en por con para una su se no lo al como más o es").split())

SHORT = 70
HIGH_LINKS, LOW_STOPS, HIGH_STOPS = 0.5, 0.06, 0.15
# shares of the page's text above which a wrapper's furniture name counts for nothing; the second one if it
# names comments or if an article is outside it
MOST, NEARLY_ALL = 0.5, 0.9

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?|\"[^\"]*\"|'[^']*'")
NAME_WORD = re.compile(r"[^a-z0-9]+")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Open:
    """An open element: what it says about the text below it."""

    tag: str
    hidden: bool
    furniture: bool
    lasting: bool  # an article below it is part of it (a comment, a teaser in a sidebar)
    article: bool
    link: bool
    wrapper: int = -1  # the innermost element with a furniture name
    story: bool = False  # in a header that is named after an article


@dataclass(slots=True)
class Wrapper:
    """An element with a furniture name: what is below it."""

    above: int
    comments: bool
    size: int = 0
    articles: int = 0
    mains: int = 0


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    furniture: bool
    article: bool
    heading: bool
    item: bool
    story: bool = False
    good: bool | None = field(default=None)


def _names(rest: str) -> tuple[set[str], str, bool]:
    """(words of class and id, role, is it hidden) of a start tag."""
    words: set[str] = set()
    role, hidden = "", False
    for name, a, b, c in ATTRIBUTE.findall(rest):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            words.update(NAME_WORD.split(value))
        elif name == "role":
            role = value
        elif name == "style":
            hidden |= bool(INVISIBLE.search(value))
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
    return words, role, hidden


def _opened(tag: str, rest: str, stack: list[Open], wrappers: list[Wrapper], nameless: set[int]) -> Open:
    above = stack[-1] if stack else Open("", False, False, False, False, False)
    words, role, hidden = _names(rest) if rest.strip() else (set(), "", False)
    lasting, furniture, article = above.lasting, above.furniture, above.article
    wrapper, story = above.wrapper, above.story
    is_main, is_article = tag == "main" or role == "main", tag == "article" or role == "article"
    wrappers[wrapper].mains += is_main
    wrappers[wrapper].articles += is_article
    if words & (LASTING if is_main or is_article else NAMES | LASTING) and tag not in ("html", "body"):
        wrapper = len(wrappers) - 1
        wrappers.insert(wrapper, Wrapper(above.wrapper, bool(words & COMMENTS)))
        if wrapper in nameless:
            words = set()
    if tag in ("article", "main") or role in ("main", "article"):
        if not above.lasting:
            furniture, article = False, True
        if words & LASTING and tag == "article":
            furniture = lasting = True
    elif tag not in ("html", "body"):
        named = bool(words & NAMES) or role in ROLES
        story |= tag == "header" and bool(words & STORY) and not furniture
        furniture |= tag in FURNITURE or named or tag == "header" and not above.article and not story
        lasting |= tag in ("aside", "footer", "nav") or bool(words & LASTING)
    return Open(tag, above.hidden or hidden or tag in HIDDEN, furniture, lasting, article,
                above.link or tag == "a", wrapper, story)


def _nameless(wrappers: list[Wrapper]) -> set[int]:
    """The wrappers whose furniture name counts for nothing; the last one is the page."""
    page = wrappers[-1]
    for w in reversed(wrappers[:-1]):
        above = wrappers[w.above]
        above.size, above.articles, above.mains = above.size + w.size, above.articles + w.articles, above.mains + w.mains
    found = set()
    for i, w in enumerate(wrappers[:-1]):
        outside = page.articles + page.mains > w.articles + w.mains
        most = NEARLY_ALL if w.comments or outside else MOST
        if 0 < w.mains == page.mains or w.size > most * page.size:
            found.add(i)
    return found


def blocks_of(html: str) -> list[Block]:
    """The visible blocks of a page, in order; read again if furniture names count for nothing."""
    wrappers = [Wrapper(-1, False)]
    found = _blocks(html, wrappers, set())
    nameless = _nameless(wrappers)
    return _blocks(html, [Wrapper(-1, False)], nameless) if nameless else found


def _blocks(html: str, wrappers: list[Wrapper], nameless: set[int]) -> list[Block]:
    found: list[Block] = []
    pieces: list[str] = []
    linked = 0
    stack: list[Open] = []
    owner: Open | None = None
    place = ""

    def flush() -> None:
        nonlocal linked, owner
        text = " ".join("".join(pieces).split())
        if text and owner is not None:
            found.append(Block(text, min(linked, len(text)), owner.furniture, owner.article,
                               len(place) == 2 and place[0] == "h" and place[1].isdigit(), place == "li", owner.story))
        pieces.clear()
        linked, owner = 0, None

    def say(text: str) -> None:
        nonlocal linked, owner
        top = stack[-1] if stack else Open("", False, False, False, False, False)
        if top.hidden or not text:
            return
        if owner is not None and (owner.furniture, owner.article) != (top.furniture, top.article):
            flush()
        text = unescape(text)
        wrappers[top.wrapper].size += len(" ".join(text.split()))
        if owner is None and not text.isspace():
            owner = top
        pieces.append(text)
        if top.link:
            linked += len(" ".join(text.split()))

    at = 0
    while True:
        m = TOKEN.search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            flush()
            place = tag if not m["end"] else ""
        if m["end"]:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d].tag == tag), -1)
            if depth >= 0:
                del stack[depth:]
        elif tag in RAW:
            closing = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = closing.end() if closing else len(html)
        elif tag not in VOID and not m["rest"].endswith("/"):
            # a block ends an open paragraph, an item the item before it
            for d in range(len(stack) - 1, -1, -1):
                if tag in CLOSES_P and stack[d].tag == "p" or stack[d].tag == tag and tag in SIBLINGS:
                    del stack[d:]
                elif stack[d].tag in BLOCKS:
                    break
            stack.append(_opened(tag, m["rest"], stack, wrappers, nameless))
    flush()
    return found


def _length(text: str) -> int:
    """Characters; those of scripts that write a word in one or two count three times."""
    return len(text) if text.isascii() else len(text) + 2 * sum(ch >= "\u2e80" for ch in text)


def _stops(text: str) -> tuple[int, int]:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words), len(words)


def classify(blocks: list[Block]) -> None:
    """Both passes; sets ``good`` on every block."""
    has_article = any(b.article and not b.furniture for b in blocks)
    for b in blocks:
        b.article |= has_article and b.story and not b.furniture
    lengths = [_length(b.text) for b in blocks]
    links = [b.linked / len(b.text) for b in blocks]
    counts = [_stops(b.text) if n >= SHORT and not b.furniture and x <= HIGH_LINKS else None for b, n, x in zip(blocks, lengths, links)]
    known = [c for c in counts if c]
    # few stop words on the whole page: its language is not among the listed ones
    listed = sum(c[0] for c in known) >= LOW_STOPS * sum(c[1] for c in known)
    for b, link, count in zip(blocks, links, counts):
        if b.furniture:
            b.good = False
        elif link > HIGH_LINKS:
            b.good = None if b.article and b.heading else False
        elif count:
            share = count[0] / count[1]
            if listed:
                b.good = True if share >= HIGH_STOPS else None if share >= LOW_STOPS or b.article else False
            else:
                b.good = True if link <= HIGH_LINKS / 2 else None
    for i in range(1, len(blocks) - 1):
        b = blocks[i]
        if b.article and not b.item and links[i] > HIGH_LINKS and lengths[i] >= SHORT and all(
                n.article and n.good for n in (blocks[i - 1], blocks[i + 1])):
            b.good = True

    def held(inside: bool) -> int:
        return sum(len(b.text) for b in blocks if b.article == inside and not b.furniture and (inside or b.good))

    if has_article and held(True) < held(False):
        for b in blocks:
            if b.article and b.good is None:
                b.good = False
        has_article = False
    if has_article:
        # furniture says nothing about the text beside it
        for inside in (True, False):
            _inherit([b for b in blocks if b.article == inside and not b.furniture], inside)
    else:
        _inherit(blocks, None)


def _inherit(blocks: list[Block], inside: bool | None) -> None:
    """The second pass, over the blocks inside or outside of articles, or over all of a page without any."""
    decided = [b.good for b in blocks]
    before, last = [], None  # (label, distance) of the nearest decided block on each side
    for i, label in enumerate(decided):
        before.append(last)
        last = (label, i) if label is not None else last
    last = None
    for i in range(len(blocks) - 1, -1, -1):
        if decided[i] is not None:
            last = (decided[i], i)
            continue
        sides = [s for s in (before[i], last) if s is not None]
        labels = {s[0] for s in sides}
        if inside:  # an article's text goes only between links
            blocks[i].good = len(sides) < 2 or True in labels
        elif len(labels) < 2:
            blocks[i].good = labels.pop() if labels else inside is None
        elif blocks[i].heading:
            blocks[i].good = last[0]  # a heading belongs to what follows
        else:
            blocks[i].good = min(sides, key=lambda s: (abs(s[1] - i), not s[0]))[0]


def main_text(html: str | None) -> str:
    blocks = blocks_of(html or "")
    classify(blocks)
    return "\n".join(b.text for b in blocks if b.good)


def extract_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """(doc, text, n_chars): doc holds the kept columns (default all); nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in text_column(batch, html)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["doc", "text", "n_chars"])

    carried = with_text(pages, html, keep)
    doc = carried.schema["doc"].dataType.simpleString()
    return carried.mapInArrow(run, f"doc {doc}, text string, n_chars long")
