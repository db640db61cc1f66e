"""Line-first cleaning: rules per line, failing lines removed, documents that lose too much rejected.

A line with words fails if
 - navigation: separators stand between its words, or it is nothing but entries of menus, or it has no end mark and nearly
   all of its words begin with a capital letter, as menus and headlines run together do;
 - punctuation: it has no end mark and fewer than ``SHORT`` words, or most of its words end in symbols;
 - boilerplate: notices' wording fills at least ``NOTICE_SHARE`` of its words, whatever it ends with, so notices go and
   prose that mentions such wording stays.
An end mark is a sign that ends a sentence, a clause or an introduction, closing quotes and brackets behind it included.
A document is rejected if its failing lines hold more than ``max_loss`` of its word characters.
Words are runs without ASCII white space; lines are split at newlines.

Cases: a null or empty text has no words and no lines with words and fails the base rules; identical
rows are judged alike; a text of one very long line is judged like any other; tables may be empty;
other columns are left alone.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clauselens.llm.common import text_bytes, text_column, with_text

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS = 0.3
NOTICE_SHARE = 0.15
# words of a line that needs an end mark, and the share of capitals that makes a menu of a line without one
SHORT = 8
CAPITALS, LEAST_CAPITALS = 0.8, 3
SYMBOLS = b"#*$%&|<>"
# fixed values: wording of page furniture and licence notices, in lower case
BOILERPLATE = [
    "accept cookies", "all rights reserved", "alle rechte vorbehalten", "allgemeine geschäftsbedingungen", "cookie policy",
    "cookie settings", "copyright ©", "datenschutzerklärung", "enable javascript", "javascript is disabled", "licensed under",
    "lorem ipsum", "mentions légales", "política de privacidad", "politique de confidentialité", "privacy policy",
    "sign in to", "sign up for our", "skip to content", "skip to main content", "subscribe to our newsletter",
    "terms and conditions", "terms of service", "terms of use", "todos los derechos reservados", "tous droits réservés",
    "use cookies", "use of cookies", "uses cookies",
]
# fixed values: entries of menus, in lower case
NAVIGATION = [
    "about", "accueil", "blog", "categories", "contact", "faq", "help", "home", "inicio", "kontakt", "login", "menu",
    "news", "next", "previous", "privacy", "search", "share", "sitemap", "startseite",
]
# fixed values: signs that end a sentence, a clause or an introduction, and what may close behind them
END_MARKS, CLOSERS = ".!?:;…。！？؟۔।॥", "\"')]”’»"
ENDS = re.compile("(?:{})(?:{})*[\\x20\\x09-\\x0D]*\\Z".format(*["|".join(map(re.escape, x)) for x in (END_MARKS, CLOSERS)]).encode())
SEPARATOR = re.compile(rb"(?:^|[\x20\x09-\x0D])(?:\||>|\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2|\xc2\xb7)(?:[\x20\x09-\x0D]|$)")
FURNITURE = re.compile("|".join(re.escape(b) for b in BOILERPLATE).encode(), re.I)
# possessive, so that a long menu with something else in it costs no backtracking
MENU = re.compile(r"\W*+(?:(?:{})\b\W*+){{2,}}+".format("|".join(NAVIGATION)).encode(), re.I)
SYMBOL_END = re.compile(rb"[#*$%&|<>]+(?=\s|$)")


def wording_fills(line: bytes, words: int) -> bool:
    """Is boilerplate wording at least ``NOTICE_SHARE`` of the words of a line?"""
    return sum(len(m.split()) for m in FURNITURE.findall(line)) >= NOTICE_SHARE * words


def capital_run(words: list[bytes]) -> bool:
    """Do nearly all words begin with a capital letter?"""
    capitals = sum(unicodedata.category(w.decode("utf-8", "replace")[0]) == "Lu" for w in words)
    return len(words) >= LEAST_CAPITALS and capitals >= CAPITALS * len(words)


def line_fails(line: bytes, words: list[bytes]) -> str | None:
    """The rule that a line with words breaks, if any."""
    marks = len(SEPARATOR.findall(line))
    if marks >= 2 and 4 * marks >= len(words) or MENU.fullmatch(line):
        return "navigation"
    if len(SYMBOL_END.findall(line)) * 2 > len(words):
        return "punctuation"
    if FURNITURE.search(line) and wording_fills(line, len(words)):
        return "boilerplate"
    if not ENDS.search(line):
        if capital_run(words):
            return "navigation"
        if len(words) < SHORT:
            return "punctuation"
    return None


def code_points(words: list[bytes]) -> int:
    data = b"".join(words)
    return len(data) if data.isascii() else len(data.decode("utf-8", "replace"))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    base = len(number)
    pairs = codes[:-1] * base + codes[1:]
    if base > 2_000_000:  # three numbers would not fit into 63 bits
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * base + codes[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def judge(text: bytes, max_loss: float = MAX_LOSS) -> dict[str, object]:
    """All figures and the verdict for one text."""
    words = text.split()
    seen: set[bytes] = set()
    duplicates, lost, cleaned, broken = 0, 0, [], Counter()
    held = sum(map(len, words))
    for line in text.split(b"\n"):
        own = line.split()
        if own:
            duplicates += line in seen
            seen.add(line)
            rule = line_fails(line, own)
            if rule:
                broken[rule] += 1
                lost += sum(map(len, own))
                continue
        cleaned.append(line)
    repeats = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    return {
        "n_words": len(words), "word_chars": code_points(words),
        "n_symbols": sum(text.count(bytes([s])) for s in SYMBOLS), "n_dup_lines": duplicates,
        "n_repeat_words": repeats, "n_failed_lines": sum(broken.values()), "lost_share": lost / held if held else 0.0,
        "base_failed": base_failed, "kept": not base_failed and lost <= max_loss * held,
        "cleaned": b"\n".join(cleaned).decode(),
    }


FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "n_failed_lines": pa.int64(), "lost_share": pa.float64(), "base_failed": pa.bool_(),
    "kept": pa.bool_(), "cleaned": pa.string(),
}
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_failed_lines long, "
          "lost_share double, base_failed boolean, kept boolean, cleaned string")


def clean_lines(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, max_loss: float = MAX_LOSS,
) -> DataFrame:
    """(doc, figures, kept, cleaned): doc holds the kept columns (default all); nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t, max_loss) for t in text_bytes(text_column(batch, text))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[n] for r in rows], t) for n, t in FIELDS.items()]],
                names=["doc", *FIELDS])

    carried = with_text(docs, text, keep)
    return carried.mapInArrow(run, f"doc {carried.schema['doc'].dataType.simpleString()}, {SCHEMA}")
