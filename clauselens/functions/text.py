"""Text columns: whitespace, quotes, folding, splitting, Markdown clean-up.

Every function takes and returns a Column built from Spark functions only, so a
projection that uses them stays in the JVM and needs no shuffle.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clauselens.functions import vocab as V

# all characters str.isspace() accepts, from the rule itself
SPACES = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())
# the same set in patterns; the ASCII form is one table lookup per character
WS = r"[\s\x1c-\x1f]"  # needs (?U)
ASCII_WS = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f ]"
ASCII_SPACE = r"[\t\x0b\f\r\x1c\x1d\x1e\x1f ]"  # without the line end
UNEVEN_IN_LINE = r"[\t\x0b\f\r\x1c\x1d\x1e\x1f]| {2}"
UNEVEN_ASCII = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f]| {2}"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
ASCII_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e]"
# all white space but the blank and the line end, and what ends a line besides the latter
ODD_SPACES = [ch for ch in SPACES if ch not in " \n"]
ODD_BREAKS = [ch for ch in ODD_SPACES if len(f"a{ch}b".splitlines()) == 2]
# letters whose case variants are not found by lower-casing: patterns without case take them for i, k and s
ODD_CASES = ["\u0130", "\u0131", "\u017f", "\u212a"]
# a line never contains this character, because it is a line break itself
NEVER_IN_LINE = "\x1c"
INVISIBLE_SPACES = "\u00a0\u200b\u200c\u200d\u2009\u202f\ufeff"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (for use inside lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first(array: Column) -> Column:
    """First element, or null for an empty array."""
    return F.try_element_at(array, F.lit(1))


def minimal(words: list[str]) -> list[str]:
    """The words without those that contain another one."""
    return [w for w in dict.fromkeys(words) if not any(o != w and o in w for o in words)]


def cue_pattern(words: list[str]) -> str:
    """Does the text contain one of the words?  One regex pass, for many words."""
    return one_of(minimal(words))


def one_of(words: list[str]) -> str:
    """A pattern for the longest of the words at a place: words that begin alike share their beginning, so few
    alternatives are tried at each place, and none where no word can begin."""
    def branches(rest: list[str]) -> str:
        heads = sorted({w[0] for w in rest if w})
        parts = [re.escape(ch) + branches([w[1:] for w in rest if w[:1] == ch]) for ch in heads]
        if not parts:
            return ""
        if "" in rest:
            return "(?:" + "|".join(parts) + ")?"
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    # two letters rule out more places than one, before any branch is tried
    heads = ["".join(re.escape(ch) for ch in sorted({w[i] for w in words})) for i in range(min(2, min(map(len, words))))]
    return "(?=" + "".join(f"[{chars}]" for chars in heads) + ")" + branches(words)


def any_of(words: list[str]) -> str:
    """One literal alternation, so a list of words is a single regex pass."""
    return "|".join(re.escape(w) for w in words)


def has_any(c: Column, words: list[str]) -> Column:
    """Does the text contain one of the words?  Byte search, no regex."""
    return reduce(lambda a, b: a | b, [c.contains(w) for w in minimal(words)])


def may_say(c: Column, plain: Column, words: list[str]) -> Column:
    """Can a pattern without case find one of the words?  Byte searches, so that texts without any are not read by patterns."""
    lower = F.lower(c)
    return has_any(lower, [w.lower() for w in words]) | (~plain & has_any(c, ODD_CASES))


def has_none(c: Column, signs: list[str]) -> Column:
    """Does the text hold none of the signs?  ASCII text is not searched for others."""
    wide = [ch for ch in signs if not ch.isascii()]
    return ~has_any(c, [ch for ch in signs if ch.isascii()]) & (is_ascii(c) | ~has_any(c, wide))


def starting_with(chars: str, plain: bool) -> str:
    """Lookahead for the first character, tested before anything dearer.

    Takes both cases and, in text that is not plain ASCII, the letters that count as
    case variants of i, k and s.
    """
    variants = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}
    letters = {v for ch in chars for v in ch.lower() + ch.upper()}
    if plain:
        letters = {ch for ch in letters if ch.isascii()}
    else:
        letters |= {v for ch in chars for v in variants.get(ch.lower(), "")}
    return "(?=[" + "".join(re.escape(ch) for ch in sorted(letters)) + "])"


def flags(letters: str, plain: bool) -> str:
    """Inline pattern flags; Unicode classes only where the text needs them."""
    wanted = letters if plain else letters + "U"
    return f"(?{wanted})" if wanted else ""


def word_start(patterns: list[str], plain: bool) -> str:
    r"""One pattern for several folded ones that all begin with ``\b`` and a letter."""
    bodies = [p.removeprefix(r"\b") for p in patterns]
    initials = "".join(re.escape(ch) for ch in sorted({b[0] for b in bodies}))
    return flags("", plain) + rf"(?=[{initials}])\b(?:" + "|".join(bodies) + ")"


def by_script(plain: Column, build: Callable[[bool], Column]) -> Column:
    """The same rule with ASCII patterns for plain text and Unicode ones otherwise."""
    return F.when(plain, build(True)).otherwise(build(False))


def strip(c: Column) -> Column:
    """Remove whitespace of any kind at both ends."""
    return F.btrim(c, F.lit(SPACES))


def is_ascii(c: Column) -> Column:
    return F.length(c) == F.octet_length(c)


def squeeze_ref(c: Column) -> Column:
    """:func:`squeeze` for a plain column or lambda variable (it is read repeatedly)."""
    uneven = c.rlike(UNEVEN_ASCII)
    wide = F.regexp_replace(c, f"(?U){WS}+", " ")
    narrow = F.when(uneven, F.regexp_replace(c, f"{ASCII_WS}+", " ")).otherwise(c)
    return F.trim(F.when(is_ascii(c), narrow).otherwise(wide))


def squeeze(c: Column) -> Column:
    """Collapse whitespace runs to one space and trim."""
    return let(c, squeeze_ref)


def cut(c: Column, limit: int | None) -> Column:
    """Shorten squeezed text to ``limit`` characters, ending in three dots; None keeps it whole."""
    if limit is None:
        return c
    short = F.concat(F.rtrim(F.substring(c, 1, limit - 3)), F.lit("..."))
    return F.when(F.length(c) <= limit, c).otherwise(short)


def quote(c: Column, limit: int | None = None) -> Column:
    """Evidence quote of a text fragment, whole unless a limit is given."""
    return let(squeeze(c), lambda x: cut(x, limit))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str], str]:
    """Compatibility decomposition without combining marks, as (from, to, longer forms, their class).

    Built from the Unicode database for every code point that it changes, but for Hangul syllables, which
    would fold into their letters; no rule looks for these.
    """
    source, target, dropped, longer = [], [], [], {}
    for cp in (*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x30000), *range(0xE0100, 0xE01F0)):
        ch = chr(cp)
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if folded == ch:
            continue
        if not folded:
            dropped.append(ch)
        elif len(folded) == 1:
            source.append(ch)
            target.append(folded)
        else:
            longer[ch] = folded
    ranges: list[list[int]] = []
    for cp in map(ord, longer):
        if ranges and cp <= ranges[-1][1] + 16:  # a superset, tested first
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    # most characters are ruled out by one test before the ranges are searched
    first, second = ranges[0], ranges[1][0]
    quick = rf"(?=[\x{{{first[0]:x}}}-\x{{{first[1]:x}}}\x{{{second:x}}}-\x{{10ffff}}])"
    wanted = quick + "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"
    return "".join(source + dropped), "".join(target), longer, wanted


def fold_latin(c: Column) -> Column:
    """:func:`fold` for words of Latin-1 letters."""
    letters = [chr(cp) for cp in range(0xC0, 0x100)]
    plain = {ch: unicodedata.normalize("NFKD", ch)[0] for ch in letters}
    changed = [ch for ch in letters if plain[ch] != ch]
    return F.lower(F.translate(c, "".join(changed), "".join(plain[ch] for ch in changed)))


def fold(c: Column) -> Column:
    """Lower case without accents."""
    return let(c, fold_ref)


def fold_ref(c: Column) -> Column:
    """:func:`fold` for a plain column or lambda variable; ASCII takes the short way."""
    source, target, longer, wanted = _fold_tables()
    forms = F.from_json(F.lit(json.dumps(longer, ensure_ascii=False)), "map<string,string>")
    # only the different characters that occur are looked up, and each of them is replaced in one go
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(wanted), F.lit(0)))
    expanded = F.aggregate(found, c, lambda text, ch: F.replace(text, ch, F.coalesce(F.try_element_at(forms, ch), ch)))
    folded = F.translate(F.when(c.rlike(wanted), expanded).otherwise(c), source, target)
    return F.lower(F.when(is_ascii(c), c).otherwise(folded))


def clean_markdown(c: Column) -> Column:
    """Drop Markdown marks and odd spaces from an exported document; order matters."""
    c = F.translate(c, INVISIBLE_SPACES, " " * len(INVISIBLE_SPACES))
    c = F.regexp_replace(c, rf"(?mdU)^#{{1,6}}{WS}+", "")
    c = F.regexp_replace(c, rf"(?mdU)^{WS}*[-*_]{{3,}}{WS}*$", "")
    c = F.regexp_replace(c, r"(?s)(\*\*|__)(.+?)\1", "$2")
    c = F.regexp_replace(c, r"(?s)(\*|_)(.+?)\1", "$2")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return strip(c)


def _clause_break(ws: str) -> str:
    return rf"(?={ws})(?:\n{{1,2}}|(?<=[.;]){ws}+)"


def split_clauses(c: Column, clause_chars: int | None = None) -> Column:
    """Clauses of a document: cut at line ends and after ``.`` or ``;``, blanks dropped.

    Clauses are whole; ``clause_chars`` shortens the longer ones.
    """
    # text whose only white space is blanks and line ends is cut by byte searches, and mostly at line ends alone
    def cut_inside(even: Column) -> Column:
        for mark, broken in ((". ", ".\n"), ("; ", ";\n"), (" \n", "\n"), ("\n ", "\n")):
            even = F.replace(even, F.lit(mark), F.lit(broken))
        return even

    even = F.when(c.contains("  "), F.regexp_replace(c, " {2,}", " ")).otherwise(c)
    ends = F.when(has_any(c, [". ", "; ", " \n", "\n ", "  "]), cut_inside(even)).otherwise(c)
    usual = F.array_remove(F.split(F.trim(ends), "\n"), "")
    # ASCII text is squeezed as a whole, then cut where white space holds a line end or follows . or ;
    narrow = F.when(c.rlike(UNEVEN_IN_LINE), F.regexp_replace(c, f"{ASCII_SPACE}+", " ")).otherwise(c)
    plain = F.array_remove(F.split(F.btrim(narrow, F.lit(" \n")), r"(?=[ \n])(?: ?\n[ \n]*|(?<=[.;]) )"), "")
    pieces = F.split(c, "(?U)" + _clause_break(WS))
    wide = F.filter(F.transform(pieces, squeeze_ref), lambda x: x != "")
    squeezed = F.when(has_none(c, ODD_SPACES), usual).when(is_ascii(c), plain).otherwise(wide)
    return squeezed if clause_chars is None else F.transform(squeezed, lambda x: cut(x, clause_chars))


def split_lines(c: Column) -> Column:
    """Lines of a document without a final empty line."""
    def drop_last_empty(parts: Column) -> Column:
        return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)

    # a line end alone is found without a pattern
    parts = F.when(has_none(c, ODD_BREAKS), F.split(c, "\n")).when(
        is_ascii(c), F.split(c, ASCII_LINE_BREAK)).otherwise(F.split(c, LINE_BREAK))
    return let(parts, drop_last_empty)


def split_paragraphs(c: Column, min_chars: int = V.PARAGRAPH_MIN_CHARS) -> Column:
    """Paragraphs of a document, trimmed, at least ``min_chars`` characters long."""
    return F.filter(
        F.transform(F.split(c, "\n\n"), strip), lambda p: F.length(p) >= min_chars
    )


def dedupe_warnings(c: Column) -> Column:
    """Trimmed, non-blank, distinct warnings in first-seen order."""
    return F.array_distinct(F.filter(F.transform(c, strip), lambda w: w != ""))


def count_cues(folded: Column, cues: list[str]) -> Column:
    """Total number of (non-overlapping, per cue) occurrences of the cues."""
    total = F.lit(0)
    for cue in cues:
        size = len(cue.encode())
        removed = F.octet_length(folded) - F.octet_length(F.replace(folded, F.lit(cue), F.lit("")))
        total = total + (removed / size).cast("int")
    return total


def language_of(french: Column, english: Column) -> Column:
    """Language from cue counts: one side needs two hits and 1.5 times the other."""
    return (
        F.when((french == 0) & (english == 0), F.lit(None).cast("string"))
        .when((french >= english * 1.5) & (french >= 2), "fr")
        .when((english >= french * 1.5) & (english >= 2), "en")
        .otherwise("mixed")
    )
