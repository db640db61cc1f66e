"""Secret scans: all rules in one deterministic automaton, one pass over the bytes of a text.

Each rule is a regular expression.  The rules are reversed, joined into one nondeterministic automaton that may
begin anywhere, and turned into a single minimal deterministic one: subset construction over classes of
bytes that no rule tells apart, then minimisation by refining a partition.  One pass from the last byte to
the first finds, for all rules together, every place where a match begins.  From the first such place a rule's
own automaton, run forwards, finds the longest end; the search goes on behind it.  So matches of a rule are
the leftmost longest that do not overlap, and only bytes inside matches are read twice.  A check may drop a match
afterwards; the text that it covered is not searched again.

Rules are written over ASCII; any other character counts as its UTF-8 bytes, and spans are in code points.

Cases: a null or empty text has no spans; repeated rows are judged alike; a null id is carried; a text of any
length is read as a whole, in bounded memory beside it; tables may be empty; new columns sit beside a struct
of the document, so none can clash.  Nothing is shuffled and no state outlives a task.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauselens.llm.common import text_bytes, text_column, with_text


class Rule(NamedTuple):
    kind: str
    pattern: str
    least: int = 0  # characters that the match, or its group, must have
    group: int = 0
    base: bool = False


WORD_LIKE = "[A-Za-z0-9_-]"
# fixed values: what is looked for, in the order of the kinds.  For `access` and `hex` the least length could
# stand in the pattern as well; in `hex` it does, so that not every letter from a to f begins a match.
RULES = [
    Rule("assign", "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
                   "[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2, True),
    Rule("access", "AKIA[A-Z0-9]+", 16, 0, True),
    Rule("hex", "[0-9a-f]{32,}", 32, 0, True),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", rf"eyJ{WORD_LIKE}+\.eyJ{WORD_LIKE}+\.{WORD_LIKE}+", 40),
    Rule("forge_token", "gh[opsru]_[A-Za-z0-9]+", 40),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("map_key", f"AIza{WORD_LIKE}+", 39),
    Rule("payment_key", "[rs]k_(live|test)_[A-Za-z0-9]+", 24),
    Rule("url_login", "[a-z][a-z0-9+.-]*://[A-Za-z0-9._~%!$&*+,;=-]+:[A-Za-z0-9._~%!$&*+,;=-]+@", 10),
    Rule("bearer", "[Bb]earer +([A-Za-z0-9._~+/=-]+)", 20, 1),
]
# states of one automaton; rules that need more are refused when they are compiled, not cut
MOST_STATES = 20_000


# --- regular expressions to automata -----------------------------------------

def parsed(pattern: str) -> tuple:
    """Syntax tree of literals, classes, groups, alternatives and ``? * + {m} {m,} {m,n}``."""
    at = 0

    def peek() -> str:
        return pattern[at:at + 1]

    def take() -> str:
        nonlocal at
        if at >= len(pattern):
            raise ValueError(f"unfinished pattern: {pattern}")
        at += 1
        return pattern[at - 1]

    def one_char() -> int:
        ch = take()
        if ch == "\\":
            ch = take()
            if ch == "x":
                return int(take() + take(), 16)
            if ch.isalnum():
                raise ValueError(f"escape \\{ch} is not supported: {pattern}")
        if not ch.isascii():
            raise ValueError(f"only ASCII is supported: {pattern}")
        return ord(ch)

    def char_class() -> tuple:
        nonlocal at
        negated = peek() == "^"
        at += negated
        held = set()
        while peek() != "]":
            low = one_char()
            high = low
            if peek() == "-" and pattern[at + 1:at + 2] != "]":
                at += 1
                high = one_char()
            held.update(range(low, high + 1))
        take()
        return ("set", frozenset(set(range(256)) - held if negated else held))

    def atom() -> tuple:
        nonlocal at
        ch = peek()
        if ch == "(":
            at += 3 if pattern[at:at + 3] == "(?:" else 1
            inner = alternatives()
            if take() != ")":
                raise ValueError(f"unbalanced group: {pattern}")
            return inner
        if ch == "[":
            at += 1
            return char_class()
        if ch in ".^$*+?{":
            raise ValueError(f"{ch} is not supported here: {pattern}")
        return ("set", frozenset([one_char()]))

    def repeated() -> tuple:
        nonlocal at
        item = atom()
        while peek() and peek() in "?*+{":
            ch = take()
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(ch, (0, 0))
            if ch == "{":
                bounds = re.match(r"(\d+)(,?)(\d*)\}", pattern[at:])
                if not bounds:
                    raise ValueError(f"bad bounds: {pattern}")
                at += bounds.end()
                low = int(bounds[1])
                high = int(bounds[3]) if bounds[3] else None if bounds[2] else low
            item = ("repeat", item, low, high)
        return item

    def sequence() -> tuple:
        items = []
        while peek() and peek() not in "|)":
            items.append(repeated())
        return ("all", items)

    def alternatives() -> tuple:
        nonlocal at
        items = [sequence()]
        while peek() == "|":
            at += 1
            items.append(sequence())
        return ("any", items)

    tree = alternatives()
    if at < len(pattern):
        raise ValueError(f"unbalanced pattern: {pattern}")
    return tree


class Nfa:
    """States with moves on sets of bytes and with empty moves."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, tree: tuple, start: int, backwards: bool) -> int:
        """Put a syntax tree behind a state; returns the state after it."""
        if tree[0] == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if tree[0] == "all":
            for item in reversed(tree[1]) if backwards else tree[1]:
                start = self.add(item, start, backwards)
            return start
        if tree[0] == "any":
            end = self.state()
            for item in tree[1]:
                begin = self.state()
                self.empty[start].append(begin)
                self.empty[self.add(item, begin, backwards)].append(end)
            return end
        _, item, low, high = tree
        for _ in range(low):
            start = self.add(item, start, backwards)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(item, loop, backwards)].append(loop)
            return loop
        end = self.state()
        for _ in range(high - low):
            self.empty[start].append(end)
            start = self.add(item, start, backwards)
        self.empty[start].append(end)
        return end

    def closed(self, states: Iterable[int]) -> frozenset:
        todo, seen = list(states), set()
        while todo:
            state = todo.pop()
            if state not in seen:
                seen.add(state)
                todo.extend(self.empty[state])
        return frozenset(seen)


def byte_classes(nfa: Nfa) -> tuple[np.ndarray, list[int]]:
    """The class of each byte, bytes that no move tells apart together, and one byte of each class."""
    marks = [[] for _ in range(256)]
    for number, held in enumerate({chars for moves in nfa.moves for chars, _ in moves}):
        for byte in held:
            marks[byte].append(number)
    numbers: dict[tuple, int] = {}
    classes = [numbers.setdefault(tuple(m), len(numbers)) for m in marks]
    return np.array(classes), [classes.index(n) for n in range(len(numbers))]


class Dfa(NamedTuple):
    """Transition arrays: next state for each state and byte class, and the mask of rules each state accepts."""

    classes: np.ndarray
    steps: np.ndarray
    accepts: np.ndarray


def determinised(nfa: Nfa, start: int, ends: dict[int, int], anywhere: bool) -> Dfa:
    """Subset construction; with ``anywhere`` a match may begin at every byte.  State 0 is the first."""
    classes, shown = byte_classes(nfa)
    begin = nfa.closed([start])
    numbers, order, steps, accepts = {begin: 0}, [begin], [], []
    for subset in order:
        accepts.append(sum({1 << ends[s] for s in subset if s in ends}))
        moves = [move for s in subset for move in nfa.moves[s]]
        row = []
        for byte in shown:
            after = nfa.closed([s for chars, s in moves if byte in chars] + ([start] if anywhere else []))
            if after not in numbers:
                if len(numbers) >= MOST_STATES:
                    raise ValueError(f"the rules need more than {MOST_STATES} states; move counts into least lengths")
                numbers[after] = len(numbers)
                order.append(after)
            row.append(numbers[after])
        steps.append(row)
    return Dfa(classes, np.array(steps), np.array(accepts, dtype=np.int64))


def minimised(dfa: Dfa) -> Dfa:
    """The smallest equivalent automaton: states are told apart by what they accept, then by where they lead."""
    _, part = np.unique(dfa.accepts, return_inverse=True)
    while True:
        _, first, finer = np.unique(np.column_stack([part, part[dfa.steps]]), axis=0, return_index=True, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    # the first state keeps number 0
    rank = np.argsort(np.argsort(first))
    part, first = rank[finer], np.sort(first)
    return Dfa(dfa.classes, part[dfa.steps[first]], dfa.accepts[first])


def compiled(rules: list[Rule]) -> tuple[Dfa, list[Dfa]]:
    """The joint automaton that reads backwards, and one for each rule that reads forwards."""
    nfa = Nfa()
    start, ends, single = nfa.state(), {}, []
    for number, rule in enumerate(rules):
        tree = parsed(rule.pattern)
        begin = nfa.state()
        nfa.empty[start].append(begin)
        ends[nfa.add(tree, begin, True)] = number
        own = Nfa()
        first = own.state()
        single.append(minimised(determinised(own, first, {own.add(tree, first, False): 0}, False)))
        if single[-1].accepts[0]:
            raise ValueError(f"the rule {rule.kind} matches the empty text")
    return minimised(determinised(nfa, start, ends, True)), single


# --- scanning ----------------------------------------------------------------

DEAD = -1


def linked_rows(dfa: Dfa) -> list[list]:
    """A list for each state: the next state's list for each byte, and at its end what the state accepts, or
    ``DEAD`` where nothing can be accepted any more."""
    rows: list[list] = [[] for _ in dfa.accepts]
    for state, (row, steps, accepts) in enumerate(zip(rows, dfa.steps, dfa.accepts.tolist())):
        row.extend(rows[s] for s in steps[dfa.classes].tolist())
        row.append(accepts or (DEAD if (steps == state).all() else 0))
    return rows


class Scanner:
    """The automata of a list of rules, ready to run over byte strings."""

    def __init__(self, rules: list[Rule], joint: Dfa, single: list[Dfa]) -> None:
        self.rules = rules
        self.backwards = linked_rows(joint)[0]
        self.forwards = [linked_rows(dfa)[0] for dfa in single]
        self.groups = [re.compile(r.pattern.encode()) if r.group else None for r in rules]

    def starts(self, data: bytes) -> dict[int, list[int]]:
        """For each rule the places where a match begins, the last one first: one pass over the bytes."""
        found: dict[int, list[int]] = defaultdict(list)
        row, place = self.backwards, len(data)
        for byte in data[::-1]:
            row = row[byte]
            place -= 1
            if row[256]:
                mask = row[256]
                while mask > 0:
                    low = mask & -mask
                    found[low.bit_length() - 1].append(place)
                    mask ^= low
        return found

    def end(self, rule: int, data: bytes, start: int) -> int:
        """The longest end of a match of one rule that begins at a place."""
        row, last = self.forwards[rule], start
        for place in range(start, len(data)):
            row = row[data[place]]
            if row[256] > 0:
                last = place + 1
            elif row[256] == DEAD:
                break
        return last

    def long_enough(self, rule: int, data: bytes, start: int, end: int) -> bool:
        group = self.groups[rule]
        if group:
            start, end = group.fullmatch(data, start, end).span(self.rules[rule].group)
        return end - start >= self.rules[rule].least

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, in order."""
        kept = []
        for rule, places in self.starts(data).items():
            behind = 0
            for start in reversed(places):
                if start >= behind:
                    behind = self.end(rule, data, start)
                    if self.long_enough(rule, data, start, behind):
                        kept.append((start, rule, behind))
        return sorted(kept)


def in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans in code points."""
    if not spans or data.isascii():
        return spans
    raw = np.frombuffer(data, dtype=np.uint8)
    places = [0, *sorted({p for start, _, end in spans for p in (start, end)})]
    held = [np.count_nonzero((raw[a:b] & 0xC0) != 0x80) for a, b in zip(places, places[1:])]
    count = dict(zip(places, [0, *np.cumsum(held).tolist()]))
    return [(count[start], rule, count[end]) for start, rule, end in spans]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def find_secrets(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: list[Rule] | None = None,
) -> DataFrame:
    """(doc, spans): doc holds the kept columns (default all); spans are (kind, start, end, base), by start, then
    kind as listed.  The automata are compiled once on the driver: their size depends on the rules only."""
    chosen = RULES if rules is None else rules
    joint, single = compiled(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, joint, single)
        for batch in batches:
            found = []
            for data in text_bytes(text_column(batch, text)):
                spans = in_code_points(data, scanner.spans(data))
                found.append([{"kind": chosen[n].kind, "start": s, "end": e, "base": chosen[n].base} for s, n, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(SPAN))], names=["doc", "spans"])

    carried = with_text(docs, text, keep)
    return carried.mapInArrow(
        run, f"doc {carried.schema['doc'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
