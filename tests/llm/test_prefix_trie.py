"""Conversation tries against plain nested dictionaries, the parentheses against a stack, and odd inputs."""

import zlib
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from clauselens.llm import prefix_trie as P
from clauselens.llm.queries import op12_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_rebuilt(turns):
    """Sequences of (role, text) by conversation, from (conv_id, turn, role, text) rows without ties."""
    own = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: (t[0] is None, t[0] or 0, t[1] is not None, t[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = own.get(conv - int(np.fmod(conv, 5)), [])[:h] + own[conv][h:]
    return out


def plain_trie(convs):
    """The contract's rows by direct counting."""
    members = {}
    for conv, walk in convs.items():
        for depth in range(len(walk) + 1):
            members.setdefault(tuple(walk[:depth]), []).append(conv)
    rows = []
    for node, inside in members.items():
        below = [m for m in members if m[:len(node)] == node]
        kids = {m for m in below if len(m) == len(node) + 1}
        leaves = sum(not any(o[:len(m)] == m and len(o) == len(m) + 1 for o in below) for m in below)
        saved = sum((len(members[m]) - 1) * (len(m[-1][1].encode()) if m else 0) for m in below)
        ends = sorted(c for c in inside if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(inside), len(node), parent, len(inside), len(kids), leaves, saved,
                     sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=repr)


def trie_of(spark, convs, shards=None):
    """Rows of the operator for given sequences of (role, text)."""
    turns = [(c, i, r, t) for c, walk in convs.items() for i, (r, t) in enumerate(walk)]
    frame = P.sequences(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    nodes = P.prefix_trie(frame).withColumnRenamed("saved", "saved_tokens")
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=300), st.integers(0, 3))
def test_find_close(moves, seed):
    bits, depth = [1], 1
    for m in moves:
        if m <= 2 + seed % 2 or depth == 1:
            bits.append(1)
            depth += 1
        else:
            bits.append(0)
            depth -= 1
    bits = np.array(bits + [0] * depth)
    stack, want = [], {}
    for at, bit in enumerate(bits):
        if bit:
            stack.append(at)
        else:
            want[stack.pop()] = at
    opens = np.flatnonzero(bits)
    assert P.find_close(np.cumsum(2 * bits - 1), opens).tolist() == [want[o] for o in opens.tolist()]


def test_find_close_deep():
    for bits in (np.repeat([1, 0], 5000), np.tile([1, 0], 5000), np.tile(np.repeat([1, 0], 700), 9)):
        bits = np.concatenate([[1], bits, [0]])
        close = P.find_close(np.cumsum(2 * bits - 1), np.flatnonzero(bits))
        assert close[0] == len(bits) - 1 and sorted(close.tolist()) == np.flatnonzero(bits == 0).tolist()


def test_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    convs = plain_rebuilt([(r.conv_id, r.turn, r.role, r.text) for r in rows])
    assert sorted((tuple(r) for r in op12_prefix_trie(spark, sf).select(*COLUMNS).collect()), key=repr) == plain_trie(convs)


def test_shared_spines(spark):
    """A hot conversation, a hot first turn with many continuations, and one that begins all others."""
    hot = [("user", "hello"), ("assistant", "é" * 7), ("user", "go on")]
    convs = {i: hot for i in range(0, 60)}
    convs |= {100 + i: [("system", "be brief"), ("user", f"q{i}"), ("assistant", "a" * (i % 4))] for i in range(150)}
    convs |= {300 + i: [("system", "be brief"), ("user", "deep")] + [("user", str(j)) for j in range(i)] for i in range(60)}
    convs |= {9000 + 5000 * i: hot[:2] for i in range(9)} | {8: hot[:1], 9: [("system", "be brief")]}
    assert trie_of(spark, convs) == plain_trie(convs)


def test_one_long_conversation(spark):
    convs = {1: [("user", f"t{i}") for i in range(3000)], 2: [("user", f"t{i}") for i in range(2500)] + [("user", "x")], 3: [("user", "t0")]}
    rows = {(r[0], r[1]): r for r in trie_of(spark, convs)}
    sizes = [len(f"t{i}") for i in range(3000)]
    assert len(rows) == 3002 and rows[1, 2500][3:7] == (2, 2, 2, sizes[2499])
    assert rows[1, 0][6] == sum(sizes[:2500]) + sizes[0] and rows[1, 3000][3:6] == (1, 0, 1)


def test_cases(spark, tmp_path):
    turns = [
        (0, 0, "user", "a"), (0, 1, None, None), (0, 2, "user", "c"), (1, None, "user", "first"), (1, 0, "user", "a"),
        (1, 1, "", ""), (2, 5, "user", ""), (2, 7, None, "x"), (3, 0, "user", "a"), (7, 0, "user", "no head"),
        (None, 0, "user", "a"), (-3, 0, "user", "n"), (-3, 1, "user", "a"), (11, 0, "u" * 40, "y" * 100_000),
    ]
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn long, role string, text string, depth long, key string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((tuple(r) for r in op12_prefix_trie(spark, str(tmp_path)).select(*COLUMNS).collect()), key=repr)
    assert got == plain_trie(plain_rebuilt(turns))
    # repeated rows are turns of their own, ties are ordered alike in any order of rows
    twice = frame.unionByName(frame)
    once = [sorted(map(repr, P.prefix_trie(P.rebuilt(f)).collect())) for f in (twice, twice.orderBy(frame.text.desc()))]
    assert once[0] == once[1]
    assert P.prefix_trie(P.rebuilt(frame.limit(0))).count() == 0
