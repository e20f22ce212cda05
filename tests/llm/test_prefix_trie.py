import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from helpers import rows_of
from sieveflow.llm import prefix_trie as module
from sieveflow.llm.prefix_trie import extents, prefix_trie, sparse_table, whole_conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, rebuild=True):
    """All nodes, from a dictionary of beginnings."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0), tie, (role, text)))
    convs = {c: [t[2] for t in sorted(ts)] for c, ts in convs.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in convs}
        convs = {c: convs.get(c - c % 100, [])[:h[c]] + ts[h[c]:] for c, ts in convs.items()}
    members = defaultdict(list)
    for c, ts in sorted(convs.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in cs if len(convs[c]) == len(node))
        out.append((cs[0], len(node), members[node[:-1]][0] if node else None, len(cs), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rng, n, words="abc", longest=9):
    rows = []
    for c in rng.sample(range(3 * n), n):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(words) * rng.randrange(1, 4)) for t in range(rng.randrange(1, longest))]
    return rows


@pytest.mark.parametrize("block, width", [(8192, 32), (16, 32), (7, 3)])
def test_same_as_plain(spark, monkeypatch, block, width):
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "WIDTH", width)
    rows = conversations(random.Random(block), 250)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(prefix_trie(df)) == plain(rows)
    assert rows_of(prefix_trie(df, whole_conversations)) == plain(rows, False)


def test_hot_conversation_and_copies(spark, monkeypatch):
    """One conversation has a third of all turns, another stands there a hundred times."""
    monkeypatch.setattr(module, "BLOCK", 10)
    rows = conversations(random.Random(4), 40)
    rows += [(500, t, "user", f"turn {t % 5}") for t in range(300)] + [(707, t, "user", f"turn {t % 5}") for t in range(299)]
    rows += [(1000 + c, t, "user", "same") for c in range(100) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for rebuild, flag in ((module.shared_heads, True), (whole_conversations, False)):
        assert rows_of(prefix_trie(df, rebuild)) == plain(rows, flag)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "é😀"), (1, 0, "user", "é😀"), (1, 0, "user", "b"), (None, 0, "user", "x"), (2, 5, "", None),
            (2, 3, None, ""), (301, 0, "user", "only"), (101, 0, "user", "x" * 100_000), (3, None, "a", "bc"), (4, None, "ab", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.selectExpr("*", "1 AS conv", "2 AS d", "3 AS chars", "4 AS pid", "5 AS depth")
    assert rows_of(prefix_trie(clash)) == plain(rows)


def test_empty(spark):
    assert rows_of(prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    assert rows_of(prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))) == []


def test_extents_need_no_neighbours():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 5, 300)
    shared[0] = 0
    rows, lengths = rng.integers(0, 300, 2000), rng.integers(1, 6, 2000)
    lo, hi = extents(sparse_table(shared), rows, lengths)
    for r, k, a, b in zip(rows, lengths, lo, hi):
        x = y = r
        while x > 0 and shared[x] >= k:
            x -= 1
        while y + 1 < 300 and shared[y + 1] >= k:
            y += 1
        assert (a, b) == (x, y)
