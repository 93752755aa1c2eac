"""The prefix trie against dictionaries of prefixes, and the parentheses against a scan."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from airlens.llm import prefix_trie
from airlens.llm.parentheses import Parentheses, preorder

SCHEMA = "conv_id long, turn long, role string, text string, key string, shard int, depth long, path string"


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = {}, {}
    for c, ts in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
            leaves[p[:d]] += p not in kids
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items()), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*prefix_trie.COLUMNS).collect()), key=str)


def rows_of(seed, n):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bé", "ccc", "longer text"])) for c in range(n) for t in range(rng.randint(1, 6))]
    return rows + [(c, t, "user", "the same") for c in range(1000, 1000 + n) for t in range(3)]   # half of all are alike


def test_equal_conversations_over_many_shards(spark):
    rows = rows_of(3, 150)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert got(prefix_trie.prefix_nodes(df)) == brute(rows)


def test_one_turn_a_shard(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 20)
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    rows = rows_of(4, 60)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(prefix_trie.prefix_nodes(df)) == brute(rows)


def test_hard_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (None, 1, "user", "gone"),
            (-7, 0, "user", ""), (-7, 1, None, "é日本"), (0, 0, "user", "x"), (0, 1, "assistant", "y"), (700, 3, "user", "z" * 100_000),
            *[(5, t, "user", f"turn {t}") for t in range(200)], *[(6, t, "user", f"turn {t}") for t in range(190)]]
    df = spark.createDataFrame([(*r, "k", 1, 2, "p") for r in rows], SCHEMA)
    out = prefix_trie.prefix_nodes(df)
    want = brute(rows)
    assert got(out) == want


def test_nothing(spark):
    assert prefix_trie.prefix_nodes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.prefix_nodes(spark.createDataFrame([(None, 1, "user", "x", "", 0, 0, "")], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 700])
def test_parentheses(n):
    rng = random.Random(n)
    depths = [0]
    while len(depths) < n:
        depths.append(rng.randint(1, depths[-1] + 1) if rng.random() < 0.6 else depths[-1] + 1)
    size, leaves = Parentheses(preorder(np.array(depths))).subtrees()
    for v in range(n):
        end = next((u for u in range(v + 1, n) if depths[u] <= depths[v]), n)
        assert size[v] == end - v
        assert leaves[v] == sum(u == n - 1 or depths[u + 1] <= depths[u] for u in range(v, end))
