"""Embedding dedup and nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from airlens.llm import embedding_dedup as E, neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int, node long, cell long, score double"
BAD = [(9001, None, 1), (9002, [0.0] * 8, 1), (9003, [float("nan")] + [1.0] * 7, 1), (9004, [float("inf")] + [1.0] * 7, 1),
       (9005, [None] + [1.0] * 7, 1), (9006, [1.0] * 3, 1), (9007, [], 1), (None, [1.0] * 8, 1), (9100, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], SCHEMA).repartition(4)


def good(v):
    return v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def make(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, 8))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] if i % 3 else base[0]
        v = v + rng.normal(size=8) * rng.choice([0, 0.02, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)) if i % 17 else None))
    return rows


def brute_links(rows, threshold):
    ok = [i for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and good(r[1])]
    x = np.array([rows[i][1] for i in ok])
    u = x / np.sqrt((x * x).sum(1))[:, None]
    s = u @ u.T
    up = {i: i for i in ok}
    links = dict.fromkeys(ok, 0)

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, i in enumerate(ok):
        for b, j in enumerate(ok):
            if a != b and rows[i][2] == rows[j][2] and s[a, b] >= threshold:
                links[i] += 1
                up[max(top(i), top(j))] = min(top(i), top(j))
    return {rows[i][0]: (links.get(i, 0), rows[top(i)][0] if i in up else rows[i][0]) for i in range(len(rows))}


@pytest.mark.parametrize("seed,block", [(1, E.BLOCK_NODES), (2, 60)])
def test_links_and_components(spark, monkeypatch, seed, block):
    monkeypatch.setattr(E, "BLOCK_NODES", block)   # small blocks: a shard is searched block by block
    rows = make(seed, 600)
    got = E.near_duplicates(frame(spark, rows), 0.93).collect()
    want = brute_links(rows, 0.93)
    assert len(got) == len(rows)
    true, found = sum(v[0] for v in want.values()), sum(r.n_links for r in got)
    assert found <= true and found >= 0.98 * true
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert np.mean([r.component_id == want[r.vec_id][1] for r in got]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_defined_cases(spark):
    rows = make(3, 40) + BAD
    rows += [rows[5], rows[5]]   # a row repeated as a whole
    got = E.near_duplicates(frame(spark, rows), 0.93).collect()
    assert len(got) == len(rows)
    want = brute_links(make(3, 40), 0.93)
    for r in got:
        assert (r.n_links, r.component_id) == want.get(r.vec_id, (0, r.vec_id))
        assert r.kept == (r.vec_id == r.component_id)
    assert E.near_duplicates(frame(spark, []).limit(0)).count() == 0
    alone = E.near_duplicates(frame(spark, BAD)).collect()
    assert len(alone) == len(BAD) and all(r.n_links == 0 and r.kept for r in alone)


def brute_near(rows, k, every):
    ok = [(r[0], np.array(r[1])) for r in rows if r[0] is not None and good(r[1])]
    out = {}
    for i, q in ok:
        if i % every == 0:
            d = sorted({(float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in ok if j != i})[:k]
            out[i] = [(n + 1, j, x) for n, (x, j) in enumerate(d)]
    return out


def test_neighbours_recall_and_exact_scores(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(40, 8)) * 2
    rows = [(i, [float(np.float32(x)) for x in centre[i % 40] + rng.normal(size=8) * 0.5], 1) for i in range(3000)]
    rows += [(5000 + i, rows[7][1], 1) for i in range(500)]   # copies
    want = brute_near(rows, 10, 50)
    got = {}
    for r in N.search(frame(spark, rows), 10, 50).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hit = 0
    exact = dict((r[0], np.array(r[1])) for r in rows)
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and [(f[2], f[1]) for f in found] == sorted((f[2], f[1]) for f in found)
        assert all(s == float(np.sqrt(((exact[v] - exact[q]) ** 2).sum())) and v != q for _, v, s in found)
        hit += len({f[1] for f in found} & {w[1] for w in want[q]})
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_neighbours_defined_cases(spark):
    rows = make(5, 8) + BAD + [make(5, 8)[2]]   # fewer than k candidates: all of them
    got = {}
    for r in N.search(frame(spark, rows), 10, 2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute_near(make(5, 8), 10, 2)
    assert N.search(frame(spark, []).limit(0)).count() == 0
    assert N.search(frame(spark, BAD[:7])).count() == 0


def test_a_failed_audit_makes_all_queries_exact(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARES", (1e-9,))   # one cell is never enough
    monkeypatch.setattr(N, "RECALL", 1.0)
    monkeypatch.setattr(N, "CELL_ROWS", 2)
    monkeypatch.setattr(N, "BLOCK_ROWS", 100)
    rows = make(8, 600)
    prepared, dim = N.prepared(frame(spark, rows))
    assert not N.fit(prepared, dim, 10).reached
    got = {}
    for r in N.search(frame(spark, rows), 10, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute_near(rows, 10, 20)


def test_blocks_of_hot_cells_find_the_same(spark, monkeypatch):
    rows = [(i, [1.0] * 8, 1) for i in range(300)] + [(1000 + i, [1.0] * 7 + [1.0 + i / 1000], 1) for i in range(300)]
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    got = {}
    for r in N.search(frame(spark, rows), 10, 100).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_near([(i, [float(np.float32(x)) for x in v], l) for i, v, l in rows], 10, 100)
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in want[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("block", [E.BLOCK_NODES, 40])
def test_links_count_whoever_found_them(spark, monkeypatch, block):
    def one_sided(x, adj, starts, q, own, reach):   # of a pair only one node's search finds the other
        inside = q @ x.T >= reach
        return inside & (np.arange(len(x))[None, :] < own[:, None])

    monkeypatch.setattr(E, "range_search", one_sided)
    monkeypatch.setattr(E, "SHARD_NODES", 60)
    monkeypatch.setattr(E, "BLOCK_NODES", block)
    prepared, dim = E.prepared(frame(spark, make(4, 500)), "label")
    nodes = E.nodes_of(prepared.where("label is not null").select("vec_id", "vec", "label"))
    rows = {r.node: r for r in nodes.collect()}
    shards = {r.node: set(r.shards) for r in E._shards(nodes, dim, 2).collect()}
    u = {n: np.array(r.vec) / np.linalg.norm(r.vec) for n, r in rows.items()}
    want = {a: sum(rows[b].copies for b in rows if a != b and rows[a].label == rows[b].label and shards[a] & shards[b] and u[a] @ u[b] >= 0.93)
            for a in rows}
    got = dict.fromkeys(rows, 0)
    for r in E.search_links(nodes, dim, 0.93, 2).collect():
        got[r.node] += r.links
    assert len(set().union(*shards.values())) > 3 and got == want and any(want.values())


def test_a_group_with_many_links_hides_no_small_pairs(spark):
    hot = [(i, [1.0] * 7 + [1.0 + i / 10000], 1) for i in range(100)]
    pairs = [(1000 + i, [float(x) for x in np.random.default_rng(i // 2).normal(size=8) + (i % 2) * 0.001], 2) for i in range(60)]
    prepared, dim = E.prepared(frame(spark, hot + pairs), "label")
    nodes = E.nodes_of(prepared.where("label is not null").select("vec_id", "vec", "label"))
    found = spark.createDataFrame([(r.node, 99, 0) for r in nodes.collect() if r.label == 1], "node long, links long, other long")
    assert E.audit(nodes, found, dim, 0.999) < E.RECALL


@pytest.mark.parametrize("block", [E.BLOCK_NODES, 40])
def test_links_are_exact_if_no_overlap_finds_them(spark, monkeypatch, block):
    lost = lambda nodes, *_: spark.createDataFrame([], "node long, links long, other long")
    monkeypatch.setattr(E, "search_links", lost)
    monkeypatch.setattr(E, "SHARD_NODES", 60)
    monkeypatch.setattr(E, "BLOCK_NODES", block)
    rows = make(6, 500)
    want = brute_links(rows, 0.93)
    got = E.near_duplicates(frame(spark, rows), 0.93).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
