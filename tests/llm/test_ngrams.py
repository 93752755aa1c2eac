"""N-gram Jaccard join and connected components against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from airlens.llm import ngram_join as N
from airlens.llm.components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < width else [tuple(w[i:i + width]) for i in range(len(w) - width + 1)])


def groups(n, linked):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in linked:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return [top(i) for i in range(n)]


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    top = groups(len(rows), pairs)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top[i]] = min(least.get(top[i], d), d)
    return sorted(((d, len(s), least.get(t) if s else d) for (d, _), s, t in zip(rows, sets, top)), key=str), len(pairs)


def compare(docs, width=4, percent=85):
    want, links = brute([(r.doc_id, r.text) for r in docs.collect()], width, percent)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.jaccard_components(docs, width, percent).collect()), key=str)
    assert got == want
    return links


def changed(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("seed,width,percent", [(1, 4, 85), (2, 5, 80)])
def test_components_equal_brute_force(spark, seed, width, percent):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 3, 5, 30, 120, 200]))) for _ in range(12)]
    common = " ".join(f"c{i}" for i in range(40))   # a passage that many texts share
    texts = [changed(rng, rng.choice(base), rng.randrange(5)) for _ in range(160)]
    texts = [t + " " + common if rng.random() < 0.4 else t for t in texts]
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    assert compare(df, width, percent) > 50


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = " ".join(f"w{i}" for i in range(150))
    texts = [base] * 60 + [changed(rng, base, rng.randrange(1, 7)) for _ in range(250)]
    compare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))


def test_defined_cases(spark, hard, nothing):
    compare(hard)
    assert N.jaccard_components(nothing).count() == 0


def test_one_of_each_group_stays(spark, hard):
    kept = N.one_of_each(hard, 5, 80)
    assert kept.columns == hard.columns
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    sets = [shingles(t, 5) for _, t in rows]
    top = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
                             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])])
    hashes = {r.text: r.h for r in hard.select("text", F.xxhash64("text").alias("h")).collect()}
    best, want = {}, []
    for (d, t), s, g in zip(rows, sets, top):
        if not s:
            want.append((str(d), t or ""))
            continue
        key = (d is not None, d or 0, hashes[t])
        if g not in best or key < best[g][0]:
            best[g] = (key, (str(d), t))
    assert got == sorted(want + [v for _, v in best.values()])


def test_connected_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)] + [(1, 50), (50, 7), (7, 1), (900, 901), (5, 5)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = [rng.choice([(a, b), (b, a)]) for a, b in chain + star]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    want = {i: 100 for i in range(100, 161)} | {1: 1, 7: 1, 50: 1, 900: 900, 901: 900} | {1000 + i: 1000 for i in range(200)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefixes_keep_every_link():
    """Two sets that link share min(l, l') tokens of their prefixes, whatever order and lengths."""
    rng = random.Random(9)
    rule = N.Rule(85)
    for _ in range(2000):
        n = rng.randrange(1, 60)
        x = set(rng.sample(range(100), n))
        y = set(x)
        for _ in range(rng.randrange(6)):
            (y.discard if rng.random() < 0.5 else y.add)(rng.randrange(100))
        if not y or not rule.linked(len(x), len(y), len(x & y)):
            continue
        least = [min(N.MOST, rule.overlap(len(s))) for s in (x, y)]
        lx, ly = (rng.randrange(1, m + 1) for m in least)
        px, py = (set(sorted(s)[:int(rule.prefix(len(s), l))]) for s, l in ((x, lx), (y, ly)))
        assert len(px & py) >= min(lx, ly)
