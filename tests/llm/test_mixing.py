"""Pfair mixing: deviation, completeness, defined cases."""

from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from airlens.llm import mixing


def deviations(parts, slots):
    """The largest distance of a source from its exact share, after every slot."""
    names, q = sorted(parts), sum(parts.values())
    at = {s: i for i, s in enumerate(names)}
    share = np.array([parts[s] / q for s in names])
    done = np.zeros(len(names))
    for t, (s, k) in zip(range(slots), mixing.earliest_deadline_first(parts)):
        assert k == done[at[s]]
        done[at[s]] += 1
        yield np.abs(done - share * (t + 1)).max()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.001, 1), min_size=1, max_size=12))
def test_deviation_from_the_exact_weights_stays_below_one_block(weights):
    parts = mixing.whole({f"s{i}": w for i, w in enumerate(weights)})
    assert all(parts["s0"] * Fraction(w) == parts[f"s{i}"] * Fraction(weights[0]) for i, w in enumerate(weights))
    assert max(deviations(parts, 500)) < 1


def test_many_sources_keep_to_their_exact_weights():
    weights = {f"s{i:04}": 1 / (i + 1) for i in range(2500)}   # the least ones are far below a thousandth
    assert max(deviations(mixing.whole(weights), 10_000)) < 1


def test_schedule_holds_every_block_once():
    blocks = {"a": 40, "b": 3, "c": 11}
    order, empty = mixing.schedule({"a": 1, "b": 5, "c": 2}, blocks)
    assert sorted(order) == [(s, k) for s, n in sorted(blocks.items()) for k in range(n)]
    assert order[:empty].count(("b", 2)) == 1 and order[empty:] == sorted(order[empty:], key=lambda b: ({"a": 8, "c": 4}[b[0]] * (b[1] + 1), b))
    for s in blocks:   # blocks of a source in turn
        assert [k for x, k in order if x == s] == list(range(blocks[s]))


def test_blocks_grow_so_that_the_schedule_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"t{i}", f"s{i % 3}") for i in range(1000)], "doc_id long, text string, source string")
    got = sorted(mixing.mix(docs, most_blocks=50).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1000)) and max(r.slot for r in got) < 53
    sizes = Counter(r.slot for r in got)
    assert max(sizes.values()) == 20
    assert [r.slot for r in got] == sorted(r.slot for r in got)


def test_mixture_is_whole_and_on_target(spark):
    rows = [(i, f"t{i}", "hot" if i % 2 else f"s{i % 6}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    weights = {"hot": 0.5, "s0": 0.2, "s2": 0.2, "s4": 0.1}
    got = sorted(mixing.mix(docs, weights, block=4).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(900)) and {r.doc_id for r in got} == set(range(900))
    seen = dict.fromkeys(weights, 0)
    order = {}
    for n, r in enumerate(got, 1):
        seen[r.source] += 1
        assert order.get(r.source, -1) < r.doc_id
        order[r.source] = r.doc_id
        if r.on_target:   # less than one block off after whole blocks, so less than two anywhere
            assert all(abs(seen[s] - w * n) < 8 for s, w in weights.items())
    assert sum(r.on_target for r in got) > 300


def test_defined_cases(spark, hard, nothing):
    got = mixing.mix(hard).collect()
    assert len(got) == hard.count() and sorted(r.position for r in got) == list(range(len(got)))
    assert "" in {r.source for r in got}
    assert mixing.mix(nothing).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(hard, {"s1": 1.0})
    with pytest.raises(ValueError):
        mixing.whole({"a": -1.0, "b": 2.0})


def test_documents_come_in_the_mixtures_order(spark, sample, hard):
    placed = {r.doc_id: r.position for r in mixing.mix(sample).collect()}
    out = mixing.mix_documents(sample)
    assert out.columns == sample.columns
    got = [placed[r.doc_id] for r in out.collect()]
    assert got == sorted(got) and len(got) == sample.count()
    assert sorted(map(str, mixing.mix_documents(hard).collect())) == sorted(map(str, hard.collect()))
