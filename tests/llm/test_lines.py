"""Line dedup against brute force."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from airlens.llm import line_dedup as L
from tests.llm.test_tokens import ordered


def one_edit(a, b):
    """Edit distance of word sequences at most one, by definition."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(docs, min_words, near_words):
    """{(doc_id, text): (n_lines, text without the lines that go)}; ``docs`` in the operator's order."""
    earlier, out = [], {}
    for doc_id, text in docs:
        if text is None:
            out[(doc_id, text)] = (0, 0, None)
            continue
        if (doc_id, text) in out:
            continue
        kept, lines = [], text.split("\n")
        for line in lines:
            w = line.strip(" ").lower().split(" ")
            if w == [""] or len(w) < min_words:
                kept.append(line)
                continue
            if not any(w == e or len(w) >= near_words and len(e) >= near_words and one_edit(w, e) for e in earlier):
                kept.append(line)
            earlier.append(w)
        out[(doc_id, text)] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def compare(spark, docs, min_words=L.MIN_WORDS, near_words=L.NEAR_WORDS):
    want = brute(ordered(docs), min_words, near_words)
    got = L.dedup_documents(docs, min_words, near_words)
    assert set(docs.columns) < set(got.columns)
    key = docs.select("doc_id", F.col("text").alias("before")).collect()
    after = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()]
    assert sorted(after, key=str) == sorted([(r.doc_id, *want[(r.doc_id, r.before)]) for r in key], key=str)
    return after


def variants(rng, line):
    w = line.split(" ")
    i = rng.randrange(len(w))
    return " ".join(rng.choice([w[:i] + ["new"] + w[i + 1:], w[:i] + w[i + 1:], w[:i] + ["extra"] + w[i:], [x.upper() for x in w], w]))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_lines_go(spark, seed):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice([2, 3, 4, 7, 8, 9, 12]))) for _ in range(25)]
    docs = [(i, "\n".join(variants(rng, rng.choice(base)) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n long").repartition(4)
    after = compare(spark, df)
    assert 0 < sum(r[2] for r in after) < sum(r[1] for r in after)


def test_repeated_words_and_a_hot_line(spark):
    docs = [(i, "a a a a a a a a" + " a" * (i % 3) + "\nthe very common line that stands in many documents\nunique line %d b c d e f g" % (i * 7)) for i in range(80)]
    compare(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(4))


def test_no_line_stays_twice(spark):
    docs = [(i, f"Yes.\n\n  ok \nline {i % 5}\n```\n   \n{i}") for i in range(40)]
    after = compare(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    kept = [line.strip(" ").lower() for *_, text in after for line in text.split("\n") if line.strip(" ")]
    assert len(kept) == len(set(kept)) == 3 + 5 + 40


def test_defined_cases(spark, hard, nothing):
    compare(spark, hard)
    assert L.dedup_documents(nothing).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=7), st.lists(st.sampled_from("ab"), max_size=7))
def test_word_check_is_the_edit_distance(a, b):
    # the same steps as the column expression takes
    p = next((i + 1 for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)) + 1)
    same = (a[p:] == b[p:] if len(a) == len(b) else a[p:] == b[p - 1:] if len(a) == len(b) + 1 else b[p:] == a[p - 1:] if len(b) == len(a) + 1 else False)
    assert same == one_edit(a, b)


def test_plan_has_no_python(sample):
    plan = L.dedup_documents(sample)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
