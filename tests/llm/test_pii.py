"""Base spans against the plain patterns; what the classifier adds and leaves alone."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from airlens.llm import pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        double = sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        return 12 <= len(digits) <= 19 and (double + sum(digits[-1::-2])) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if valid(k, m[0]))


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(docs, out):
    want = sorted((d, [sum(k == kind for _, k, _ in b) for kind in range(4)], hashlib.sha256(joined(b).encode()).hexdigest())
                  for d, b in ((-1 if r.doc_id is None else r.doc_id, brute(r.text)) for r in docs.collect()))
    rows = out.collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in rows) == want
    return rows


def test_base_spans_of_the_sample(spark, sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    for r in check(sample, pii.personal_data(sample)):   # base spans stay, and nothing is added that overlaps
        all_spans = [s for s in r.spans.split(",") if s]
        assert set(joined(brute(texts[r.doc_id])).split(",")) - {""} <= set(all_spans)


def test_hard_rows(spark, hard, nothing):
    check(hard, pii.personal_data(hard))
    assert pii.personal_data(nothing).collect() == []


def test_random_texts():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice("0112345 .-@@ab+(),é") for _ in range(rng.randint(0, 50)))
        assert sorted((s, k, e) for k, s, e in pii.matches(text)) == sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text)), text


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "1." * 150_000, "1-" * 150_000, "@a." * 100_000, "+1" + " " * 300_000, "(at)" * 75_000, "a." * 150_000 + "@b"])
def test_long_texts_take_linear_time(text):
    t0 = time.time()
    for start, kind, end, _ in pii.spans(text):
        pii.votes(text, start, end, kind)
    assert time.time() - t0 < 10


def test_other_notations_are_added_and_clean_texts_left_alone(spark, sample):
    planted = [("Call me at 555-123-4567 today", "phone:11:23"), ("mail jane.doe (at) example (dot) com now", "email:5:36"),
               ("my card 4111.1111.1111.1111 is lost", "card:8:27"), ("host 10[.]20[.]30[.]40 is down", "ip:5:22")]
    clean = ["It costs 1234 5678 9012 3456 units", "version 1.2.3.400 of 2024-10-12", "arrive at home.The end", "ISBN 978-3-16-148410-0, order 4111-1111-1111-1112",
             "key 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08"]
    docs = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate([p[0] for p in planted] + clean)], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(sample.select("doc_id", "text").unionByName(docs)).where("doc_id >= 1000000").collect()}
    assert [found[10**6 + i] for i in range(len(planted))] == [p[1] for p in planted]
    assert [found[10**6 + len(planted) + i] for i in range(len(clean))] == [""] * len(clean)


def test_reliabilities_are_found():
    """Votes drawn from known reliabilities: EM gets them back without labels."""
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6])
    v = np.where(rng.random((len(truth), pii.LABELERS)) < right, truth[:, None], ~truth[:, None]) * 2
    rows, n = np.unique(v, axis=0, return_counts=True)
    prior, chance = pii.reliabilities(rows, np.zeros(len(rows), bool), n.astype(float))
    assert abs(prior - 0.3) < 0.02
    assert np.abs(np.exp(chance[1][:, 2]) - right).max() < 0.03
