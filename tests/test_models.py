"""Least squares, passive-aggressive and RMSE (FIXTURES F7)."""

import math

import pytest
from pyspark.sql import functions as F

from airlens.operators.regression import (compare, feature_label, fit_linear, pa_fit, pa_fit_groups, pa_step,
                                          pa_weights_frame, predict_linear, predict_pa, target_index)


def test_ols_exact_plane(spark):
    rows = [(float(a), float(b), float(3 + 2 * a - b)) for a in range(3) for b in range(3)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    m = fit_linear(df, ["a", "b"])
    assert m.intercept == pytest.approx(3.0)
    assert list(m.coefficients) == [pytest.approx(2.0), pytest.approx(-1.0)]
    scored = predict_linear(m, df, ["a", "b"])
    assert compare(scored, predictions=["linear_prediction"]).first()["rmse_linear"] == pytest.approx(0.0, abs=1e-9)


def test_pa_hand_steps():
    w, b = pa_step([0.0], 0.0, [2.0], 10.0)
    assert (w, b) == ([2.0], 1.0)
    w, b = pa_step(w, b, [1.0], 3.5)
    assert w[0] == pytest.approx(2.2) and b == pytest.approx(1.2)


def test_mixing_one_partition_one_epoch_is_sequential(spark):
    rows = [(i, float(i % 5), float((i * 3) % 7), float(i % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, label double")
    w, b, n = pa_fit(df, ["x1", "x2"], order=["id"])
    sw, sb = [0.0, 0.0], 0.0
    for _, x1, x2, y in rows:
        sw, sb = pa_step(sw, sb, [x1, x2], y)
    assert n == 200 and w == sw and b == sb
    w4, b4, n4 = pa_fit(df, ["x1", "x2"], order=["id"], shard=F.col("id") % 4, epochs=2)
    assert n4 == 200 and all(math.isfinite(v) for v in w4 + [b4])


def test_per_entity_fold_and_prediction(spark):
    rows = [("a", 1, 2.0, 10.0), ("a", 2, 1.0, 3.5), ("b", 1, 2.0, 10.0)]
    df = spark.createDataFrame(rows, "e string, o long, x double, label double")
    wts = {r["e"]: r for r in pa_fit_groups(df, "e", ["o"], ["x"]).collect()}
    assert wts["a"]["w"][0] == pytest.approx(2.2) and wts["a"]["b"] == pytest.approx(1.2) and wts["a"]["n"] == 2
    assert wts["b"]["w"] == [2.0] and wts["b"]["b"] == 1.0
    pred = predict_pa(df, pa_fit_groups(df, "e", ["o"], ["x"]), ["x"], entity="e")
    got = {(r["e"], r["o"]): r["pa_prediction"] for r in pred.collect()}
    assert got[("a", 1)] == pytest.approx(2.2 * 2 + 1.2)
    glob = predict_pa(df, pa_weights_frame(spark, [2.0], 1.0, 1), ["x"])
    assert sorted(r["pa_prediction"] for r in glob.collect()) == [3.0, 5.0, 5.0]


def test_rmse_value(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 6.0)], "label double, p double")
    assert compare(df, predictions=["p"]).first()["rmse_p"] == pytest.approx(math.sqrt(3))


@pytest.mark.parametrize("k", [-1, 5, "x", 1.5])
def test_target_index_validated(k):
    with pytest.raises(ValueError):
        target_index(k)


def test_feature_label_slices(spark):
    from airlens.schemas import FEATURES, LABELS
    row = {c: float(i) for i, c in enumerate(FEATURES + LABELS)}
    df = spark.createDataFrame([row])
    out = feature_label(df, 2)
    assert out.columns == FEATURES + ["label"] and out.first()["label"] == row[LABELS[2]]


def _fold(rows, w=None, b=0.0):
    from airlens.operators.regression import pa_step
    w = [0.0] * len(rows[0][0]) if w is None else list(w)
    for x, y in rows:
        w, b = pa_step(w, b, list(x), y)
    return w, b


def test_many_entities_fold_exactly_and_whatever_the_split(spark):
    rows = [(f"e{i % 40}" if i % 3 else "hot", i, (i * 37 % 11) / 3.0, (i * 17 % 7) / 2.0, (i * 13 % 5) / 1.5) for i in range(900)]
    rows += [(None, 1000 + i, 1.0 * i, 2.0, 3.0) for i in range(5)]
    df = spark.createDataFrame(rows, "e string, o long, x1 double, x2 double, label double")
    for n in (1, 2, 8):
        got = {r["e"]: r for r in pa_fit_groups(df.repartition(n), "e", ["o"], ["x1", "x2"]).collect()}
        assert set(got) == {r[0] for r in rows}
        for e in got:
            own = sorted((r for r in rows if r[0] == e), key=lambda r: r[1])
            w, b = _fold([((r[2], r[3]), r[4]) for r in own])
            assert got[e]["w"] == w and got[e]["b"] == b and got[e]["n"] == len(own)


def test_global_fit_depends_on_shards_only(spark):
    from airlens.operators.regression import shard_of
    rows = [(i, (i * 37 % 11) / 3.0, (i * 13 % 5) / 1.5) for i in range(300)]
    df = spark.createDataFrame(rows, "o long, x double, label double")
    fits = [pa_fit(df.repartition(n), ["x"], order=["o"], shard=shard_of(["o"], 4)) for n in (1, 2, 8)]
    assert fits[0] == fits[1] == fits[2]
    spark.conf.set("airlens.rank.hotGroupRows", "10")
    try:
        assert pa_fit(df, ["x"], order=["o"], shard=shard_of(["o"], 4)) == fits[0]
    finally:
        spark.conf.unset("airlens.rank.hotGroupRows")


def test_init_goes_on_where_the_last_call_ended(spark):
    rows = [("a" if i % 2 else "b", i, (i * 37 % 11) / 3.0, (i * 13 % 5) / 1.5) for i in range(100)]
    df = spark.createDataFrame(rows, "e string, o long, x double, label double")
    w, b, _ = pa_fit(df.where("o < 60"), ["x"], order=["o"])
    whole = pa_fit(df, ["x"], order=["o"])
    assert pa_fit(df.where("o >= 60"), ["x"], order=["o"], init=(w, b))[:2] == whole[:2]
    first = pa_fit_groups(df.where("o < 60"), "e", ["o"], ["x"])
    second = {r["e"]: (r["w"], r["b"]) for r in pa_fit_groups(df.where("o >= 60"), "e", ["o"], ["x"], init=first).collect()}
    assert second == {r["e"]: (r["w"], r["b"]) for r in pa_fit_groups(df, "e", ["o"], ["x"]).collect()}


def test_mixed_method_is_the_average_of_its_shards(spark):
    from airlens.operators.regression import shard_of
    rows = [("a", i, float(i % 3), float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "e string, o long, x double, label double")
    got = pa_fit_groups(df, "e", ["o"], ["x"], method="mixed", shards=3).first()
    shards = {}
    for r in df.withColumn("s", shard_of(["o"], 3)).orderBy("o").collect():
        shards.setdefault(r["s"], []).append(((r["x"],), r["label"]))
    fits = [(_fold(v), len(v)) for v in shards.values()]
    assert got["n"] == 60
    assert got["w"][0] == pytest.approx(sum(f[0][0] * n for f, n in fits) / 60)
    assert got["b"] == pytest.approx(sum(f[1] * n for f, n in fits) / 60)
    with pytest.raises(ValueError):
        pa_fit_groups(df, "e", ["o"], ["x"], method="auto")


def test_comparison_and_rmse_lines(spark):
    from airlens.operators.regression import comparison_lines, rmse_lines
    df = spark.createDataFrame([(1.0, 1.5, 2.0)], "label double, pa_prediction double, linear_prediction double")
    assert comparison_lines(df).first()["line"] == "Real:   1.000000\tPA:   1.500000\tLinear:   2.000000"
    lines = [r["line"] for r in rmse_lines(compare(df)).collect()]
    assert lines == ["PA - Root mean squared error: 0.5", "Linear - Root mean squared error: 1.0"]
