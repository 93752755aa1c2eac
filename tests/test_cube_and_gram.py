"""The moment cube, the one-scan fit of all targets, bucketed alignment and training on a stream."""

import datetime as dt
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.functions.predicates import Box, Period
from airlens.operators.gram import fit_all, merge
from airlens.operators.regression import fit_linear, pa_fit_groups, pa_step, predict_linear
from airlens.plans.bucketed import DAY, align_bucketed, ingest_bucketed
from airlens.plans.cube import ingest_cube, merge_moments, moment_columns, region_report_cube, split_cells, read_cube
from airlens.plans.report import region_report
from airlens.schemas import Layout
from airlens.session import scratch_path
from airlens.streaming.sources import decode, file_lines
from airlens.streaming.train import latest_weights, stream_pa_fit


# --- cube ---------------------------------------------------------------------
READING = "ts timestamp_ntz, latitude double, longitude double, a double, b double"


def readings(spark, n=3000, seed=4):
    rng = random.Random(seed)
    rows = [(dt.datetime(2014, 8, 1) + dt.timedelta(hours=rng.randrange(2400)), round(rng.uniform(56, 57), 3), round(rng.uniform(10, 11), 3),
             rng.gauss(1e6, 1), None if rng.random() < 0.1 else rng.uniform(-5, 5)) for _ in range(n)]
    rows += [(None, 56.5, 10.5, 1.0, 1.0), (dt.datetime(2014, 9, 1), None, 10.5, 1.0, 1.0), (dt.datetime(2014, 9, 1), 56.5, 10.5, None, None)]
    return spark.createDataFrame(rows, READING).repartition(4)


@pytest.mark.parametrize("box,period", [
    ((56.0, 57.0, 10.0, 11.0), ("2014-08-01", "2014-12-01")), ((56.25, 56.75, 10.1, 10.333), ("2014-08-15", "2014-09-15")),
    ((56.123, 56.129, 10.4, 10.5), ("2014-08-15", "2014-10-15")), ((60.0, 61.0, 10.0, 11.0), ("2014-08-01", "2014-12-01"))])
def test_cube_report_equals_the_report_on_readings(spark, box, period):
    rows, out, cube = readings(spark), scratch_path(spark, "r"), scratch_path(spark, "c")
    geo = dict(attributes=["a", "b"], cell=0.1)
    ingest_cube(rows.where("latitude < 56.4"), out, cube, batch="one", **geo)
    for _ in range(2):   # a retry replaces its readings and cells
        ingest_cube(rows.where("latitude >= 56.4 OR latitude IS NULL"), out, cube, batch="2", **geo)
    box, period = Box(*box), Period.of(*period)
    got = {r.attribute: r for r in region_report_cube(spark, out, cube, box, period, **geo).collect()}
    want = {r.attribute: r for r in region_report(rows, box, period, attributes=["a", "b"]).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k].elements == want[k].elements
        for c in ("min", "max", "mean", "std"):
            assert got[k][c] == pytest.approx(want[k][c], rel=1e-9, abs=1e-9)


def test_whole_cells_are_not_read_again(spark):
    out, cube = scratch_path(spark, "r"), scratch_path(spark, "c")
    ingest_cube(readings(spark), out, cube, attributes=["a"], cell=0.1)
    inside, cut = split_cells(read_cube(spark, cube), Box(56.2, 56.8, 10.2, 10.8), Period.of("2014-08-01", "2014-12-01"))
    assert inside.count() >= 100 and cut.count() <= 60   # 4 months of 36 cells; only readings right on the upper sides are cut


def test_merged_moments_keep_their_digits(spark):
    x = np.random.default_rng(3).normal(1e9, 1, 4000)
    rows = spark.createDataFrame([(float(v), i % 37) for i, v in enumerate(x)], "a double, g int")
    from airlens.plans.cube import _moments
    row = merge_moments(rows.groupBy("g").agg(*_moments(["a"])).select(*moment_columns(1)), 1).first()
    assert row._std0 == pytest.approx(x.std(), rel=1e-6) and row._mean0 == pytest.approx(x.mean(), rel=1e-12)


# --- all targets in one scan -----------------------------------------------------
def design(spark, n=800):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        day, w = i % 7, float(rng.normal(1000, 5))
        x = [float(rng.normal()), float(rng.uniform(0, 50)), *[float(day == k) for k in range(7)], w, w]   # flags sum to 1, one value given twice
        rows.append((*x, *[float(rng.normal() + x[0] * (t + 1) + day - 0.1 * w) for t in range(5)]))
    names = ["s", "v", *[f"d{k}" for k in range(7)], "w1", "w2"]
    return spark.createDataFrame(rows, [*names, *[f"y{t}" for t in range(5)]]).repartition(5), names


def test_all_targets_predict_like_five_fits(spark):
    df, names = design(spark)
    models = fit_all(df, names, [f"y{t}" for t in range(5)])
    assert models.rank == 9   # 11 features, of which two directions have no variance
    both = models.predict(df)
    for t in range(5):
        each = predict_linear(fit_linear(df.withColumn("label", F.col(f"y{t}")), names), both, names)
        gap = each.agg(F.max(F.abs(F.col("linear_prediction") - F.col(f"predicted_y{t}"))), F.avg(F.pow(F.col(f"y{t}") - F.col(f"predicted_y{t}"), 2))).first()
        assert gap[0] < 1e-4   # a singular design sends Spark ML to an iterative solver, which stops early
        assert gap[1] * models.elements == pytest.approx(models.residuals[t], rel=1e-6)
    table = np.array([[float(v) for v in r] for r in both.collect()])
    x = np.column_stack([np.ones(len(table)), table[:, :11]])
    exact = x @ np.linalg.lstsq(x, table[:, 11:16], rcond=None)[0]
    assert np.abs(exact - table[:, 16:]).max() < 1e-6
    assert models.coefficients[-1] == pytest.approx(models.coefficients[-2])   # least norm: shared evenly


def test_fit_all_refuses_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    with pytest.raises(Exception, match="null or NaN"):
        fit_all(df, ["x"], ["y"])
    with pytest.raises(ValueError, match="no rows"):
        fit_all(df.where("x > 1"), ["x"], ["y"])


def test_moments_merge_in_any_order():
    x = np.random.default_rng(1).normal(5, 2, (100, 3))
    parts = [(float(len(p)), p.mean(axis=0), (p - p.mean(axis=0)).T @ (p - p.mean(axis=0))) for p in np.array_split(x, 7)]
    n, mean, cross = merge([(0.0, 0, 0), *parts[::-1]])
    assert n == 100 and mean == pytest.approx(x.mean(axis=0)) and cross == pytest.approx(np.cov(x.T, bias=True) * 100)


# --- bucketed alignment -----------------------------------------------------------
def test_bucketed_alignment_plans_no_exchange(spark):
    rng = random.Random(5)
    day = dt.datetime(2014, 8, 1)
    left = [("hot" if i % 3 else f"s{i % 5}", day + dt.timedelta(hours=rng.randrange(100)), i) for i in range(900)]
    right = [("hot" if i % 3 else f"s{i % 6}", day + dt.timedelta(hours=rng.randrange(100)), i) for i in range(700)]
    names = []
    for rows, c in ((left, "l"), (right, "r")):
        names.append(f"t_{uuid.uuid4().hex[:8]}")
        df = spark.createDataFrame(rows, f"sensor_id string, ts timestamp_ntz, {c} int").repartition(3)
        ingest_bucketed(df, names[-1], scratch_path(spark, "b"), buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        out = align_bucketed(spark, *names, left_order=["l"], right_order=["r"], left_columns=["l"], right_columns=["r"])
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.l, r.r) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert DAY not in out.columns
    sides = [{}, {}]
    for side, rows in zip(sides, (left, right)):
        for s, t, i in rows:
            side.setdefault((s, t), []).append(i)
    assert got == sorted(p for k in sides[0] for p in zip(sides[0][k], sides[1].get(k, [])))


# --- training on a stream ---------------------------------------------------------
ROWS = Layout(fields=((0, "sensor", "string"), (1, "place", "long"), (2, "x", "double"), (3, "label", "double")), ts=None, header_field=-1)


def test_stream_training_goes_on_after_a_restart(spark, tmp_path):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.4 else f"s{rng.randrange(5)}", i, rng.uniform(-1, 1), rng.uniform(-2, 2)) for i in range(400)]
    folder = tmp_path / "in"
    folder.mkdir()
    target, checkpoint = scratch_path(spark, "w"), scratch_path(spark, "ck")

    def add(part):
        mine = rows[part * 100:(part + 1) * 100]
        rng.shuffle(mine)   # order inside a batch does not matter
        path = folder / f"{part}.csv"
        path.write_text("\n".join(f"{s},{i},{x!r},{y!r}" for s, i, x, y in mine))
        os.utime(path, (1e9 + part, 1e9 + part))

    def run():
        records = decode(file_lines(spark, str(folder), "*.csv", max_files_per_trigger=1), ROWS, bad_rows="fail")
        stream_pa_fit(records, target, checkpoint, "sensor", ["place"], ["x"], partitions=2).awaitTermination()

    add(0), add(1)
    run()
    add(2), add(3)
    run()   # a new query on the same checkpoint
    got = {r.sensor: (r.w[0], r.b, r.n) for r in latest_weights(spark, target, "sensor").collect()}
    df = spark.createDataFrame(rows, "sensor string, place long, x double, label double")
    want = {r.sensor: (r.w[0], r.b, r.n) for r in pa_fit_groups(df, "sensor", ["place"], ["x"]).collect()}
    assert got == want


def test_stream_training_calls_the_fold_per_bucket_not_per_entity(spark, tmp_path):
    # far more entities than buckets, ids no double holds, one of them null; the state has a value per bucket
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(2 ** 60, 2 ** 60 + 700)]), i, rng.uniform(-1, 1), rng.uniform(-2, 2)) for i in range(3000)]
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(2):
        path = folder / f"{part}.csv"
        path.write_text("\n".join(f"{s},{i},{x!r},{y!r}" for s, i, x, y in rows[part * 1500:(part + 1) * 1500]))
        os.utime(path, (1e9 + part, 1e9 + part))
    records = decode(file_lines(spark, str(folder), "*.csv", max_files_per_trigger=1), ROWS, bad_rows="fail")
    records = records.withColumn("sensor", F.when(F.col("sensor") != "None", F.col("sensor")).cast("long"))
    target = scratch_path(spark, "w")
    query = stream_pa_fit(records, target, scratch_path(spark, "ck"), "sensor", ["place"], ["x"], partitions=2)
    query.awaitTermination()
    assert [p["stateOperators"][0]["numRowsTotal"] <= 256 for p in query.recentProgress if p["numInputRows"]] == [True, True]
    got = {r.sensor: (r.w[0], r.b, r.n) for r in latest_weights(spark, target, "sensor").collect()}
    want = {}
    for sensor, _, x, y in rows:
        w, b, n = want.get(sensor, (0.0, 0.0, 0))
        (w,), b = pa_step([w], b, [x], y)
        want[sensor] = (w, b, n + 1)
    assert got == want and None in got
