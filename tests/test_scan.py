"""The ordered scan over readings and points against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from airlens.operators.scan import _below, attach_scan

BASE = dt.datetime(2024, 1, 1)
SERIES = {"a": "value a", "b": "row", "none": "nothing"}


def at(m):
    return None if m is None else BASE + dt.timedelta(seconds=m)


def brute(points, name, t, how):
    mine = sorted((m, v) for s, m, v in points if s == name and m is not None and v is not None)
    if t is None or not mine:
        return None
    below, above = [p for p in mine if p[0] <= t], [p for p in mine if p[0] >= t]
    if how == "backward":
        return below[-1][1] if below else mine[0][1]
    if how == "forward":
        return above[0][1] if above else mine[-1][1]
    if below and below[-1][0] == t:
        return below[-1][1]
    if not below or not above:
        return (below or [mine[-1]])[-1][1] if not above else above[0][1]
    (s, v), (e, w) = below[-1], above[0]
    return ((e - t) * v + (t - s) * w) / (e - t + t - s)


def case(seed):
    rng = random.Random(seed)
    points = [(rng.choice("ab"), rng.randint(0, 400) if rng.random() < 0.8 else 200, round(rng.uniform(-9, 9), 3)) for _ in range(80)]
    points += [("a", None, 1.0), ("b", 5, None)]
    # a third of the readings share one time, some lie outside of all points, some have none
    times = [200] * 100 + [rng.randint(-50, 450) for _ in range(190)] + [None] * 10
    return points, times


@pytest.mark.parametrize("how", ["interpolate", "backward", "forward"])
@pytest.mark.parametrize("seed", [1, 2])
def test_scan_matches_brute_force(spark, how, seed):
    points, times = case(seed)
    pts = spark.createDataFrame([(s, at(m), v) for s, m, v in points], "measurement string, ts timestamp_ntz, value double")
    rows = spark.createDataFrame([(i, at(m), "s", None) for i, m in enumerate(times)], "id int, ts timestamp_ntz, bucket string, point double").repartition(5)
    got = attach_scan(rows, "ts", pts, SERIES, how)
    assert got.columns == ["id", "ts", "bucket", "point", *SERIES.values()]
    found = {r.id: [r[c] for c in SERIES.values()] for r in got.collect()}
    assert len(found) == len(times)
    for i, t in enumerate(times):
        for have, name in zip(found[i], SERIES):
            want = brute(points, name, t, how)
            assert have == (want if want is None else pytest.approx(want, abs=1e-9)), (i, t, name)


def test_without_points_or_rows(spark):
    none = spark.createDataFrame([], "measurement string, ts timestamp_ntz, value double")
    rows = spark.createDataFrame([(1, BASE)], "id int, ts timestamp_ntz")
    assert [tuple(r) for r in attach_scan(rows, "ts", none, {"a": "v"}).collect()] == [(1, BASE, None)]
    assert attach_scan(rows.where("id > 1"), "ts", none, {"a": "v"}).collect() == []


def test_readings_are_exchanged_once(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    pts = ev.select(F.col("event_type").alias("measurement"), "ts", "value")
    plan = attach_scan(ev.select("event_id", "ts"), "ts", pts, {k: k for k in ("click", "view", "error")})._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    dealt = [x for x in initial.splitlines() if "Exchange hashpartitioning(bucket" in x]
    assert len([x for x in dealt if "bucket" in x]) <= 3   # readings with points, the edges of buckets, their join
    assert "CartesianProduct" not in initial and "BroadcastNestedLoopJoin" not in initial


def test_binary_search(spark):
    bounds = [3, 3, 7, 7, 7, 20]
    df = spark.range(25).select("id", _below(bounds, F.col("id"), False).alias("lo"), _below(bounds, F.col("id"), True).alias("hi"))
    for r in df.collect():
        assert (r.lo, r.hi) == (sum(b < r.id for b in bounds), sum(b <= r.id for b in bounds))
