"""Property tests."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airlens.functions.predicates import Box, Period
from airlens.operators.align import align_on_time
from airlens.operators.profile import profile
from airlens.operators.series import SeriesIndex
from airlens.plans.report import region_report
from airlens.schemas import POLLUTION
from airlens.sinks.results import RESULT_COLUMNS
from airlens.streaming.report import stream_region_report
from airlens.streaming.sources import decode, file_lines

BASE = dt.datetime(2024, 1, 1)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.floats(-50, 50)), min_size=2, max_size=30, unique_by=lambda p: p[0]),
       st.lists(st.integers(-50, 550), min_size=1, max_size=30))
def test_interpolation_between_neighbours(spark, points, queries):
    pts = spark.createDataFrame([("m", BASE + dt.timedelta(minutes=m), v) for m, v in points],
                                "measurement string, ts timestamp_ntz, value double")
    rows = spark.createDataFrame([(i, BASE + dt.timedelta(minutes=q)) for i, q in enumerate(queries)],
                                 "id int, ts timestamp_ntz")
    got = {r["id"]: r["v"] for r in SeriesIndex(pts).lookup(rows, "ts", "m", "v").collect()}
    srt = sorted(points)
    for i, q in enumerate(queries):
        below = [v for m, v in srt if m <= q] or [srt[0][1]]
        above = [v for m, v in srt if m >= q] or [srt[-1][1]]
        lo, hi = sorted((below[-1], above[0]))
        assert lo - 1e-9 <= got[i] <= hi + 1e-9


def test_profile_invariant_under_repartitioning(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    attrs = ["l_quantity", "l_extendedprice", "l_discount"]
    a = {r["attribute"]: r for r in profile(li.coalesce(1), attrs).collect()}
    b = {r["attribute"]: r for r in profile(li.repartition(7), attrs).collect()}
    for k in attrs:
        assert a[k]["elements"] == b[k]["elements"]
        for c in ("min", "max", "mean", "std"):
            assert a[k][c] == pytest.approx(b[k][c], rel=1e-12)


def test_hot_group_alignment_matches_brute_force(spark):
    # one key holds most rows
    left = [("hot", 1, i) for i in range(40)] + [("cold", 1, 100 + i) for i in range(3)]
    right = [("hot", 1, 1000 + i) for i in range(25)] + [("cold", 1, 2000 + i) for i in range(5)]
    ldf = spark.createDataFrame(left, "s string, t int, lp long")
    rdf = spark.createDataFrame(right, "s string, t int, rp long")
    got = sorted((r["lp"], r["rp"]) for r in align_on_time(ldf, rdf, ["s", "t"], ["lp"], ["rp"]).collect())
    want = sorted(list(zip(range(40), range(1000, 1025))) + list(zip(range(100, 103), range(2000, 2003))))
    assert got == want


def test_stream_with_one_batch_equals_batch(spark, tmp_path):
    text = """2,10,40,50,60,10.1,56.1,2014-08-15 00:00:00
4,10,41,51,61,10.2,56.2,2014-08-15 00:05:00
7,12,46,56,66,10.15,56.15,2014-08-15 00:30:00
"""
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(text)
    box, period = Box(56.1, 56.2, 10.1, 10.2), Period.of("2014-08-15", "2014-09-15")
    out = str(tmp_path / "out")
    stream_region_report(decode(file_lines(spark, str(src)), POLLUTION), box, period, out,
                         str(tmp_path / "ck")).awaitTermination()
    streamed = {r["substance"]: r for r in spark.read.parquet(out).select(*RESULT_COLUMNS).collect()}
    batch = {r["attribute"]: r for r in region_report(
        decode(spark.read.text(str(src)), POLLUTION), box, period).collect()}
    assert set(streamed) == set(batch)
    for k, r in batch.items():
        assert tuple(streamed[k][c] for c in ("elements", "min", "max", "mean", "std")) == \
               tuple(r[c] for c in ("elements", "min", "max", "mean", "std"))


def test_merged_rows_are_pollution_rows(spark):
    from airlens.plans import driver_queries as D
    from airlens.plans.merge import merge_files
    root = D.stage_sensor_files(spark, "/root/testdata/sf0.001")
    merged = merge_files(spark, root + "/pollution", root + "/traffic", root + "/weather")
    keys = Counter((r["sensor_id"], r["Timestamp"]) for r in merged.select("sensor_id", "Timestamp").collect())
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_type = 'click'")
    poll = Counter((str(r["user_id"]), r["d"]) for r in
                   ev.select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d")).collect())
    assert all(n <= poll[k] for k, n in keys.items())


def test_uneven_points_keep_index_small_and_exact(spark):
    # a dense burst, a sparse tail and one point fifty years earlier
    pts = [(-50 * 365 * 24 * 3600, 7.0)] + [(i, float(i % 13)) for i in range(0, 2000)] + \
          [(2000 + 3600 * j, float(j)) for j in range(1, 50)]
    df = spark.createDataFrame([("m", BASE + dt.timedelta(seconds=s), v) for s, v in pts],
                               "measurement string, ts timestamp_ntz, value double")
    idx = SeriesIndex(df)
    assert idx.w0["m"] == 1_000_000          # the burst forced the robust layout (shortest gap: 1 s)
    assert idx.exploded["m"] <= 9 * len(pts)
    queries = [-10**9, -5, 0, 1, 500, 1999, 2001, 2000 + 3600 * 7 + 100, 2000 + 3600 * 60]
    rows = spark.createDataFrame([(i, BASE + dt.timedelta(seconds=q)) for i, q in enumerate(queries)],
                                 "id int, ts timestamp_ntz")
    got = {r["id"]: r["v"] for r in idx.lookup(rows, "ts", "m", "v").collect()}
    srt = sorted(pts)
    for i, q in enumerate(queries):
        if q <= srt[0][0]:
            want = srt[0][1]
        elif q >= srt[-1][0]:
            want = srt[-1][1]
        else:
            s = max(p for p in srt if p[0] <= q)
            e = min(p for p in srt if p[0] >= q)
            want = s[1] if s[0] == q else ((e[0] - q) * s[1] + (q - s[0]) * e[1]) / (e[0] - s[0])
        assert got[i] == pytest.approx(want)


def test_series_index_with_one_series(spark):
    pts = spark.createDataFrame([("m", BASE + dt.timedelta(minutes=3 * i), float(i)) for i in range(200)],
                                "measurement string, ts timestamp_ntz, value double")
    idx = SeriesIndex(pts)
    rows = spark.createDataFrame([(1, BASE + dt.timedelta(minutes=301)), (2, BASE + dt.timedelta(minutes=3 * 150))],
                                 "id int, ts timestamp_ntz")
    got = {r["id"]: r["v"] for r in idx.lookup(rows, "ts", "m", "v").collect()}
    assert got[1] == pytest.approx(100 + 1 / 3) and got[2] == 150.0
