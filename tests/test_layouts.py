"""Files on a curve, the order audit, the keyed table and the timed replay."""

import datetime as dt
import glob
import random
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from airlens.functions.predicates import Box, Period
from airlens.operators.audit import order_audit
from airlens.plans.ingest import curve_key, ingest_on_curve, ingest_readings, read_ingested, region_report_ingested
from airlens.plans.report import region_report
from airlens.session import scratch_path
from airlens.sinks.keyed import compact, create_keyed_table, upsert
from airlens.sources.records import read_pollution
from airlens.streaming.timed import BATCH, replay_timed

DAY = dt.datetime(2014, 8, 1)


# --- files on a space-filling curve ----------------------------------------------
def files(root):
    return glob.glob(f"{root.removeprefix('file:')}/month=*/batch=*/*.parquet")


def overlapping(root, box):
    """Files whose statistics do not keep them away from the box."""
    n = 0
    for f in files(root):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            s = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(meta.num_columns)}
            if s["latitude"].min <= box.max_lat and s["latitude"].max >= box.min_lat and s["longitude"].min <= box.max_long and s["longitude"].max >= box.min_long:
                n += 1
                break
    return n


def test_a_box_opens_few_files_of_the_curve(spark):
    rng = random.Random(8)
    rows = spark.createDataFrame([(DAY + dt.timedelta(minutes=i), rng.gauss(56.2, 0.2), rng.uniform(10, 11), float(i)) for i in range(4000)],
                                 "ts timestamp_ntz, latitude double, longitude double, a double").repartition(3)
    box, period = Box(56.1, 56.15, 10.4, 10.5), Period.of("2014-08-01", "2014-09-01")
    reports, opened = [], []
    for ingest, more in ((ingest_readings, {"cell": 0.01}), (ingest_on_curve, {"files": 16})):
        out = scratch_path(spark, "layout")
        ingest(rows, out, **more)
        read = read_ingested(spark, out)
        assert read.count() == 4000
        reports.append(sorted(map(tuple, region_report_ingested(read, box, period, attributes=["a"]).collect())))
        opened.append((overlapping(out, box), len(files(out))))
    want = sorted(map(tuple, region_report(rows, box, period, attributes=["a"]).collect()))
    for got in reports:
        assert got[0][:4] == want[0][:4] and got[0][4:] == pytest.approx(want[0][4:])
    assert opened[0][0] == opened[0][1]        # dealt by a hash of the cell, every file may hold the box
    assert opened[1][1] >= 8 and opened[1][0] <= opened[1][1] // 4


def test_curve_key_interleaves_bits(spark):
    df = spark.createDataFrame([(float(i), float(j)) for i in range(4) for j in range(4)], "i double, j double")
    got = {(r.i, r.j): r.k for r in df.select("i", "j", curve_key(F.col("i"), F.col("j"), [1.0, 2.0, 3.0], [1.0, 2.0, 3.0], 2).alias("k")).collect()}
    assert [got[p] for p in ((0, 0), (0, 1), (1, 0), (1, 1), (0, 2), (2, 0), (3, 3))] == [0, 1, 2, 3, 4, 8, 15]


# --- order audit ----------------------------------------------------------------
def test_audit_over_blocks_of_a_file(spark, write_files):
    rng = random.Random(9)
    files, want = {}, {}
    for name in ("a1.csv", "a2.csv", "a3.csv"):
        times = [DAY + dt.timedelta(minutes=5 * i) for i in range(3000)]
        if name != "a1.csv":
            for i in rng.sample(range(3000), 40 if name == "a2.csv" else 1500):
                times[i] += dt.timedelta(minutes=rng.randint(-60, 60))
        files[name] = "ozone,pm,co,so2,no2,longitude,latitude,timestamp\n" + "\n".join(f"1,2,3,4,5,10.1,56.1,{t}" for t in times) + "\n"
        want[name] = (3000, sum(b < a for a, b in zip(times, times[1:])))
    path = write_files(files, "audit")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")   # many blocks a file
    try:
        readings = read_pollution(spark, path, with_path=True, position="_pos")
        assert readings.select("_pos.block").distinct().count() > 3
        got = {r.file_path.rsplit("/", 1)[1]: (r.readings, r.out_of_order) for r in order_audit(readings).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want and want["a1.csv"][1] == 0
    assert order_audit(readings.where("ozone > 5")).collect() == []


# --- the keyed table ------------------------------------------------------------
KEYED = "substance string, timestamp timestamp_ntz, mean double"


def keyed(spark):
    path = scratch_path(spark, "keyed")
    name = "keyed_" + uuid.uuid4().hex[:8]
    create_keyed_table(spark, name, "substance STRING, timestamp TIMESTAMP_NTZ, mean DOUBLE", path)
    return name


def content(spark, name):
    spark.catalog.refreshTable(name)
    return {(r.substance, r.timestamp): (r.mean, r.write_id) for r in spark.table(name).collect()}


def writes(spark):
    for w in range(3):
        rows = [("Ozone" if i % 2 else "PM", DAY + dt.timedelta(hours=6 * i + w * 12), float(100 * w + i)) for i in range(8)]
        yield w, rows, spark.createDataFrame(rows, KEYED)


def test_last_write_of_a_key_wins(spark):
    name, want = keyed(spark), {}
    for w, rows, df in writes(spark):
        upsert(df, name, w)
        want |= {(s, t): (m, w) for s, t, m in rows}
        assert content(spark, name) == want
        assert spark.table(name).count() == len(want)
    upsert(spark.createDataFrame([("PM", DAY, -1.0)], KEYED), name, -5)   # an older write does not undo a newer one
    assert content(spark, name) == want
    compact(spark, name, [DAY.date()])
    assert content(spark, name) == want
    assert upsert(spark.createDataFrame([], KEYED), name, 9) == []


@pytest.mark.parametrize("stop", [0, 1, 2])
def test_a_kill_between_swaps_loses_and_doubles_nothing(spark, stop):
    name, want = keyed(spark), {}

    class Killed(Exception):
        pass

    for w, rows, df in writes(spark):
        before = content(spark, name)
        seen = []

        def kill(day):
            if len(seen) == stop:
                raise Killed
            seen.append(day)

        try:
            upsert(df, name, w, before_swap=kill)
        except Killed:
            new = {(s, t): (m, w) for s, t, m in rows}
            for key, value in content(spark, name).items():   # every day is wholly old or wholly new
                assert value == ((before | new) if key[1].date() in seen else before)[key]
            upsert(df, name, w)
        want |= {(s, t): (m, w) for s, t, m in rows}
        assert content(spark, name) == want


# --- timed replay ----------------------------------------------------------------
def test_timed_replay_keeps_time_order_and_goes_on_after_a_stop(spark):
    rng = random.Random(10)
    rows = [(DAY + dt.timedelta(seconds=rng.randrange(10_000)), f"line {i}") for i in range(500)] + [(None, "no time")]
    messages = spark.createDataFrame(rows, "ts timestamp_ntz, value string").repartition(6)
    path, checkpoint, waited = scratch_path(spark, "out"), scratch_path(spark, "ck"), []

    def wait(seconds):
        waited.append(seconds)
        if len(waited) == 3:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        replay_timed(messages, path, checkpoint, batches=5, speed_up=100.0, wait=wait)
    assert replay_timed(messages, path, checkpoint, batches=5) == [3, 4]
    assert replay_timed(messages, path, checkpoint, batches=5) == []
    time_of = {v: t for t, v in rows}
    batches = {}
    for r in spark.read.text(path).collect():
        batches.setdefault(r[BATCH], []).append(time_of[r.value])
    assert sum(map(len, batches.values())) == 500 and len(batches) == 5
    for k in range(4):
        assert max(batches[k]) <= min(batches[k + 1])
    starts = [min(batches[k]) for k in range(4)]
    assert waited == pytest.approx([(b - a).total_seconds() / 100 for a, b in zip(starts, starts[1:])])


def test_named_files_come_from_the_tasks(spark, tmp_path):
    """No folder per file to be renamed by the driver; missing idents get a file that names no sensor."""
    import os

    from pyspark.sql import functions as F

    from airlens.plans.staging import stage_named_files
    rows = spark.createDataFrame([(i, None if i % 50 == 7 else str(i % 40), f"v{i}") for i in range(400)], "i long, s string, v string")
    root = stage_named_files(spark, rows, [F.col("v"), F.col("i")], "v,timestamp", "i", F.col("s"), "t", "named", root=str(tmp_path / "named"))
    names = sorted(n for n in os.listdir(root) if not n.startswith("."))
    assert names == sorted([f"t{k}.csv" for k in range(40)] + ["t__HIVE_DEFAULT_PARTITION__.csv"])
    for k in (0, 13, 39):
        mine = [i for i in range(400) if i % 40 == k and i % 50 != 7]
        assert (tmp_path / "named" / f"t{k}.csv").read_text() == "v,timestamp\n" + "".join(f"v{i},{i}\n" for i in mine)
    assert not [d for d in os.listdir(tmp_path) if d != "named"]


def test_staged_files_grow_in_number_not_in_rows(spark, monkeypatch):
    from airlens.plans import staging
    monkeypatch.setattr(staging, "ROWS_PER_FILE", 100)
    assert [staging.files_for(spark.range(n), 3) for n in (0, 250, 301, 1000)] == [3, 3, 4, 10]
