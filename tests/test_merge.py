"""Pairing, time alignment, weather lookups and the merged record (FIXTURES F2-F4)."""

import datetime as dt
import gzip
import random

import pytest
from pyspark.errors import PySparkException
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from airlens.functions.columns import to_ts
from airlens.operators.align import align_on_time, first_group, pair_first
from airlens.operators.ranking import rank_within
from airlens.operators.series import SeriesIndex
from airlens.plans.merge import merge_files, write_merged
from airlens.sources import records, small
from airlens.sources.records import read_merged, read_traffic
from airlens.sources.weather import read_weather

T = dt.datetime


def ts(s):
    return T.strptime(s, "%H:%M").replace(year=2014, month=8, day=15)


# --- weather interpolation (F3) ---------------------------------------------------
@pytest.fixture(scope="module")
def weather_index(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("weather")
    (d / "dewptm.txt").write_text(
        '{"2014-08-15T00:50:00": "16", "2014-08-15T00:20:00": "10", "2014-08-15T00:30:00": ""}\n')
    (d / "hum.txt").write_text('{"2014-08-15T00:20:00": "5"}\n')
    (d / "tempm.txt").write_text('{"2014-08-15T00:20:00": "1", "2014-08-15T00:40:00": "3"}\n'
                                 '{"2014-08-15T00:20:00": "2", "2014-08-15T00:40:00": "4"}\n')
    files = {"dewptm": "dewptm.txt", "hum": "hum.txt", "tempm": "tempm.txt"}
    return SeriesIndex(read_weather(spark, str(d), files))


@pytest.mark.parametrize("t,expected", [("00:10", 10.0), ("00:20", 10.0), ("00:25", 11.0), ("00:35", 13.0),
                                        ("00:50", 16.0), ("01:00", 16.0)])
def test_interpolation_cases(spark, weather_index, t, expected):
    q = spark.createDataFrame([(1, ts(t))], "id int, ts timestamp_ntz")
    v = weather_index.lookup(q, "ts", "dewptm", "v").first()["v"]
    assert v == pytest.approx(expected)


def test_single_point_and_empty_series(spark, weather_index):
    q = spark.createDataFrame([(1, ts("00:00")), (2, ts("03:00"))], "id int, ts timestamp_ntz")
    assert [r["v"] for r in weather_index.lookup(q, "ts", "hum", "v").orderBy("id").collect()] == [5.0, 5.0]
    assert weather_index.lookup(q, "ts", "wspdm", "v").where("v IS NOT NULL").count() == 0


def test_ties_floor_last_ceiling_first(spark, weather_index):
    # tempm has (00:20: 1, 2) and (00:40: 3, 4): ties ordered by value
    q = spark.createDataFrame([(1, ts("00:20")), (2, ts("00:30")), (3, ts("00:10")), (4, ts("00:50"))],
                              "id int, ts timestamp_ntz")
    get = lambda how: [r["v"] for r in weather_index.lookup(q, "ts", "tempm", "v", how).orderBy("id").collect()]
    assert get("interpolate") == [2.0, pytest.approx(2.5), 1.0, 4.0]   # exact->last, (2+3)/2, clamps
    assert get("backward") == [2.0, 2.0, 1.0, 4.0]
    assert get("forward") == [1.0, 3.0, 1.0, 4.0]


# --- alignment and pairing (F2) -------------------------------------------------------
def test_duplicates_pair_by_position(spark):
    left = spark.createDataFrame([("s", ts("00:05"), i, f"a{i}") for i in (1, 2, 3)],
                                 "sensor_id string, ts timestamp_ntz, lpos int, a string")
    right = spark.createDataFrame([("s", ts("00:05"), i, f"b{i}") for i in (1, 2)],
                                  "sensor_id string, ts timestamp_ntz, rpos int, b string")
    out = align_on_time(left, right, ["sensor_id", "ts"], ["lpos"], ["rpos"]).select("a", "b").collect()
    assert sorted((r["a"], r["b"]) for r in out) == [("a1", "b1"), ("a2", "b2")]


def test_first_partner_file(spark):
    traffic = spark.createDataFrame([("2", "t2.csv", 1), ("2", "t2b.csv", 2), ("3", "t3.csv", 3),
                                     ("007", "t007.csv", 4)], "sensor_id string, file_path string, v int")
    kept = sorted(r["v"] for r in first_group(traffic, "sensor_id", "file_path").collect())
    assert kept == [1, 3, 4]
    poll = spark.createDataFrame([("1", 10), ("2", 20), ("2", 21), ("7", 70)], "sensor_id string, p int")
    pairs = sorted((r["p"], r["v"]) for r in pair_first(poll, traffic, "sensor_id", "file_path").collect())
    assert pairs == [(20, 1), (21, 1)]          # '7' does not match '007'


@pytest.mark.parametrize("small", [True, False])
def test_rank_within_matches_row_number(spark, small):
    # ties in the first order column, a null key, and one key with most rows
    rows = [(None if i % 5 == 4 else "k1" if i % 4 else "k2", i * 7 % 3, i) for i in range(400)] + [("k3", 1, 1000)]
    df = spark.createDataFrame(rows, "k string, o long, id long")
    got = {r["id"]: r["rank"] for r in rank_within(df, ["k"], ["o", "id"], small_groups=small).collect()}
    w = Window.partitionBy("k").orderBy("o", "id")
    want = {r["id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=25))
def test_alignment_count_is_sum_of_min_multiplicities(spark, lrows, rrows):
    left = spark.createDataFrame([(str(s), t, i) for i, (s, t) in enumerate(lrows)], "sensor_id string, t int, lp int")
    right = spark.createDataFrame([(str(s), t, i) for i, (s, t) in enumerate(rrows)], "sensor_id string, t int, rp int")
    n = align_on_time(left, right, ["sensor_id", "t"], ["lp"], ["rp"]).count()
    from collections import Counter
    lc, rc = Counter((str(s), t) for s, t in lrows), Counter((str(s), t) for s, t in rrows)
    assert n == sum(min(c, rc[k]) for k, c in lc.items())


# --- the whole merge (F4) ------------------------------------------------------------
POLLUTION = """ozone,particulate_matter,carbon_monoxide,sulfur_dioxide,nitrogen_dioxide,longitude,latitude,timestamp
2,10,40,50,60,10.1,56.1,2014-08-15 00:00:00
4,10,41,51,61,10.2,56.2,2014-08-15 00:05:00
4,10,42,52,62,10.15,56.15,2014-08-15 00:10:00
"""
TRAFFIC = """c0,c1,speed,c3,c4,TIMESTAMP,vehicles
x,x,56,x,x,2014-08-15T00:00:00,7
x,x,57,x,x,2014-08-15T00:05:00,8
x,x,58,x,x,2014-08-15T00:05:00,9
x,x,59,x,x,2014-08-15T00:12:00,1
"""
WEATHER = '{"2014-08-15T00:20:00": "10", "2014-08-15T00:30:00": "", "2014-08-15T00:50:00": "16"}\n'


def test_merged_record_and_roundtrip(spark, write_files, tmp_path):
    p = write_files({"pollution12.csv": POLLUTION}, "pollution")
    t = write_files({"traffic12.csv": TRAFFIC, "traffic99.csv": TRAFFIC}, "traffic")
    w = write_files({"dewptm.txt": WEATHER}, "weather")
    same = {m: "dewptm.txt" for m in ("dewptm", "hum", "pressurem", "tempm", "wdird", "wspdm")}
    from airlens.plans import merge as M
    merged = M.merge(
        M.read_pollution(spark, p, entity_pattern=M.ID_PATTERN, position="_pos"),
        read_traffic(spark, t, entity_pattern=M.ID_PATTERN, with_path=True, position="_pos"),
        read_weather(spark, w, same))
    rows = merged.orderBy("Timestamp").collect()
    assert len(rows) == 2
    r = rows[0]
    assert r["sensor_id"] == "12" and r["Timestamp"] == ts("00:00")
    assert (r["Latitude"], r["Longitude"], r["Average_speed"], r["Vehicle_count"]) == (56.1, 10.1, 56.0, 7.0)
    assert [r[c] for c in ("Is_Monday", "Is_Tuesday", "Is_Wednesday", "Is_Thursday", "Is_Friday",
                           "Is_Saturday", "Is_Sunday")] == [0, 0, 0, 0, 1, 0, 0]
    assert [r[c] for c in ("Dew_point", "Humidity", "Pressure", "Temperature", "Wind_direction",
                           "Wind_speed")] == [10.0] * 6
    assert [r[c] for c in ("Ozone", "Particulate_matter", "Carbon_monoxide", "Sulfur_dioxide",
                           "Nitrogen_dioxide")] == [2.0, 10.0, 40.0, 50.0, 60.0]
    assert rows[1]["Average_speed"] == 57.0       # first of the two 00:05 traffic rows

    out = str(tmp_path / "merged")
    write_merged(merged, out)
    files = list((tmp_path / "merged" / "sensor_id=12").glob("*.csv"))
    assert files and files[0].read_text().startswith("Timestamp, Latitude, Longitude, Average_speed")
    back = read_merged(spark, out).orderBy("Timestamp").collect()
    assert [tuple(x) for x in back] == [tuple(x[c] for c in back[0].asDict()) for x in rows]


def test_merge_files_default_weather_names(spark, write_files):
    p = write_files({"pollution1.csv": POLLUTION}, "p")
    t = write_files({"traffic1.csv": TRAFFIC}, "t")
    w = write_files({f"{m}.txt": WEATHER for m in ("dewptm", "hum", "pressurem", "tempm", "wdird", "wspdm")}, "w")
    assert merge_files(spark, p, t, w).count() == 2


def test_file_without_id_pairs_with_nothing(spark, write_files):
    from airlens.plans import merge as M
    p = write_files({"pollution.csv": POLLUTION, "pollution5.csv": POLLUTION}, "p2")
    ids = {r["sensor_id"] for r in M.read_pollution(spark, p, entity_pattern=M.ID_PATTERN).collect()}
    assert ids == {None, "5"}


def test_first_traffic_file_from_listing(spark, write_files):
    p = write_files({"pollution12.csv": POLLUTION}, "p3")
    t = write_files({"traffic12.csv": TRAFFIC, "z_traffic12.csv": TRAFFIC.replace(",56,", ",99,"),
                     "b_traffic12.csv": TRAFFIC.replace(",57,", ",98,"), "trafficX.csv": TRAFFIC}, "t3")
    w = write_files({f"{m}.txt": WEATHER for m in ("dewptm", "hum", "pressurem", "tempm", "wdird", "wspdm")}, "w3")
    rows = merge_files(spark, p, t, w).orderBy("Timestamp").collect()
    assert [r["Average_speed"] for r in rows] == [56.0, 98.0]     # b_traffic12.csv: first id-12 path


def test_every_pollution_file_pairs_with_the_traffic_file(spark, write_files):
    p = write_files({"pollution12.csv": POLLUTION, "second_pollution12.csv": POLLUTION.replace("\n2,", "\n7,")}, "p4")
    t = write_files({"traffic12.csv": TRAFFIC}, "t4")
    w = write_files({f"{m}.txt": WEATHER for m in ("dewptm", "hum", "pressurem", "tempm", "wdird", "wspdm")}, "w4")
    rows = sorted((r["Timestamp"], r["Ozone"], r["Average_speed"]) for r in merge_files(spark, p, t, w).collect())
    assert rows == [(ts("00:00"), 2.0, 56.0), (ts("00:00"), 7.0, 56.0), (ts("00:05"), 4.0, 57.0), (ts("00:05"), 4.0, 57.0)]


def test_many_chosen_files_are_joined(spark, write_files, monkeypatch):
    from airlens.sources import records
    t = write_files({f"{n}traffic{i}.csv": TRAFFIC for i in range(6) for n in ("a_", "b_")}, "t5")
    few = records.read_first_files(spark, t, records.TRAFFIC, r"(\d+)\.csv", position="_pos")
    monkeypatch.setattr(records, "MAX_LISTED", 2)
    many = records.read_first_files(spark, t, records.TRAFFIC, r"(\d+)\.csv", position="_pos")
    key = ["sensor_id", "file_path", "average_speed", "ts"]
    assert sorted(map(tuple, few.select(*key).collect())) == sorted(map(tuple, many.select(*key).collect()))
    assert few.count() == 24 and all("/a_traffic" in r["file_path"] for r in few.collect())


def test_null_time_gives_null_and_keeps_row(spark, weather_index):
    q = spark.createDataFrame([(1, ts("00:25")), (2, None)], "id int, ts timestamp_ntz")
    got = {r["id"]: r["v"] for r in weather_index.lookup(q, "ts", "dewptm", "v").collect()}
    assert got == {1: pytest.approx(11.0), 2: None}


def test_merged_reader_accepts_both_separators(spark, write_files):
    from airlens.schemas import MERGED_HEADER
    row = "2014-08-15 00:00:00, 56.1, 10.1, 56, 7, 0, 0, 0, 0, 1, 0, 0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 2, 10, 40, 50, 60"
    d = write_files({"merged1.csv": ", ".join(MERGED_HEADER) + "\n" + row + "\n",
                     "merged2.csv": ",".join(MERGED_HEADER) + "\n" + row.replace(", ", ",") + "\n"}, "mixed")
    rows = read_merged(spark, d).drop("sensor_id").collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0]["Nitrogen_dioxide"] == 60.0


def test_weather_malformed_line_fails_or_is_dropped(spark, write_files):
    d = write_files({"dewptm.txt": WEATHER + "\n" + '{"2014-08-15T01:00:00": "3"\n'}, "badweather")
    with pytest.raises(PySparkException, match="MALFORMED_RECORD|Malformed"):
        read_weather(spark, d, {"dewptm": "dewptm.txt"}).collect()
    ok = read_weather(spark, d, {"dewptm": "dewptm.txt"}, mode="drop").collect()
    assert sorted(r["value"] for r in ok) == [10.0, 16.0]


def test_merged_csv_is_written_by_the_tasks(spark, tmp_path):
    """Sensor folders as before, also for ids that a path cannot hold; the modes of Spark's writers."""
    import os

    from airlens.schemas import MERGED_HEADER
    names = [n for n in MERGED_HEADER if n != "Timestamp"]
    schema = "sensor_id string, Timestamp timestamp_ntz, " + ", ".join(f"{n} {'int' if n.endswith('day') else 'double'}" for n in names)
    value = lambda i, n: None if n == "Ozone" else 1 if n.endswith("day") else i + 1e10
    rows = spark.createDataFrame([(s, ts(f"00:{i:02d}"), *[value(i, n) for n in names]) for s in ("007", "a/b", None) for i in (2, 1)], schema)
    out = str(tmp_path / "merged")
    for _ in range(2):
        write_merged(rows, out)      # overwritten, not added to
    assert sorted(n for n in os.listdir(out) if n.startswith("sensor")) == ["sensor_id=007", "sensor_id=__HIVE_DEFAULT_PARTITION__", "sensor_id=a%2Fb"]
    (part,) = os.listdir(f"{out}/sensor_id=007")
    assert part.startswith("part-") and part.endswith(".csv") and not os.path.exists(f"{out}/sensor_id=007/.{part}.crc")
    lines = open(f"{out}/sensor_id=007/{part}").read().splitlines()
    spark_written = str(tmp_path / "spark")
    (rows.where("sensor_id = '007'").coalesce(1).sortWithinPartitions("Timestamp").drop("sensor_id").write.option("header", True)
     .option("sep", ", ").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(spark_written))
    (theirs,) = [n for n in os.listdir(spark_written) if n.startswith("part-")]
    assert lines == open(f"{spark_written}/{theirs}").read().splitlines()
    write_merged(rows, out, mode="append")
    assert len(os.listdir(f"{out}/sensor_id=007")) == 2
    write_merged(rows, out, mode="ignore")
    with pytest.raises(FileExistsError):
        write_merged(rows, out, mode="error")


def test_many_series_exchange_the_rows_once(spark):
    """Beyond the broadcast limit all series are scanned together; values are those of the lookups."""
    pts = spark.createDataFrame([(s, ts(f"{h:02d}:{m:02d}"), float(h * m + len(s))) for s in ("a", "bb", "ccc") for h in range(0, 24, 2) for m in (0, 0, 7, 31)],
                                "measurement string, ts timestamp_ntz, value double")
    rows = spark.createDataFrame([(i, None if i % 29 == 0 else ts(f"{i % 24:02d}:{i % 60:02d}")) for i in range(300)], "id int, ts timestamp_ntz")
    columns = {"a": "va", "bb": "vb", "ccc": "vc", "none": "vn"}
    small, large = SeriesIndex(pts), SeriesIndex(pts, broadcast_rows=1)
    for how in ("interpolate", "backward", "forward"):
        got, expected = large.attach(rows, "ts", columns, how), small.attach(rows, "ts", columns, how)
        assert got.columns == expected.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate explode") == 0      # no row is multiplied by bucket levels


# --- folders of very many small files ---------------------------------------------------
def test_many_small_files_are_read_once_by_few_tasks(spark, tmp_path):
    # a folder per sensor, as write_merged makes them: one scan of a file each took a task per folder to list
    line = "2014-08-15 00:00:00, 56.1, 10.1, 1, 2, 0, 0, 0, 0, 1, 0, 0, " + ", ".join("3" for _ in range(10)) + ", {}\n"
    for i in range(1100):
        d = tmp_path / "merged" / f"sensor_id={i:04d}"
        d.mkdir(parents=True)
        (d / "part-0.csv").write_text("Timestamp, Latitude\n" + line.format(i))
        (d / "_left").write_text("no record")
    back = read_merged(spark, str(tmp_path / "merged"))
    assert len(back.inputFiles()) < 100
    assert sorted((r["sensor_id"], r["Nitrogen_dioxide"]) for r in back.collect()) == [(f"{i:04d}", float(i)) for i in range(1100)]
    (tmp_path / "merged" / "sensor_id=0000" / "more.csv").write_text("\n")
    with gzip.open(tmp_path / "merged" / "sensor_id=0000" / "z.csv.gz", "wt") as f:   # Spark's reader knows it
        f.write(line.format(5000))
    assert read_merged(spark, str(tmp_path / "merged")).where("Nitrogen_dioxide = 5000").count() == 1


def test_small_files_give_the_rows_of_sparks_reader(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    for kind, fields in (("pollution", "{0},2,3,4,5,10.1,56.1,2014-08-15 00:0{1}:00"), ("traffic", "x,x,{0},x,x,2014-08-15T00:0{1}:00,7")):
        (tmp_path / kind).mkdir()
        for i in range(60):
            ends, name = rng.choice(["\n", "\r\n", "\r"]), f"{kind} {'%#' if i % 7 else 'b'}{i // 2 if kind == 'traffic' else i}{'b' if i % 2 and kind == 'traffic' else ''}"
            lines = ["a,b,c,d,e,TIMESTAMP,g,timestamp"] + [fields.format(rng.randrange(99), rng.randrange(4)) for _ in range(rng.randrange(6))] + ["", " "]
            text = ends.join(lines) + rng.choice(["", ends])
            (tmp_path / kind / f"{name}.csv").write_bytes((b"\xef\xbb\xbf" if i % 5 == 0 else b"") + text.encode())
        (tmp_path / kind / "_hidden1.csv").write_text("no record")
        (tmp_path / kind / "other1.txt").write_text("no record")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "dewptm.txt").write_text(WEATHER)
    same = {m: "dewptm.txt" for m in ("dewptm", "hum", "pressurem", "tempm", "wdird", "wspdm")}

    def rows():
        pollution = records.read_pollution(spark, str(tmp_path / "pollution"), entity_pattern=r"(\d+)\.csv", with_path=True)
        traffic = records.read_first_files(spark, str(tmp_path / "traffic"), records.TRAFFIC, r"(\d+)b?\.csv")
        merged = merge_files(spark, str(tmp_path / "pollution"), str(tmp_path / "traffic"), str(tmp_path / "w"), same)
        return [sorted(map(repr, df.collect())) for df in (pollution, traffic, merged)]

    want = rows()
    monkeypatch.setattr(small, "MANY_FILES", 1)
    assert small.list_small(spark, str(tmp_path / "pollution"), "*.csv") is not None
    assert rows() == want and all(want)


@pytest.mark.parametrize("text", ["2014-02-28 23:59:59", "2014-02-30 00:00:00", "2014-02-28 24:00:00", "2014-02-28 00:00:60", "2014-2-28 00:00:00", "0000-01-01 00:00:00",
                                  "2014-02-28T00:00:00", "2014-02-28 00:00:00\n", "2014-02-28 00:00:00.5", "", None])
def test_times_by_cast_are_those_of_the_pattern(spark, text):
    df = spark.createDataFrame([(text,)], "t string").repartition(1)
    fmt = "yyyy-MM-dd HH:mm:ss"
    valid = F.try_to_timestamp("t", F.lit(fmt)).isNotNull()
    want = df.select(F.when(valid, F.to_timestamp_ntz("t", F.lit(fmt))).cast("string")).first()[0]
    assert df.select(to_ts("t", fmt, "try").cast("string")).first()[0] == want
