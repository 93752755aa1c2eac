"""Region report over pollution files (FIXTURES F1)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from airlens.functions.predicates import Box, Period
from airlens.plans.report import region_report, report_lines
from airlens.sources.records import read_pollution

HEADER = "ozone,particulate_matter,carbon_monoxide,sulfur_dioxide,nitrogen_dioxide,longitude,latitude,timestamp\n"
ROWS = """2,10,40,50,60,10.1,56.1,2014-08-15 00:00:00
4,10,41,51,61,10.2,56.2,2014-08-15 00:05:00
4,10,42,52,62,10.15,56.15,2014-08-15 00:10:00
4,10,43,53,63,10.15,56.15,2014-08-15 00:15:00
5,10,44,54,64,10.15,56.15,2014-08-15 00:20:00
5,10,45,55,65,10.15,56.15,2014-08-15 00:25:00
7,10,46,56,66,10.15,56.15,2014-08-15 00:30:00
9,10,47,57,67,10.15,56.15,2014-09-15 00:00:00
99,10,48,58,68,10.15,56.15,2014-09-15 00:05:00
99,10,48,58,68,10.25,56.15,2014-08-15 00:40:00
"""
BOX = Box(56.1, 56.2, 10.1, 10.2)
PERIOD = Period.of("2014-08-15", "2014-09-15")


def report(spark, path, **kw):
    return {r["attribute"]: r for r in region_report(read_pollution(spark, path, **kw), BOX, PERIOD).collect()}


def test_inclusive_bounds_and_population_std(spark, write_files):
    rep = report(spark, write_files({"pollution1.csv": HEADER + ROWS}))
    assert set(rep) == {"Ozone", "Particulate matter", "Carbon monoxide", "Sulfur dioxide", "Nitrogen dioxide"}
    o = rep["Ozone"]
    assert o["elements"] == 8
    assert (o["min"], o["max"], o["mean"]) == (2.0, 9.0, 5.0)
    assert o["std"] == pytest.approx(2.0)          # population, not sample (2.138)
    assert rep["Particulate matter"]["std"] == 0.0


def test_headers_anywhere_blank_lines_and_padding(spark, write_files):
    lines = ROWS.splitlines()
    text = "\n".join(lines[:3] + ["", HEADER.strip(), "   "] + [" 4 , 10,43,53,63,10.15,56.15,2014-08-15 00:15:00"]
                     + lines[4:]) + "\n"
    path = write_files({"pollution1.csv": text, "pollution2.csv": "", "pollution3.csv": HEADER,
                        "notes.txt": "not,a,record\n"})
    assert report(spark, path)["Ozone"]["elements"] == 8


def test_one_row_std_zero_and_empty_inputs(spark, write_files):
    one = write_files({"p.csv": ROWS.splitlines()[2] + "\n"}, "one")
    rep = report(spark, one)
    assert rep["Ozone"]["elements"] == 1 and rep["Ozone"]["std"] == 0.0
    assert report(spark, write_files({"p.csv": HEADER}, "hdr")) == {}
    assert report(spark, write_files({"p.csv": ""}, "zero")) == {}


def test_impossible_box_gives_no_rows(spark, write_files):
    df = read_pollution(spark, write_files({"p.csv": HEADER + ROWS}))
    assert region_report(df, Box(0, 1, 0, 1), PERIOD).count() == 0


def test_bad_rows_modes(spark, write_files):
    path = write_files({"p.csv": HEADER + ROWS + "x,10,40,50,60,10.1,56.1,2014-08-15 00:00:00\n"})
    with pytest.raises((PySparkException, CapturedException, Exception)):
        read_pollution(spark, path).collect()
    assert report(spark, path, bad_rows="drop")["Ozone"]["elements"] == 8
    q = read_pollution(spark, path, bad_rows="quarantine")
    bad = q.where("_bad").collect()
    assert len(bad) == 1 and bad[0]["_line"].startswith("x,")


def test_report_lines(spark, write_files):
    df = read_pollution(spark, write_files({"p.csv": HEADER + ROWS}))
    lines = {(r["attribute"], r["kind"]): r["line"] for r in report_lines(region_report(df, BOX, PERIOD)).collect()}
    assert lines[(None, "count")] == "Total number of elements: 8."
    assert sum(1 for k in lines if k[1] == "count") == 1
    assert lines[("Ozone", "range")] == "Ozone range: [2.0, 9.0]."
    assert lines[("Ozone", "std")] == "Ozone standard deviation: 2.0."
    none = region_report(df, Box(1.0, 2.0, 10.1, 10.2), PERIOD)
    assert sorted((r["kind"], r["line"]) for r in report_lines(none).collect()) == [
        ("count", "Total number of elements: 0."), ("empty", "There are no elements so no further analysis can be made.")]


def test_profile_is_one_aggregation(spark, write_files):
    df = read_pollution(spark, write_files({"p.csv": HEADER + ROWS}))
    plan = region_report(df, BOX, PERIOD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1


def test_short_record_fails_even_without_ansi(spark, write_files):
    path = write_files({"p.csv": HEADER + ROWS + "1,2,2014-08-15 00:00:00\n"}, "short")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="fewer than 8 fields"):
            read_pollution(spark, path).collect()
        assert report(spark, path, bad_rows="drop")["Ozone"]["elements"] == 8
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_ingested_layout_gives_the_same_report(spark, write_files, tmp_path):
    from airlens.plans.ingest import ingest_readings, read_ingested, region_report_ingested
    df = read_pollution(spark, write_files({"p.csv": HEADER + ROWS}, "ing"))
    out = str(tmp_path / "ingested")
    ingest_readings(df, out)
    months = sorted(p.name for p in (tmp_path / "ingested").glob("month=*"))
    assert months == ["month=2014-08-01", "month=2014-09-01"]
    got = {r["attribute"]: r for r in region_report_ingested(read_ingested(spark, out), BOX, PERIOD).collect()}
    want = {r["attribute"]: r for r in region_report(df, BOX, PERIOD).collect()}
    assert set(got) == set(want)
    for k, w in want.items():   # same rows; sums may run in another order, so floats to 1e-12
        assert got[k]["elements"] == w["elements"]
        assert [got[k][c] for c in ("min", "max", "mean", "std")] == \
               pytest.approx([w[c] for c in ("min", "max", "mean", "std")], rel=1e-12)
