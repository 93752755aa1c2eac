"""User-level jobs end to end: merge -> write -> train -> replay -> stream score."""

import math

from airlens.plans import driver_queries as D
from airlens.plans.merge import merge_files, write_merged
from airlens.operators.regression import feature_label
from airlens.plans.train import load_models, train_files
from airlens.schemas import MERGED
from airlens.sources.records import read_merged
from airlens.streaming.replay import replay
from airlens.streaming.score import stream_score
from airlens.streaming.sources import decode, file_lines

SF = "/root/testdata/sf0.001"


def test_merge_train_replay_score(spark, tmp_path):
    root = D.stage_sensor_files(spark, SF)
    merged = merge_files(spark, root + "/pollution", root + "/traffic", root + "/weather")
    n = merged.count()
    assert n > 0
    out = str(tmp_path / "merged")
    write_merged(merged, out)

    pa_path, lin_path = str(tmp_path / "pa"), str(tmp_path / "linear")
    models = train_files(spark, out, 0, pa_path, lin_path)
    assert set(models) == {"pa", "linear"}
    loaded = load_models(spark, pa_path, lin_path)
    assert len(loaded["pa"].first()["w"]) == 15

    # replay the merged files as a stream of lines, then score it
    replayed = str(tmp_path / "replayed")
    replay(spark, out + "/*", str(tmp_path / "ck-replay"), sink="files", path=replayed,
           files_per_batch=None, header_field=0).awaitTermination()
    records = feature_label(decode(file_lines(spark, replayed, None), MERGED), 0)
    target = str(tmp_path / "scores")
    stream_score(records, target, str(tmp_path / "ck-score"), linear=loaded["linear"],
                 pa_weights=loaded["pa"]).awaitTermination()
    res = spark.read.parquet(target).collect()
    assert sum(r["elements"] for r in res) == n
    assert all(math.isfinite(r["rmse_pa"]) and math.isfinite(r["rmse_linear"]) for r in res)


def test_stream_jobs_from_folders(spark, tmp_path, write_files):
    from airlens.functions.predicates import Box, Period
    from airlens.plans.apps import stream_report_job, stream_score_job
    from tests.test_report import HEADER, ROWS
    src = write_files({"pollution1.csv": HEADER + ROWS}, "stream-in")
    q = stream_report_job(spark, Box(56.1, 56.2, 10.1, 10.2), Period.of("2014-08-15", "2014-09-15"),
                          "analysis_info_job", str(tmp_path / "ai"), str(tmp_path / "ck1"), folder=src)
    q.awaitTermination()
    from airlens.sinks.results import read_results
    rows = read_results(spark, "analysis_info_job", True).where("substance = 'Ozone'").collect()
    assert len(rows) == 1 and rows[0]["elements"] == 8

    root = D.stage_sensor_files(spark, SF)
    merged = merge_files(spark, root + "/pollution", root + "/traffic", root + "/weather")
    out = str(tmp_path / "merged")
    write_merged(merged, out)
    train_files(spark, out, 1, str(tmp_path / "pa"), str(tmp_path / "lin"))
    replayed = str(tmp_path / "replayed")
    replay(spark, out + "/*", str(tmp_path / "ck-r"), sink="files", path=replayed, files_per_batch=None,
           header_field=0).awaitTermination()
    stream_score_job(spark, 1, str(tmp_path / "scores"), str(tmp_path / "ck2"), linear_path=str(tmp_path / "lin"),
                     folder=replayed).awaitTermination()        # the "Spark model only" consumer
    res = spark.read.parquet(str(tmp_path / "scores")).collect()
    assert sum(r["elements"] for r in res) == merged.count() and "rmse_pa" not in res[0].asDict()


def test_train_on_flat_files_and_on_parquet(spark, tmp_path):
    root = D.stage_sensor_files(spark, SF)
    merged = merge_files(spark, root + "/pollution", root + "/traffic", root + "/weather")
    out, flat, twin = (str(tmp_path / n) for n in ("merged", "flat", "twin"))
    write_merged(merged, out)
    write_merged(merged, twin, format="parquet")
    (tmp_path / "flat").mkdir()
    for i, f in enumerate((tmp_path / "merged").glob("sensor_id=*/*.csv")):   # what a user has: merged<id>.csv
        (tmp_path / "flat" / f"{i}_merged{f.parent.name.split('=')[1]}.csv").write_text(f.read_text())
    key = ["sensor_id", "Timestamp", "Ozone", "Average_speed"]
    rows = [sorted(tuple(r) for r in df.select(*key).collect()) for df in
            (read_merged(spark, out), read_merged(spark, flat), read_merged(spark, twin, format="parquet"))]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == merged.count()
    fits = [train_files(spark, p, 0, str(tmp_path / f"pa{i}"), str(tmp_path / f"lin{i}"), format=f)["pa"].first()
            for i, (p, f) in enumerate(((out, "csv"), (flat, "csv"), (twin, "parquet")))]
    assert fits[0]["n"] == len(rows[0])
    assert fits[0]["w"] == fits[1]["w"] == fits[2]["w"]


def test_second_ingest_keeps_the_first(spark, tmp_path):
    import datetime as dt

    from airlens.plans.ingest import ingest_readings, read_ingested

    def drop(days):
        return spark.createDataFrame([(dt.datetime(2014, m, d), 56.0 + d / 100, 10.0) for m, d in days],
                                     "ts timestamp_ntz, latitude double, longitude double")
    out = str(tmp_path / "ingested")
    ingest_readings(drop([(7, d) for d in range(1, 11)]), out, batch="001")
    ingest_readings(drop([(7, 1), (8, 1)]), out, batch="002")
    assert read_ingested(spark, out).count() == 12
    ingest_readings(drop([(7, 1), (8, 1)]), out, batch="002")    # a retry replaces its own rows
    assert read_ingested(spark, out).count() == 12
    assert {r["batch"] for r in read_ingested(spark, out).select("batch").collect()} == {"001", "002"}
