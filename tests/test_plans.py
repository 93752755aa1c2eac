"""Physical-plan properties that matter at scale."""

import datetime as dt

from pyspark.sql import functions as F

from airlens.operators.align import align_on_time
from airlens.operators.series import SeriesIndex
from airlens.plans import driver_queries as D

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_region_profile_single_exchange_and_pushdown(spark):
    plan = plan_of(D.QUERIES["region_profile"](spark, SF))
    assert plan.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(l_discount)" in plan
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_extendedprice:double,l_discount:double" in plan


def test_series_lookup_is_an_equi_join_even_when_not_broadcast(spark):
    base = dt.datetime(2024, 1, 1)
    pts = spark.createDataFrame([("m", base + dt.timedelta(minutes=10 * i), float(i)) for i in range(50)],
                                "measurement string, ts timestamp_ntz, value double")
    rows = spark.createDataFrame([(i, base + dt.timedelta(minutes=7 * i)) for i in range(60)],
                                 "id int, ts timestamp_ntz")
    for limit in (1, 10**6):          # forced shuffle path, then the broadcast path
        idx = SeriesIndex(pts, broadcast_rows=limit)
        out = idx.lookup(rows, "ts", "m", "v")
        plan = plan_of(out)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert ("SortMergeJoin" in plan) if limit == 1 else ("BroadcastHashJoin" in plan)
        assert out.where("v IS NULL").count() == 0


def test_alignment_join_reuses_window_partitioning(spark):
    ev = D.table(spark, SF, "events")
    left = ev.where("event_type = 'click'").select(F.date_trunc("hour", "ts").alias("h"),
                                                    F.col("event_id").alias("l"))
    right = ev.where("event_type = 'view'").select(F.date_trunc("hour", "ts").alias("h"),
                                                    F.col("event_id").alias("r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(align_on_time(left, right, ["h"], ["l"], ["r"], small_groups=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one hash exchange per side feeds both the window and the join
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in plan


def test_ingested_report_prunes_partitions(spark):
    df = D.QUERIES["region_profile_ingested"](spark, SF)
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(month" in plan and "month#" in plan
    assert "PushedFilters: [IsNotNull(l_discount)" in plan
    rows = {r["attribute"]: r for r in df.collect()}
    base = {r["attribute"]: r for r in D.QUERIES["region_profile"](spark, SF).collect()}
    assert rows == base
