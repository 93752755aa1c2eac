"""Readings as bucketed tables, so that alignment needs no exchange.

``ingest_bucketed`` writes readings once as a table whose files are cut by a hash of (sensor, day)
and sorted by sensor and time, with one file per bucket. Two tables of equal bucket counts are then aligned
bucket by bucket: numbering duplicates and joining on (sensor, day, time, position) both find their rows
where they are. A day's readings of one sensor are the largest unit, so a sensor that holds a third of
all rows still spreads over all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.align import align_on_time

DAY = "reading_day"


def ingest_bucketed(readings: DataFrame, name: str, location: str, *, entity: str = "sensor_id", ts: str = "ts", buckets: int = 64) -> None:
    """Write ``readings`` as table ``name`` at ``location``; ``buckets`` must be equal for tables to be aligned."""
    day = F.to_date(ts)
    rows = readings.withColumn(DAY, day).repartition(buckets, F.col(entity), F.col(DAY))   # the buckets' own hash: a file each
    (rows.write.mode("overwrite").format("parquet").option("path", location).bucketBy(buckets, entity, DAY).sortBy(entity, DAY, ts).saveAsTable(name))


def align_bucketed(spark: SparkSession, left: str, right: str, *, left_order: Sequence, right_order: Sequence, entity: str = "sensor_id",
                   ts: str = "ts", k: str = "_k", left_columns: Sequence[str], right_columns: Sequence[str]) -> DataFrame:
    """The rows of two bucketed tables that share entity and time, k-th with k-th (see :func:`align_on_time`).

    Without ``spark.sql.requireAllClusterKeysForCoPartition=false`` (set by ``build_session``) Spark
    exchanges both sides all the same; results do not depend on it."""
    keys = [entity, DAY, ts]
    one = spark.table(left).select(*keys, *left_columns)
    two = spark.table(right).select(*keys, *right_columns)
    return align_on_time(one, two, keys, left_order, right_order, k=k, small_groups=True).drop(DAY)
