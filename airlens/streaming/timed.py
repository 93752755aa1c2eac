"""Replay in the order of event time, at a stated speed-up.

All files' records are cut by quantiles of their event time into batches, written once in folders by
batch, and emitted batch by batch in time order: no record of a batch is later than any of the next
batch. Between two batches the replay waits for the time that passed between their first events, divided
by the speed-up. A batch that was emitted whole is marked by its folder's success file, so a replay that is
started again with the same checkpoint goes on behind it and replaces the batch that was cut off.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import micros_between
from ..operators.scan import _below, time_bounds

_EPOCH = "1970-01-01 00:00:00"
BATCH = "replay_batch"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cut_by_time(messages: DataFrame, out: str, batches: int, ts: str = "ts", value: str = "value") -> None:
    """Write ``messages`` (``ts``, ``value``) under ``out/replay_batch=<k>/``, sorted by time, k in time order."""
    t = micros_between(F.lit(_EPOCH).cast("timestamp_ntz"), F.col(ts))
    bounds = time_bounds(messages.select(t.alias("t")), batches)
    rows = messages.where(F.col(ts).isNotNull()).select(_below(bounds, t, False).alias(BATCH), F.col(ts).alias("ts"), F.col(value).alias("value"))
    rows.repartitionByRange(BATCH, "ts").sortWithinPartitions(BATCH, "ts").write.mode("overwrite").partitionBy(BATCH).parquet(out)


def replay_timed(messages: DataFrame, path: str, checkpoint: str, *, batches: int, speed_up: float | None = None,
                 ts: str = "ts", value: str = "value", wait=time.sleep) -> list[int]:
    """Emit ``messages`` as text under ``path/replay_batch=<k>/`` in time order and return the batches emitted now.

    ``speed_up``: event seconds per second (``None``: no waiting); ``wait``: called with the seconds to wait."""
    spark = messages.sparkSession
    cut = f"{checkpoint.rstrip('/')}/cut"
    if not _exists(spark, f"{cut}/_SUCCESS"):
        cut_by_time(messages, cut, batches, ts, value)
    held = spark.read.parquet(cut)
    starts = {r[BATCH]: r["s"] for r in held.groupBy(BATCH).agg(F.min("ts").alias("s")).collect()}   # one row per batch
    done, last = [], None
    for k in sorted(starts):
        if speed_up and last is not None:
            wait(max(0.0, (starts[k] - last).total_seconds() / speed_up))
        last = starts[k]
        target = f"{path.rstrip('/')}/{BATCH}={k}"
        if _exists(spark, f"{target}/_SUCCESS"):
            continue
        # the part files' names are in order of time
        held.where(F.col(BATCH) == k).repartitionByRange(F.col("ts")).sortWithinPartitions("ts").select("value").write.mode("overwrite").text(target)
        done.append(k)
    return done
