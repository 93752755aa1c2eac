"""Streaming region report and event-time windowed profile.

``stream_region_report``: every micro-batch is filtered to the box and period
and profiled with the same single-aggregation plan as the batch report; the
rows are appended to the result table with the processing time and batch id.
An empty batch (or one empty after filtering) writes nothing.  Offsets and
progress live in the checkpoint, so a restarted query resumes without
losing or duplicating batches.

``window_profile``: the replayable event-time variant - tumbling windows on
the reading time with a watermark, same aggregates per window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import instant_as_ntz, ntz_as_instant
from ..functions.predicates import Box, Period, in_region
from ..operators.profile import profile_aggs, unpivot_profile, wide_columns
from ..plans.report import region_report
from ..schemas import POLLUTANT_LABELS, POLLUTANTS
from ..sinks.results import ResultWriter, result_rows, write_batch_files


def _trigger(writer, trigger):
    if trigger is None or trigger == "available_now":
        return writer.trigger(availableNow=True)
    if isinstance(trigger, (int, float)):
        return writer.trigger(processingTime=f"{float(trigger)} seconds")
    return writer.trigger(processingTime=str(trigger))


def start(writer, session, partitions="auto") -> StreamingQuery:
    """Start a query with its own shuffle width.

    A streaming query copies the session's SQL settings when it starts, and a
    stateful operator fixes its number of state partitions in the checkpoint
    on the first start.  ``partitions="auto"`` uses the cluster's default
    parallelism (total executor cores) for both the per-batch shuffles and the
    state store; an int sets it; ``None`` keeps the session's setting.  The
    session's own value is restored right after the start.
    """
    if partitions is None:
        return writer.start()
    n = session.sparkContext.defaultParallelism if partitions == "auto" else int(partitions)
    key = "spark.sql.shuffle.partitions"
    previous = session.conf.get(key)
    session.conf.set(key, str(n))
    try:
        return writer.start()
    finally:
        session.conf.set(key, previous)


def stream_region_report(readings: DataFrame, box: Box, period: Period, target: str, checkpoint: str, *,
                         trigger=None, attributes: Sequence[str] = POLLUTANTS,
                         labels: Sequence[str] | None = None, is_table: bool = False,
                         lat: str = "latitude", long: str = "longitude", ts: str = "ts",
                         partitions="auto", unit: str | None = None) -> StreamingQuery:
    """Start the per-batch report.  ``trigger``: seconds between batches, a
    processing-time string, or ``None`` for one pass over available data;
    ``partitions``: see :func:`start`.  ``unit``: a column of numbers (those of
    the files); every unit of a micro-batch then gets a report of its own,
    whose ``batch_id`` is the unit's number, from one aggregation."""
    if labels is None:
        labels = POLLUTANT_LABELS if list(attributes) == POLLUTANTS else list(attributes)

    sink = ResultWriter(readings.sparkSession, target, is_table)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rep = region_report(batch, box, period, attributes=attributes, labels=labels, lat=lat, long=long, ts=ts,
                            group_by=[unit] if unit else [])
        sink.write(result_rows(rep, F.col(unit) if unit else F.lit(batch_id)), batch_id)

    w = readings.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return start(_trigger(w, trigger), readings.sparkSession, partitions)


def window_profile(readings: DataFrame, box: Box, period: Period, *, every: str = "1 day",
                   watermark: str = "1 day", attributes: Sequence[str] = POLLUTANTS,
                   lat: str = "latitude", long: str = "longitude", ts: str = "ts") -> DataFrame:
    """Streaming aggregate: one wide row per window (``window_start`` plus
    ``elements`` and ``_min<i>/_max<i>/_mean<i>/_std<i>``).  Watermarks need a
    TIMESTAMP, so the NTZ reading time is mapped to the instant with the same
    UTC digits and back (no dependence on the session time zone)."""
    et = ntz_as_instant(F.col(ts))
    r = (readings.where(in_region(box, period, lat, long, ts)).withColumn("_et", et)
         .withWatermark("_et", watermark))
    return r.groupBy(F.window("_et", every).alias("w")).agg(*profile_aggs(attributes)).select(
        instant_as_ntz(F.col("w.start")).alias("window_start"), *wide_columns(len(attributes)))


def unpivot_window_profile(wide: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Wide window rows -> ``window_start, attribute, elements, min, max, mean, std``."""
    return unpivot_profile(wide, labels, ["window_start"])


def stream_window_profile(readings: DataFrame, box: Box, period: Period, target: str, checkpoint: str, *,
                          every: str = "1 day", watermark: str = "1 day", trigger=None,
                          attributes: Sequence[str] = POLLUTANTS, labels: Sequence[str] | None = None,
                          output_mode: str = "update", partitions="auto", **geo) -> StreamingQuery:
    """Keep ``target`` (parquet) up to date with the windowed profile.

    ``update`` (default): partitioned by window, each batch rewrites only the
    windows it changed.  ``append``: a window is written once, after the
    watermark passes it, as one file per batch inside day partitions, which
    suits short windows (partitions grow per day, not per window)."""
    if labels is None:
        labels = POLLUTANT_LABELS if list(attributes) == POLLUTANTS else list(attributes)
    wide = window_profile(readings, box, period, every=every, watermark=watermark, attributes=attributes, **geo)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = unpivot_window_profile(batch, labels)
        if output_mode == "append":
            # every window arrives once, after the watermark: one file per
            # batch inside day partitions (idempotent, bounded partitions)
            write_batch_files(rows.withColumn("day", F.to_date("window_start")), target, batch_id, "day")
        else:
            # update mode re-emits changed windows: each batch replaces them
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("window_start").parquet(target))

    w = wide.writeStream.outputMode(output_mode).foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return start(_trigger(w, trigger), readings.sparkSession, partitions)
