"""The stream jobs with the arguments their users pass.

``stream_report_job``: lines from a folder or a topic -> pollution records ->
region report per micro-batch -> result table.  ``stream_score_job``: merged
lines -> features and target ``k`` -> both saved models -> per-batch RMSE
(and optionally the per-row comparison).  Both return the running
``StreamingQuery``; ``interval`` is the trigger in seconds (``None`` processes
what is available and stops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.predicates import Box, Period
from ..operators.regression import feature_label
from ..schemas import MERGED, POLLUTION
from ..sinks.results import create_result_table
from ..streaming.report import _trigger, stream_region_report
from ..streaming.score import stream_score
from ..streaming.sources import decode, file_lines, topic_lines
from .train import load_models


def _lines(spark: SparkSession, source: str, *, folder: str | None, bootstrap_servers: str | None,
           topic: str | None, files_per_batch: int | None, source_options: dict | None = None) -> DataFrame:
    if source == "files":
        if not folder:
            raise ValueError("folder is required for the files source")
        return file_lines(spark, folder, None, files_per_batch)
    if source == "kafka":
        if not (bootstrap_servers and topic):
            raise ValueError("bootstrap_servers and topic are required for the kafka source")
        return topic_lines(spark, bootstrap_servers, topic, **(source_options or {}))
    raise ValueError("source must be 'files' or 'kafka'")


def _records(lines: DataFrame, layout, bad_rows: str, quarantine: str | None, checkpoint: str, interval):
    """Good records, and the query that keeps the bad ones (``bad_rows="quarantine"``) as text in a folder."""
    if bad_rows != "quarantine":
        return decode(lines, layout, bad_rows), None
    if not quarantine:
        raise ValueError("bad_rows='quarantine' needs a quarantine folder")
    marked = decode(lines, layout, "quarantine")
    bad = marked.where("_bad").select(F.col("_line").alias("value")).writeStream.format("text")
    side = _trigger(bad.option("checkpointLocation", checkpoint.rstrip("/") + "-quarantine"), interval).start(quarantine)
    return marked.where("not _bad").drop("_bad", "_line"), side


def stream_report_job(spark: SparkSession, box: Box, period: Period, table: str, table_location: str,
                      checkpoint: str, *, source: str = "files", folder: str | None = None,
                      bootstrap_servers: str | None = None, topic: str | None = None, interval=None,
                      files_per_batch: int | None = None, bad_rows: str = "fail", quarantine: str | None = None,
                      source_options: dict | None = None) -> StreamingQuery:
    """Create the result table if needed and start the per-batch report.

    ``bad_rows``: ``fail`` (default), ``drop``, or ``quarantine``: a second
    query writes the bad lines to the folder ``quarantine``.
    ``source_options`` go to the topic source (offsets, rate)."""
    create_result_table(spark, table, table_location)
    lines = _lines(spark, source, folder=folder, bootstrap_servers=bootstrap_servers, topic=topic,
                   files_per_batch=files_per_batch, source_options=source_options)
    records, _ = _records(lines, POLLUTION, bad_rows, quarantine, checkpoint, interval)
    return stream_region_report(records, box, period, table, checkpoint, trigger=interval, is_table=True)


def stream_score_job(spark: SparkSession, k, target: str, checkpoint: str, *, pa_path: str | None = None,
                     linear_path: str | None = None, source: str = "files", folder: str | None = None,
                     bootstrap_servers: str | None = None, topic: str | None = None, interval=None,
                     files_per_batch: int | None = None, rows_target: str | None = None, bad_rows: str = "fail",
                     quarantine: str | None = None, source_options: dict | None = None) -> StreamingQuery:
    """Score merged records with the saved models (either may be omitted).
    ``bad_rows``, ``quarantine``, ``source_options``: see :func:`stream_report_job`."""
    models = load_models(spark, pa_path, linear_path)
    lines = _lines(spark, source, folder=folder, bootstrap_servers=bootstrap_servers, topic=topic,
                   files_per_batch=files_per_batch, source_options=source_options)
    decoded, _ = _records(lines, MERGED, bad_rows, quarantine, checkpoint, interval)
    records = feature_label(decoded, k)
    return stream_score(records, target, checkpoint, linear=models.get("linear"), pa_weights=models.get("pa"),
                        rows_target=rows_target, trigger=interval)
