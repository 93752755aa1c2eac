"""Replay a folder of record files as a stream of lines.

Lines are trimmed; blank lines and header lines (the word ``timestamp`` in
the tested field) are dropped; each remaining line becomes one message.
Files are taken oldest first, ``files_per_batch`` at a time, so the replay
paces itself; the sink is a folder of text files or a Kafka topic (UTF-8
value, no key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import field_at, is_blank, is_header
from .report import _trigger, start
from .sources import file_lines, require_kafka


def replay_lines(lines: DataFrame, header_field: int = -1, sep: str = ",") -> DataFrame:
    """Cleaned message text, column ``value``."""
    v = F.trim(F.col("value"))
    parts = F.split(v, sep)
    return (lines.select(v.alias("value"))
            .where(~is_blank(F.col("value")))
            .where(~F.coalesce(is_header(field_at(parts, header_field, strict=False)), F.lit(False))))


def replay(spark: SparkSession, source: str, checkpoint: str, *, sink: str = "files", path: str | None = None,
           bootstrap_servers: str | None = None, topic: str | None = None, glob: str = "*.csv",
           files_per_batch: int | None = 1, header_field: int = -1, trigger=None,
           partitions="auto") -> StreamingQuery:
    """Start the replay into ``path`` (text files) or a Kafka ``topic``."""
    msgs = replay_lines(file_lines(spark, source, glob, files_per_batch), header_field)
    if sink == "files":
        if not path:
            raise ValueError("path is required for the files sink")
        w = msgs.writeStream.format("text").option("path", path)
    elif sink == "kafka":
        if not (bootstrap_servers and topic):
            raise ValueError("bootstrap_servers and topic are required for the kafka sink")
        require_kafka(spark)
        w = (msgs.select(F.encode("value", "UTF-8").alias("value")).writeStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic))
    else:
        raise ValueError("sink must be 'files' or 'kafka'")
    return start(_trigger(w.option("checkpointLocation", checkpoint), trigger), spark, partitions)
