"""Streaming sources: record lines from a topic or from files landing in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Layout
from ..sources.records import parse_records


def file_lines(spark: SparkSession, path: str, glob: str | None = "*.csv",
               max_files_per_trigger: int | None = None, unit: str | None = None) -> DataFrame:
    """Lines of files appearing in ``path`` (oldest first), column ``value``.
    ``unit`` names a column with the number at the end of the file's name, for
    results per file that do not depend on how many files a micro-batch takes."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "false")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = r.load(path)
    if unit is None:
        return lines
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)(?:\.[^.]*)?$", 1)
    return lines.select("value", F.when(number != "", number).cast("long").alias(unit))


def files_per_trigger(spark: SparkSession, path: str, least: int = 8, batches: int = 24, most: int = 400) -> int:
    """Files to take at once from the folder ``path``, so that a pass over it costs the overhead of
    about ``batches`` micro-batches however many files there are: ``least`` files at least, and
    ``most`` at most, which bounds the rows of a micro-batch.  Only the listing is read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = len(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder))
    return max(least, min(most, -(-files // batches)))


KAFKA_PROVIDER = "org.apache.spark.sql.kafka010.KafkaSourceProvider"


def require_kafka(spark: SparkSession) -> None:
    """Fail early, with a clear message, when the Kafka connector is absent."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            KAFKA_PROVIDER, False, spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader())
    except Exception as e:  # noqa: BLE001 - py4j wraps ClassNotFoundException
        raise RuntimeError("the Spark Kafka connector (spark-sql-kafka-0-10) is not on the classpath; "
                           "add it with --packages, or use the folder source/sink") from e


def topic_lines(spark: SparkSession, bootstrap_servers: str, topic: str, **options) -> DataFrame:
    """Record values of a Kafka topic as text, column ``value``.

    Needs the Spark Kafka connector on the classpath (not bundled here).
    Offsets live in the query checkpoint, so a restart resumes where the
    last committed batch ended.
    """
    require_kafka(spark)
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def decode(lines: DataFrame, layout: Layout, bad_rows: str = "fail") -> DataFrame:
    """Typed records from a stream of lines.  Blank lines and header lines are
    dropped.  A malformed record stops the stream by default; ``bad_rows``
    ``drop`` discards such records and ``quarantine`` marks them (``_bad``,
    ``_line``), for callers who choose so."""
    keep = [c for c in lines.columns if c != "value"]
    return parse_records(lines, layout, bad_rows, keep=keep)
