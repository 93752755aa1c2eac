"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "airlens", driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the library assumes.

    UTC session time so that NTZ <-> TIMESTAMP casts are identities, AQE on so
    joins/aggregations re-plan on runtime sizes and skewed shuffle partitions
    get split, co-partitioned joins allowed on a subset of the join keys, and
    the UI off.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # joins on (sensor, time, position) may reuse the window's hash
          # partitioning on (sensor, time): high-cardinality keys, and groups
          # are bounded by the hot-key split of rank_within
          .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:   # local mode: the executors live in the driver JVM
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, once per application.

    Functions that run in workers refer to the package by name, so it is sent
    along as a zip file through Spark's own file distribution.
    """
    sc = spark.sparkContext
    if getattr(sc, "_airlens_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(here)
    fd, name = tempfile.mkstemp(prefix="airlens-", suffix=".zip")   # the driver's copy, which Spark serves to executors
    with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for folder, _, files in os.walk(here):
            for x in files:
                if x.endswith(".py"):
                    z.write(os.path.join(folder, x), os.path.relpath(os.path.join(folder, x), top))
    sc.addPyFile(name)
    sc._airlens_shipped = True


def cluster_settings(total_cores: int, input_tb: float = 100.0) -> dict[str, str]:
    """Settings for a large cluster (pass them to ``spark-submit --conf``).

    * input splits of 256 MB: 100 TB -> ~400k scan tasks, each well inside an
      executor core's memory share even after parsing text;
    * the initial shuffle width gives ~512 MB partitions for a shuffle as
      large as the input (capped at 200k reducers), then AQE coalesces toward
      256 MB and splits skewed partitions over 5x the median (and over 1 GB);
    * broadcast only below 64 MB as measured at run time; the library's own
      explicit broadcasts carry their own row-count checks.
    """
    shuffle = min(200_000, max(4 * total_cores, int(input_tb * 1024 * 1024 / 512)))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only in local mode,
    where driver and executors are one process, is one made when it is unset;
    on a cluster that is an error, as executors would not share the folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_spark_subdir(current) else current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="airlens-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def _is_spark_subdir(path: str) -> bool:
    # setCheckpointDir appends a random UUID directory to the configured root.
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/airlens/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in columns below the shared checkpoint folder, for several scans."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
