"""The analysis result table: one row per substance per non-empty batch.

Layout: ``<location>/batch_block=<batch_id // BLOCK>/batch-<batch_id>.parquet``.

* Each batch writes exactly one file named by its id; a batch retried after a
  failure replaces that file and never duplicates rows.
* The catalog partitions by ``batch_block`` only, so partitions grow
  ``BLOCK`` times slower than batches (one per batch would mean millions of
  partitions a year at 5-second triggers).
* Where files of a micro-batch are reported one by one, ``batch_id`` is the
  number of the file; the file name and the block stay those of the micro-batch.
* ``substance`` is a data column: result rows are tiny, and a substance filter
  still reaches the parquet scan.  Newest first is an ordinary sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import rank_within

BLOCK = 10_000
RESULT_COLUMNS = ["timestamp", "elements", "min", "max", "mean", "std", "substance", "batch_id"]
RESULT_DDL = ("timestamp TIMESTAMP, elements BIGINT, min DOUBLE, max DOUBLE, mean DOUBLE, std DOUBLE, "
              "substance STRING, batch_id BIGINT, batch_block BIGINT")


def create_result_table(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({RESULT_DDL}) USING parquet "
              f"PARTITIONED BY (batch_block) LOCATION '{location}'")


def drop_result_table(spark: SparkSession, name: str) -> None:
    """Drops the table definition (the data folder is external and stays)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def result_rows(profile: DataFrame, batch_id: int | Column) -> DataFrame:
    """Profile rows -> result rows stamped with the processing time."""
    return profile.select(F.current_timestamp().alias("timestamp"), F.col("elements").cast("long"),
                          "min", "max", "mean", "std", F.col("attribute").alias("substance"),
                          (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast("long").alias("batch_id"))


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


class ResultWriter:
    """Idempotent append of batches to a table name or a folder.

    One write job per batch; its single file lands at
    ``batch_block=<id // BLOCK>/batch-<id>.parquet``, replacing the file of an
    earlier attempt of the same batch (see :func:`write_batch_files`).  A
    table's location is looked up once, and its partition is registered only
    when a batch opens a new block; readers refresh (:func:`read_results`).
    """

    def __init__(self, spark: SparkSession, target: str, is_table: bool = False):
        self.target, self.is_table, self.block = target, is_table, None
        self.root = (table_location(spark, target) if is_table else target).rstrip("/")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        block = batch_id // BLOCK
        tagged = rows.select(*RESULT_COLUMNS).withColumn("batch_block", F.lit(block).cast("long"))
        write_batch_files(tagged, self.root, batch_id, "batch_block")
        if self.is_table and block != self.block:
            rows.sparkSession.sql(f"ALTER TABLE {self.target} ADD IF NOT EXISTS PARTITION (batch_block = {block})")
        self.block = block


def write_results(rows: DataFrame, target: str, is_table: bool = False, batch_id: int | None = None) -> None:
    """Append one batch (see :class:`ResultWriter`)."""
    if batch_id is None:
        batch_id = int(rows.select(F.max("batch_id")).first()[0] or 0)
    ResultWriter(rows.sparkSession, target, is_table).write(rows, batch_id)


def write_batch_files(rows: DataFrame, root: str, batch_id: int, by: str, single: bool = True) -> None:
    """This batch's files as ``<root>/<by>=<v>/batch-<id>[-<n>].parquet``,
    replacing an earlier attempt's, so a retried batch never duplicates rows
    and partitions grow with the values of ``by`` (blocks, days), not with
    batches.  ``single``: the rows are few and make one file per value."""
    spark = rows.sparkSession
    root = root.rstrip("/")
    staging = f"{root}/_staging/batch-{batch_id:012d}"
    (rows.coalesce(1) if single else rows).write.mode("overwrite").partitionBy(by).parquet(staging)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for d in fs.listStatus(Path(staging)):
        name = d.getPath().getName()
        if not d.isDirectory() or not name.startswith(f"{by}="):
            continue
        fs.mkdirs(Path(f"{root}/{name}"))
        for old in fs.globStatus(Path(f"{root}/{name}/batch-{batch_id:012d}*.parquet")):
            fs.delete(old.getPath(), False)
        parts = [st.getPath() for st in fs.listStatus(d.getPath()) if st.getPath().getName().startswith("part-")]
        for i, part in enumerate(parts):
            suffix = "" if len(parts) == 1 else f"-{i:05d}"
            fs.rename(part, Path(f"{root}/{name}/batch-{batch_id:012d}{suffix}.parquet"))
    fs.delete(Path(staging), True)


def read_results(spark: SparkSession, source: str, is_table: bool = False) -> DataFrame:
    """The result table (catalog name or folder).  A table is refreshed first:
    a running stream keeps adding files that a cached listing would miss."""
    if is_table:
        spark.catalog.refreshTable(source)
        return spark.table(source)
    return spark.read.parquet(source)


def latest_results(spark: SparkSession, source: str, substance: str, is_table: bool = False) -> DataFrame:
    """Rows of one substance, newest first, with ``recency`` (1 = newest).

    One substance gains a row per batch forever, so the numbering uses the
    skew-safe :func:`rank_within` rather than a single-task window."""
    df = read_results(spark, source, is_table)
    newest_first = [-F.unix_micros("timestamp"), -F.col("batch_id")]
    return (rank_within(df.where(F.col("substance") == substance), ["substance"], newest_first, out="recency")
            .orderBy("recency"))
