"""A result table with a primary key: the last write of (substance, timestamp) wins.

The table is partitioned by the day of the timestamp. An upsert merges its rows with the days they touch,
writes each day's new content whole into a fresh folder, and then points the table's partition at that folder:
one change in the catalog per day, so a reader sees a day before or after it, never in between. A job that is
killed earlier leaves folders that nothing points at; one that is killed between days is simply run again,
as the same rows give the same content. An upsert of no rows for a day compacts it into one folder.

A write carries ``write_id`` (a batch's number); of equal keys the larger one stays, and rows of one
write that are equal in key are settled by ``tie`` columns, the largest last.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY, WRITE = "day", "write_id"
KEY = ("substance", "timestamp")


def create_keyed_table(spark: SparkSession, name: str, columns: str, location: str) -> None:
    """``columns``: DDL of the data columns, ``substance`` and ``timestamp`` among them."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {WRITE} BIGINT, {DAY} DATE) USING parquet PARTITIONED BY ({DAY}) LOCATION '{location}'")


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"].rstrip("/")


def newest(rows: DataFrame, columns: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """One row per key: that of the last write."""
    rest = [c for c in columns if c not in KEY]
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(*rest), F.struct(WRITE, *tie)).alias("r")).select(*KEY, "r.*").select(*columns)


def upsert(rows: DataFrame, name: str, write_id: int, tie: Sequence[str] = (), days: Sequence | None = None, before_swap=None) -> list:
    """Merge ``rows`` into table ``name`` as write ``write_id`` and return the days that were swapped.

    ``days``: rewrite these as well (compaction); ``before_swap``: called with each day before its swap."""
    spark = rows.sparkSession
    spark.catalog.refreshTable(name)
    table = spark.table(name)
    columns = [c for c in table.columns if c != DAY]
    new = rows.withColumn(WRITE, F.lit(write_id).cast("long")).withColumn(DAY, F.to_date("timestamp"))
    touched = sorted({r[0] for r in new.select(DAY).distinct().collect()} | set(days or ()))   # days of one write
    if not touched:
        return []
    old = table.where(F.col(DAY).isin(touched))
    merged = newest(old.select(*columns).unionByName(new.select(*columns)), columns, [t for t in tie if t in columns]).withColumn(DAY, F.to_date("timestamp"))
    fresh = f"{_location(spark, name)}/version-{uuid.uuid4().hex}"
    merged.hint("rebalance", DAY).write.partitionBy(DAY).parquet(fresh)   # a large day is split
    for day in touched:
        if before_swap:
            before_swap(day)
        folder = f"{fresh}/{DAY}={day}"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({DAY} = DATE '{day}') LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({DAY} = DATE '{day}') SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return touched


def compact(spark: SparkSession, name: str, days: Sequence) -> list:
    """Rewrite ``days`` into one file each."""
    columns = [c for c in spark.table(name).columns if c not in (DAY, WRITE)]
    return upsert(spark.table(name).where("false").select(*columns), name, 0, days=days)
