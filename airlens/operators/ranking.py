"""Row number inside a group, safe for groups of any size.

``row_number() OVER (PARTITION BY keys ORDER BY ...)`` sends a whole group to
one task: fine for ordinary groups, a straggler (or worse) when one key holds a
large share of the data.  ``rank_within`` therefore range-partitions on the
full ``(keys, order)`` tuple, so that a hot group, ties in its first order
columns and null keys included, spreads over as many partitions as its size
asks for.  Rows are numbered inside their partition and a group that goes on
from an earlier partition gets the count of its rows there added: one row per
partition, the only thing that is broadcast.  No probe, no size switch: every
group takes the same path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_POS_BITS = 33   # monotonically_increasing_id(): partition above, row number below


def _order_cols(order: Sequence) -> list:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "rank",
                small_groups: bool = False) -> DataFrame:
    """``df`` plus ``out``: 1-based position of each row inside its ``keys``
    group following ``order``.  ``order`` should be a total order within each
    group for a deterministic result.  Null keys form a group of their own.

    ``small_groups``: the caller states that no group is large (for example
    readings of one sensor at one instant); a plain window then does.
    Otherwise the sorted rows are written once below the shared checkpoint
    folder, so that every later read sees the same partition boundaries.
    """
    keys, order = list(keys), _order_cols(order)
    if small_groups:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranked")
    (df.repartitionByRange(width, *keys, *order).sortWithinPartitions(*keys, *order)
       .withColumn("_pos", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("_pid", F.shiftright("_pos", _POS_BITS))

    local = Window.partitionBy("_pid", *keys).orderBy("_pos")
    numbered = rows.withColumn("_local", F.row_number().over(local))
    # at most two groups of a partition go over its edge: its first and its last
    groups = (rows.groupBy("_pid", *keys)
                  .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"), F.max("_pos").alias("_last")))
    ends = groups.groupBy("_pid").agg(F.max("_last").alias("_end"))
    edges = (groups.join(F.broadcast(ends), "_pid")   # one row per partition
                   .where((F.col("_first") == F.shiftleft("_pid", _POS_BITS)) | (F.col("_last") == F.col("_end"))))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (edges.withColumn("_off", F.sum("_n").over(before))
                    .where(F.col("_off").isNotNull()).select("_pid", F.col("_last").alias("_until"), "_off"))
    joined = numbered.join(F.broadcast(offsets), "_pid", "left")   # one row per partition
    rank = F.col("_local") + F.when(F.col("_pos") <= F.col("_until"), F.col("_off")).otherwise(F.lit(0))
    return joined.select(*df.columns, rank.cast("long").alias(out))
