"""A cube of mergeable moments beside ingested readings.

For every month and map cell the cube keeps, per attribute, count, least, greatest, mean and the sum of squared
deviations, and the ranges of place and time that the cell's readings really have. A report takes the
cells whose ranges lie inside of the box and the period from the cube, leaves those outside, and reads raw
readings only of the cells that the box or the period cuts: of their months only (partition pruning),
with the box as a pushed filter. Since ranges are those of the readings, not of the grid, the split is
exact whatever the cell width.

Cells are merged by Chan's formula about the merged mean, so nothing is lost to cancellation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import Box, Period, in_region, ntz_literal
from ..operators.profile import unpivot_profile
from ..schemas import POLLUTANT_LABELS, POLLUTANTS
from .ingest import BATCH, PART, ingest_readings, month_of, period_partitions, read_ingested

LIMITS = ("lat", "long", "ts")


def _cell(c: str, width: float) -> Column:
    return F.floor(F.col(c).cast("double") / F.lit(width))


def _moments(attributes: Sequence[str]) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("elements")]
    for i, a in enumerate(attributes):
        c = F.col(a).cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"), F.avg(c).alias(f"mean{i}"),
                 (F.var_pop(c) * F.count(c)).alias(f"m2_{i}")]
    return aggs


def moment_columns(n: int) -> list[str]:
    return ["elements"] + [f"{k}{i}" for i in range(n) for k in ("n", "min", "max", "mean", "m2_")]


def ingest_cube(readings: DataFrame, out: str, cube: str, *, attributes: Sequence[str] = POLLUTANTS, ts: str = "ts", lat: str = "latitude",
                long: str = "longitude", batch: str | None = None, cell: float = 0.1) -> str:
    """Ingest ``readings`` under ``out`` (see :func:`ingest_readings`) and their cells under ``cube``.
    Ingesting a batch again replaces its readings and its cells only. Readings without place or
    time belong to no region and to no cell."""
    spark = readings.sparkSession
    batch = ingest_readings(readings, out, ts=ts, lat=lat, long=long, batch=batch, cell=cell)
    rows = read_ingested(spark, out).where(F.col(BATCH) == batch).dropna(subset=[ts, lat, long])
    limits = [f(F.col(c)).alias(f"{k}_{name}") for name, c in zip(LIMITS, (lat, long, ts)) for k, f in (("min", F.min), ("max", F.max))]
    (rows.groupBy(PART, _cell(lat, cell).alias("cell_lat"), _cell(long, cell).alias("cell_long")).agg(*limits, *_moments(attributes))
     .withColumn(BATCH, F.lit(batch)).repartition(PART)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, BATCH).parquet(cube))
    return batch


def read_cube(spark: SparkSession, cube: str) -> DataFrame:
    schema = spark.read.parquet(cube).schema
    kept = T.StructType([T.StructField(f.name, T.StringType()) if f.name == BATCH else f for f in schema.fields])
    return spark.read.schema(kept).parquet(cube)


def merge_moments(cells: DataFrame, n: int) -> DataFrame:
    """One row of merged moments, as the wide profile of ``n`` attributes."""
    one = cells.agg(*[(F.sum(F.col(f"n{i}") * F.col(f"mean{i}")) / F.sum(f"n{i}")).alias(f"_mean{i}") for i in range(n)])
    aggs = [F.sum("elements").alias("elements")]
    for i in range(n):
        off = F.col(f"mean{i}") - F.col(f"_mean{i}")
        m2 = F.sum(F.col(f"m2_{i}") + F.col(f"n{i}") * off * off)
        aggs += [F.min(f"min{i}").alias(f"_min{i}"), F.max(f"max{i}").alias(f"_max{i}"), F.max(f"_mean{i}").alias(f"_mean{i}"),
                 F.sqrt(m2 / F.sum(f"n{i}")).alias(f"_std{i}")]
    return cells.join(F.broadcast(one)).agg(*aggs)   # one row of means


def split_cells(cells: DataFrame, box: Box, period: Period) -> tuple[DataFrame, DataFrame]:
    """(cells inside of box and period, cells that these cut)."""
    lo = [F.lit(box.min_lat), F.lit(box.min_long), ntz_literal(period.start)]
    hi = [F.lit(box.max_lat), F.lit(box.max_long), ntz_literal(period.end)]
    near = cells.where(period_partitions(period))
    inside, touched = F.lit(True), F.lit(True)
    for name, a, b in zip(LIMITS, lo, hi):
        inside &= (F.col(f"min_{name}") >= a) & (F.col(f"max_{name}") <= b)
        touched &= (F.col(f"max_{name}") >= a) & (F.col(f"min_{name}") <= b)
    return near.where(inside), near.where(touched & ~inside)


def region_report_cube(spark: SparkSession, out: str, cube: str, box: Box, period: Period, *, attributes: Sequence[str] = POLLUTANTS,
                       labels=None, lat: str = "latitude", long: str = "longitude", ts: str = "ts", cell: float = 0.1) -> DataFrame:
    """The region report from the cube and the raw readings of cut cells: the rows of
    :func:`airlens.plans.report.region_report`. ``attributes`` and ``cell`` are those of the ingest."""
    if labels is None:
        labels = POLLUTANT_LABELS if list(attributes) == POLLUTANTS else list(attributes)
    inside, cut = split_cells(read_cube(spark, cube), box, period)
    n = len(attributes)
    months = [r[0] for r in cut.select(PART).distinct().collect()]   # months of one period
    parts = inside.select(*moment_columns(n))
    if months:
        keys = cut.select(F.col(PART).alias("_m"), F.col(BATCH).alias("_b"), F.col("cell_lat").alias("_i"), F.col("cell_long").alias("_j"))
        raw = read_ingested(spark, out).where(F.col(PART).isin(months) & period_partitions(period) & in_region(box, period, lat, long, ts))
        mine = ((F.col(PART) == F.col("_m")) & (F.col(BATCH) == F.col("_b")) & (_cell(lat, cell) == F.col("_i")) & (_cell(long, cell) == F.col("_j")))
        parts = parts.unionByName(raw.join(keys, mine, "left_semi").agg(*_moments(attributes)))
    return unpivot_profile(merge_moments(parts, n).where(F.col("elements") > 0), labels)
