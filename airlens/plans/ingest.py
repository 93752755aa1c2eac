"""One-time ingest of readings into a layout the region report can prune.

Raw CSV offers nothing to push down: every line is read and parsed.  After
ingest the readings are parquet files partitioned by the month of the reading
time and sorted by ``(latitude, longitude)`` inside each file, so

* the period predicate also becomes a predicate on the partition column and
  only the months of the period are listed and read (partition pruning), and
* the box predicate skips row groups by their min/max statistics.

Rows are dealt to tasks by a hash of the month and a map cell, so a month spreads
over as many tasks as it has cells.  Every ingest adds to what is there: files
lie under ``month=.../batch=.../`` and a retry of a batch replaces that batch only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import Box, Period, in_region, ntz_literal
from ..operators.profile import profile
from ..operators.scan import _below
from ..schemas import POLLUTANT_LABELS, POLLUTANTS

PART, BATCH, CURVE = "month", "batch", "__place_on_curve"


def month_of(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("timestamp_ntz").cast("date")


def ingest_readings(readings: DataFrame, out: str, *, ts: str = "ts", lat: str = "latitude",
                    long: str = "longitude", batch: str | None = None, cell: float = 0.1) -> str:
    """Add ``readings`` as parquet under ``out/month=YYYY-MM-01/batch=<batch>/``
    and return the batch's name.

    ``batch`` names the drop (default: a new name); ingesting a batch again
    replaces its own rows and no others.  ``cell`` is the width of the map
    cells, in degrees, that rows are dealt out by."""
    batch = batch or uuid.uuid4().hex[:16]
    place = [F.floor(F.col(c).cast("double") / F.lit(cell)) for c in (lat, long)]
    (readings.withColumn(PART, month_of(F.col(ts))).withColumn(BATCH, F.lit(batch))
     .repartition(PART, *place).sortWithinPartitions(PART, lat, long)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, BATCH).parquet(out))
    return batch


def curve_key(lat: Column, long: Column, lat_bounds: list, long_bounds: list, bits: int) -> Column:
    """Place on a bit-interleaving curve of 2 ** bits by 2 ** bits cells whose sides are quantiles."""
    i, j = _below(lat_bounds, lat, True).cast("long"), _below(long_bounds, long, True).cast("long")
    key = F.lit(0).cast("long")
    for b in range(bits):
        key = key + F.shiftleft(F.shiftright(i, b).bitwiseAND(F.lit(1)), 2 * b + 1) + F.shiftleft(F.shiftright(j, b).bitwiseAND(F.lit(1)), 2 * b)
    return key


def ingest_on_curve(readings: DataFrame, out: str, *, ts: str = "ts", lat: str = "latitude", long: str = "longitude",
                    batch: str | None = None, bits: int = 5, files: int | None = None) -> str:
    """As :func:`ingest_readings`, with files that are compact on the map: readings are cut into ranges of month and
    place on a space-filling curve, so file statistics keep a box's report away from most files in both
    directions. ``files``: how many ranges (default: the shuffle's width, fewer where they are small). A
    crowded cell is cut further by latitude, longitude and time; readings without place come first."""
    batch = batch or uuid.uuid4().hex[:16]
    cells = 1 << bits
    quantiles = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    found = readings.agg(*[F.percentile_approx(F.col(c).cast("double"), quantiles, 10_000).alias(n) for c, n in ((lat, "lat"), (long, "long"))]).first()
    key = curve_key(F.col(lat).cast("double"), F.col(long).cast("double"), sorted(found["lat"] or []), sorted(found["long"] or []), bits)
    order = [F.col(PART), F.col(CURVE), F.col(lat), F.col(long), F.col(ts)]
    (readings.withColumn(PART, month_of(F.col(ts))).withColumn(BATCH, F.lit(batch)).withColumn(CURVE, key)
     .repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(PART, CURVE, lat, long).drop(CURVE)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, BATCH).parquet(out))
    return batch


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """All ingested readings; ``month`` and ``batch`` are columns (``batch`` stays text)."""
    schema = spark.read.parquet(path).schema
    kept = T.StructType([T.StructField(f.name, T.StringType()) if f.name == BATCH else f for f in schema.fields])
    return spark.read.schema(kept).parquet(path)


def period_partitions(period: Period) -> Column:
    """The partition predicate implied by an inclusive period."""
    return F.col(PART).between(month_of(ntz_literal(period.start)), month_of(ntz_literal(period.end)))


def region_report_ingested(readings: DataFrame, box: Box, period: Period, *, attributes=POLLUTANTS,
                           labels=None, lat: str = "latitude", long: str = "longitude",
                           ts: str = "ts") -> DataFrame:
    """The region report over ingested readings: same rows as
    :func:`airlens.plans.report.region_report`, reading only the period's
    months and the row groups that can hold the box."""
    if labels is None:
        labels = POLLUTANT_LABELS if list(attributes) == POLLUTANTS else list(attributes)
    kept = readings.where(period_partitions(period) & in_region(box, period, lat, long, ts))
    return profile(kept, attributes, labels)
