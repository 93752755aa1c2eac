"""Region report: filter readings to a box and period, profile the attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import Box, Period, in_region
from ..operators.profile import profile
from ..schemas import (POLLUTANT_LABELS, POLLUTANTS, REPORT_COUNT, REPORT_EMPTY, REPORT_MEAN, REPORT_RANGE,
                       REPORT_STD)


def region_readings(readings: DataFrame, box: Box, period: Period, *, lat: str = "latitude",
                    long: str = "longitude", ts: str = "ts") -> DataFrame:
    """Readings inside the box and period (all bounds inclusive)."""
    return readings.where(in_region(box, period, lat, long, ts))


def region_report(readings: DataFrame, box: Box, period: Period, *,
                  attributes: Sequence[str] = POLLUTANTS, labels: Sequence[str] | None = None,
                  lat: str = "latitude", long: str = "longitude", ts: str = "ts",
                  group_by: Sequence[str] = ()) -> DataFrame:
    """One row per attribute: ``attribute, elements, min, max, mean, std``.

    No rows at all when nothing falls inside the region.
    """
    if labels is None:
        labels = POLLUTANT_LABELS if list(attributes) == POLLUTANTS else list(attributes)
    return profile(region_readings(readings, box, period, lat=lat, long=long, ts=ts),
                   attributes, labels, group_by)


def report_lines(report: DataFrame) -> DataFrame:
    """The printed report as text rows ``(attribute, kind, line)``.

    One ``count`` line (no attribute: the count is the same for all), then per
    attribute a ``range``, ``mean`` and ``std`` line with plain numbers.  An
    empty report gives the count 0 and the message that there is nothing to
    analyse.
    """
    a = F.col("attribute")
    number = lambda c: F.col(c).cast("double").cast("string")
    counted = report.agg(F.coalesce(F.max("elements"), F.lit(0)).alias("n"))
    head = counted.select(F.lit(None).cast("string").alias("attribute"), F.inline(F.filter(F.array(
        F.struct(F.lit("count").alias("kind"), F.concat(F.lit(REPORT_COUNT), F.col("n").cast("string"), F.lit(".")).alias("line")),
        F.struct(F.when(F.col("n") == 0, F.lit("empty")).alias("kind"), F.lit(REPORT_EMPTY).alias("line"))),
        lambda x: x.kind.isNotNull())))
    rows = F.array(
        F.struct(F.lit("range").alias("kind"),
                 F.concat(a, F.lit(REPORT_RANGE), number("min"), F.lit(", "), number("max"), F.lit("].")).alias("line")),
        F.struct(F.lit("mean").alias("kind"), F.concat(a, F.lit(REPORT_MEAN), number("mean"), F.lit(".")).alias("line")),
        F.struct(F.lit("std").alias("kind"), F.concat(a, F.lit(REPORT_STD), number("std"), F.lit(".")).alias("line")),
    )
    return head.unionByName(report.select("attribute", F.inline(rows)))
