"""Region and period predicates (both inclusive on every side)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    min_lat: float
    max_lat: float
    min_long: float
    max_long: float


@dataclass(frozen=True)
class Period:
    """Inclusive period.  Dates mean midnight, so the last day only
    contributes its 00:00:00 readings (pass the next day to include it)."""

    start: dt.datetime
    end: dt.datetime

    @staticmethod
    def of(start, end) -> "Period":
        return Period(_as_datetime(start), _as_datetime(end))


def _as_datetime(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    s = str(v)
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S" if " " in s else "%Y-%m-%d")


def ntz_literal(v: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (no session time zone involved)."""
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def in_box(box: Box, lat: str = "latitude", long: str = "longitude") -> Column:
    return (F.col(lat).between(F.lit(box.min_lat), F.lit(box.max_lat))
            & F.col(long).between(F.lit(box.min_long), F.lit(box.max_long)))


def in_period(period: Period, ts: str = "ts") -> Column:
    return F.col(ts).between(ntz_literal(period.start), ntz_literal(period.end))


def in_region(box: Box, period: Period, lat: str = "latitude", long: str = "longitude",
              ts: str = "ts") -> Column:
    return in_box(box, lat, long) & in_period(period, ts)
