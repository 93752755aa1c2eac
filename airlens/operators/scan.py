"""As-of values of many series at once: one ordered scan over readings and points.

Readings and points are dealt to buckets by time (quantiles of all times, at most one bucket
per shuffle partition), and every bucket is sorted by time once in each direction. Going forward,
the last point of a series is what a reading looks back at; going backward, it is what the
reading looks ahead at. Where the bucket has no such point, the nearest one of the buckets
before or after answers: two points per series and bucket, one small row per bucket, which is all that
is broadcast. So the readings are exchanged once, however many series there are.

Points are first reduced to one row per series and time (smallest and largest value of ties). A time
that many readings share spreads over as many buckets as its quantiles ask for: its points stand in
the first of them, and the others get them as the last points before.

Answers are those of :class:`~airlens.operators.series.SeriesIndex`: backward takes the largest value of
the latest point (none: the first point), forward the smallest of the earliest (none: the last point),
interpolation the line between both, an exact hit or the end point. Readings without time get null.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import micros_between, seconds_between
from .series import HOW

_EPOCH = "1970-01-01 00:00:00"


def _micros(c) -> Column:
    return micros_between(F.lit(_EPOCH).cast("timestamp_ntz"), c)


def _below(bounds: list[int], t: Column, equal: bool) -> Column:
    """How many of the sorted ``bounds`` are less than ``t`` (``equal``: or equal), by binary search."""
    known = F.lit(bounds)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    fits = (lambda b: b <= t) if equal else (lambda b: b < t)
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.coalesce(fits(F.get(known, at + s - 1)), F.lit(False)), at + s).otherwise(at))


def time_bounds(times: DataFrame, buckets: int) -> list[int]:
    """Quantiles of the column ``t`` (microseconds) that cut it into ``buckets`` of equal size."""
    if buckets < 2:
        return []
    row = times.agg(F.percentile_approx("t", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), max(10_000, 20 * buckets)).alias("q")).first()
    return sorted(row["q"] or [])


def attach_scan(rows: DataFrame, ts: str, points: DataFrame, columns: Mapping[str, str], how: str = "interpolate", *,
                series: str = "measurement", point_ts: str = "ts", value: str = "value", times: DataFrame | None = None) -> DataFrame:
    """``rows`` plus one looked-up column per series: ``columns`` maps series -> column.

    ``times``: a frame whose column ``ts`` has times distributed like those of ``rows``, where
    that is cheaper to read than ``rows`` (it only sizes the buckets)."""
    ties = (points.where(F.col(point_ts).isNotNull() & F.col(value).isNotNull() & F.col(series).isin(list(columns)))
            .groupBy(F.col(series).alias("s"), F.col(point_ts).alias("ts"))
            .agg(F.min(value).cast("double").alias("first"), F.max(value).cast("double").alias("last")))
    return scan_ties(rows, ts, ties, columns, how, times=times, point_times=points.select(F.col(point_ts).alias("ts")))


def scan_ties(rows: DataFrame, ts: str, ties: DataFrame, columns: Mapping[str, str], how: str = "interpolate", *,
              times: DataFrame | None = None, point_times: DataFrame | None = None) -> DataFrame:
    """:func:`attach_scan` from points that are one row per series and time already: ``ties`` has
    ``s, ts, first, last``; ``point_times`` has their times ``ts`` where those are cheaper to read."""
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = (rows if times is None else times).select(_micros(F.col(ts)).alias("t"))
    bounds = time_bounds(seen.unionByName((ties if point_times is None else point_times).select(_micros(F.col("ts")).alias("t"))), buckets)

    t = _micros("ts")
    low, high = _below(bounds, t, False), _below(bounds, t, True)
    spread = [F.col(f.name) for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    deal = F.xxhash64(*spread)
    read = rows.select(F.col(ts).alias("ts"), deal.alias("deal"), F.struct(*[F.col(c) for c in rows.columns]).alias("row"))
    read = read.withColumn("low", low).withColumn("high", high)
    read = read.select(F.when(F.col("ts").isNull(), F.pmod("deal", F.lit(buckets)))
                       .otherwise(F.col("low") + F.pmod("deal", F.col("high") - F.col("low") + 1)).cast("int").alias("bucket"), "ts", "row")
    marks = ties.select(low.cast("int").alias("bucket"), "ts", "s", F.struct("ts", "first", "last").alias("point"))
    # the nearest points outside of each bucket: one row per bucket
    names = {name: i for i, name in enumerate(columns)}
    of = lambda name: F.when(F.col("s") == F.lit(name), F.col("point"))
    ends = marks.groupBy("bucket").agg(*[f(of(n)).alias(f"{k}{i}") for n, i in names.items() for k, f in (("lo", F.min), ("hi", F.max))])
    ends = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(ends, "bucket", "left")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("bucket").alias("at"), *[F.last(f"hi{i}", True).over(before).alias(f"before{i}") for i in names.values()],
                       *[F.last(f"lo{i}", True).over(after).alias(f"after{i}") for i in names.values()])

    both = read.unionByName(marks, allowMissingColumns=True)
    forward = Window.partitionBy("bucket").orderBy("ts", F.col("s").isNull())
    backward = Window.partitionBy("bucket").orderBy(F.desc("ts"), F.col("s").isNull())
    both = both.select("*", *[F.last(of(n), True).over(w).alias(f"{k}{i}") for k, w in (("back", forward), ("ahead", backward)) for n, i in names.items()])
    met = both.where("row IS NOT NULL").join(F.broadcast(ends), F.col("bucket") == F.col("at"))   # one row per bucket
    values = [_value(F.col("ts"), F.coalesce(f"back{i}", f"before{i}"), F.coalesce(f"ahead{i}", f"after{i}"), how) for i in names.values()]
    out = met.select("row", *[F.when(F.col("ts").isNotNull(), v).alias(f"value{i}") for i, v in zip(names.values(), values)])
    return out.select("row.*", *[F.col(f"value{i}").alias(columns[n]) for n, i in names.items()])


def _value(t: Column, back: Column, ahead: Column, how: str) -> Column:
    """The answer from the latest point up to ``t`` and the earliest from ``t`` on (either may be null)."""
    hit = back["ts"] == t
    if how == "backward":
        return F.coalesce(back["last"], ahead["first"])
    if how == "forward":
        return F.when(hit, back["first"]).otherwise(F.coalesce(ahead["first"], back["last"]))
    c1, c2 = seconds_between(t, ahead["ts"]), seconds_between(back["ts"], t)
    line = (c1 * back["last"] + c2 * ahead["first"]) / (c1 + c2)
    return F.when(hit, back["last"]).when(back.isNull(), ahead["first"]).when(ahead.isNull(), back["last"]).otherwise(line)
