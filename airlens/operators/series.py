"""As-of lookups and linear interpolation against sparse series (weather).

Points ``(series, ts, value)`` are first reduced to one row per distinct time
(``first`` / ``last`` value of ties, in value order), numbered with the
skew-safe :func:`rank_within` and joined to their successor, giving half-open
segments ``[s_ts, e_ts)``.  A lookup time falls in exactly one segment, which
answers all three questions:

* backward  (latest point <= t; ties -> last; none -> the first point)
* forward   (earliest point >= t; ties -> first; none -> the last point)
* interpolate (exact hit -> last tie; before the first / after the last point
  -> that end point; otherwise ``(c1*v_s + c2*v_e) / (c1 + c2)`` with
  ``c1 = e - t`` and ``c2 = t - s`` in seconds)

The interval join is an equi join on time buckets: each segment is exploded
into the buckets it overlaps (bucket width = mean gap of the series, so the
explosion is at most about twice the number of points) and the lookup side
computes its one bucket.  The segment side is broadcast only when its row
count, known exactly from the written segment table, is under a limit;
otherwise it is a shuffle join that AQE may still turn into a broadcast.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import micros_between, seconds_between
from ..session import scratch_path
from .ranking import rank_within

MAX_CANDIDATES = 64   # segments one level-0 bucket may meet before the robust layout is used
BROADCAST_ROWS_CONF = "airlens.series.broadcastRows"
DEFAULT_BROADCAST_ROWS = 1_000_000   # about 60-80 MB of segment rows
HOW = ("interpolate", "backward", "forward")


def _ntz(v: dt.datetime) -> Column:
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def segments(points: DataFrame, series: str = "measurement", ts: str = "ts", value: str = "value") -> DataFrame:
    """``(series, s_ts, s_first, s_last, e_ts, e_first)``; ``e_ts`` is null for
    the last point of a series."""
    ties = (points.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
            .groupBy(series, ts).agg(F.min(value).alias("s_first"), F.max(value).alias("s_last")))
    ranked = rank_within(ties, [series], [ts], out="_r")
    succ = ranked.select(series, (F.col("_r") - 1).alias("_r"), F.col(ts).alias("e_ts"),
                         F.col("s_first").alias("e_first"))
    return (ranked.join(succ, [series, "_r"], "left")
            .select(series, F.col(ts).alias("s_ts"), "s_first", "s_last", "e_ts", "e_first"))


class SeriesIndex:
    """Segments of every series, written once, plus per-series bounds.

    The bounds (one row per series) and the bucket levels present (one row per
    series and level, a few dozen at most) are collected to the driver and
    become literals of the lookup expressions.

    Bucketing is multi-level so that neither the explosion nor the candidates
    per probe depend on how the points are spread: a segment of length
    ``len`` sits on level ``L = max(0, floor(log_8(len / w0)))`` and is
    exploded into the buckets of width ``w0 * 8**L`` it overlaps (at most 9);
    segments are disjoint, so a bucket of level ``L >= 1`` meets at most two
    of them.  ``w0`` is the mean gap / 8 (few levels, so few probes), unless
    some level-0 bucket would then meet more than ``MAX_CANDIDATES`` segments;
    such a series uses ``w0`` = its shortest segment, where every bucket meets
    at most two.  A lookup probes one bucket on each level present; both
    layouts are exact.
    """

    FANOUT = 8

    def __init__(self, points: DataFrame, series: str = "measurement", ts: str = "ts",
                 value: str = "value", broadcast_rows: int | None = None):
        spark = points.sparkSession
        self.series = series
        self.broadcast_rows = broadcast_rows or int(
            spark.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))
        # written once, in folders by series: a lookup reads its own series only
        made = segments(points, series, ts, value)
        path = scratch_path(spark, "segments")
        made.write.partitionBy(series).parquet(path)
        self.seg = spark.read.schema(made.schema).parquet(path)
        rows = (self.seg.groupBy(series)
                .agg(F.min("s_ts").alias("first_ts"), F.max("s_ts").alias("last_ts"),
                     F.count(F.lit(1)).alias("n"),
                     F.min(micros_between("s_ts", "e_ts")).alias("min_len"))
                .collect())
        self.bounds = {r[series]: r for r in rows}
        # start with w0 = mean gap / FANOUT (few levels on ordinary data); a
        # series whose level-0 buckets then hold too many segments (a dense
        # burst) falls back to w0 = its shortest segment, where every bucket
        # meets at most two segments
        robust = {k: max(1, int(r["min_len"] or 1)) for k, r in self.bounds.items()}
        fast = {}
        for k, r in self.bounds.items():
            span = int((r["last_ts"] - r["first_ts"]) / dt.timedelta(microseconds=1))
            fast[k] = max(robust[k], span // max(1, r["n"]) // self.FANOUT)
        self.w0, self.levels, self.exploded = dict(fast), {}, {}
        layout = self._layout(fast) if self.bounds else {}
        dense = [k for k, (_, _, cand) in layout.items() if cand > MAX_CANDIDATES]
        if dense:
            layout.update(self._layout({k: robust[k] for k in dense}))
            self.w0.update({k: robust[k] for k in dense})
        for k, (levels, exploded, _) in layout.items():
            self.levels[k], self.exploded[k] = levels, exploded

    def _layout(self, w0s: dict) -> dict:
        """Per series in ``w0s``: (levels present, index rows, most segments
        met by one level-0 bucket) for bucket base width ``w0s[series]``."""
        per = F.col(self.series)
        w0 = F.create_map(*[x for k, v in w0s.items() for x in (F.lit(k), F.lit(v))])[per]
        first = F.create_map(*[x for k in w0s for x in (F.lit(k), _ntz(self.bounds[k]["first_ts"]))])[per]
        seg = self.seg.where(per.isin(list(w0s)))
        cells = (self._with_levels(seg, w0, first)
                 .select(self.series, "_lvl", F.explode(F.sequence("_b0", "_b1")).alias("_b"))
                 .groupBy(self.series, "_lvl", "_b").agg(F.count(F.lit(1)).alias("c")))
        out: dict = {}
        for r in (cells.groupBy(self.series, "_lvl")
                  .agg(F.sum("c").alias("rows"), F.max("c").alias("cand")).collect()):
            levels, rows_, cand = out.get(r[self.series], ([], 0, 0))
            levels = sorted(levels + [int(r["_lvl"])])
            out[r[self.series]] = (levels, rows_ + int(r["rows"]),
                                   max(cand, int(r["cand"]) if r["_lvl"] == 0 else 0))
        return out

    def _with_levels(self, seg: DataFrame, w0: Column, first: Column) -> DataFrame:
        """``_lvl``, ``_w`` (bucket width in microseconds) and ``_b0``/``_b1``
        (first and last bucket overlapped, counted from the series' first
        time ``first``) for every segment."""
        k = float(self.FANOUT)
        lvl = F.when(F.col("e_ts").isNull(), F.lit(0)).otherwise(
            F.greatest(F.lit(0), F.floor(F.log(k, micros_between("s_ts", "e_ts") / w0)).cast("int")))
        end = F.col("e_ts") - F.expr("INTERVAL 1 MICROSECOND")
        return (seg.withColumn("_lvl", lvl)
                .withColumn("_w", w0.cast("double") * F.pow(F.lit(k), F.col("_lvl")))
                .withColumn("_b0", F.floor(micros_between(first, "s_ts") / F.col("_w")).cast("long"))
                .withColumn("_b1", F.when(F.col("e_ts").isNull(), F.col("_b0"))
                            .otherwise(F.floor(micros_between(first, end) / F.col("_w")).cast("long"))))

    def lookup(self, rows: DataFrame, ts: str, name, out: str, how: str = "interpolate") -> DataFrame:
        """``rows`` plus column ``out``: the value of series ``name`` at ``rows[ts]``.
        Null when the series has no points or ``ts`` is null."""
        if how not in HOW:
            raise ValueError(f"how must be one of {HOW}")
        b = self.bounds.get(name)
        if b is None:
            return rows.withColumn(out, F.lit(None).cast("double"))
        origin, last = _ntz(b["first_ts"]), _ntz(b["last_ts"])
        w0, k = self.w0[name], self.FANOUT

        p = f"__{out}_"
        seg = self._with_levels(self.seg.where(F.col(self.series) == F.lit(name)), F.lit(w0), origin)
        cols = ("s_ts", "s_first", "s_last", "e_ts", "e_first")
        seg = seg.select(F.col("_lvl").alias(p + "l"), F.explode(F.sequence("_b0", "_b1")).alias(p + "b"),
                         *[F.col(c).alias(p + c) for c in cols])
        # one sentinel entry (level -1) answers rows whose time is null
        sentinel = seg.sparkSession.createDataFrame([(-1, -1) + (None,) * len(cols)], seg.schema)
        seg = seg.unionByName(sentinel)
        if self.exploded.get(name, 0) + 1 <= self.broadcast_rows:
            seg = F.broadcast(seg)

        t = F.col(ts)
        tc = F.least(F.greatest(t, origin), last)
        probes = F.when(t.isNull(), F.array(F.struct(F.lit(-1).alias("l"), F.lit(-1).cast("long").alias("b"))))
        probes = probes.otherwise(F.array(*[
            F.struct(F.lit(lv).alias("l"),
                     F.floor(micros_between(origin, tc) / F.lit(float(w0 * k ** lv))).cast("long").alias("b"))
            for lv in self.levels[name]]))
        q = (rows.withColumn(p + "t", tc)
             .withColumn(p + "probe", F.explode(probes))
             .withColumn(p + "ql", F.col(p + "probe.l")).withColumn(p + "qb", F.col(p + "probe.b"))
             .drop(p + "probe"))
        s_ts, e_ts = F.col(p + "s_ts"), F.col(p + "e_ts")
        hit = (s_ts <= F.col(p + "t")) & (e_ts.isNull() | (F.col(p + "t") < e_ts))
        cond = ((F.col(p + "ql") == F.col(p + "l")) & (F.col(p + "qb") == F.col(p + "b"))
                & (hit | (F.col(p + "ql") == -1)))
        # exactly one segment holds the clamped time, on exactly one level
        # (or the sentinel, for a null time): every input row comes out once
        j = q.join(seg, cond, "inner")

        s_first, s_last, e_first = F.col(p + "s_first"), F.col(p + "s_last"), F.col(p + "e_first")
        if how == "backward":
            v = F.when(t < origin, s_first).otherwise(s_last)
        elif how == "forward":
            v = F.when(t > last, s_last).when(t <= s_ts, s_first).otherwise(e_first)
        else:
            c1 = seconds_between(t, e_ts)
            c2 = seconds_between(s_ts, t)
            v = (F.when(t < origin, s_first).when(t > last, s_last).when(t == s_ts, s_last)
                 .otherwise((c1 * s_last + c2 * e_first) / (c1 + c2)))
        return j.withColumn(out, F.when(t.isNotNull(), v)).select(*rows.columns, out)

    def attach(self, rows: DataFrame, ts: str, columns: Mapping, how: str = "interpolate") -> DataFrame:
        """One looked-up column per series: ``columns`` maps series -> column.

        Where all those series' index rows may be broadcast together, the rows pass through one lookup after
        the other without an exchange.  Otherwise every lookup would exchange the rows, with all values found
        so far and once per bucket level; so they are exchanged once, with the points of all series' segments,
        and scanned in order of time (:func:`airlens.operators.scan.scan_ties`)."""
        if sum(self.exploded.get(name, 0) + 1 for name in columns) > self.broadcast_rows:
            from .scan import scan_ties   # which imports HOW from here

            ties = self.seg.where(F.col(self.series).isin(list(columns))).select(
                F.col(self.series).alias("s"), F.col("s_ts").alias("ts"), F.col("s_first").alias("first"), F.col("s_last").alias("last"))
            return scan_ties(rows, ts, ties, columns, how)
        for name, out in columns.items():
            rows = self.lookup(rows, ts, name, out, how)
        return rows
