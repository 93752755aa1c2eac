"""Weather series: JSON-lines files, one object per line mapping ISO time -> value.

``{"2014-08-15T00:20:00": "10", "2014-08-15T00:30:00": "", ...}``; an empty
string means "not measured" and is dropped.  Every file holds one measurement;
by default the measurement is the file name without ``.txt``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import to_double, to_ts
from ..schemas import ISO_TS_FORMAT, WEATHER_MEASUREMENTS


def explode_points(lines: DataFrame, json_col: str, keep: list[str] | tuple = (), mode: str = "fail",
                   key_is_time: bool = True, ts_format: str = ISO_TS_FORMAT) -> DataFrame:
    """JSON objects -> one row per entry with a non-empty value.

    Output ``(keep..., key, ts, value)`` when ``key_is_time`` (``ts`` parsed from
    the key), else ``(keep..., key, value)``.  Non-string JSON values are taken
    as their text, so ``{"k": 69}`` gives value 69.0.
    """
    # a malformed line is null here: fail mode raises on it, others read it as
    # an empty object; blank lines carry nothing and are skipped
    lines = lines.where(F.length(F.trim(F.col(json_col))) > 0)
    lines = lines.withColumn("_parsed", F.from_json(F.col(json_col), "map<string,string>"))   # a column, so that it is parsed once
    parsed = F.col("_parsed")
    if mode == "fail":
        parsed = F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("Malformed JSON object: "), F.col(json_col)))).otherwise(parsed)
    entries = lines.select(*keep, F.explode(parsed).alias("key", "_raw"))
    entries = entries.where(F.col("_raw").isNotNull() & (F.trim(F.col("_raw")) != ""))
    cols: list[Column] = [F.col(c) for c in keep] + [F.col("key")]
    if key_is_time:
        cols.append(to_ts(F.col("key"), ts_format, mode).alias("ts"))
    cols.append(to_double(F.col("_raw"), mode).alias("value"))
    out = entries.select(*cols)
    if mode != "fail":
        out = out.where(F.col("value").isNotNull() & (F.col("ts").isNotNull() if key_is_time else F.lit(True)))
    return out


def read_weather(spark: SparkSession, path: str, files: Mapping[str, str] | None = None,
                 mode: str = "fail") -> DataFrame:
    """``(measurement, ts, value)`` for every measurement.

    ``files`` maps measurement -> file name inside ``path``; the default is
    ``<measurement>.txt`` for the six standard measurements.  Passing the
    same file for all six reproduces runs where one file fed every column.
    """
    base = path.rstrip("/")
    if files is None:
        files = {m: f"{m}.txt" for m in WEATHER_MEASUREMENTS}
    by_file: dict[str, list[str]] = {}
    for m, f in files.items():
        by_file.setdefault(f, []).append(m)
    parts = []
    for f, ms in by_file.items():
        lines = spark.read.text(f"{base}/{f}")
        # one scan per distinct file; a file feeding several measurements is
        # read once and fanned out with a generator
        lines = lines.select(F.explode(F.array(*[F.lit(m) for m in ms])).alias("measurement"), "value")
        pts = explode_points(lines.withColumnRenamed("value", "_json"), "_json", ["measurement"], mode)
        parts.append(pts.select("measurement", "ts", "value"))
    return reduce(DataFrame.unionByName, parts)
