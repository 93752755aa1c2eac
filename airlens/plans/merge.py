"""Merge job: pollution x traffic per sensor and time, plus weather.

1. traffic rows are restricted to the first traffic file of each sensor id;
2. every pollution file is aligned with its sensor's traffic file on the time,
   duplicate timestamps pairing by position;
3. the six weather measurements are interpolated at each row's time;
4. weekday flags are derived and the 23 merged columns assembled.

Everything is one lazy DataFrame; times are read once beforehand, to cut them into buckets.
:func:`merge_files` keeps the weather points, and the lines of very many small files, in columns, as they are read more than once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import weekday_flags
from ..operators.align import align_on_time, first_group
from ..operators.scan import attach_scan
from ..operators.series import SeriesIndex
from ..sinks.named import FILE, LINE, NO_IDENT, write_named
from ..schemas import MERGED_HEADER, MERGED_SEP, POLLUTANTS, TRAFFIC, WEATHER_COLUMNS, WEEKDAY_COLUMNS
from ..session import kept
from ..sources.records import read_first_files, read_pollution
from ..sources.weather import read_weather

ID_PATTERN = r"(\d+)\.csv"


def merge(pollution: DataFrame, traffic: DataFrame, weather: DataFrame | SeriesIndex,
          weather_columns: Mapping[str, str] = WEATHER_COLUMNS, traffic_is_first_file: bool = False) -> DataFrame:
    """Merged rows ``(sensor_id, Timestamp, ..., Nitrogen_dioxide)``.

    ``pollution``: ``sensor_id, ts, <5 pollutants>, latitude, longitude, _pos`` and, if a
    sensor has several files, ``file_path``: each is paired with the traffic file;
    ``traffic``: ``sensor_id, file_path, ts, average_speed, vehicle_count, _pos``;
    ``weather``: ``(measurement, ts, value)`` points or a prepared SeriesIndex.
    ``traffic_is_first_file``: the traffic rows already come from one file per
    sensor (chosen from the listing), so the row-level first-file step is skipped.
    """
    t = traffic if traffic_is_first_file else first_group(traffic, "sensor_id", "file_path")
    file = F.col("file_path") if "file_path" in pollution.columns else F.lit("")
    left = pollution.select("sensor_id", "ts", F.col("_pos").alias("_lpos"), file.alias("_lfile"),
                            *POLLUTANTS, "latitude", "longitude")
    right = t.select("sensor_id", "ts", F.col("_pos").alias("_rpos"), "average_speed", "vehicle_count")
    aligned = align_on_time(left, right, ["sensor_id", "ts"], ["_lpos"], ["_rpos"], left_group=["_lfile"],
                            small_groups=True)   # readings of one sensor at one instant
    if isinstance(weather, SeriesIndex):
        rows = weather.attach(aligned, "ts", weather_columns)
    else:   # aligned rows have times of pollution readings, which are cheaper to read
        rows = attach_scan(aligned, "ts", weather, weather_columns, times=left)
    return assemble(rows, weather_columns)


def assemble(rows: DataFrame, weather_columns: Mapping[str, str] = WEATHER_COLUMNS,
             pollutants=POLLUTANTS) -> DataFrame:
    """The 23 merged columns (plus ``sensor_id``) in file order."""
    p_names = MERGED_HEADER[18:23]
    return rows.select(
        "sensor_id",
        F.col("ts").alias("Timestamp"),
        F.col("latitude").cast("double").alias("Latitude"),
        F.col("longitude").cast("double").alias("Longitude"),
        F.col("average_speed").cast("double").alias("Average_speed"),
        F.col("vehicle_count").cast("double").alias("Vehicle_count"),
        *weekday_flags("ts", WEEKDAY_COLUMNS),
        *[F.col(c).cast("double").alias(c) for c in MERGED_HEADER[12:18] if c in weather_columns.values()],
        *[F.col(src).cast("double").alias(dst) for src, dst in zip(pollutants, p_names)],
    )


def merge_files(spark: SparkSession, pollution_path: str, traffic_path: str, weather_path: str,
                weather_files: Mapping[str, str] | None = None) -> DataFrame:
    """The merge job from file locations (sensor id = digits before ``.csv``).

    The first traffic file of each sensor is chosen from the file listing, so
    only those files are read and no pairing shuffle is needed."""
    pollution = read_pollution(spark, pollution_path, entity_pattern=ID_PATTERN, with_path=True, position="_pos")
    traffic = read_first_files(spark, traffic_path, TRAFFIC, ID_PATTERN, glob="*csv", position="_pos")
    weather = kept(read_weather(spark, weather_path, weather_files), "points")   # read for the buckets and for the lookup
    return merge(pollution, traffic, weather, traffic_is_first_file=True)


def write_merged(merged: DataFrame, out: str, mode: str = "overwrite", format: str = "csv") -> None:
    """One headed ``", "``-separated CSV set per sensor under
    ``out/sensor_id=<id>/``: rows are dealt out by sensor, and Spark splits the
    partition of a very large one and joins small ones as it measures them.
    ``format="parquet"``: the same rows as parquet, in ranges of sensor and time
    without folders, so files do not grow with sensors and statistics find one."""
    if format == "parquet":
        (merged.repartitionByRange("sensor_id", "Timestamp").sortWithinPartitions("sensor_id", "Timestamp")
         .write.mode(mode).parquet(out))
        return
    if not _prepared(merged.sparkSession, out, mode):
        return
    names = [f.name for f in merged.schema.fields if f.name != "sensor_id"]
    fields = [F.date_format(n, "yyyy-MM-dd HH:mm:ss") if n == "Timestamp" else F.col(n).cast("string") for n in names]
    sensor = F.col("sensor_id").cast("string")
    rows = merged.hint("rebalance", "sensor_id").sortWithinPartitions("sensor_id", "Timestamp").select(
        F.when(sensor != "", sensor).otherwise(F.lit(NO_IDENT)).alias(FILE),
        F.concat_ws(MERGED_SEP, *[F.coalesce(f, F.lit("")) for f in fields]).alias(LINE))
    write_named(rows, out, MERGED_SEP.join(names), "sensor_id=", split=True)


def _prepared(spark: SparkSession, out: str, mode: str) -> bool:
    """Whether to write, by the modes of Spark's writers; ``overwrite`` removes what is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    folder = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if mode not in ("append", "overwrite", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "append" or not folder.exists(path):
        return True
    if mode in ("error", "errorifexists"):
        raise FileExistsError(out)
    if mode == "overwrite":
        folder.delete(path, True)
    return mode == "overwrite"
