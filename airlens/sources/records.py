"""Positional delimited-text readers (pollution, traffic, merged files).

Files are read as text lines and split on the separator (no quoting, no
escaping), so a field is addressed by position exactly like the files are
written.  Header lines may appear anywhere (every file of a directory has one)
and are recognised by the word ``timestamp`` in their time field; blank lines
are dropped.  All of it is column expressions over ``spark.read.text``: the
scan is split by file blocks and nothing reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import BAD_ROW_MODES, entity_from_path, field_at, is_blank, is_header, parse, to_ts
from ..schemas import MERGED, POLLUTION, TRAFFIC, Layout
from .small import list_small, nested_lines


#: Up to so many chosen files are named in the scan's predicate.
MAX_LISTED = 1000


def read_lines(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv") -> DataFrame:
    """Text lines of every matching file directly under ``path`` (non-recursive).

    ``path`` may be a file, a directory, a glob or a list of them; all files
    are read as one table.
    """
    reader = spark.read.option("recursiveFileLookup", "false")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.text(paths)


def first_file_per_entity(spark: SparkSession, path, pattern: str, glob: str | None = "*.csv") -> list[str]:
    """From the file listing only (no data is read): the first file, in path
    order, of every entity id found by ``pattern``; files without an id are
    left out.  Spark already holds this listing on the driver to plan the scan."""
    listing = read_lines(spark, path, glob).inputFiles()
    first: dict[str, str] = {}
    for f in sorted(listing):
        m = re.search(pattern, f)
        if m and m.group(1) not in first:
            first[m.group(1)] = f
    return sorted(first.values())


def parse_records(lines: DataFrame, layout: Layout, bad_rows: str = "fail",
                  keep: Sequence[str] = (), value_col: str = "value") -> DataFrame:
    """Typed columns from a column of delimited lines.

    ``bad_rows``: ``fail`` raises on the first unparsable field (like a plain
    ``float()``), ``drop`` silently removes such rows, ``quarantine`` keeps them
    with all-null fields and ``_bad = true`` plus the raw ``_line``.
    """
    if bad_rows not in BAD_ROW_MODES:
        raise ValueError(f"bad_rows must be one of {BAD_ROW_MODES}")
    mode = "fail" if bad_rows == "fail" else "try"
    strict = bad_rows == "fail"
    line = F.col(value_col)
    parts = F.split(line, re.escape(layout.sep))
    body = lines.where(~is_blank(line))
    body = body.where(~F.coalesce(is_header(field_at(parts, layout.header_field, strict=False)), F.lit(False)))

    if bad_rows == "fail":
        # an explicit arity check (a filter is always evaluated), independent of ANSI mode
        positions = [p for p, _, _ in layout.fields] + ([layout.ts[0]] if layout.ts else [])
        # fields counted from the end come after those counted from the start
        needed = max([p + 1 for p in positions if p >= 0] or [0]) + max([-p for p in positions if p < 0] or [0])
        body = body.where(F.when(F.size(parts) >= needed, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"record has fewer than {needed} fields: "), line))))
    typed: list[Column] = [parse(field_at(parts, p, strict), t, mode).alias(n) for p, n, t in layout.fields]
    if layout.ts:
        pos, ts_name, fmt = layout.ts
        typed.append(to_ts(field_at(parts, pos, strict), fmt, mode).alias(ts_name))
    out = body.select(*keep, *typed, line.alias("_line"))
    if bad_rows == "fail":
        return out.drop("_line")
    bad = F.lit(False)
    for name in layout.columns:
        bad = bad | F.col(name).isNull()
    if bad_rows == "drop":
        return out.where(~bad).drop("_line")
    cols = [F.when(~bad, F.col(n)).alias(n) for n in layout.columns]
    return out.select(*keep, *cols, bad.alias("_bad"), "_line")


def read_records(spark: SparkSession, path, layout: Layout, *, glob: str | None = "*.csv",
                 bad_rows: str = "fail", entity_pattern: str | None = None,
                 entity_col: str = "sensor_id", with_path: bool = False, position: str | None = None) -> DataFrame:
    """Scan delimited files with ``layout``.

    ``entity_pattern``: regular expression whose first group, found in the file
    path, becomes ``entity_col`` (text: leading zeros are significant).
    ``with_path`` keeps the source path as ``file_path``; ``position`` names a
    column that orders the records of a file as they stand in it.  The lines of
    a folder of very many small files are read here, once (see :mod:`.small`).
    """
    small = list_small(spark, path, glob)
    return _read(read_lines(spark, path, glob) if small is None else small.lines(), layout, bad_rows, entity_pattern, entity_col, with_path, position)


def _read(lines: DataFrame, layout: Layout, bad_rows: str, entity_pattern: str | None, entity_col: str,
          with_path: bool, position: str | None) -> DataFrame:
    extra = []
    if position:   # the block of the file that a task reads, then the line within the task
        lines = lines.withColumn(position, F.struct(F.col("_metadata.file_block_start").alias("block"),
                                                    F.monotonically_increasing_id().alias("line")))
        extra.append(position)
    if entity_pattern:
        lines = lines.withColumn(entity_col, entity_from_path(entity_pattern))
        extra.append(entity_col)
    if with_path:
        lines = lines.withColumn("file_path", F.col("_metadata.file_path"))
        extra.append("file_path")
    return parse_records(lines, layout, bad_rows, keep=extra)


def read_pollution(spark: SparkSession, path, **kw) -> DataFrame:
    """Pollution readings: 5 pollutants, longitude, latitude, ``ts``."""
    return read_records(spark, path, POLLUTION, **kw)


def read_traffic(spark: SparkSession, path, **kw) -> DataFrame:
    """Traffic readings: only average speed (field 2), ``ts`` (field 5, ISO
    ``T``) and vehicle count (field 6) are read; the rest is pruned."""
    kw.setdefault("glob", "*csv")
    return read_records(spark, path, TRAFFIC, **kw)


def read_first_files(spark: SparkSession, path, layout: Layout, pattern: str, *, glob: str | None = "*.csv",
                     bad_rows: str = "fail", position: str | None = None) -> DataFrame:
    """Records of the first file (in path order) of every entity only, with
    ``sensor_id`` and ``file_path``.  The choice is made from the file listing
    that Spark holds to plan the scan: a few files become a predicate that
    leaves the others unopened, many become a table that is semi-joined.  Of
    very many small files only the chosen ones are read, once (see :mod:`.small`)."""
    small = list_small(spark, path, glob)
    if small is not None:
        first: dict[str, str] = {}
        for name in sorted(small.names):
            m = re.search(pattern, small.path(name))
            if m and m.group(1) not in first:
                first[m.group(1)] = name
        small.names = sorted(first.values())
        return _read(small.lines(), layout, bad_rows, pattern, "sensor_id", True, position)
    chosen = [re.sub("^file:/+", "file:/", c) for c in first_file_per_entity(spark, path, pattern, glob)]
    lines = read_lines(spark, path, glob)

    def plain(c):   # a listing and a scan write a local path with different numbers of slashes
        return F.regexp_replace(c, "^file:/+", "file:/")

    if len(chosen) <= MAX_LISTED:
        lines = lines.where(plain(F.col("_metadata.file_path")).isin(chosen)) if chosen else lines.where(F.lit(False))
        return _read(lines, layout, bad_rows, pattern, "sensor_id", True, position)
    rows = _read(lines, layout, bad_rows, pattern, "sensor_id", True, position)
    listed = spark.createDataFrame([(c,) for c in chosen], "_chosen string")
    return rows.join(listed, plain(F.col("file_path")) == F.col("_chosen"), "left_semi")


def read_merged(spark: SparkSession, path: str, glob: str | None = None, format: str = "csv", **kw) -> DataFrame:
    """Merged training rows as :func:`airlens.plans.merge.write_merged` writes
    them, or a flat folder of ``<name><id>.csv`` files with the same ``", "``
    layout.  The sensor id comes from the ``sensor_id=<id>`` folder, else from
    the file name, and stays text so leading zeros survive.  ``format`` may be
    ``parquet`` for the parquet twin."""
    if format == "parquet":
        typed = spark.read.parquet(path).schema
        fields = [T.StructField("sensor_id", T.StringType()) if f.name == "sensor_id" else f for f in typed.fields]
        return spark.read.schema(T.StructType(fields)).parquet(path)
    lines = nested_lines(spark, path, glob)
    if lines is None:
        reader = spark.read.schema("value string").option("recursiveFileLookup", "true")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        lines = reader.text(path)
    file = F.col("_metadata.file_path")
    folder = F.regexp_extract(file, "/sensor_id=([^/]+)/", 1)
    named = F.regexp_extract(file, r"(\d+)\.csv$", 1)
    sensor = F.when(folder != "", F.when(folder != "__HIVE_DEFAULT_PARTITION__", folder)).when(named != "", named)
    return parse_records(lines.withColumn("sensor_id", sensor), MERGED, kw.pop("bad_rows", "fail"), keep=["sensor_id"])
