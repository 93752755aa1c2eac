"""Write driver tables out as the delimited text files the readers consume.

Used by the stand-in queries and the tests: Spark renders each row as one
line, adds header lines (at the top of every file and again in the middle)
and whitespace-only lines, and writes ``*.csv`` part files into a fresh
folder under the shared checkpoint location; files that need a name of their
own are written by the tasks.  The data never passes through the driver.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.named import FILE, LINE, NO_IDENT, file_system, write_named

#: Rows that a staged file of a table gets at most (about); a file is sorted by one task.
ROWS_PER_FILE = 500_000


def write_lines(lines: DataFrame, out: str, files: int) -> str:
    """Write ``(_file, _pos, line)`` rows as ``files`` text files of lines,
    ordered by ``_pos`` inside each file, with a ``.csv`` suffix."""
    (lines.repartition(files, "_file").sortWithinPartitions("_file", "_pos").select(LINE)
     .write.mode("overwrite")
     .option("sep", "\u0001").option("quote", "").option("escape", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(out))
    return out


def stage_table(spark: SparkSession, df: DataFrame, fields: Sequence[Column], header: str,
                order: str, file_of: Column, files: int, name: str,
                mid_positions: Sequence[float] = (1000.5,), blank_positions: Sequence[float] = (2000.5,)) -> str:
    """Render ``df`` as comma-separated lines in ``files`` files.

    ``file_of`` assigns each row a file number (0..files-1) and ``order`` its
    position.  Every file starts with ``header``; ``mid_positions`` put the
    header again after those positions and ``blank_positions`` a blank line.
    """
    rows = df.select(file_of.alias("_file"), F.col(order).cast("double").alias("_pos"),
                     F.concat_ws(",", *[f.cast("string") for f in fields]).alias(LINE))
    extra = [F.struct(F.lit(-1.0).alias("_pos"), F.lit(header).alias(LINE))]
    extra += [F.struct(F.lit(float(p)).alias("_pos"), F.lit(header).alias(LINE)) for p in mid_positions]
    extra += [F.struct(F.lit(float(p)).alias("_pos"), F.lit(" ").alias(LINE)) for p in blank_positions]
    # one header/blank set per file that actually received rows
    marks = (rows.select("_file").distinct()
             .select("_file", F.inline(F.array(*extra))))
    out = scratch_path(spark, name)
    return write_lines(rows.unionByName(marks), out, files)


def files_for(df: DataFrame, least: int) -> int:
    """How many files ``df`` is staged as: ``least``, more where they would hold over ``ROWS_PER_FILE`` rows."""
    return max(least, -(-df.count() // ROWS_PER_FILE))


def spread(key: Column, files: int) -> Column:
    """Deterministic file number for a key (hash spread, every row kept)."""
    return F.pmod(F.xxhash64(key), F.lit(files)).cast("int")


def stage_named_files(spark: SparkSession, df: DataFrame, fields: Sequence[Column] | Column, header: str | None,
                      order: str, ident: Column, prefix: str, name: str, ext: str = ".csv",
                      root: str | None = None) -> str:
    """One file per ``ident`` value named ``<prefix><ident><ext>``, header
    first.  ``fields`` is a list of columns joined by commas, or one column
    holding the whole line."""
    line = fields if isinstance(fields, Column) else F.concat_ws(",", *[f.cast("string") for f in fields])
    ident = ident.cast("string")
    rows = df.select(F.when(ident != "", ident).otherwise(F.lit(NO_IDENT)).alias(FILE),
                     F.col(order).cast("double").alias("_pos"), line.alias(LINE))
    out = root or scratch_path(spark, name)
    # an explicit partition count keeps AQE from coalescing the many small
    # per-file outputs into one serial task
    rows = rows.repartition(spark.sparkContext.defaultParallelism, "_file").sortWithinPartitions("_file", "_pos")
    write_named(rows, out, header, prefix, ext)
    return out


def stage_stream_chunks(spark: SparkSession, df: DataFrame, fields: Sequence[Column] | Column, order: str,
                        chunk: Column, name: str, header: str | None = None) -> str:
    """One ``chunkNNNNNN.csv`` file per chunk number, with modification times
    increasing with the chunk number: a file stream source taking one file
    per trigger then sees chunk ``i`` as micro-batch ``i``."""
    root = stage_named_files(spark, df, fields, header, order, F.lpad(chunk.cast("string"), 6, "0"),
                             "chunk", name)
    jvm = spark.sparkContext._jvm
    Path, folder = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.Path(root)
    hadoop = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system, base = file_system(hadoop.makeQualified(folder).toString())
    names = sorted(f.path for f in system.get_file_info(fs.FileSelector(base)) if f.path.endswith(".csv"))
    for i, name in enumerate(names):
        at = 1_500_000_000_000 + i * 1000
        if isinstance(system, fs.LocalFileSystem):   # without calls to the JVM, which take far longer than the change
            os.utime(name, ns=(at * 1_000_000, at * 1_000_000))
        else:
            hadoop.setTimes(Path(f"{root}/{name.rsplit('/', 1)[1]}"), at, -1)
    return root
