"""Files with names of their own: one per sensor, station or chunk.

Spark's writers choose the names of files and, with a folder per value, commit
and rename file after file on the driver, which at a hundred thousand sensors
takes far longer than the data.  Here the tasks write the lines they hold
straight into files named by the value, through pyarrow's file systems (a shared
mount, HDFS, object stores); the driver does nothing per file.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

FILE, LINE = "_file", "line"
NO_IDENT = "__HIVE_DEFAULT_PARTITION__"   # stands for a missing value, as in the names of Spark's own folders
_SPECIAL = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def path_name(value: str) -> str:
    """``value`` as Spark writes it into the name of a partition's folder."""
    return _SPECIAL.sub(lambda m: f"%{ord(m.group()):02X}", value)


def file_system(uri: str):
    """(pyarrow file system, path) of a qualified location."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


def write_named(rows: DataFrame, root: str, header: str | None = None, prefix: str = "", ext: str = ".csv",
                split: bool = False) -> None:
    """Write ``(_file, line)`` rows, sorted by file inside their partitions, as files
    ``root/<prefix><_file><ext>`` with ``header`` on top.

    All rows of a file stand in one partition, unless ``split``: then each partition
    writes ``root/<prefix><_file>/part-<partition>-<call><ext>``.  A file gets its name
    when it is whole, so a task tried again replaces what it left; with ``split`` the file ``_SUCCESS`` comes last.
    Until then it stands in the folder it is for or in one of the task, as tasks hold each other up in a shared one.
    """
    spark = rows.sparkSession
    ship_package(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    hadoop = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    hadoop.mkdirs(path)
    uri, call = hadoop.makeQualified(path).toString(), uuid.uuid4().hex

    def write(batches):
        system, base = file_system(uri)
        tail = f"/part-{TaskContext.get().partitionId():05d}-{call}{ext}" if split else ext
        name = part = out = None
        files, own = 0, f"{base}/_{uuid.uuid4().hex}"   # readers skip names with an underscore
        if not split:
            system.create_dir(own)

        def close():
            out.close()
            system.move(part, f"{base}/{prefix}{path_name(name)}{tail}")

        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))   # a run of rows of one file is joined and written at once
            ends = pa.concat_arrays([pa.array([0], pa.int32()), runs.run_ends])
            texts = pc.binary_join(pa.ListArray.from_arrays(ends, pc.fill_null(batch.column(1), "")), "\n")
            for ident, text in zip(runs.values.to_pylist(), texts):
                head = ""
                if out is None or ident != name:
                    if out is not None:
                        close()
                    name, files = ident, files + 1
                    folder = f"{base}/{prefix}{path_name(name)}" if split else own
                    if split:
                        system.create_dir(folder)
                    part = f"{folder}/_{uuid.uuid4().hex}"
                    out = system.open_output_stream(part)
                    head = "" if header is None else f"{header}\n"
                out.write(f"{head}{text}\n".encode())
        if out is not None:
            close()
        if not split:
            system.delete_dir(own)
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    rows.select(FILE, LINE).mapInArrow(write, "files long").agg(F.sum("files")).collect()   # one number
    if split:
        hadoop.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/_SUCCESS")).close()
