"""Folders of very many small text files.

Spark's text reader spends milliseconds on every file, and lists a folder of folders by
a task each, so files of a few lines cost far more than their lines.  Here the tasks
read their share of the files through pyarrow's file systems, and the lines are kept in
columns below the shared checkpoint folder, so that every later scan reads a few large files.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import kept, ship_package
from ..sinks.named import file_system

#: A folder with fewer entries, or with a larger file, is left to Spark's reader.
MANY_FILES, SMALL_BYTES = 1000, 16 << 20
#: Files that a task reads at most (about).
FILES_PER_TASK = 4000
_PACKED = re.compile(r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd|zip|lzo|xz|Z|br)$", re.IGNORECASE)
_QUOTED = re.compile("[^A-Za-z0-9_!.~'()*,;:$&+=@/\u0100-\U0010ffff\u00a1-\u00ff-]|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BATCH_LINES = 10_000


def _hidden(name: str) -> bool:
    """Names that Spark's listing leaves out."""
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _written(location: str) -> str:
    """``location`` as Java writes a path into a URI."""
    return _QUOTED.sub(lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), location)


def _matches(name: str, ending: str) -> bool:
    return not _hidden(name) and name.endswith(ending)


class SmallFiles:
    """The listing of a folder whose files are many and small: ``names`` below ``uri``."""

    def __init__(self, spark: SparkSession, uri: str, names: list[str]):
        self.spark, self.uri, self.names = spark, uri, names

    def path(self, name: str) -> str:
        """The file's location as ``_metadata.file_path`` has it."""
        return _written(f"{self.uri}/{name}")

    def lines(self) -> DataFrame:
        """``value`` and ``_metadata`` (``file_path``, and as ``file_block_start`` the line's number in its file)."""
        return _lines_of(self.spark, self.uri, self.names, None)


def list_small(spark: SparkSession, path, glob: str | None) -> SmallFiles | None:
    """The files directly in the folder ``path``, or ``None`` where Spark's reader should read them."""
    listed = _entries(spark, path, glob)
    if listed is None:
        return None
    uri, entries, ending = listed
    if any(e.type == fs.FileType.Directory for e in entries):
        return None
    files = [e for e in entries if _matches(e.base_name, ending)]
    if len(files) < MANY_FILES or any(e.size > SMALL_BYTES or _PACKED.search(e.base_name) for e in files):
        return None
    return SmallFiles(spark, uri, [e.base_name for e in files])


def nested_lines(spark: SparkSession, path, glob: str | None) -> DataFrame | None:
    """The lines of all files in the folders below ``path`` (see :meth:`SmallFiles.lines`), or ``None``
    where Spark's reader should read them.  The tasks list the folders."""
    listed = _entries(spark, path, glob)
    if listed is None:
        return None
    uri, entries, ending = listed
    if len(entries) < MANY_FILES or any(e.size > SMALL_BYTES or _PACKED.search(e.base_name) for e in entries if e.is_file):
        return None
    names = [e.base_name for e in entries if e.type == fs.FileType.Directory or _matches(e.base_name, ending)]
    try:
        return _lines_of(spark, uri, names, ending)
    except Exception as e:  # noqa: BLE001 - the error comes wrapped from the workers
        if _NOT_SMALL not in str(e):
            raise
        return None


_NOT_SMALL = "a file in a folder is large or compressed"


def _entries(spark: SparkSession, path, glob: str | None):
    """(location, entries that Spark would list, end of the names that ``glob`` asks for), or ``None``: not a plain folder."""
    ending = "" if glob is None else glob[1:]
    if not isinstance(path, str) or re.search(r"[*?\[\]{}%\\]", path) or (glob is not None and not re.fullmatch(r"\*[\w.-]*", glob)):
        return None
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = hadoop.makeQualified(folder).toString().rstrip("/")
    try:
        system, base = file_system(uri)
        entries = system.get_file_info(fs.FileSelector(base))
    except (OSError, pa.ArrowException, NotImplementedError):   # not a folder, or no such file system in pyarrow
        return None
    return uri, [e for e in entries if not _hidden(e.base_name)], ending


def _lines_of(spark: SparkSession, uri: str, names: list[str], ending: str | None) -> DataFrame:
    """Lines of the files ``names`` below ``uri``; with ``ending``, a folder among them stands for all such files below it."""
    ship_package(spark)

    def read(batches):
        system, base = file_system(uri)

        def files(name):
            if ending is None:
                return [name]
            if system.get_file_info(f"{base}/{name}").is_file:
                return [name]
            found = system.get_file_info(fs.FileSelector(f"{base}/{name}", recursive=True))
            below = [(e.path[len(base) + 1:], e) for e in found if e.is_file]
            below = [(n, e) for n, e in below if not any(_hidden(p) for p in n.split("/")) and n.endswith(ending)]
            if any(e.size > SMALL_BYTES or _PACKED.search(n) for n, e in below):
                raise ValueError(_NOT_SMALL)
            return [n for n, _ in below]

        def batch(values, paths, counts, numbers):
            of = pa.array([i for i, n in enumerate(counts) for _ in range(n)], pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array(paths, pa.string()).take(of), pa.array(numbers, pa.int64())],
                                              ["value", "file_path", "number"])

        values, paths, counts, numbers = [], [], [], []
        for given in batches:
            for entry in given.column(0).to_pylist():
                for name in files(entry):
                    with system.open_input_file(f"{base}/{name}") as f:
                        data = f.read()
                    data = data.removeprefix(b"\xef\xbb\xbf")
                    if b"\r" in data:
                        data = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
                    lines = data.removesuffix(b"\n").split(b"\n") if data else []
                    values += lines
                    paths.append(_written(f"{uri}/{name}"))
                    counts.append(len(lines))
                    numbers += range(len(lines))
                    if len(values) >= _BATCH_LINES:
                        yield batch(values, paths, counts, numbers)
                        values, paths, counts, numbers = [], [], [], []
        if values:
            yield batch(values, paths, counts, numbers)

    width = max(spark.sparkContext.defaultParallelism, -(-len(names) // FILES_PER_TASK))
    table = spark.createDataFrame(pa.table({"name": pa.array(names, pa.string())})).repartition(width, "name")
    lines = kept(table.mapInArrow(read, "value binary, file_path string, number long"), "lines")
    return lines.select(F.col("value").cast("string").alias("value"), F.struct("file_path", F.col("number").alias("file_block_start")).alias("_metadata"))
