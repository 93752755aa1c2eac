"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens.session import scratch_path

#: Bytes of text that a worker handles at once inside a batch.
SLICE_BYTES = 3 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    cuts lineage, survives lost executors, and fixes non-deterministic columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, size: int, *key: str) -> DataFrame:
    """At most ``size`` rows, those with the smallest hashes of ``key``. Tasks pass on
    only rows below a bound that about twice as many are expected under, so what
    reaches the driver does not grow with the tasks."""
    n, span = df.count(), 1 << 40
    bound = span if n <= 2 * size else span * 2 * size // n
    keyed = df.withColumn("_h", F.pmod(F.xxhash64(*key), F.lit(span)))
    return keyed.where(F.col("_h") < bound).orderBy("_h").limit(size)


def most_frequent(counts: DataFrame, size: int):
    """About the ``size`` rows of (key, n) with the largest n, as Arrow; rows below an
    approximate quantile of n stay where they are."""
    counts = materialize(counts, "counts")
    rows = counts.count()
    if rows > size:
        edge = counts.agg(F.percentile_approx("n", 1 - size / rows, 1_000_000).alias("e")).first().e
        counts = counts.where(F.col("n") > edge)
    return counts.toArrow()


def lean(fn):
    """``fn`` for ``mapInArrow``, giving memory it has freed back to the system after each batch and at its
    end: Python workers outlive their tasks, and what their allocators keep is missing to the stages that follow."""
    def run(batches):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # of the GNU C library

        def give_back():
            pa.default_memory_pool().release_unused()
            if trim is not None:
                trim(0)

        def fed():
            for batch in batches:
                yield batch
                del batch
                give_back()

        yield from fn(fed())
        give_back()

    return run


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_path(name: str) -> str:
    """Default place of a public vocabulary file (a parameter everywhere it is used)."""
    import public_tokenizers

    return public_tokenizers.path(name) if not os.path.isabs(name) else name


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Consecutive slices of ``batch`` of about ``limit`` bytes of ``column`` (one row at least)."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(size) - size) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(bounds, bounds[1:]):
        yield batch.slice(a, b - a)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + length)."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    kind = np.int32 if total < 2 ** 31 and (len(starts) == 0 or int(starts.max()) < 2 ** 31) else np.int64
    before = np.cumsum(lengths) - lengths
    return np.repeat((starts - before).astype(kind), lengths) + np.arange(total, dtype=kind)


def crc32_u32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes()) & 0xFFFFFFFF


def source_key(column: str = "source"):
    """A null source is a source of its own."""
    return F.coalesce(F.col(column), F.lit(""))


def crc32_sql(column: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an integer column's decimal text."""
    bits = "lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END"
    one = f"lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [b::BIGINT FOR b IN range(8)]), {bits})"
    text = f"[ascii(c)::BIGINT FOR c IN string_split({column}::VARCHAR, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {text}), {one}), 4294967295::BIGINT)"
