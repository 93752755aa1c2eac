"""Operator 1: token ids in compressed files with short-document access.

``write_tokens`` encodes every document, appends an end id and writes shards in
ascending doc_id order: a Parquet folder whose rows are shards of
about ``shard_bytes`` of raw ids. A shard holds one zstandard frame per document
(so one document is read without the others), the frames' end offsets, and
the hash of the dictionary they need; the dictionary itself, trained on
serialized id arrays, is a one-row table beside the shards. ``read_tokens``
turns shards back into one row per document; ``read_document`` reads one.

Encoding runs inside the range-partitioned, sorted tasks: one shuffle of the
texts, no shuffle of ids. A document's start is the sum of the partitions before
(one total per partition, at most ``spark.sql.shuffle.partitions`` rows), of
the shards before it in its partition (kept in each shard) and of the
documents before it in its shard.

Defined cases: null or empty text gives the end id alone; rows with a null
doc_id come first; repeated doc_ids are written once per row, ordered by a hash
of the text;
other columns are ignored; an empty table gives empty files.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from airlens.llm.chunks import ChunkEncoder
from airlens.llm.common import crc32_u32, hash_sample, slices, width
from airlens.session import scratch_path

SHARD_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("dict_hash", T.StringType()),
    T.StructField("tokens_before", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("payload", T.BinaryType()),
])
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: The dictionary is trained on the first ids of so many documents (chosen by hash) and has at most so many bytes.
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 512, 8192, 65536


def serialize(ids: np.ndarray) -> bytes:
    """Little-endian, two bytes per id where all ids allow it; the first byte is the width."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return (b"\x04" if wide else b"\x02") + ids.astype("<u4" if wide else "<u2").tobytes()


def deserialize(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if raw[0] == 4 else "<u2", offset=1).astype(np.uint32)


def train_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """A zstandard dictionary from a bounded sample; empty where there is too little to train on."""
    import zstandard

    some = hash_sample(docs.select("doc_id", "text"), SAMPLE_DOCS, "doc_id").where("text is not null and text <> ''")
    rows = some.select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).collect()
    enc = ChunkEncoder(path)
    samples = []
    for r in rows:
        ids, _ = enc.encode(pa.array([r.text], pa.string()))
        samples.append(serialize(np.append(ids, end_id).astype(np.uint32)))
    total = sum(map(len, samples))
    if len(samples) < 16 or total < 8192:
        return b""
    return zstandard.train_dictionary(min(DICT_BYTES, max(1024, total // 8)), samples).as_bytes()


def write_tokens(docs: DataFrame, out: str, path: str, end_id: int, shard_bytes: int = 1 << 20) -> str:
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, path, end_id)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary") \
        .coalesce(1).write.parquet(f"{out}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)   # DICT_BYTES at most

    def encode(batches):
        import zstandard
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = ChunkEncoder(path)
        d = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        pack = zstandard.ZstdCompressor(level=1, dict_data=d)
        shard, before = 0, 0
        ids_of, ends, frames, tokens, raw = [], [], [], 0, 0

        def flush():
            nonlocal shard, before, ids_of, ends, frames, tokens, raw
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "dict_hash": [dict_hash],
                "tokens_before": [before], "n_tokens": [tokens],
                "doc_ids": pa.array([ids_of], pa.list_(pa.int64())), "ends": pa.array([ends], pa.list_(pa.int64())),
                "payload": pa.array([b"".join(frames)], pa.binary())})
            shard, before = shard + 1, before + tokens
            ids_of, ends, frames, tokens, raw = [], [], [], 0, 0
            return row

        for batch in batches:
            for piece in slices(batch, "text"):
                ids, off = enc.encode(piece.column("text"))
                for k, doc_id in enumerate(piece.column("doc_id").to_pylist()):
                    own = np.append(ids[off[k]:off[k + 1]], np.uint32(end_id))
                    frame = pack.compress(serialize(own))
                    ids_of.append(doc_id)
                    frames.append(frame)
                    ends.append((ends[-1] if ends else 0) + len(frame))
                    tokens += len(own)
                    raw += 4 * len(own)
                    if raw >= shard_bytes:
                        yield flush()
        if ids_of:
            yield flush()

    key = [F.col("doc_id"), F.xxhash64("text")]   # rows of one repeated doc_id can be told apart, too
    (docs.select("doc_id", F.col("text"))
         .repartitionByRange(width(spark), *key).sortWithinPartitions(*key)
         .mapInArrow(encode, SHARD_SCHEMA).write.parquet(f"{out}/shards"))
    return out


def _dictionary(spark: SparkSession, out: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{out}/dictionary").collect()[0]
    return row.dict_hash, bytes(row.dictionary)


def open_frames(dict_hash: str, dictionary: bytes):
    """A function from a shard's (dict_hash, payload slice) to ids; refuses another dictionary."""
    import zstandard

    if hashlib.sha256(dictionary).hexdigest() != dict_hash:
        raise ValueError("the dictionary does not have the hash the files name")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(shard_hash: str, frame) -> np.ndarray:
        if shard_hash != dict_hash:
            raise ValueError(f"shard needs dictionary {shard_hash}, not {dict_hash}")
        return deserialize(unpack.decompress(frame))
    return ids


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    dict_hash, dictionary = _dictionary(spark, out)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{out}/shards")
    totals = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base, run = {}, 0
    for part, n in totals:   # one number per write task
        base[part], run = run, run + n
    shared = spark.sparkContext.broadcast((base, dictionary))

    def decode(batches):
        base, dictionary = shared.value
        open_ids = open_frames(dict_hash, dictionary)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                part, own_hash, before = (row.column(c)[0].as_py() for c in ("part", "dict_hash", "tokens_before"))
                payload = row.column("payload")[0].as_buffer()
                doc_ids, ends = row.column("doc_ids")[0].as_py(), row.column("ends")[0].as_py()
                start, at, rows = base[part] + before, 0, []
                for doc_id, end in zip(doc_ids, ends):
                    ids = open_ids(own_hash, payload.slice(at, end - at))
                    rows.append((doc_id, start, len(ids), crc32_u32(ids)))
                    start, at = start + len(ids), end
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "dict_hash", "tokens_before", "doc_ids", "ends", "payload").mapInArrow(decode, DOC_SCHEMA)


def read_document(spark: SparkSession, out: str, doc_id: int) -> list[list[int]]:
    """Ids of the rows with this doc_id: one shard row is fetched per hit and only its frames are opened."""
    dict_hash, dictionary = _dictionary(spark, out)
    open_ids = open_frames(dict_hash, dictionary)
    found = []
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{out}/shards")
    for r in (shards.where(F.array_contains("doc_ids", F.lit(doc_id).cast("long"))).orderBy("part", "shard")
                    .select("dict_hash", "doc_ids", "ends", "payload").toLocalIterator()):
        for k, own in enumerate(r.doc_ids):
            if own == doc_id:
                found.append(open_ids(r.dict_hash, bytes(r.payload[r.ends[k - 1] if k else 0:r.ends[k]])).tolist())
    return found


def encode_table(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write the files under the shared checkpoint folder and read them back."""
    out = write_tokens(docs, scratch_path(docs.sparkSession, "tokens"), path, end_id)
    return read_tokens(docs.sparkSession, out)
