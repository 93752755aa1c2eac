"""Passive-aggressive training on a stream.

The weights of every entity (sensor) are keyed state: a micro-batch's rows of an entity are sorted
and folded on top of them, and the new weights are written with the batch. Offsets and state are in the
checkpoint, so a restarted query goes on with the weights it had; a retried batch replaces its own
rows. As long as batches arrive in the order of ``order``, the weights after any batch are those of the
sequential fold over all rows so far (:func:`airlens.operators.regression.pa_fit_groups`).

A call of the fold costs milliseconds however few rows it gets, so entities are dealt to ``buckets`` by a hash
and a call folds all entities of a bucket, whose weights are one value of the state. Like the state's
partitions, the number of buckets stays with a checkpoint.

Memory: a task holds the rows of one bucket in one batch, which the source's pace bounds, and the bucket's weights.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.regression import PA_C, PA_EPSILON, _fold_batch
from ..schemas import FEATURES
from ..sinks.results import BLOCK, write_batch_files
from .report import _trigger, start


#: Buckets that entities are dealt to: few, as each costs a call in every batch, but several per core.
BUCKETS = 256


def _packed(names, w: np.ndarray, b: np.ndarray, n: np.ndarray) -> bytes:
    """The weights of a bucket's entities as one value."""
    table = pa.table({"name": pa.array(names, pa.string(), from_pandas=True), "w": pa.array(w.tolist(), pa.list_(pa.float64())), "b": b, "n": n})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table = pa.ipc.open_stream(bytes(value)).read_all()
    w = table["w"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), width)
    return table["name"].to_pandas().to_numpy(dtype=object), w, table["b"].to_numpy(), table["n"].to_numpy()


def stream_weights(records: DataFrame, entity: str, order: Sequence[str], features: Sequence[str] = FEATURES, label: str = "label",
                   c: float = PA_C, epsilon: float = PA_EPSILON, buckets: int = BUCKETS) -> DataFrame:
    """Streaming ``(entity, w, b, n)``: the weights of each entity that a micro-batch changed."""
    features, order = list(features), [o for o in order if o != entity]
    kind, width = records.schema[entity].dataType.simpleString(), len(features)

    def fold(key, frames, state):
        rows = list(frames)
        rows = rows[0] if len(rows) == 1 else pd.concat(rows, ignore_index=True)
        known, w, b, n = _unpacked(state.get[0], width) if state.exists else (np.empty(0, object), np.empty((0, width)), np.empty(0), np.empty(0, np.int64))
        codes, names = pd.factorize(np.concatenate([known, rows["_entity"].to_numpy(dtype=object)]), use_na_sentinel=False)   # a null is an entity too
        new = len(names) - len(known)
        w, b, n = np.vstack([w, np.zeros((new, width))]), np.append(b, np.zeros(new)), np.append(n, np.zeros(new, np.int64))
        rows = rows.assign(_code=codes[len(known):]).sort_values(["_code", *order], kind="stable")
        codes = rows["_code"].to_numpy()
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        sizes, met = np.diff(np.append(first, len(codes))), codes[first]
        now_w, now_b = w[met], b[met]
        _fold_batch(rows[features].to_numpy(dtype="float64"), rows[label].to_numpy(dtype="float64"), first, sizes, now_w, now_b, c, epsilon)
        w[met], b[met] = now_w, now_b
        n[met] += sizes
        state.update((_packed(names, w, b, n),))
        yield pd.DataFrame({"_entity": np.asarray(names, dtype=object)[met], "w": now_w.tolist(), "b": now_b, "n": n[met]})

    dealt = records.select(F.pmod(F.xxhash64(entity), F.lit(int(buckets))).cast("int").alias("_bucket"), F.col(entity).cast("string").alias("_entity"),
                           *order, *features, label)
    weights = dealt.groupBy("_bucket").applyInPandasWithState(fold, "_entity string, w array<double>, b double, n long", "weights binary",
                                                              "update", GroupStateTimeout.NoTimeout)
    return weights.select(F.col("_entity").cast(kind).alias(entity), "w", "b", "n")


def stream_pa_fit(records: DataFrame, target: str, checkpoint: str, entity: str, order: Sequence[str], features: Sequence[str] = FEATURES,
                  label: str = "label", *, c: float = PA_C, epsilon: float = PA_EPSILON, trigger=None, partitions="auto",
                  buckets: int = BUCKETS) -> StreamingQuery:
    """Train on ``records`` and add each batch's changed weights to ``target`` (read with :func:`latest_weights`)."""
    weights = stream_weights(records, entity, order, features, label, c, epsilon, buckets)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.select("*", F.lit(batch_id).cast("long").alias("batch_id"), F.lit(batch_id // BLOCK).cast("long").alias("batch_block"))
        write_batch_files(tagged, target, batch_id, "batch_block", single=False)

    w = weights.writeStream.outputMode("update").foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return start(_trigger(w, trigger), records.sparkSession, partitions)


def latest_weights(spark: SparkSession, target: str, entity: str) -> DataFrame:
    """``(entity, w, b, n)``: every entity's newest weights, as ``predict_pa`` takes them."""
    rows = spark.read.parquet(target)
    return rows.groupBy(entity).agg(F.max_by(F.struct("w", "b", "n"), "batch_id").alias("m")).select(entity, "m.*")
