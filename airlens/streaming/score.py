"""Score a stream of merged records with both models, side by side.

Per micro-batch: decode the record lines (features and label only), add the
passive-aggressive prediction (a native expression over the weights) and the
Spark ML prediction (``model.transform``), then append

* the per-row comparison ``(batch_id, label, pa_prediction, linear_prediction)``
  when ``rows_target`` is given, and
* one ``(batch_id, elements, rmse_pa, rmse_linear)`` row per non-empty batch,

both as files named by the batch inside blocks of batches (the result table's
layout), so folders do not grow with batches.

Either model may be omitted (the "Spark model only" consumer).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.regression import compare, load_pa, predict_linear, predict_pa, save_pa
from ..schemas import FEATURES
from ..session import scratch_path
from ..sinks.results import BLOCK, write_batch_files
from .report import _trigger, start

WEIGHTS_BROADCAST_ROWS = 200_000   # 15 doubles each: about 30 MB at the limit


def score(records: DataFrame, linear: LinearRegressionModel | None = None, pa_weights: DataFrame | None = None,
          features: Sequence[str] = FEATURES, entity: str | None = None) -> DataFrame:
    """Add ``linear_prediction`` and/or ``pa_prediction`` columns."""
    out = records
    if pa_weights is not None:
        out = predict_pa(out, pa_weights, features, entity=entity)
    if linear is not None:
        out = predict_linear(linear, out, features)
    return out


def stream_score(records: DataFrame, target: str, checkpoint: str, *, linear: LinearRegressionModel | None = None,
                 pa_weights: DataFrame | None = None, features: Sequence[str] = FEATURES,
                 entity: str | None = None, rows_target: str | None = None, keep: Sequence[str] = (),
                 trigger=None, partitions="auto", unit: str | None = None) -> StreamingQuery:
    """Start scoring.  ``unit``: a column of numbers (those of the files); every unit of a
    micro-batch is compared on its own, and its ``batch_id`` is the unit's number."""
    if linear is None and pa_weights is None:
        raise ValueError("at least one model is required")
    preds = [p for p, m in (("pa_prediction", pa_weights), ("linear_prediction", linear)) if m is not None]
    if pa_weights is not None and entity is None:
        # a global model is one row of feature-count size: read it once
        row = pa_weights.select("w", "b").first()
        pa_weights = pa_weights.sparkSession.createDataFrame([(row["w"], row["b"])], "w array<double>, b double")
    elif pa_weights is not None:
        # every micro-batch plans anew: without the copy each would train the weights again
        saved = scratch_path(records.sparkSession, "stream-pa-weights")
        save_pa(pa_weights, saved)
        pa_weights = load_pa(records.sparkSession, saved)
        if pa_weights.count() <= WEIGHTS_BROADCAST_ROWS:
            # micro-batch plans are not re-planned adaptively: broadcast the
            # per-entity weights explicitly, but only after checking their size
            pa_weights = F.broadcast(pa_weights)
        else:
            # too large to broadcast: hash-partition the weights once, as wide as
            # the stream's shuffles, and keep them, so every micro-batch shuffles
            # only its own rows against an already partitioned side
            width = (records.sparkSession.sparkContext.defaultParallelism if partitions in (None, "auto")
                     else int(partitions))
            pa_weights = pa_weights.repartition(width, entity).persist()

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        number = F.col(unit) if unit else F.lit(batch_id)
        scored = score(batch, linear, pa_weights, features, entity).withColumn("batch_id", number.cast("long"))
        block = F.lit(batch_id // BLOCK).cast("long").alias("batch_block")
        if rows_target:
            scored = scored.persist()
        try:
            if rows_target:
                write_batch_files(scored.select("batch_id", *keep, "label", *preds, block), rows_target, batch_id,
                                  "batch_block", single=False)
            summary = compare(scored, "label", preds, group_by=["batch_id"])
            write_batch_files(summary.select("*", block), target, batch_id, "batch_block")
        finally:
            if rows_target:
                scored.unpersist()

    w = records.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return start(_trigger(w, trigger), records.sparkSession, partitions)
