"""Regression models on the merged table.

* ordinary least squares: Spark ML ``LinearRegression`` with library defaults;
* passive-aggressive regression (PA-I, epsilon-insensitive; Crammer et al.,
  JMLR 7, 2006) which Spark ML lacks:

  ``err = y - (w.x + b)``, ``loss = max(0, |err| - epsilon)``,
  ``tau = min(C, loss / (|x|^2 + 1))``, ``w += tau*sign(err)*x``,
  ``b += tau*sign(err)`` (the bias is a constant-1 feature).

  The update is sequential by definition.  ``pa_fit`` trains one global model
  by iterative parameter mixing (McDonald et al., NAACL 2010): every shard
  (a stated expression of the row) folds its rows from the current weights,
  Spark averages the shards' weights by row count (the driver receives one
  row), and the next epoch starts from the average.  With one shard and one
  epoch it is exactly the sequential fold.  ``pa_fit_groups`` runs one exact
  sequential fold per entity, or shards and mixes every entity on request.

Predictions of both models are native column expressions; nothing is
collected per row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURES, LABELS

PA_C = 1.0
PA_EPSILON = 0.1


# --- features and label ------------------------------------------------------
def target_index(k) -> int:
    """Validate the target pollutant index (0..4)."""
    if isinstance(k, bool) or not isinstance(k, int):
        try:
            k = int(str(k), 10)
        except ValueError:
            raise ValueError(f"target index must be an integer 0..4, got {k!r}") from None
    if not 0 <= k < len(LABELS):
        raise ValueError(f"target index must be in 0..{len(LABELS) - 1}, got {k}")
    return k


def feature_label(df: DataFrame, k, features: Sequence[str] = FEATURES, labels: Sequence[str] = LABELS,
                  keep: Sequence[str] = ()) -> DataFrame:
    """``keep..., <features as double>, label`` for target ``labels[k]``."""
    k = target_index(k)
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features],
                     F.col(labels[k]).cast("double").alias("label"))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


# --- ordinary least squares --------------------------------------------------
def fit_linear(df: DataFrame, features: Sequence[str] = FEATURES, label: str = "label") -> LinearRegressionModel:
    """Spark ML linear regression, defaults (intercept, no regularisation)."""
    return LinearRegression(featuresCol="features", labelCol=label).fit(assemble(df, features))


def predict_linear(model: LinearRegressionModel, df: DataFrame, features: Sequence[str] = FEATURES,
                   out: str = "linear_prediction") -> DataFrame:
    return (model.transform(assemble(df, features, "_features_")
                            .withColumnRenamed("_features_", model.getFeaturesCol()))
            .drop(model.getFeaturesCol()).withColumnRenamed(model.getPredictionCol(), out))


def linear_coefficients(model: LinearRegressionModel, features: Sequence[str]) -> dict[str, float]:
    out = {"intercept": float(model.intercept)}
    out.update({f"coef_{f}": float(c) for f, c in zip(features, model.coefficients.toArray())})
    return out


def save_linear(model: LinearRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_linear(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


# --- passive-aggressive --------------------------------------------------------
def pa_step(w: list[float], b: float, x: Sequence[float], y: float, c: float = PA_C,
            epsilon: float = PA_EPSILON) -> tuple[list[float], float]:
    """One PA-I update; returns the new ``(w, b)``."""
    pred = 0.0
    sq = 0.0
    for wi, xi in zip(w, x):
        pred += wi * xi
        sq += xi * xi
    pred += b
    err = y - pred
    loss = max(0.0, abs(err) - epsilon)
    if loss == 0.0:
        return w, b
    step = min(c, loss / (sq + 1.0)) * (1.0 if err > 0 else -1.0)
    return [wi + step * xi for wi, xi in zip(w, x)], b + step


def _fold_batch(xs: np.ndarray, ys: np.ndarray, starts: np.ndarray, sizes: np.ndarray, w: np.ndarray, b: np.ndarray,
                c: float, epsilon: float) -> None:
    """Fold the rows of several groups into ``w`` and ``b`` (one row per group,
    changed in place): step j of all groups at once while many have a j-th
    row, then the few long groups one by one.  Both take the same operations
    in the same order as :func:`pa_step`."""
    live = np.argsort(-sizes, kind="stable")
    j = 0
    while len(live) >= 16:
        at = starts[live] + j
        x, y = xs[at], ys[at]
        pred, sq = np.zeros(len(live)), np.zeros(len(live))
        for i in range(xs.shape[1]):
            pred += w[live, i] * x[:, i]
            sq += x[:, i] * x[:, i]
        err = y - (pred + b[live])
        step = np.minimum(c, np.maximum(0.0, np.abs(err) - epsilon) / (sq + 1.0)) * np.where(err > 0, 1.0, -1.0)
        hit = np.abs(err) > epsilon
        w[live[hit]] += step[hit, None] * x[hit]
        b[live[hit]] += step[hit]
        j += 1
        live = live[sizes[live] > j]
    for g in live.tolist():
        gw, gb = w[g].tolist(), float(b[g])
        for at in range(int(starts[g]) + j, int(starts[g] + sizes[g])):
            gw, gb = pa_step(gw, gb, xs[at].tolist(), float(ys[at]), c, epsilon)
        w[g], b[g] = gw, gb


def _fold_groups(data: DataFrame, groups: Sequence[str], order: Sequence[str], feats: list[str], label: str,
                 c: float, epsilon: float) -> DataFrame:
    """Sequential PA fold per ``groups`` value over rows clustered by the
    groups and sorted by ``order``: ``(groups..., w, b, n)``.  A group starts
    from its columns ``_w0``, ``_b0``.  Null keys form a group."""
    groups = list(groups)
    data = (data.select(*groups, *order, *feats, label, "_w0", "_b0").repartition(*groups)
            .sortWithinPartitions(*groups, *order)
            .withColumn("_key", F.to_json(F.struct(*groups)))   # one comparable key, nulls included
            .select("_key", *groups, *feats, label, "_w0", "_b0"))
    schema = ", ".join(f"{g} {data.schema[g].dataType.simpleString()}" for g in groups)

    def fold(batches):
        last = None   # (key, group values, w, b, n) of the group that may go on in the next batch

        def emit(rows):
            cols = {g: pd.Series([r[1][i] for r in rows], dtype=object) for i, g in enumerate(groups)}
            cols.update({"w": [list(map(float, r[2])) for r in rows], "b": [float(r[3]) for r in rows],
                         "n": [int(r[4]) for r in rows]})
            return pd.DataFrame(cols)

        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf["_key"].to_numpy(dtype=object)
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            sizes = np.diff(np.append(first, len(keys)))
            xs, ys = pdf[feats].to_numpy(dtype="float64"), pdf[label].to_numpy(dtype="float64")
            w = np.array([list(v) for v in pdf["_w0"].iloc[first]], dtype="float64").reshape(len(first), len(feats))
            b = pdf["_b0"].iloc[first].to_numpy(dtype="float64").copy()
            done = np.zeros(len(first), dtype=np.int64)
            if last is not None and last[0] == keys[0]:
                w[0], b[0], done[0] = last[2], last[3], last[4]
            elif last is not None:
                yield emit([last])
            _fold_batch(xs, ys, first, sizes, w, b, c, epsilon)
            values = list(zip(*[pdf[g].iloc[first].astype(object).where(pdf[g].iloc[first].notna(), None).tolist()
                                for g in groups]))
            rows = [(keys[at], values[i], w[i], b[i], done[i] + sizes[i]) for i, at in enumerate(first.tolist())]
            if len(rows) > 1:
                yield emit(rows[:-1])
            last = rows[-1]
        if last is not None:
            yield emit([last])

    return data.mapInPandas(fold, f"{schema}, w array<double>, b double, n long")


def _mix(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-weighted average of shard models per ``keys`` (one model without keys)."""
    keys = list(keys)

    def mean(c):   # one shard's model stays as it is
        return F.when(F.count(F.lit(1)) == 1, F.max(c)).otherwise(F.sum(F.col(c) * F.col("n")) / F.sum("n"))

    per_i = (parts.select(*keys, "n", F.posexplode("w").alias("i", "wi"))
             .groupBy(*keys, "i").agg(mean("wi").alias("wi")))
    w = (per_i.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "wi"))).alias("_w"))
         .select(*keys, F.col("_w.wi").alias("w")))
    bn = parts.groupBy(*keys).agg(mean("b").alias("b"), F.sum("n").alias("n"))
    if not keys:
        return w.crossJoin(bn)   # one row each
    bn = bn.select(*[F.col(k).alias(f"_{k}") for k in keys], "b", "n")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return w.join(bn, same).select(*keys, "w", "b", "n")


def shard_of(columns: Sequence[str], shards: int) -> Column:
    """The stated shard of a row: a hash of its ``columns``, whatever partition it is read in."""
    return F.pmod(F.xxhash64(*columns), F.lit(int(shards))).cast("int")


def pa_fit(df: DataFrame, features: Sequence[str] = FEATURES, label: str = "label", *,
           order: Sequence[str] = (), shard: Column | None = None, epochs: int = 1,
           init: tuple[Sequence[float], float] | None = None, c: float = PA_C,
           epsilon: float = PA_EPSILON) -> tuple[list[float], float, int]:
    """Global PA model by iterative parameter mixing; returns ``(w, b, n)``.

    Rows are dealt to shards by the expression ``shard`` (``shard_of`` makes
    one; without it there is one shard, which is the plain sequential fold)
    and folded per shard in the order of ``order``, so the model depends on the
    rows, ``shard`` and ``order`` only, not on how the input is split.
    ``init``: weights of an earlier call to go on from.
    """
    feats = list(features)
    w, b, n = ([0.0] * len(feats), 0.0, 0) if init is None else (list(map(float, init[0])), float(init[1]), 0)
    if len(w) != len(feats):
        raise ValueError(f"init has {len(w)} weights for {len(feats)} features")
    data = df.select(*order, *feats, label, (F.lit(0) if shard is None else shard).alias("_shard"))
    if epochs > 1:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(epochs):
            start = data.withColumn("_w0", F.array(*[F.lit(v) for v in w])).withColumn("_b0", F.lit(b))
            parts = _fold_groups(start, ["_shard"], order, feats, label, c, epsilon).persist(StorageLevel.MEMORY_AND_DISK)
            try:   # one row per shard, averaged by Spark; the driver receives one row
                row = _mix(parts, []).first()
            finally:
                parts.unpersist()
            if row is None or not row["n"]:
                break
            w, b, n = list(row["w"]), row["b"], row["n"]
    finally:
        if epochs > 1:
            data.unpersist()
    return w, b, n


PA_METHODS = ("sequential", "mixed")


def pa_fit_groups(df: DataFrame, entity: str, order: Sequence[str], features: Sequence[str] = FEATURES,
                  label: str = "label", c: float = PA_C, epsilon: float = PA_EPSILON,
                  method: str = "sequential", shards: int = 16, init: DataFrame | None = None) -> DataFrame:
    """One PA model per entity: ``(entity, w, b, n)``.

    ``method="sequential"`` is the exact fold of every entity's rows in the
    order of ``order``: rows are clustered by entity, sorted, and streamed
    carrying only open weights (memory O(features), never a whole group); an
    entity is one task's work by definition.  ``method="mixed"`` deals the rows
    of every entity to ``shards`` shards by a hash of the ``order`` columns,
    folds those in parallel and averages them by rows: another algorithm, for
    callers with huge entities.  The caller chooses; no size does.

    ``init``: a weights table ``(entity, w, b)`` of an earlier call; entities
    without a row in it start from zero.
    """
    if method not in PA_METHODS:
        raise ValueError(f"method must be one of {PA_METHODS}, got {method!r}")
    feats = list(features)
    data = df.select(entity, *order, *feats, label)
    zero = F.array(*[F.lit(0.0) for _ in feats])
    if init is None:
        data = data.withColumn("_w0", zero).withColumn("_b0", F.lit(0.0))
    else:
        old = init.select(F.col(entity).alias("_entity"), F.col("w").alias("_w"), F.col("b").alias("_b"))
        data = (data.join(old, F.col(entity).eqNullSafe(F.col("_entity")), "left")
                    .withColumn("_w0", F.coalesce("_w", zero)).withColumn("_b0", F.coalesce("_b", F.lit(0.0))))
    if method == "sequential":
        return _fold_groups(data, [entity], order, feats, label, c, epsilon)
    data = data.withColumn("_shard", shard_of(order, shards))
    return _mix(_fold_groups(data, [entity, "_shard"], order, feats, label, c, epsilon), [entity])


def pa_weights_frame(spark, w: Sequence[float], b: float, n: int) -> DataFrame:
    """The global model as a one-row table (what gets saved and loaded)."""
    return spark.createDataFrame([(list(map(float, w)), float(b), int(n))], "w array<double>, b double, n long")


def pa_expression(w: Sequence[float] | Column, b: float | Column, features: Sequence[str]) -> Column:
    """``w.x + b`` as a native expression (literal weights or weight columns)."""
    acc = F.lit(0.0)
    for i, f in enumerate(features):
        wi = F.element_at(w, i + 1) if isinstance(w, Column) else F.lit(float(w[i]))
        acc = acc + wi * F.col(f)
    return acc + (b if isinstance(b, Column) else F.lit(float(b)))


def predict_pa(df: DataFrame, weights: DataFrame, features: Sequence[str] = FEATURES, entity: str | None = None,
               out: str = "pa_prediction") -> DataFrame:
    """Apply PA weights: per-entity weights are equi-joined on ``entity``
    (AQE broadcasts them when small); a global one-row model is read once
    (its size is the feature count) and inlined as literals."""
    if entity is None:
        row = weights.select("w", "b").first()
        return df.withColumn(out, pa_expression(row["w"], row["b"], features))
    wt = weights.select(entity, F.col("w").alias("_w"), F.col("b").alias("_b"))
    return (df.join(wt, entity, "left")
            .withColumn(out, pa_expression(F.col("_w"), F.col("_b"), features)).drop("_w", "_b"))


def save_pa(weights: DataFrame, path: str) -> None:
    weights.write.mode("overwrite").parquet(path)


def load_pa(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- evaluation --------------------------------------------------------------
def rmse(label: str | Column, prediction: str | Column) -> Column:
    """Root mean squared error aggregate."""
    lab = F.col(label) if isinstance(label, str) else label
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.sqrt(F.avg(F.pow(lab - pred, F.lit(2.0))))


def compare(scored: DataFrame, label: str = "label",
            predictions: Sequence[str] = ("pa_prediction", "linear_prediction"),
            group_by: Sequence[str] = ()) -> DataFrame:
    """``elements`` and one ``rmse_<model>`` per prediction column, in one
    aggregation (optionally per group, e.g. per micro-batch)."""
    aggs = [F.count(F.lit(1)).alias("elements")]
    aggs += [rmse(label, p).alias("rmse_" + p.replace("_prediction", "")) for p in predictions]
    return scored.groupBy(*group_by).agg(*aggs).where(F.col("elements") > 0)


def comparison_lines(scored: DataFrame, label: str = "label",
                     predictions: Sequence[str] = ("pa_prediction", "linear_prediction"),
                     keep: Sequence[str] = ()) -> DataFrame:
    """Per-row text ``Real: %10f<TAB>PA: %10f<TAB>Linear: %10f`` (a column
    ``line``; rows are rendered by the executors, nothing is collected)."""
    names = {"pa_prediction": "PA", "linear_prediction": "Linear"}
    fmt = "\t".join(["Real: %10f"] + [f"{names.get(p, p)}: %10f" for p in predictions])
    return scored.select(*keep, F.format_string(fmt, F.col(label), *[F.col(p) for p in predictions]).alias("line"))


def rmse_lines(summary: DataFrame, predictions: Sequence[str] = ("pa_prediction", "linear_prediction"),
               keep: Sequence[str] = ()) -> DataFrame:
    """``<model> - Root mean squared error: <value>`` rows from :func:`compare`."""
    names = {"pa_prediction": "PA", "linear_prediction": "Linear"}
    rows = F.array(*[F.concat(F.lit(f"{names.get(p, p)} - Root mean squared error: "),
                              F.col("rmse_" + p.replace("_prediction", "")).cast("string"))
                     for p in predictions])
    return summary.select(*keep, F.explode(rows).alias("line"))

