"""Training job: both regressors for one target pollutant, saved for scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.regression import (feature_label, fit_linear, load_linear, load_pa, pa_fit, pa_weights_frame,
                                    save_linear, save_pa, shard_of, target_index)
from ..schemas import FEATURES
from ..sources.records import read_merged

MODELS = ("pa", "linear")


def train(merged: DataFrame, k, *, models: Sequence[str] = MODELS, pa_path: str | None = None,
          linear_path: str | None = None, epochs: int = 1, order: Sequence[str] = ("sensor_id", "Timestamp"),
          shards: int = 64, init: DataFrame | None = None) -> dict:
    """Fit the requested models on ``merged`` for target ``k`` (0..4).

    The passive-aggressive model is trained by parameter mixing over
    ``shards`` shards (a hash of ``sensor_id``, so one sensor is folded in one
    place) with rows ordered by ``order`` and all columns inside a shard; it
    does not depend on how the input is split.  ``init``: the weights table of
    an earlier call to go on from.  The linear model is Spark ML's.  Returns ``{"pa": weights DataFrame,
    "linear": LinearRegressionModel}`` and saves them when paths are given.
    """
    k = target_index(k)
    unknown = set(models) - set(MODELS)
    if unknown:
        raise ValueError(f"unknown models {sorted(unknown)}")
    keep = [c for c in order if c in merged.columns]
    data = feature_label(merged, k, keep=keep)
    out: dict = {}
    if "pa" in models:
        start = init.select("w", "b").first() if init is not None else None
        shard = shard_of(["sensor_id"], shards) if "sensor_id" in keep else shard_of([*FEATURES, "label"], shards)
        ordered = data.select(*data.columns, *[F.col(c).alias(f"_o{i}") for i, c in enumerate([*FEATURES, "label"])])
        w, b, n = pa_fit(ordered, FEATURES, order=[*keep, *[f"_o{i}" for i in range(len(FEATURES) + 1)]], shard=shard,
                         epochs=epochs, init=None if start is None else (start["w"], start["b"]))
        out["pa"] = pa_weights_frame(merged.sparkSession, w, b, n)
        if pa_path:
            save_pa(out["pa"], pa_path)
    if "linear" in models:
        out["linear"] = fit_linear(data, FEATURES)
        if linear_path:
            save_linear(out["linear"], linear_path)
    return out


def train_files(spark: SparkSession, merged_path: str, k, pa_path: str, linear_path: str, format: str = "csv",
                **kw) -> dict:
    """``train`` on merged files: what ``write_merged`` wrote (text or parquet)
    or a flat folder of ``merged<id>.csv`` files."""
    return train(read_merged(spark, merged_path, format=format), k, pa_path=pa_path, linear_path=linear_path, **kw)


def load_models(spark: SparkSession, pa_path: str | None = None, linear_path: str | None = None) -> dict:
    out: dict = {}
    if pa_path:
        out["pa"] = load_pa(spark, pa_path)
    if linear_path:
        out["linear"] = load_linear(linear_path)
    return out
