"""Least squares for several targets in one scan.

Every task reduces its rows to counts, means and centred cross products of features and targets (a
square matrix of their number), merged by Chan's formula in two steps: groups of tasks, then the groups on
the driver, which gets at most GROUPS small matrices. An eigendecomposition of the features' correlation
matrix shows its rank: directions without variance (weekday flags that sum to one, a measurement
given twice) are left out, which gives the coefficients of least norm among all that
predict best. Predictions are those of a separate fit for each target.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Matrices that reach the driver, and the share of the largest eigenvalue below which a direction has no variance.
GROUPS, TOLERANCE = 64, 1e-10


@dataclass
class LinearModels:
    features: list[str]
    targets: list[str]
    intercepts: np.ndarray       # by target
    coefficients: np.ndarray     # features x targets
    elements: int
    rank: int
    residuals: np.ndarray        # sum of squared errors by target

    def predict(self, df: DataFrame, prefix: str = "predicted_") -> DataFrame:
        """``df`` plus one native column ``<prefix><target>`` per target."""
        return df.select("*", *[self.expression(t).alias(prefix + t) for t in self.targets])

    def expression(self, target: str) -> Column:
        k = self.targets.index(target)
        out = F.lit(float(self.intercepts[k]))
        for f, c in zip(self.features, self.coefficients[:, k]):
            out = out + F.lit(float(c)) * F.col(f).cast("double")
        return out


def merge(parts) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, centred cross products) of all ``parts`` together."""
    n, mean, cross = 0.0, 0.0, 0.0
    for m, mu, c in parts:
        if not m:
            continue
        off = mu - mean if n else mu
        cross = c if not n else cross + c + np.outer(off, off) * (n * m / (n + m))
        mean = mu if not n else mean + off * (m / (n + m))
        n += m
    return n, mean, cross


def _frame(part) -> pd.DataFrame:
    n, mean, cross = part
    return pd.DataFrame({"n": [float(n)], "mean": [np.asarray(mean).tolist()], "cross": [np.asarray(cross).ravel().tolist()]})


def _parts(pdf: pd.DataFrame, d: int):
    return [(n, np.array(mu), np.array(c).reshape(d, d)) for n, mu, c in zip(pdf["n"], pdf["mean"], pdf["cross"])]


def moments(df: DataFrame, columns: Sequence[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """Counts, means and centred cross products of ``columns`` over all rows, in one job.
    A null or NaN is an error, as in a fit on assembled features."""
    columns, d = list(columns), len(columns)
    schema = "n double, mean array<double>, cross array<double>"

    def reduce_task(batches):
        state = (0.0, np.zeros(d), np.zeros((d, d)))
        for pdf in batches:
            x = pdf[columns].to_numpy(dtype="float64")
            if not len(x):
                continue
            if np.isnan(x).any():
                raise ValueError(f"null or NaN in {[c for c, bad in zip(columns, np.isnan(x).any(axis=0)) if bad]}")
            mu = x.mean(axis=0)
            state = merge([state, (float(len(x)), mu, (x - mu).T @ (x - mu))])
        if state[0]:
            yield _frame(state)

    def merge_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return _frame(merge(_parts(pdf, d)))

    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    tasks = data.mapInPandas(reduce_task, schema).withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    rows = tasks.groupBy("_g").applyInPandas(lambda pdf: merge_group(pdf), schema).toPandas()   # at most GROUPS
    return merge(_parts(rows, d))


def fit_all(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> LinearModels:
    """Least squares with intercept of every target on ``features``, in one scan of ``df``."""
    features, targets = list(features), list(targets)
    n, mean, cross = moments(df, [*features, *targets])
    if not n:
        raise ValueError("no rows to fit")
    f = len(features)
    xx, xy, yy = cross[:f, :f], cross[:f, f:], np.diag(cross)[f:]
    scale = np.sqrt(np.diag(xx))
    scale = np.where(scale > 0, scale, 1.0)
    values, vectors = np.linalg.eigh(xx / np.outer(scale, scale))
    kept = values > TOLERANCE * max(float(values.max()), 1e-300) * f
    inverse = (vectors[:, kept] / values[kept]) @ vectors[:, kept].T
    b = (inverse @ (xy / scale[:, None])) / scale[:, None]
    return LinearModels(features, targets, mean[f:] - mean[:f] @ b, b, int(n), int(kept.sum()), np.maximum(yy - (b * xy).sum(axis=0), 0.0))
