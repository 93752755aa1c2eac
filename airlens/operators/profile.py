"""Attribute profile: count, range, mean and population standard deviation.

All attributes are computed in ONE aggregation (partial aggregate per task,
one small exchange, final aggregate), then turned into one row per attribute
with ``inline``.  With ``group_by`` the same plan yields one profile per group;
the partial aggregate means a hot group costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROFILE_COLUMNS = ["attribute", "elements", "min", "max", "mean", "std"]


def profile_aggs(attributes: Sequence[str]) -> list:
    """``elements`` plus ``_min<i>, _max<i>, _mean<i>, _std<i>`` per attribute."""
    aggs = [F.count(F.lit(1)).alias("elements")]
    for i, a in enumerate(attributes):
        c = F.col(a).cast("double")
        aggs += [F.min(c).alias(f"_min{i}"), F.max(c).alias(f"_max{i}"),
                 F.avg(c).alias(f"_mean{i}"), F.stddev_pop(c).alias(f"_std{i}")]
    return aggs


def wide_columns(n: int) -> list[str]:
    return ["elements"] + [f"_{k}{i}" for i in range(n) for k in ("min", "max", "mean", "std")]


def unpivot_profile(wide: DataFrame, labels: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide aggregate row(s) -> one row per attribute, via ``inline``."""
    rows = F.array(*[
        F.struct(F.lit(label).alias("attribute"), F.col(f"_min{i}").alias("min"),
                 F.col(f"_max{i}").alias("max"), F.col(f"_mean{i}").alias("mean"),
                 F.col(f"_std{i}").alias("std"))
        for i, label in enumerate(labels)])
    return wide.select(*keep, "elements", F.inline(rows)).select(*keep, *PROFILE_COLUMNS)


def profile(df: DataFrame, attributes: Sequence[str], labels: Sequence[str] | None = None,
            group_by: Sequence[str] = ()) -> DataFrame:
    """``(group_by..., attribute, elements, min, max, mean, std)``.

    ``std`` is the population standard deviation (one row -> 0.0).  An empty
    input (or an empty group) yields no rows at all, never a row of nulls.
    """
    labels = list(labels) if labels is not None else list(attributes)
    if len(labels) != len(attributes):
        raise ValueError("labels and attributes differ in length")
    wide = df.groupBy(*group_by).agg(*profile_aggs(attributes)).where(F.col("elements") > 0)
    return unpivot_profile(wide, labels, group_by)
