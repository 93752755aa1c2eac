"""Pairing sensor files and aligning two time series of one sensor.

``first_group``  keeps, per entity, only the rows of its first source group
                 (e.g. the first traffic file listed for a sensor id).
``align_on_time`` is the equi join on ``(entity, ts)`` of two ascending series
                 in which duplicate timestamps pair k-th with k-th: each side
                 numbers its rows inside ``(entity, ts)`` and the join key
                 includes that number, so a timestamp present a times on the
                 left and b times on the right gives min(a, b) pairs, never a*b.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import rank_within


def first_group(df: DataFrame, entity: str | Sequence[str], group_col: str) -> DataFrame:
    """Rows of ``df`` whose ``group_col`` is the smallest for their entity.

    The per-entity minimum is a partial aggregate (one row per entity) joined
    back with a semi join; AQE broadcasts it when its runtime size is small
    and splits skewed partitions otherwise.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    first = df.groupBy(*entity).agg(F.min(group_col).alias(group_col))
    return df.join(first, [*entity, group_col], "left_semi")


def pair_first(left: DataFrame, right: DataFrame, entity: str | Sequence[str], group_col: str) -> DataFrame:
    """Inner join of ``left`` with the first ``group_col`` group of ``right``
    per entity; left rows without a partner disappear."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    return left.join(first_group(right, entity, group_col), entity, "inner")


def align_on_time(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence,
                  right_order: Sequence, k: str = "_k", small_groups: bool = False,
                  left_group: Sequence[str] = ()) -> DataFrame:
    """Join ``left`` and ``right`` on ``keys`` pairing duplicates by position.

    ``left_order`` / ``right_order`` state the order of duplicates on each side
    (file position in the reference).  Non-key column names must not clash.
    Rows without a partner at the same key and position are dropped, and so
    are rows with a null key (they have no partner).  ``small_groups``: no key
    has many rows, so a plain window numbers them (see :func:`rank_within`).
    ``left_group``: columns that split the left side into series (files) of
    their own, each of which is aligned with the whole right side.
    """
    keys = list(keys)
    left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    lr = rank_within(left, [*keys, *left_group], left_order, out=k, small_groups=small_groups)
    rr = rank_within(right, keys, right_order, out=k, small_groups=small_groups)
    return lr.join(rr, [*keys, k], "inner")
