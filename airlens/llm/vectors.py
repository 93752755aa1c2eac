"""Reading vectors in tasks, and what operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def dimension(rows: DataFrame) -> int:
    """The most frequent vector length (the smallest of several); 0 without vectors."""
    found = (rows.where("vec is not null and size(vec) > 0").groupBy(F.size("vec").alias("d"))
             .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect())
    return found[0].d if found else 0


def usable(vec: str, dim: int):
    """A condition: a vector of ``dim`` finite components that are not all zero."""
    c = F.col(vec)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return c.isNotNull() & (F.size(c) == dim) & F.forall(c, finite) & F.exists(c, lambda x: x != 0)


def prepared(embeddings: DataFrame, *more: str) -> tuple[DataFrame, int]:
    """(vec_id, vec as doubles, more) of the rows that take part, and the dimension."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"), *more)
    dim = dimension(rows)
    return rows.where(F.col("vec_id").isNotNull() & usable("vec", dim)), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls as a matrix of doubles."""
    flat = pc.list_flatten(column)
    return np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(len(column), dim)


def list_column(x: np.ndarray) -> pa.Array:
    offsets = np.arange(0, x.size + 1, x.shape[1] if x.size else 1, dtype=np.int32) if len(x) else np.zeros(1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x, np.float64).ravel()))


class Groups:
    """Consecutive runs of equal keys over the batches of a sorted partition:
    yields (key, batch slice); a key's rows may come in several slices."""

    def __init__(self, batches, *keys: str):
        self.batches, self.keys = batches, keys

    def __iter__(self):
        for batch in self.batches:
            if batch.num_rows == 0:
                continue
            cols = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in self.keys]
            change = np.zeros(batch.num_rows, bool)
            change[0] = True
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                yield tuple(c[a] for c in cols), batch.slice(a, b - a)
