"""Order audit: readings that stand before an earlier one in their file.

The alignment of the original walks two files with cursors and silently loses readings that are out of
order. The audit counts, per file, readings whose time is before that of the reading just ahead of them.
Every task reduces the blocks it reads, in their order, to one row each (readings, first and last time,
steps back inside); neighbouring blocks of a file are then compared by these rows. One scan,
and one small exchange.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import micros_between

_EPOCH = "1970-01-01 00:00:00"


def order_audit(readings: DataFrame, file: str = "file_path", ts: str = "ts", position: str = "_pos") -> DataFrame:
    """``(<file>, readings, out_of_order)`` per file of ``readings`` as a reader returns them: tasks hold
    whole blocks in order, with ``position`` a struct of ``block`` and ``line``. Readings without time are
    counted, but not compared."""
    t = micros_between(F.lit(_EPOCH).cast("timestamp_ntz"), F.col(ts))
    rows = readings.select(F.col(file).alias("file"), F.col(f"{position}.block").cast("long").alias("block"), t.alias("t"))

    def blocks(batches):
        key, n, first, last, back = None, 0, None, None, 0

        def row():
            return pd.DataFrame({"file": [key[0]], "block": [key[1]], "n": [n], "first": pd.array([first], "Int64"), "last": pd.array([last], "Int64"), "back": [back]})

        for pdf in batches:
            if not len(pdf):
                continue
            files, places = pdf["file"].to_numpy(dtype=object), pdf["block"].to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (files[1:] != files[:-1]) | (places[1:] != places[:-1]))))
            for a, b in zip(cuts, np.append(cuts[1:], len(pdf))):
                if (files[a], places[a]) != key:
                    if key is not None:
                        yield row()
                    key, n, first, last, back = (files[a], places[a]), 0, None, None, 0
                times = pdf["t"].iloc[a:b].dropna().to_numpy(dtype="int64")
                n += int(b - a)
                if len(times):
                    back += int((np.diff(times) < 0).sum()) + int(last is not None and times[0] < last)
                    first, last = int(times[0]) if first is None else first, int(times[-1])
        if key is not None:
            yield row()

    each = rows.mapInPandas(blocks, "file string, block long, n long, first long, last long, back long")
    ahead = F.last("last", True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))   # blocks of one file
    seams = each.withColumn("seam", F.coalesce((F.col("first") < ahead).cast("long"), F.lit(0)))
    return seams.groupBy(F.col("file").alias(file)).agg(F.sum("n").alias("readings"), F.sum(F.col("back") + F.col("seam")).alias("out_of_order"))
