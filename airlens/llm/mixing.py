"""Operator 5: mixing sources to target weights by Pfair scheduling.

Each source's documents, in a stated order, are cut into blocks. Time runs in
slots of one block. With target weight w, block j of a source (from 0) is
released at slot floor(j / w) and due by slot ceil((j + 1) / w); the slot takes
the released block with the earliest deadline (ties by source name). With
weights that add up to one every deadline is met, so after any number of slots
a source is less than one block away from its exact share: weights are whole
numbers or floats, both taken as exact fractions, and never rounded.

The schedule is made for blocks, not for documents: from the counts of the
sources it follows which block takes which slot, and where the slot's documents
start. A block has ``block`` documents, or more where there would be over
``MOST_BLOCKS`` blocks (the number of documents over ``MOST_BLOCKS``), so the
schedule has at most ``MOST_BLOCKS`` rows and one per source. Documents are
numbered inside their source and find their block's row; the place in the
mixture is arithmetic, there is no sort of the mixture. Target weights hold up to
the first slot of a source that has run out (``on_target``); the blocks that are
left then follow by deadline, without gaps. Every document is placed once.

Defined cases: a null source is the source ''; documents are ordered within
their source by doc_id (nulls first), then text; repeated rows are placed each;
a source without weight is an error; other columns are ignored; an empty table gives no rows.
The names of the sources and their weights are a list on the driver.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import source_key, width
from airlens.operators.ranking import rank_within

BLOCK, MOST_BLOCKS = 16, 1 << 20
#: Rows of the schedule up to which it is broadcast.
BROADCAST_ROWS = 200_000
#: The default weights are square roots in units of 1 / ROOT_UNIT.
ROOT_UNIT = 1 << 20


def whole(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers in exactly the same proportions."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    if any(w < 0 for w in exact.values()) or not any(exact.values()):
        raise ValueError("weights must not be negative and must not all be zero")
    unit = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * unit) for s, w in exact.items()}


def earliest_deadline_first(parts: dict[str, int]):
    """(source, number of its block) slot by slot, without end."""
    q, slot = sum(parts.values()), 0
    waiting = [(0, s, 0) for s in parts]   # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []   # deadline, source, block
    while True:
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * q // parts[s]), s, k))
        _, s, k = heapq.heappop(ready)
        yield s, k
        heapq.heappush(waiting, ((k + 1) * q // parts[s], s, k + 1))
        slot += 1


def schedule(parts: dict[str, int], blocks: dict[str, int]) -> tuple[list[tuple[str, int]], int]:
    """(source, block) of every block in the order of slots, and the first slot that would stay empty."""
    q, order, done = sum(parts.values()), [], dict.fromkeys(blocks, 0)
    for s, k in earliest_deadline_first(parts):
        if k == blocks.get(s, 0):
            break
        order.append((s, k))
        done[s] += 1
    empty = len(order)
    rest = sorted((-(-(k + 1) * q // parts[s]), s, k) for s, n in blocks.items() for k in range(done[s], n))
    return order + [(s, k) for _, s, k in rest], empty


def source_counts(docs: DataFrame) -> dict[str, int]:
    return {r.source: r.n for r in docs.groupBy(source_key().alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()}


def square_root_weights(counts: dict[str, int]) -> dict[str, int]:
    """The default target: shares as the square root of the number of documents."""
    return {s: int(math.sqrt(n) * ROOT_UNIT) for s, n in counts.items()}


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """(doc_id, source, block, slot, position, on_target, _h) of every document; ``position``
    counts from 0 in the mixture's order, ``_h`` is a hash of the text."""
    counts = source_counts(docs)
    weights = square_root_weights(counts) if weights is None else weights
    missing = sorted(set(counts) - {s for s, w in weights.items() if w > 0})
    if missing:
        raise ValueError(f"no target weight for sources {missing}")
    block = max(block, -(-sum(counts.values()) // most_blocks))
    order, empty = [], 0
    if counts:
        parts = whole({s: weights[s] for s in counts})
        order, empty = schedule(parts, {s: -(-n // block) for s, n in counts.items()})
    sizes = np.array([min(block, counts[s] - k * block) for s, k in order], np.int64)
    plan = docs.sparkSession.createDataFrame(pa.table({
        "_source": pa.array([s for s, _ in order], pa.string()), "_k": pa.array([k for _, k in order], pa.int64()),
        "slot": pa.array(np.arange(len(order))), "_start": pa.array(np.cumsum(sizes) - sizes)}))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key().alias("source"),
                       F.xxhash64("text").alias("_h"))
    ranked = rank_within(rows, ["source"], ["doc_id", "_h"], out="_rank")
    r = F.col("_rank") - 1
    blocked = ranked.withColumn("block", F.floor(r / block).cast("long")).withColumn("_in", r % block)
    placed = blocked.join(F.broadcast(plan) if len(order) <= BROADCAST_ROWS else plan,
                          (F.col("source") == F.col("_source")) & (F.col("block") == F.col("_k")))
    return placed.select("doc_id", "source", "block", "slot", (F.col("_start") + F.col("_in")).alias("position"),
                         (F.col("slot") < F.lit(empty)).alias("on_target"), "_h")


def mix_documents(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` with all their columns in the mixture's order: range-partitioned
    and sorted by position, so that the files written from it are the mixture in turn.
    Rows alike in doc_id and text stand together, at the first of their places."""
    order = (mix(docs.select("doc_id", "source", "text"), weights, block)
             .groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_key")).agg(F.min("position").alias("_position")))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_h"), F.struct(*docs.columns).alias("row"))   # names of other columns are theirs
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_key"))
    return (keyed.join(order, same).repartitionByRange(width(docs.sparkSession), "_position")
                 .sortWithinPartitions("_position").select("row.*"))


ORACLE = f"""
WITH RECURSIVE n AS (SELECT coalesce(source, '') AS source, count(*) AS n, floor(sqrt(count(*)) * {ROOT_UNIT})::HUGEINT AS p FROM documents GROUP BY 1),
size AS (SELECT greatest({BLOCK}, (sum(n) + {MOST_BLOCKS} - 1) // {MOST_BLOCKS})::BIGINT AS size FROM n),
parts AS (SELECT source, n, p, sum(p) OVER () AS q, (n + size - 1) // size AS blocks FROM n, size),
lists AS (SELECT list(source ORDER BY source) AS names, list(p ORDER BY source) AS ps, list(blocks ORDER BY source) AS sizes, sum(p)::HUGEINT AS q FROM parts),
edf AS (
  SELECT 0::BIGINT AS t, NULL::VARCHAR AS source, NULL::BIGINT AS k, list_transform(ps, lambda x: 0::BIGINT) AS done FROM lists
  UNION ALL
  SELECT t + 1, names[pick], done[pick], list_transform(done, lambda x, i: CASE WHEN i = pick THEN x + 1 ELSE x END)
  FROM (SELECT *, list_position(due, list_min(due)) AS pick
        FROM (SELECT t, done, names, sizes, list_transform(ps, lambda p, i: CASE WHEN (done[i] * q) // p <= t THEN ((done[i] + 1) * q + p - 1) // p END) AS due
              FROM edf, lists))
  WHERE done[pick] < sizes[pick]),
placed AS (SELECT source, k, t - 1 AS slot FROM edf WHERE t > 0),
ends AS (SELECT count(*) AS empty FROM placed),
blocks AS (SELECT source, p, q, unnest(range(0, blocks::BIGINT)) AS k FROM parts),
slots AS (SELECT source, k, slot FROM placed UNION ALL
  SELECT source, k, empty + row_number() OVER (ORDER BY ((k + 1) * q + p - 1) // p, source, k) - 1
  FROM (SELECT * FROM blocks ANTI JOIN placed USING (source, k)), ends),
d AS (SELECT doc_id, coalesce(source, '') AS source,
             row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id NULLS FIRST) - 1 AS r FROM documents),
b AS (SELECT d.*, r // size AS block, r % size AS place FROM d, size)
SELECT doc_id, b.source, block::BIGINT AS block, slot::BIGINT AS slot,
       (row_number() OVER (ORDER BY slot, place) - 1)::BIGINT AS position, slot < empty AS on_target
FROM b JOIN slots ON slots.source = b.source AND slots.k = b.block, ends"""
