"""Operator 10: nearest neighbours by multiprobe p-stable hashing.

Every table hashes a vector by a few Gaussian projections a.x + b, cut into
cells of one width. The difference of two vectors' projections is normal with
their distance as deviation, so the chance that a neighbour at the expected
distance lies in a cell next to the query's is known for every perturbation. A
query visits cells in the order of that chance until the visited ones hold the
wanted share of it; candidates of all tables are merged and ranked by the
exact distance in double precision.

The index holds every row. Fitted beforehand: the number of projections (from
the number of rows), the cell width (from the spread of a bounded sample) and
the share to visit, the smallest whose recall on ``AUDIT`` sample queries,
compared with brute force over all rows, reaches ``RECALL``.

Work is dealt out by blocks of cells. Cells with many rows (copies) are split
over several blocks, so a task holds one block of bounded size at a time, and
queries stream past it; of a query and a block only the best k leave the task.
A query that finds fewer than k rows (empty cells around it) is compared with
all rows, and so is every query if no share reaches ``RECALL`` in the audit: in
blocks of ``BLOCK_ROWS`` rows that the queries stream past.

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows without vec_id;
rows with the query's vec_id are its own; a repeated row with the same vector
counts once; ties go to the smaller vec_id; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from airlens.llm.common import hash_sample, materialize
from airlens.llm.vectors import Groups, list_column, matrix, prepared

TABLES, CELL_ROWS = 2, 64
SAMPLE, AUDIT, RECALL = 4096, 64, 0.97
BLOCK_ROWS = 16384
#: cells looked at on either side of a query's own, in each projection
REACH = 4
SHARES = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.87, 0.93, 0.97, 0.99, 0.999)

_phi = np.vectorize(lambda z: 0.5 * math.erfc(-z / math.sqrt(2)))


class Hashing:
    """Projections, cell width and the order in which cells are visited."""

    def __init__(self, dim: int, rows: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.k = max(2, min(12, round(math.log(max(rows, 2) / CELL_ROWS, 5)) if rows > CELL_ROWS else 2))
        self.a = rng.normal(size=(TABLES, self.k, dim))
        self.shift = rng.random(size=(TABLES, self.k))
        self.mix = rng.integers(1, 2 ** 61, size=(TABLES, self.k), dtype=np.int64) | 1
        self.widths = np.ones((TABLES, self.k))
        self.distance, self.share = 1.0, SHARES[-1]
        self.reached = True   # the audited recall

    def fit_widths(self, sample: np.ndarray) -> None:
        for t in range(TABLES):
            p = sample @ self.a[t].T
            spread = np.quantile(p, 0.98, axis=0) - np.quantile(p, 0.02, axis=0)
            self.widths[t] = np.maximum(spread / 4, 1e-9)   # about five cells for a projection

    def places(self, x: np.ndarray, t: int) -> np.ndarray:
        return x @ self.a[t].T / self.widths[t] + self.shift[t]

    def cells(self, x: np.ndarray, t: int) -> np.ndarray:
        """One number per vector's cell."""
        return self.number(np.floor(self.places(x, t)).astype(np.int64), t)

    def number(self, coords: np.ndarray, t: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (coords * self.mix[t]).sum(axis=-1) + np.int64(t)
            h ^= h >> np.int64(29)
            return h * np.int64(0x2545F4914F6CDD1D)

    def visited(self, q: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """(cells, chances) of a query in table t, likeliest first, up to the wanted share."""
        place = self.places(q[None, :], t)[0]
        own = np.floor(place)
        steps = np.arange(-REACH, REACH + 1)
        edges = (own[:, None] + np.arange(-REACH, REACH + 2)[None, :] - place[:, None]) * self.widths[t][:, None] / max(self.distance, 1e-12)
        chance = np.diff(_phi(edges), axis=1)
        # product over projections, dropping after each the least likely that the share can do without
        spare = (1 - self.share) / (2 * self.k)
        coords, prob = np.zeros((1, 0), np.int64), np.ones(1)
        for i in range(self.k):
            keep = np.flatnonzero(chance[i] > 1e-6)
            keep = keep if len(keep) else np.array([REACH])
            prob = (prob[:, None] * chance[i][keep][None, :]).ravel()
            coords = np.concatenate([np.repeat(coords, len(keep), axis=0),
                                     np.tile((own[i] + steps[keep]).astype(np.int64), len(coords))[:, None]], axis=1)
            order = np.argsort(-prob, kind="stable")
            upto = int(np.searchsorted(np.cumsum(prob[order]), prob.sum() * (1 - spare))) + 1
            coords, prob = coords[order[:upto]], prob[order[:upto]]
        upto = int(np.searchsorted(np.cumsum(prob), self.share)) + 1
        return self.number(coords[:upto], t), prob[:upto]


def nearest(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int, norms: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k rows nearest to q, the rows ``own`` left out. A fast
    product narrows the rows down; distances are computed on the vectors themselves."""
    norms = np.einsum("ij,ij->i", x, x) if norms is None else norms
    rough = norms - 2 * (x @ q)
    rough[ids == own] = np.inf
    most = k * TABLES   # a block may hold a row once for every table
    if len(rough) > 4 * most:
        edge = np.partition(rough, most - 1)[most - 1]
        at = np.flatnonzero(rough <= edge + 1e-9 * (1 + abs(edge) + float(q @ q)))
    else:
        at = np.flatnonzero(np.isfinite(rough))
    d = np.sqrt(((x[at] - q) ** 2).sum(axis=1))
    order = np.lexsort((ids[at], d))
    # a row found through several tables counts once
    picked, seen = [], set()
    for o in order:
        key = (int(ids[at[o]]), float(d[o]))
        if key not in seen and np.isfinite(d[o]):
            seen.add(key)
            picked.append(o)
            if len(picked) == k:
                break
    return ids[at[picked]], d[picked]


def fit(rows: DataFrame, dim: int, k: int) -> Hashing:
    """A hashing for ``rows`` (vec_id, vec), with its share audited against brute force."""
    spark = rows.sparkSession
    n = rows.count()
    hashing = Hashing(dim, n)
    sample = hash_sample(rows, SAMPLE, "vec_id", "vec").collect()
    if not sample:
        return hashing
    hashing.fit_widths(np.array([r.vec for r in sample]))
    queries = [(r.vec_id, np.array(r.vec)) for r in sample[:AUDIT]]
    shared = spark.sparkContext.broadcast(queries)   # AUDIT vectors

    def brute(batches):
        best = [[] for _ in shared.value]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, ids = matrix(batch.column("vec"), dim), batch.column("vec_id").to_numpy()
            norms = np.einsum("ij,ij->i", x, x)
            where = {int(v): i for i, v in enumerate(ids)}
            for j, (own, q) in enumerate(shared.value):
                found, d = nearest(x, ids, q, own, k, norms)
                best[j] = sorted(best[j] + [(float(b), int(a), x[where[int(a)]]) for a, b in zip(found, d)], key=lambda r: r[:2])[:k]
        out = [(j, d, i, v) for j, rows in enumerate(best) for d, i, v in rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out]),
                                              pa.array([o[2] for o in out], pa.int64()), list_column(np.array([o[3] for o in out]))],
                                             names=["j", "d", "vec_id", "vec"])

    top = Window.partitionBy("j").orderBy("d", "vec_id")
    true = (rows.select("vec_id", "vec").mapInArrow(brute, "j int, d double, vec_id long, vec array<double>")
            .withColumn("r", F.row_number().over(top)).where(F.col("r") <= k).collect())
    if not true:
        return hashing
    hashing.distance = float(np.quantile([r.d for r in true], 0.9))
    by: dict[int, list] = {}
    for r in true:
        by.setdefault(r.j, []).append(np.array(r.vec))
    for share in SHARES:
        hashing.share = share
        hit = total = 0
        for j, near in by.items():
            x = np.array(near)
            found = np.zeros(len(x), bool)
            for t in range(TABLES):
                found |= np.isin(hashing.cells(x, t), hashing.visited(queries[j][1], t)[0])
            hit, total = hit + int(found.sum()), total + len(x)
        hashing.reached = hit >= RECALL * total
        if hashing.reached:
            break
    return hashing


def search(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query row."""
    spark = embeddings.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows, dim = prepared(embeddings)
    if not dim:
        return spark.createDataFrame([], out)
    rows = materialize(rows.dropDuplicates(["vec_id", "vec"]), "vectors")
    hashing = fit(rows, dim, k)
    queries = rows.where(F.col("vec_id") % every == 0)
    if not hashing.reached:
        return exact(rows, queries, dim, k)
    shared = spark.sparkContext.broadcast(hashing)
    total = rows.count() * TABLES

    def hashed(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vec"), dim)
                for t in range(TABLES):
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vec"), pa.array(shared.value.cells(x, t))],
                                                     names=["vec_id", "vec", "cell"])

    index = materialize(rows.mapInArrow(hashed, "vec_id long, vec array<double>, cell long"), "cells")
    # a cell with many rows is spread over several parts
    parts = index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (BLOCK_ROWS // 4)).cast("int").alias("parts"))
    split = parts.where("parts > 1").select(F.col("cell").alias("_cell"), "parts")   # at most 4 * rows / BLOCK_ROWS rows
    split = F.broadcast(split) if total < 1 << 30 else split
    blocks = max(1, math.ceil(total / BLOCK_ROWS))

    def block_of(part):
        return F.pmod(F.xxhash64("cell", part.cast("long")), F.lit(blocks)).cast("int")

    indexed = (index.join(split, F.col("cell") == F.col("_cell"), "left")
               .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1))))
               .select(block_of(F.col("part")).alias("block"), F.lit(0).alias("kind"), F.array("cell").alias("cells"), "vec_id", "vec"))

    def probe(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch.column("vec"), dim)
            for t in range(TABLES):
                found = [shared.value.visited(q, t)[0] for q in x]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vec"), pa.array([f.tolist() for f in found], pa.list_(pa.int64()))],
                                                 names=["vec_id", "vec", "cells"])

    probes = (queries.mapInArrow(probe, "vec_id long, vec array<double>, cells array<long>")
              .select("vec_id", "vec", F.explode("cells").alias("cell"))
              .join(split, F.col("cell") == F.col("_cell"), "left")
              .select("vec_id", "vec", "cell", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
              .select(block_of(F.col("part")).alias("block"), "vec_id", "vec", "cell")
              .groupBy("block", "vec_id", F.xxhash64("vec").alias("_v")).agg(F.first("vec").alias("vec"), F.collect_set("cell").alias("cells"))
              .select("block", F.lit(1).alias("kind"), "cells", "vec_id", "vec"))
    found = _best(_ranked(indexed, probes, dim, k), k)
    found = materialize(found, "found")
    # too few found: all rows are candidates
    short = queries.select("vec_id", "vec").join(
        found.groupBy(F.col("query_id").alias("_q")).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= k),
        F.col("vec_id") == F.col("_q"), "left_anti")
    if short.isEmpty():
        return found
    rest = exact(rows, short, dim, k)
    done = short.select(F.col("vec_id").alias("_q")).distinct()
    return found.join(done, F.col("query_id") == F.col("_q"), "left_anti").unionByName(rest)


def exact(rows: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """The k nearest rows of each of ``queries`` (vec_id, vec), found by comparison with every row once."""
    blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    dealt = rows.select(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"),
                        F.array(F.lit(0).cast("long")).alias("cells"), "vec_id", "vec")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                           F.lit(None).cast("array<long>").alias("cells"), "vec_id", "vec")
    return _best(_ranked(dealt, asked, dim, k), k)


def _ranked(indexed: DataFrame, probes: DataFrame, dim: int, k: int) -> DataFrame:
    """The best k rows of every block for every query that visits it."""
    def scan(batches):
        block, state = None, None
        for (b, kind), part in Groups(batches, "block", "kind"):
            x, ids = matrix(part.column("vec"), dim), part.column("vec_id").to_numpy()
            if kind == 0:
                cells = np.array([c[0] for c in part.column("cells").to_pylist()], np.int64)
                if b != block:
                    block, state = b, [[], [], []]
                for kept, new in zip(state, (x, ids, cells)):
                    kept.append(new)
                continue
            if b != block:
                continue   # a block without rows
            if len(state) == 3:   # the first query: put the block's rows in the order of their cells
                bx, bi, bc = (np.concatenate(s) for s in state)
                order = np.argsort(bc, kind="stable")
                bx, bi, bc = bx[order], bi[order], bc[order]
                state = [bx, bi, bc, np.einsum("ij,ij->i", bx, bx)]
            bx, bi, bc, norms = state
            out = ([], [], [])
            for q, own, cells in zip(x, ids, part.column("cells").to_pylist()):
                if cells is None:
                    at = np.arange(len(bi))
                else:
                    c = np.sort(np.array(cells, np.int64))
                    lo, hi = np.searchsorted(bc, c, "left"), np.searchsorted(bc, c, "right")
                    at = np.concatenate([np.arange(a, z) for a, z in zip(lo, hi) if z > a] or [np.zeros(0, np.int64)])
                if len(at):
                    near, d = nearest(bx[at], bi[at], q, own, k, norms[at])
                    out[0].extend([int(own)] * len(near))
                    out[1].extend(near.tolist())
                    out[2].extend(d.tolist())
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                                                 names=["query_id", "vec_id", "score"])

    both = indexed.unionByName(probes).repartition("block").sortWithinPartitions("block", "kind")
    return both.mapInArrow(scan, "query_id long, vec_id long, score double")


def _best(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (candidates.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
