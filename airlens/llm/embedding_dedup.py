"""Operator 6: embedding near-duplicates on a robust-pruned flat graph.

Equal vectors of a label are one node with a number of copies. Nodes are dealt
to overlapping shards, those of their nearest centres (k-means of a bounded
sample). In every shard a graph is built: a node's nearest and some random
others are its candidates, robust pruning keeps the diverse ones, and edges are
made to run both ways. The adjacency lists a node got in its shards are united.

Then every node is searched for in its shards: a greedy search goes from the
shard's medoids (and the node itself, where it is in the graph) to the
neighbourhood, and expands every node in range until none is left. A found pair
counts only if its cosine in double precision reaches the threshold, and for both
of its nodes, whichever search found it. A pair that shares several shards counts
in the first; there such pairs are compared exactly, as are those of two blocks, so
none that another search may find is left out. What leaves a task is linear in the
nodes: a number of links and one edge for each, not the pairs.

``audit`` compares the links of a bounded sample of nodes with brute force over
all, node by node, those with few links also on their own; below ``RECALL`` the
shards are made to overlap more, and the whole is done again. If that does not do,
``exact_links`` compares every node with all shards of its label that can hold a
link of it by their centre's distance. Shards above ``BLOCK_NODES`` are split into blocks, each with its own
graph that all nodes of the shard are searched in, so memory stays bounded.

Defined cases: vectors without vec_id or label, and vectors that are null,
zero, of another length than most or hold null or non-finite components, link
with nothing; an input row repeated as a whole gets the same result again and
counts once; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from airlens.llm.common import hash_sample, materialize
from airlens.llm.components import components
from airlens.llm.vectors import Groups, matrix, prepared

SAMPLE, SHARD_NODES, MAX_CENTRES, BLOCK_NODES = 16384, 1000, 1024, 4096
NEAREST, RANDOM, DEGREE, ALPHA = 32, 16, 12, 1.2
MEDOIDS, BEAM, SLACK, BATCH = 8, 16, 0.03, 256
AUDIT, RECALL = 256, 0.98
#: Nodes of at most so many links are audited on their own too.
FEW = 8


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def centres(sample: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """Spherical k-means of the sample."""
    k = max(1, min(MAX_CENTRES, len(sample), -(-n // SHARD_NODES)))
    c = sample[np.random.default_rng(5).choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        own = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        size = np.sqrt((sums ** 2).sum(axis=1))
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], c)
    return c


def build_graph(x: np.ndarray, seed: int) -> list[np.ndarray]:
    """Robust-pruned adjacency lists of unit vectors, edges both ways."""
    n = len(x)
    rng = np.random.default_rng(seed)
    heads, tails = [], []
    for a in range(0, n, BATCH):
        rows = np.arange(a, min(a + BATCH, n))
        sims = x[rows] @ x.T
        sims[np.arange(len(rows)), rows] = -np.inf
        near = min(NEAREST, n - 1)
        cand = np.argpartition(-sims, near - 1, axis=1)[:, :near] if near else np.zeros((len(rows), 0), np.int64)
        cand = np.concatenate([cand, rng.integers(0, n, size=(len(rows), RANDOM))], axis=1)
        s = np.take_along_axis(sims, cand, axis=1)
        order = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, order, axis=1), np.take_along_axis(s, order, axis=1)
        alive = np.isfinite(s)
        alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]   # equal neighbours stand together
        dist = np.sqrt(np.maximum(0, 2 - 2 * np.where(np.isfinite(s), s, 0)))
        points = x[cand]
        every = np.arange(len(rows))
        for _ in range(DEGREE):
            go = alive.any(axis=1)
            if not go.any():
                break
            pick = alive.argmax(axis=1)
            heads.append(rows[go])
            tails.append(cand[every, pick][go])
            between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("rcd,rd->rc", points, x[cand[every, pick]])))
            alive &= ALPHA * between > dist
            alive[every, pick] = False
    if not heads:
        return [np.zeros(0, np.int64) for _ in range(n)]
    u, v = np.concatenate(heads), np.concatenate(tails)
    pairs = np.unique(np.concatenate([np.stack([u, v], 1), np.stack([v, u], 1)]), axis=0)
    return np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, n)))


def medoids(x: np.ndarray) -> np.ndarray:
    """The node nearest to the mean, of all nodes and of slices along the widest direction of a few."""
    along = np.argsort(x @ (x[np.argmin(x @ x.mean(axis=0))] - x.mean(axis=0)), kind="stable")
    parts = [np.arange(len(x)), *np.array_split(along, min(MEDOIDS, len(x)))]
    return np.unique([p[np.argmax(x[p] @ x[p].mean(axis=0))] for p in parts])


def range_search(x: np.ndarray, adj: np.ndarray, starts: np.ndarray, q: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
    """For each query (unit rows of q; ``own`` its node or -1) a mask of the nodes
    in range that a greedy search finds: (queries, nodes)."""
    b, n = len(q), len(x)
    seen, inside, wait = np.zeros((b, n), bool), np.zeros((b, n), bool), np.zeros((b, n), bool)
    beam_s, beam_i = np.full((b, BEAM), -np.inf), np.zeros((b, BEAM), np.int64)
    fresh = np.zeros((b, BEAM), bool)

    def visit(rows, nodes):   # nodes: (rows, m), -1 for none, no node twice in a row
        ok = nodes >= 0
        ok &= ~seen[rows[:, None], np.where(ok, nodes, 0)]
        at, col = np.nonzero(ok)
        if not len(at):
            return
        r, node = rows[at], nodes[at, col]
        seen[r, node] = True
        s = np.einsum("ij,ij->i", x[node], q[r])
        inside[r, node] = s >= reach
        wait[r, node] = s >= reach - SLACK
        sims = np.full(nodes.shape, -np.inf)
        sims[at, col] = s
        all_s = np.concatenate([beam_s[rows], sims], axis=1)
        all_i = np.concatenate([beam_i[rows], nodes], axis=1)
        all_f = np.concatenate([fresh[rows], np.isfinite(sims)], axis=1)
        top = np.argpartition(-all_s, BEAM - 1, axis=1)[:, :BEAM]
        beam_s[rows], beam_i[rows], fresh[rows] = (np.take_along_axis(v, top, axis=1) for v in (all_s, all_i, all_f))

    every = np.arange(b)
    visit(every, np.broadcast_to(starts, (b, len(starts))))
    visit(every, own[:, None])
    rows = every
    while len(rows):
        waiting = wait[rows]
        has = waiting.any(axis=1)
        s = np.where(fresh[rows], beam_s[rows], -np.inf)
        slot = s.argmax(axis=1)
        go = has | np.isfinite(s[np.arange(len(rows)), slot])
        rows, has, slot, waiting = rows[go], has[go], slot[go], waiting[go]
        if not len(rows):
            break
        node = np.where(has, waiting.argmax(axis=1), beam_i[rows, slot])
        wait[rows, node] = False
        fresh[rows] &= beam_i[rows] != node[:, None]
        visit(rows, adj[node])
    return inside


def exact_range(x: np.ndarray, q: np.ndarray, reach: float) -> np.ndarray:
    """The mask of ``range_search`` from all products. Those at the threshold are taken
    one by one, which gives the same for (a, b) as for (b, a)."""
    s = q @ x.T
    inside = s >= reach
    row, col = np.nonzero(np.abs(s - reach) < 1e-9)
    inside[row, col] = np.einsum("ij,ij->i", x[col], q[row]) >= reach
    return inside


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of a and b (padded lists, -1 for none) have a number in common."""
    ids = np.unique(b[b >= 0])
    if not len(ids):
        return np.zeros((len(a), len(b)), bool)

    def ones(lists):
        out = np.zeros((len(lists), len(ids)), np.float32)
        row, col = np.nonzero(lists >= 0)
        at = np.minimum(np.searchsorted(ids, lists[row, col]), len(ids) - 1)
        known = ids[at] == lists[row, col]
        out[row[known], at[known]] = 1
        return out

    return ones(a) @ ones(b).T > 0


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max([1, *map(len, lists)])), -1, np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


class _Sets:
    """Disjoint sets of a block's nodes."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, nodes: np.ndarray) -> None:
        tops = {self.top(int(i)) for i in nodes}
        least = min(tops)
        for t in tops:
            self.up[t] = least


def nodes_of(rows: DataFrame) -> DataFrame:
    """(node, label, rep, copies, vec): one row for each different vector of a label."""
    same = (rows.distinct().groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
            .withColumn("node", F.monotonically_increasing_id()))
    return materialize(same.select("node", "label", "rep", "copies", "vec"), "nodes")


def _shards(nodes: DataFrame, dim: int, overlap: int) -> DataFrame:
    """Nodes with the centres they are dealt to, one row for each: (grp, block, ..., shards)."""
    spark = nodes.sparkSession
    n = nodes.count()
    sample = hash_sample(nodes.select("node", "vec"), SAMPLE, "node").select("vec").collect()
    c = spark.sparkContext.broadcast(centres(unit(np.array([r.vec for r in sample], np.float64)), n))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                sims = unit(matrix(batch.column("vec"), dim)) @ c.value.T
                m = min(overlap, sims.shape[1])
                own = np.sort(np.argpartition(-sims, m - 1, axis=1)[:, :m], axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.tolist(), pa.list_(pa.int32()))],
                                                 names=[*batch.schema.names, "shards"])

    dealt = nodes.mapInArrow(assign, T.StructType([*nodes.schema.fields, T.StructField("shards", T.ArrayType(T.IntegerType()))]))
    dealt = materialize(dealt.select("*", F.explode("shards").alias("centre")), "shards")
    blocks = dealt.groupBy(F.col("label").alias("_l"), F.col("centre").alias("_c")).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES).cast("int").alias("blocks"))
    return (dealt.join(blocks, (F.col("label") == F.col("_l")) & (F.col("centre") == F.col("_c"))).drop("_l", "_c")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))


def _group(block):
    return F.xxhash64("label", "centre", block)


def search_links(nodes: DataFrame, dim: int, threshold: float, overlap: int) -> DataFrame:
    """(node, links, other): links found in a shard and one node linked with, per node and shard."""
    dealt = _shards(nodes, dim, overlap)
    placed = dealt.withColumn("grp", _group(F.col("block")))

    def graphs(batches):
        key, held = None, []

        def finish():
            ids, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            adj = build_graph(unit(x), int(len(ids)))
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array([ids[a].tolist() for a in adj], pa.list_(pa.int64()))],
                                              names=["node", "adj"])

        for (k,), part in Groups(batches, "grp"):
            if held and k != key:
                yield finish()
                held = []
            key = k
            held.append((part.column("node").to_numpy(), matrix(part.column("vec"), dim)))
        if held:
            yield finish()

    lists = (placed.select("grp", "node", "vec").repartition("grp").sortWithinPartitions("grp", "node")
             .mapInArrow(graphs, "node long, adj array<long>"))
    united = (lists.groupBy(F.col("node").alias("_n")).agg(F.array_distinct(F.flatten(F.collect_list("adj"))).alias("adj")))
    columns = ["grp", "kind", "centre", "node", "copies", "shards", "adj", "vec"]
    graph = placed.join(united, F.col("node") == F.col("_n")).withColumn("kind", F.lit(0)).select(*columns)
    asked = (dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"))
             .withColumn("grp", _group(F.col("to"))).withColumn("kind", F.lit(1)).withColumn("adj", F.lit(None).cast("array<long>")).select(*columns))

    def count(out, who, inside, q_before, before, copies, ids, sets):
        first = inside & ~_share(q_before, before)   # counted in an earlier shard if both are there
        for i in np.flatnonzero(inside.any(axis=1)):
            hit = np.flatnonzero(inside[i])
            sets.join(hit)
            out[0].append(int(who[i]))
            out[1].append(int(copies[first[i]].sum()))
            out[2].append(int(ids[hit[0]]))

    def search(batches):
        key, held, ready = None, [], None

        def close():
            if ready is None:
                return None
            ids, x, adj, starts, copies, shards, sets, found, centre = ready
            before = np.where(shards < centre, shards, -1)
            out = ([], [], [])
            for a in range(0, len(ids), BATCH):   # found from either side is found
                inside = found[a:a + BATCH] | found[:, a:a + BATCH].T
                count(out, ids[a:a + BATCH], inside, before[a:a + BATCH], before, copies, ids, sets)
            tops = np.array([sets.top(i) for i in range(len(ids))])
            moved = np.flatnonzero(tops != np.arange(len(ids)))
            return _found(np.concatenate([np.array(out[0], np.int64), ids[moved]]),
                          np.concatenate([np.array(out[1], np.int64), np.zeros(len(moved), np.int64)]),
                          np.concatenate([np.array(out[2], np.int64), ids[tops[moved]]]))

        for (k, kind), part in Groups(batches, "grp", "kind"):
            if k != key:
                last = close()
                if last is not None:
                    yield last
                key, held, ready = k, [], None
            if kind == 0:
                held.append(part)
                continue
            if ready is None:
                t = pa.Table.from_batches(held).combine_chunks()
                col = {c: t.column(c).combine_chunks() for c in ("node", "copies", "shards", "adj", "vec")}
                ids = col["node"].to_numpy()
                order = np.argsort(ids, kind="stable")
                ids = ids[order]
                x = unit(matrix(col["vec"], dim))[order]
                adj = col["adj"].to_pylist()
                local = []
                for i in order.tolist():
                    a = np.array(adj[i], np.int64)
                    at = np.minimum(np.searchsorted(ids, a), len(ids) - 1)
                    local.append(at[ids[at] == a])
                shards = _padded([np.array(col["shards"][i].as_py()) for i in order.tolist()])
                ready = (ids, x, _padded(local), medoids(x), col["copies"].to_numpy()[order], shards, _Sets(len(ids)),
                         np.zeros((len(ids), len(ids)), bool), int(part.column("centre")[0].as_py()))
            ids, x, adj, starts, copies, shards, sets, found, centre = ready
            q, who = unit(matrix(part.column("vec"), dim)), part.column("node").to_numpy()
            q_shards = _padded([np.array(v) for v in part.column("shards").to_pylist()])
            before, after = (np.where(shards < centre, shards, -1), np.where(shards > centre, shards, -1))
            for a in range(0, len(q), BATCH):
                at = np.minimum(np.searchsorted(ids, who[a:a + BATCH]), len(ids) - 1)
                here = ids[at] == who[a:a + BATCH]
                near, theirs = q[a:a + BATCH], q_shards[a:a + BATCH]
                exact = exact_range(x, near, threshold)
                if here.any():
                    row = np.flatnonzero(here)
                    inside = range_search(x, adj, starts, near[row], at[row], threshold)
                    inside |= exact[row] & _share(np.where(theirs[row] > centre, theirs[row], -1), after)
                    inside[np.arange(len(row)), at[row]] = False
                    found[at[row]] = inside
                if not here.all():
                    row, out = np.flatnonzero(~here), ([], [], [])
                    count(out, who[a:a + BATCH][row], exact[row], np.where(theirs[row] < centre, theirs[row], -1), before, copies, ids, sets)
                    if out[0]:
                        yield _found(*map(np.array, out))
        last = close()
        if last is not None:
            yield last

    both = graph.unionByName(asked).repartition("grp").sortWithinPartitions("grp", "kind", "node")
    return materialize(both.mapInArrow(search, "node long, links long, other long"), "links")


def _found(node, links, other) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(links, pa.int64()), pa.array(other, pa.int64())],
                                      names=["node", "links", "other"])


def audit(nodes: DataFrame, found: DataFrame, dim: int, threshold: float) -> float:
    """The share of the true links of ``AUDIT`` nodes that were found (1.0 if they have none):
    the mean over nodes with links, or over those with few if that is less."""
    spark = nodes.sparkSession
    sample = hash_sample(nodes, AUDIT, "rep", "node").collect()
    if not sample:
        return 1.0
    asked = spark.sparkContext.broadcast((np.array([r.node for r in sample]), [r.label for r in sample],
                                          unit(np.array([r.vec for r in sample], np.float64))))

    def brute(batches):
        ids, labels, q = asked.value
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                hit = unit(matrix(batch.column("vec"), dim)) @ q.T >= threshold
                hit &= np.array(batch.column("label").to_pylist(), object)[:, None] == np.array(labels, object)[None, :]
                hit &= batch.column("node").to_numpy()[:, None] != ids[None, :]
                total += (hit * batch.column("copies").to_numpy()[:, None]).sum(axis=0)
        yield _found(ids, total, ids)

    truth = nodes.mapInArrow(brute, "node long, links long, other long").groupBy("node").agg(F.sum("links").alias("true"))
    have = found.groupBy(F.col("node").alias("_n")).agg(F.sum("links").alias("have"))
    share = F.least(F.coalesce("have", F.lit(0)) / F.col("true"), F.lit(1.0))
    row = (truth.join(have, F.col("node") == F.col("_n"), "left").where(F.col("true") > 0)
           .agg(F.avg(share).alias("all"), F.avg(F.when(F.col("true") <= FEW, share)).alias("few")).first())
    return min(1.0 if x is None else x for x in row)


def exact_links(nodes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """What ``search_links`` returns, with every link: a node is compared with all nodes
    of a shard if its angle to the centre is within the shard's radius and the threshold's."""
    spark = nodes.sparkSession
    sample = hash_sample(nodes.select("node", "vec"), SAMPLE, "node").select("vec").collect()
    c = spark.sparkContext.broadcast(unit(centres(unit(np.array([r.vec for r in sample], np.float64)), nodes.count())))

    def angles(column):
        return np.arccos(np.clip(unit(matrix(column, dim)) @ c.value.T, -1, 1))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                far = angles(batch.column("vec"))
                own = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32()), pa.array(far[np.arange(len(own)), own])],
                                                 names=[*batch.schema.names, "centre", "angle"])

    columns = ["node", "label", "copies", "vec"]
    fields = [nodes.schema[x] for x in columns]
    dealt = materialize(nodes.select(*columns).mapInArrow(
        assign, T.StructType([*fields, T.StructField("centre", T.IntegerType()), T.StructField("angle", T.DoubleType())])), "homes")
    limit = np.full(len(c.value), -np.inf)
    for r in dealt.groupBy("centre").agg(F.max("angle").alias("radius")).collect():   # a row per centre
        limit[r.centre] = r.radius + np.arccos(min(1.0, max(-1.0, threshold))) + 1e-6
    limits = spark.sparkContext.broadcast(limit)

    def reach(batches):
        for batch in batches:
            if batch.num_rows:
                near = angles(batch.column("vec")) <= limits.value
                to = [np.flatnonzero(x).tolist() for x in near]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, pa.list_(pa.int32()))], names=[*batch.schema.names, "to"])

    blocks = dealt.groupBy(F.col("label").alias("_l"), F.col("centre").alias("_c")).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES).cast("int").alias("blocks"))

    def with_blocks(df):
        return df.join(blocks, (F.col("label") == F.col("_l")) & (F.col("centre") == F.col("_c")))

    held = with_blocks(dealt).withColumn("grp", _group(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))).withColumn("kind", F.lit(0))
    reached = nodes.select(*columns).mapInArrow(reach, T.StructType([*fields, T.StructField("to", T.ArrayType(T.IntegerType()))]))
    asked = (with_blocks(reached.select(*columns, F.explode("to").alias("centre")))
             .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
             .withColumn("grp", _group(F.col("block"))).withColumn("kind", F.lit(1)))

    def compare(batches):
        key, kept, ready = None, [], None

        def close():
            ids, x, copies, sets = ready
            tops = np.array([sets.top(i) for i in range(len(ids))])
            moved = np.flatnonzero(tops != np.arange(len(ids)))
            return _found(ids[moved], np.zeros(len(moved), np.int64), ids[tops[moved]])

        for (k, kind), part in Groups(batches, "grp", "kind"):
            if k != key:
                if ready is not None:
                    yield close()
                key, kept, ready = k, [], None
            if kind == 0:
                kept.append(part)
                continue
            if not kept:   # a block that got no node
                continue
            if ready is None:
                t = pa.Table.from_batches(kept).combine_chunks()
                ids = t.column("node").to_numpy()
                ready = (ids, unit(matrix(t.column("vec").combine_chunks(), dim)), t.column("copies").to_numpy(), _Sets(len(ids)))
            ids, x, copies, sets = ready
            q, who = unit(matrix(part.column("vec"), dim)), part.column("node").to_numpy()
            for a in range(0, len(q), BATCH):
                inside = exact_range(x, q[a:a + BATCH], threshold) & (who[a:a + BATCH, None] != ids[None, :])
                out = ([], [], [])
                for i in np.flatnonzero(inside.any(axis=1)):
                    hit = np.flatnonzero(inside[i])
                    sets.join(hit)
                    out[0].append(int(who[a + i]))
                    out[1].append(int(copies[hit].sum()))
                    out[2].append(int(ids[hit[0]]))
                if out[0]:
                    yield _found(*map(np.array, out))
        if ready is not None:
            yield close()

    parts = [df.select("grp", "kind", "node", "copies", "vec") for df in (held, asked)]
    both = parts[0].unionByName(parts[1]).repartition("grp").sortWithinPartitions("grp", "kind", "node")
    return materialize(both.mapInArrow(compare, "node long, links long, other long"), "links")


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows, dim = prepared(embeddings, "label")
    every = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    alone = every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not dim:
        return alone
    nodes = nodes_of(rows.where("label is not null").select("vec_id", "vec", "label"))
    if nodes.isEmpty():
        return alone
    for overlap in (2, 4, 8):
        found = search_links(nodes, dim, threshold, overlap)
        if audit(nodes, found, dim, threshold) >= RECALL:
            break
    else:
        found = exact_links(nodes, dim, threshold)
    joined = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    least = (joined.join(nodes.select("node", "rep"), F.col("id") == F.col("node")).groupBy(F.col("component").alias("_c"))
             .agg(F.min("rep").alias("least")))
    of_node = joined.join(least, F.col("component") == F.col("_c")).select(F.col("id").alias("_i"), "least")
    links = found.groupBy(F.col("node").alias("_n")).agg(F.sum("links").alias("links"))
    result = (nodes.join(links, F.col("node") == F.col("_n"), "left").join(of_node, F.col("node") == F.col("_i"), "left")
              .select(F.col("label").alias("_label"), F.col("vec").alias("_vec"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component_id")))
    out = every.join(result, (F.col("label") == F.col("_label")) & (F.col("vec") == F.col("_vec")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component_id", F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
