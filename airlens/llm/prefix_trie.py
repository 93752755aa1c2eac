"""Operator 13: the trie of conversation prefixes, as balanced parentheses per shard.

Conversations are rebuilt (see ``rebuilt``) and sorted by the sequence of their turns' digests, then
by conv_id; a range of that order is a shard, so equal conversations spread over as many shards as
they need. Within a shard the common prefix with the conversation before tells which nodes each one
adds, which gives the trie as balanced parentheses (``parentheses``): the closing parenthesis of a
node, found through blocks of the range min-max tree, delimits its subtree; ranks of ``()`` count
its leaves, and cumulative arrays over the preorder give members and savings.

Nodes that reach over a shard's edge are those on the common prefix of the conversations on both
sides of it: the shard's spine. Shards hand on partial figures for spines, all others are final. Equal
spine nodes are merged by a digest of their path, their own leaves and savings are added up to the root, and the
nodes below get the merged parent by (shard, number), so no key is hot. Spines are as long as what two neighbouring
shards have in common and as many as shards: one task adds them up, in time linear in their nodes. Only one row
per shard is broadcast: how deep its two spines are.

Memory: a task holds one shard, of about SHARD_TURNS turns. A single conversation is one row of 52
bytes a turn, without its texts. The digest of a node's ends is sequential by definition: for a spine
node it streams once over chunks of joined ids, which shards make beforehand.

Defined cases: a null turn number comes first, equal ones follow role and digest of the turn; null role and
text are empty; rows without conv_id belong to no conversation and are left out; repeated rows are turns of
their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from airlens.llm.common import crc32_sql, materialize, ragged, width
from airlens.llm.parentheses import Parentheses, preorder, within
from airlens.llm.vectors import Groups

#: A rebuilt conversation starts with the turns of the first of GROUP ids, fewer than HEADS of them.
GROUP, HEADS = 100, 6
#: Turns of a shard, about, and bytes of a turn's digest.
SHARD_TURNS, DIGEST = 1_000_000, 16
#: Conversation ids joined into one row.
CHUNK = 8192
NOTHING = hashlib.sha256(b"").hexdigest()

ENCODED = ("kind int, shard int, no long, parent long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
           "n_leaves long, saved_tokens long, last long, ends string, path binary, above binary")
NODE, SPINE, ENDS = 0, 1, 2
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, lengths): turns' digests in a row, and their code points. A conversation c starts with
    the first crc32(c) % HEADS turns of conversation c - c % GROUP, and goes on with its own turns after as many."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", role.alias("role"), digest.alias("digest"), F.char_length(text).alias("length")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["length"].alias("length"))).alias("turns"))
    own = materialize(own, "turns")
    heads = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("_b"), F.slice("turns", 1, HEADS - 1).alias("head"))
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("_b"), "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), h)).otherwise(F.slice("turns", 1, 0))
    whole = both.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"),
                        F.transform("turns", lambda t: t["length"]).alias("lengths"))


def common_prefix(a: bytes | None, b: bytes | None) -> int:
    """Digests that two keys begin with alike; -1 if one is missing."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0] if len(differ) else n) // DIGEST


def sharded(rows: DataFrame) -> DataFrame:
    """``rows`` with their shard and the depths of its left and right spine (-1: no neighbour)."""
    spark = rows.sparkSession
    turns = rows.agg(F.sum(F.size("lengths") + 1)).first()[0] or 0
    shards = max(width(spark), turns // SHARD_TURNS)
    placed = materialize(rows.repartitionByRange(shards, "key", "conv_id").withColumn("shard", F.spark_partition_id()), "shards")
    order = Window.orderBy("shard")   # one row per shard
    ends = (placed.groupBy("shard").agg(F.min("key").alias("first"), F.max("key").alias("last"))
            .select("shard", "first", "last", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")))

    def depths(batches):
        for batch in batches:
            row = batch.to_pydict()
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), pa.array(list(map(common_prefix, row["before"], row["first"])), pa.int64()),
                 pa.array(list(map(common_prefix, row["last"], row["after"])), pa.int64())], names=["_s", "left", "right"])

    spines = materialize(ends.mapInArrow(depths, "_s int, left long, right long"), "spines")
    return placed.join(F.broadcast(spines), F.col("shard") == F.col("_s")).drop("_s")   # one row per shard


class Shard:
    """The trie of sorted conversations (ids, digests in a row, code points, turns of each)."""

    def __init__(self, ids: np.ndarray, digests: np.ndarray, lengths: np.ndarray, turns: np.ndarray):
        off = np.append(0, np.cumsum(turns))
        both = np.minimum(turns[1:], turns[:-1])
        same = (digests[ragged(off[1:-1], both)] == digests[ragged(off[:-2], both)]).all(axis=1)
        differ = np.flatnonzero(~same)
        pair = np.repeat(np.arange(len(both)), both)[differ]
        pair, at = np.unique(pair, return_index=True)
        shared = np.append(0, both)
        shared[pair + 1] = differ[at] - (np.cumsum(both) - both)[pair]
        added = turns - shared
        maker = np.repeat(np.arange(len(ids)), added)
        place = ragged(off[:-1] + shared, added)   # of each node's last turn
        self.ids, self.digests, self.off = ids, digests, off
        self.depth = np.append(0, place - off[maker] + 1)
        self.maker = np.append(0, maker)
        self.last = np.append(0, lengths[place])
        self.n = len(self.depth)
        end = np.where(added > 0, np.cumsum(added), 0)   # the node that a conversation ends at: the newest one so far
        self.end = np.maximum.accumulate(end)
        nested = Parentheses(preorder(self.depth))
        self.size, self.leaves = nested.subtrees()
        self.members = within(np.bincount(self.end, minlength=self.n), self.size)
        # a node's members are consecutive
        bounds = np.stack([self.maker, self.maker + self.members], 1).ravel()
        self.least = np.minimum.reduceat(np.append(ids, ids[-1]), bounds)[::2]
        key = self.depth * (self.n + 1) + np.arange(self.n)   # the parent is the newest node one level higher
        order = np.argsort(key, kind="stable")
        self.parent = order[np.maximum(np.searchsorted(key[order], key - (self.n + 1)) - 1, 0)]
        self.parent[0] = -1
        self.children = np.bincount(self.parent[1:], minlength=self.n)

    def spine(self, left: int, right: int) -> dict[int, tuple[bytes, bytes | None]]:
        """The nodes on a prefix shared with a neighbouring shard: digests of their path and their parent's."""
        found = chain(range(left + 1), self.digests)   # the first conversation's path comes first
        path, node = [], int(self.end[-1])
        while node >= 0:
            path.append(node)
            node = int(self.parent[node])
        return found | chain(path[::-1][:right + 1], self.digests[self.off[-2]:])


def chain(nodes, digests: np.ndarray) -> dict[int, tuple[bytes, bytes | None]]:
    """Digests by node for ``nodes``, a path from the root, with ``digests`` of its turns."""
    found, above = {}, None
    for i, node in enumerate(nodes):
        own = bytes(DIGEST) if above is None else hashlib.blake2b(above + digests[i - 1].tobytes(), digest_size=DIGEST).digest()
        found[int(node)] = (own, above)
        above = own
    return found


def _batch(kind: int, shard: int, n: int, **columns) -> pa.RecordBatch:
    columns |= {"kind": np.full(n, kind, np.int32), "shard": np.full(n, shard, np.int32)}
    arrays, names = [], []
    for part in ENCODED.split(", "):
        name, sort = part.split(" ")
        t = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[sort]
        x = columns.get(name)
        arrays.append(pa.nulls(n, t) if x is None else x if isinstance(x, pa.Array) else pa.array(x, t))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def encode_shard(number: int, trie: Shard, left: int, right: int):
    """Batches of ENCODED: final nodes, partial figures of spine nodes, and the ids that end at these."""
    shared = trie.spine(left, right)
    spine = np.zeros(trie.n, bool)
    spine[list(shared)] = True
    own = np.where(spine, 0, (trie.members - 1) * trie.last)
    saved = within(own, trie.size)
    childless = trie.size == 1
    leaves = trie.leaves - within((childless & spine).astype(np.int64), trie.size)
    up = np.maximum(trie.parent, 0)
    children = trie.children - np.bincount(up[1:][spine[1:]], minlength=trie.n)   # a spine node counts its spine children when merged
    ends, chunks = np.full(trie.n, NOTHING, object), []
    cuts = np.flatnonzero(np.append(True, trie.end[1:] != trie.end[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(trie.ids))):
        node = trie.end[a]
        if not spine[node]:
            ends[node] = hashlib.sha256(",".join(map(str, trie.ids[a:b].tolist())).encode()).hexdigest()
            continue
        chunks += [(shared[int(node)][0], i, ",".join(map(str, trie.ids[i:min(b, i + CHUNK)].tolist()))) for i in range(a, b, CHUNK)]
    under = spine[up] & (trie.parent >= 0)
    done = np.flatnonzero(~spine)
    for part in np.array_split(done, max(1, len(done) // 50_000)):
        yield _batch(NODE, number, len(part), no=part, parent=np.where(under[part], trie.parent[part], -1), conv_id=trie.least[part], depth=trie.depth[part],
                     parent_conv_id=pa.array(trie.least[up[part]], mask=under[part] | (trie.parent[part] < 0)), n_convs=trie.members[part], n_children=children[part],
                     n_leaves=leaves[part], saved_tokens=saved[part], ends=pa.array(ends[part], pa.string()))
    half = np.flatnonzero(spine)
    if len(half):
        yield _batch(SPINE, number, len(half), no=half, conv_id=trie.least[half], depth=trie.depth[half], n_convs=trie.members[half], n_children=children[half],
                     n_leaves=leaves[half], saved_tokens=saved[half], last=trie.last[half],
                     path=pa.array([shared[int(v)][0] for v in half], pa.binary()), above=pa.array([shared[int(v)][1] for v in half], pa.binary()))
    for part in (chunks[i:i + 50] for i in range(0, len(chunks), 50)):
        yield _batch(ENDS, number, len(part), no=np.array([c[1] for c in part]), ends=pa.array([c[2] for c in part]), path=pa.array([c[0] for c in part], pa.binary()))


def encode(batches):
    """Rows sorted by shard, key and conv_id become ENCODED, shard by shard."""
    held, key = [], None

    def finish():
        ids = np.concatenate([h[0] for h in held])
        digests = np.frombuffer(b"".join(h[1] for h in held), np.uint64).reshape(-1, DIGEST // 8)
        trie = Shard(ids, digests, np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]))
        yield from encode_shard(int(key[0]), trie, int(key[1]), int(key[2]))

    for k, part in Groups(batches, "shard", "left", "right"):
        if key is not None and k != key:
            yield from finish()
            held = []
        key = k
        lists = part.column("lengths")
        held.append((part.column("conv_id").to_numpy(), b"".join(part.column("key").to_pylist()), np.asarray(lists.flatten(), np.int64),
                     np.asarray(lists.value_lengths(), np.int64)))
    if key is not None:
        yield from finish()


def joined_ends(chunks: DataFrame) -> DataFrame:
    """(path, ends_sha256) from rows of joined ids in order of shard and place."""
    def digest(batches):
        path, state = None, None
        for batch in batches:
            done = []
            for p, ids in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
                if p != path:
                    if path is not None:
                        done.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _ends(done)
        if path is not None:
            yield _ends([(path, state.hexdigest())])

    rows = chunks.select("path", "shard", "no", "ends").repartition("path").sortWithinPartitions("path", "shard", "no")
    return rows.mapInArrow(digest, "path binary, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])], names=["path", "ends_sha256"])


def added_up(nodes: DataFrame) -> DataFrame:
    """(path, leaf, own): sums over the subtree of every node of (path, above, depth, leaf, own), in one task."""
    def climb(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([("depth", "descending")])
        paths, above = rows.column("path").to_pylist(), rows.column("above").to_pylist()
        place = {p: i for i, p in enumerate(paths)}
        leaf, own = rows.column("leaf").to_pylist(), rows.column("own").to_pylist()
        for i, p in enumerate(above):   # the deepest first
            if p is not None:
                leaf[place[p]] += leaf[i]
                own[place[p]] += own[i]
        for i in range(0, len(paths), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(paths[i:i + 10_000], pa.binary()), pa.array(leaf[i:i + 10_000], pa.int64()), pa.array(own[i:i + 10_000], pa.int64())],
                                             names=["path", "leaf", "own"])

    return nodes.select("path", "above", "depth", "leaf", "own").coalesce(1).mapInArrow(climb, "path binary, leaf long, own long")


def merge_spines(encoded: DataFrame) -> DataFrame:
    """Spine nodes with their whole figures, one row for each path."""
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = encoded.where(F.col("kind") == SPINE).groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("last").alias("last"),
                                                                       F.max("above").alias("above"), *total)
    below = merged.where("depth > 0").groupBy(F.col("above").alias("_p")).agg(F.count(F.lit(1)).alias("more"))
    merged = merged.join(below, F.col("path") == F.col("_p"), "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("_p", "more")
    merged = materialize(merged.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n_convs") - 1) * F.col("last")), "merged-spines")
    added = added_up(merged).withColumnRenamed("path", "_p")
    parents = merged.select(F.col("path").alias("_q"), F.col("conv_id").alias("parent_conv_id"))
    ends = joined_ends(encoded.where(F.col("kind") == ENDS)).withColumnRenamed("path", "_e")
    whole = (merged.drop("leaf", "own").join(added, F.col("path") == F.col("_p")).join(parents, F.col("above") == F.col("_q"), "left")
             .join(ends, F.col("path") == F.col("_e"), "left"))
    return materialize(whole.select("path", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
                                    (F.col("saved_tokens") + F.col("own")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")), "whole-spines")


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """COLUMNS of every node of the trie of rebuilt conversations."""
    rows = sharded(materialize(rebuilt(conversations), "rebuilt"))
    sorted_rows = rows.repartition("shard").sortWithinPartitions("shard", "key", "conv_id")
    encoded = materialize(sorted_rows.select("shard", "left", "right", "conv_id", "key", "lengths").mapInArrow(encode, ENCODED), "encoded")
    spines = merge_spines(encoded)
    nodes = encoded.where(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256")
    heads = (encoded.where(F.col("kind") == SPINE).select(F.col("shard").alias("_s"), F.col("no").alias("_n"), "path")
             .join(spines.select(F.col("path").alias("_p"), F.col("conv_id").alias("head")), F.col("path") == F.col("_p")).select("_s", "_n", "head"))
    under = nodes.where("parent >= 0").drop("path").join(heads, (F.col("shard") == F.col("_s")) & (F.col("parent") == F.col("_n"))).withColumn("parent_conv_id", F.col("head"))
    return (nodes.where("parent < 0").select(*COLUMNS).unionByName(under.select(*COLUMNS)).unionByName(spines.select(*COLUMNS)))


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'digest': substr(sha256(strlen(role) || ':' || role || text), 1, {2 * DIGEST}), 'length': length(text)}}
               ORDER BY turn NULLS FIRST, role, substr(sha256(strlen(role) || ':' || role || text), 1, {2 * DIGEST})) AS turns FROM t GROUP BY conv_id),
h AS (SELECT *, {crc32_sql('conv_id')} % {HEADS} AS h FROM own),
r AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1:h], []), h.turns[h + 1:]) AS turns FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % {GROUP}),
p AS (SELECT conv_id, turns[1:d] AS path, d AS depth, len(turns) AS n FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(path[-1].length, 0) AS last,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM p GROUP BY path, depth),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (path)),
total AS (SELECT path[1:k] AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * last) AS saved
          FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM full_node) GROUP BY 1)
SELECT f.conv_id, f.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       total.n_leaves::BIGINT AS n_leaves, total.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN total USING (path) LEFT JOIN node up ON f.depth > 0 AND up.path = f.path[1:f.depth - 1]"""
