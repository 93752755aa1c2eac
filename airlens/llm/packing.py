"""Operator 8: best-fit packing after dominance reduction.

Every document is encoded and, only if it has more than ``capacity`` tokens,
cut into full pieces (the first takes the rest). Packing then looks at
lengths only. The histogram of lengths has at most ``capacity`` rows whatever
the corpus holds, so the plan is made on it: ``reduce_dominated`` permanently
fixes sets that provably dominate every other set with the same item
(Martello and Toth's reduction), the rest is packed best-fit decreasing. A plan
is a list of runs, "so many sequences alike, holding these lengths"; every run
takes the next pieces of a length by their rank inside that length, so a piece
finds its sequence and place by a range lookup on (length, rank). Ranks come
from ``rank_within``, which spreads a length that most pieces have; with
``stored_order`` they follow the documents' order in their files (or, for a
frame that is no table of files, its own order), so the sequences fill in it.

Defined cases: null or empty text is the end id alone (one token); rows with
null or repeated doc_ids are documents of their own; other columns are
ignored; an empty table packs into nothing.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from airlens.llm.chunks import ChunkEncoder
from airlens.llm.common import crc32_u32, lean, materialize, slices
from airlens.operators.ranking import rank_within

#: Entries of a worker's cache of pre-tokens here.
CACHE_ENTRIES = 150_000
PIECES = "row_key long, doc_id long, file string, row long, piece int, start long, length long, ids_crc32 long"
RUNS = "length long, rank_from long, rank_to long, per_bin long, first_bin long, offset long"


def in_stored_order(docs: DataFrame) -> DataFrame:
    """``docs`` with file and row: where each stands in the files (a frame of
    another kind is written first, in the order of its partitions)."""
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = materialize(docs.select("doc_id", "text"), "ordered")
    return docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def cut_documents(docs: DataFrame, path: str, end_id: int, capacity: int, stored_order: bool = False) -> DataFrame:
    """One row per piece; ``row_key`` tells rows of one doc_id apart, (file, row) is
    the document's place, null without ``stored_order``."""
    def pieces(batches):
        enc = ChunkEncoder(path, entries=CACHE_ENTRIES)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids, off = enc.encode(part.column("text"))
                keys, doc_ids, files, at = (part.column(c).to_pylist() for c in ("row_key", "doc_id", "file", "row"))
                out = []
                for k, doc_id in enumerate(doc_ids):
                    own = np.append(ids[off[k]:off[k + 1]], np.uint32(end_id))
                    first = len(own) % capacity or capacity
                    cuts = [0, *range(first, len(own) + 1, capacity)]
                    for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        out.append((keys[k], doc_id, files[k], at[k], j, a, b - a, crc32_u32(own[a:b])))
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=["row_key", "doc_id", "file", "row", "piece", "start", "length", "ids_crc32"])

    if stored_order:
        docs = in_stored_order(docs)
    else:
        docs = docs.select("doc_id", "text", F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("row"))
    return docs.select(F.xxhash64("text").alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "file", "row", "text").mapInArrow(lean(pieces), PIECES)


class Stock:
    """How many pieces of each length are left, and which lengths those are (ascending)."""

    def __init__(self, hist: dict[int, int]):
        self.count = {int(w): int(c) for w, c in hist.items() if c > 0}
        self.sizes = sorted(self.count)

    def take(self, w: int, n: int = 1) -> None:
        self.count[w] -= n
        if self.count[w] == 0:
            del self.count[w]
            self.sizes.pop(bisect_left(self.sizes, w))

    def smallest(self, n: int, without: int) -> list[int]:
        """The ``n`` smallest pieces left after one of length ``without`` is put aside."""
        out = []
        for w in self.sizes:
            out += [w] * min(n - len(out), self.count[w] - (w == without))
            if len(out) == n:
                break
        return out

    def largest(self, limit: int, without: int) -> int | None:
        """The largest piece of at most ``limit`` once one of length ``without`` is put aside."""
        at = bisect_left(self.sizes, limit + 1) - 1
        if at >= 0 and self.sizes[at] == without and self.count[without] == 1:
            at -= 1
        return self.sizes[at] if at >= 0 else None

    def best_pair(self, limit: int, without: int) -> int:
        """The largest sum of two pieces of at most ``limit`` (0 if none)."""
        left = dict(self.count)
        left[without] -= 1
        sizes = [w for w in self.sizes if left[w] > 0 and w < limit]
        best, i, j = 0, 0, len(sizes) - 1
        while i <= j:
            total = sizes[i] + sizes[j]
            if total > limit:
                j -= 1
            elif i == j and left[sizes[i]] < 2:
                i += 1
            else:
                best, i = max(best, total), i + 1
        return best


def reduce_dominated(hist: dict[int, int], capacity: int) -> tuple[list[tuple[int, tuple[int, ...]]], dict[int, int]]:
    """Fixed sequences as (how many, lengths), and the histogram left.

    With w a piece, r the room beside it, and k the largest other piece that
    fits into r, the set is fixed as
    * {w} if no other piece fits;
    * {w, k} if k fills r exactly, or if no two other pieces fit into r, or if
      no three do and no two have a sum above k: whatever else stood beside w
      could stand in k's place in another sequence.
    """
    stock, fixed = Stock(hist), []
    for w in list(stock.sizes):   # exact pairs, for all pieces of a length at once
        if w not in stock.count:
            continue
        if w == capacity:
            fixed.append((stock.count[w], (w,)))
            stock.take(w, stock.count[w])
        elif 2 * w < capacity and capacity - w in stock.count:
            n = min(stock.count[w], stock.count[capacity - w])
            fixed.append((n, (capacity - w, w)))
            stock.take(w, n)
            stock.take(capacity - w, n)
        elif 2 * w == capacity and stock.count[w] > 1:
            n = stock.count[w] // 2
            fixed.append((n, (w, w)))
            stock.take(w, 2 * n)
    at = len(stock.sizes) - 1
    while at >= 0 and stock.sizes:   # from the largest down, until no set dominates
        at = min(at, len(stock.sizes) - 1)
        w = stock.sizes[at]
        room = capacity - w
        k = stock.largest(room, w)
        if k is None:
            n = stock.count[w] if 2 * w > capacity else 1   # nothing fits beside any of them
            fixed.append((n, (w,)))
            stock.take(w, n)
            at -= w not in stock.count
            continue
        low = stock.smallest(3, w)
        two = len(low) >= 2 and low[0] + low[1] <= room
        three = len(low) >= 3 and sum(low) <= room
        if not two or (not three and stock.best_pair(room, w) <= k):
            if not two and k != w and k not in low[:2]:
                # while k lasts, and while the two smallest stay, the same holds for the next pair
                n = min(stock.count[w], stock.count[k])
            else:
                # three pieces of a length beside w are all that the conditions look at: the same
                # holds for the next pair while there are four of w and of k
                n = max(1, (stock.count[w] - 2) // 2 if k == w else min(stock.count[w], stock.count[k]) - 3)
            fixed.append((n, (w, k)))
            stock.take(w, n)
            stock.take(k, n)
            at = min(at, len(stock.sizes) - 1)
            continue
        at -= 1
    return fixed, stock.count


def best_fit(hist: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing on a histogram: (how many sequences, lengths) with
    all pieces of one length and all sequences with one room handled at once."""
    open_bins: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}
    rooms: list[int] = []

    def add(room: int, n: int, held: tuple[tuple[int, int], ...]) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append((n, held))

    for w in sorted(hist, reverse=True):
        left = hist[w]
        while left:
            at = bisect_left(rooms, w)
            if at == len(rooms):
                each = capacity // w
                n, rest = divmod(left, each)
                if n:
                    add(capacity - each * w, n, ((w, each),))
                if rest:
                    add(capacity - rest * w, 1, ((w, rest),))
                break
            room = rooms[at]
            n, held = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            # a sequence takes further pieces of this length while it stays the best fit for them:
            # the room it gets is smaller than any other that fits, so it takes all it can
            each = room // w
            full = min(n, left // each)
            if full:
                add(room - each * w, full, held + ((w, each),))
                left, n = left - full * each, n - full
            if n and left:
                add(room - left * w, 1, held + ((w, left),))
                left, n = 0, n - 1
            if n:
                add(room, n, held)
    return [(n, tuple(w for w, m in held for _ in range(m))) for group in open_bins.values() for n, held in group]


def plan(hist: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    fixed, rest = reduce_dominated(hist, capacity)
    return fixed + best_fit(rest, capacity)


def runs(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, per_bin, first_bin, offset): the pieces of
    a length with such ranks go, ``per_bin`` to a sequence, to first_bin and on."""
    used: dict[int, int] = {}
    out, first = [], 0
    for n, lengths in patterns:
        offset, i = 0, 0
        while i < len(lengths):
            w, per = lengths[i], 1
            while i + per < len(lengths) and lengths[i + per] == w:
                per += 1
            a = used.get(w, 0)
            used[w] = a + n * per
            out.append((w, a, a + n * per, per, first, offset))
            offset, i = offset + per * w, i + per
        first += n
    return out


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = 2048, stored_order: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    pieces = materialize(cut_documents(docs, path, end_id, capacity, stored_order), "pieces")
    hist = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}   # capacity rows at most
    rows = runs(plan(hist, capacity))
    # file names count their parts with five digits at least, so a longer name is a later part
    place = [F.length("file"), "file", "row"] if stored_order else []
    ranked = rank_within(pieces, ["length"], [*place, "doc_id", "row_key", "piece"], out="rank")
    # all runs of a length in one row, by ascending rank: at most ``capacity`` rows
    table = (spark.createDataFrame(rows, RUNS) if rows else spark.createDataFrame([], RUNS))
    by_length = table.groupBy(F.col("length").alias("_length")).agg(
        F.sort_array(F.collect_list(F.struct("rank_from", "rank_to", "per_bin", "first_bin", "offset"))).alias("_runs"))
    r = F.col("rank") - 1
    joined = ranked.join(F.broadcast(by_length), F.col("length") == F.col("_length"))
    placed = joined.withColumn("_run", F.filter("_runs", lambda x: (x.rank_from <= r) & (r < x.rank_to))[0])
    place = r - F.col("_run.rank_from")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_run.first_bin") + F.floor(place / F.col("_run.per_bin"))).cast("long").alias("sequence_id"),
        (F.col("_run.offset") + (place % F.col("_run.per_bin")) * F.col("length")).cast("long").alias("offset"))
