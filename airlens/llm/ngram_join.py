"""Operator 9: n-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct word shingles; documents with equal sets are
one class from the start. Tokens have one global order, rare before frequent
(``frequent_tokens``: bounded summaries of all documents, the rest by hash).
If two sets are similar enough, then for every l their first
``n - ceil(t * n) + l`` tokens have l in common. Each class takes the l whose
estimated cost is least: longer prefixes read longer posting lists but leave
fewer candidates to verify, as a pair must share min(l, l') prefix tokens.

Links are wanted for components, so pairs that cannot change them are not
made. First, stars: in a posting list every class is paired with one leader of
its size range only, the likeliest leader of each class is verified on whole
sets, and found links merge components; this repeats with other leaders while
it links many classes. That takes work linear in the postings and leaves little of a
large group of near copies (the rounds only save work). Then every pair of classes that shares enough
prefix tokens, fits in size and still lies in two components is verified. So no
link that matters is lost, and a group of copies is never paired with itself.

Before whole sets are compared, short signatures (token parities, whose
difference never exceeds that of the sets) rule most pairs out; whole sets are
made for the documents of the pairs left only. A leader that many classes ask
for is split over tasks.

Defined cases: null, empty or blank text has an empty set and links with nothing;
rows with equal doc_id and repeated rows are documents of their own (with one
component if alike); a null doc_id has the component of its class, null if all
are; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from airlens.llm.chunks import release
from airlens.llm.common import lean, materialize, most_frequent, slices
from airlens.llm.components import components
from airlens.llm.shingles import shingle_sets
from airlens.llm.vectors import Groups

#: Longest multi-match: a pair must share up to so many prefix tokens.
MOST = 3
SUMMARY, FREQUENT = 65536, 262144
#: Rows of at most 16 bytes up to which a counted table is broadcast.
BROADCAST_ROWS = 500_000
#: Stars go on for so many rounds at most, while a round links a class in STAR_GAIN.
STAR_ROUNDS, STAR_GAIN, LEADER_ROWS = 6, 20, 512
#: Bytes of text that are made into sets at once.
SLICE = 2 << 20
#: Bits of a set's signature.
SIGNATURE = 1024
#: Words of 64 bits of the small signature that rows of posting lists carry.
FOLD = 4
#: Cost of one verification in postings read.
VERIFY = 20.0


class Rule:
    """Links at 100 * intersection >= percent * union."""

    def __init__(self, percent: int):
        self.percent = percent

    def overlap(self, n):
        """The least intersection of a set of n with a partner: ceil(t * n)."""
        return -(-self.percent * n // 100)

    def linked(self, n, m, both):
        return 100 * both >= self.percent * (n + m - both)

    def prefix(self, n, match):
        return np.minimum(n, n - self.overlap(n) + match)

    def fits(self, n: Column, m: Column) -> Column:
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def bucket(self, n: Column) -> Column:
        """Sizes that fit lie in one bucket or in neighbouring ones."""
        return F.floor(F.log(n.cast("double")) / F.lit(-math.log(self.percent / 100)) + 1e-9).cast("int")


def frequent_tokens(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, counts), sorted by token: what is frequent inside a task of any size, by summaries of
    SUMMARY tokens at most; the FREQUENT most frequent are kept. It sets an order only."""
    def summarise(batches):
        release()
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, _ = shingle_sets(part.column("text"), width)
                u, c = np.unique(h, return_counts=True)
                keys, at = np.unique(np.concatenate([keys, u[c > 1]]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, c[c > 1]]), len(keys)).astype(np.int64)
                if len(keys) > SUMMARY:
                    top = np.sort(np.argpartition(-counts, SUMMARY - 1)[:SUMMARY])
                    keys, counts = keys[top], counts[top]
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["token", "n"])

    counted = docs.select("text").mapInArrow(lean(summarise), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n >= 4")
    rows = most_frequent(counted, FREQUENT).to_pandas()
    tokens, counts = rows["token"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return tokens[order], counts[order]


class Order:
    """The global order of tokens: rare before frequent, then by hash (hashes are scrambled, so random to texts)."""

    BITS = 22

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        self.tokens, self.counts = tokens, counts
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[tokens & np.uint64((1 << self.BITS) - 1)] = True

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """A token's count if it is frequent, else 0."""
        rank = np.zeros(len(h), np.int64)
        at = np.flatnonzero(self.maybe[h & np.uint64((1 << self.BITS) - 1)])
        if len(at):
            found = np.minimum(np.searchsorted(self.tokens, h[at]), len(self.tokens) - 1)
            rank[at] = np.where(self.tokens[found] == h[at], self.counts[found], 0)
        return rank

    def first(self, own: np.ndarray, rank: np.ndarray, size: int) -> np.ndarray:
        """The first ``size`` tokens of a sorted set."""
        return own[:size] if not rank.any() else own[np.argsort(rank, kind="stable")[:size]]


def signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each set the parity of its tokens in SIGNATURE bins, as 64-bit words. Two sets'
    signatures differ in at most as many bits as the sets differ in tokens."""
    n = len(off) - 1
    doc_of = np.repeat(np.arange(n), np.diff(off))
    odd = np.bincount(doc_of * SIGNATURE + (h >> np.uint64(40)).astype(np.int64) % SIGNATURE, minlength=n * SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(n, SIGNATURE // 64)


def document_sets(docs: DataFrame, width: int, rule: Rule) -> DataFrame:
    """(row, doc_id, text_hash, n, digest, prefix, sig) of every row of ``docs``; prefix for the longest match."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, width))   # FREQUENT entries

    def sets(batches):
        release()
        order = Order(*shared.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, off = shingle_sets(part.column("text"), width)
                n = np.diff(off)
                digests = [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() for a, b in zip(off, off[1:])]
                rank = order.ranks(h)
                size = rule.prefix(n, MOST) * (n > 0)
                kept = [order.first(h[a:b], rank[a:b], k) for a, b, k in zip(off, off[1:], size)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)),
                                                 pa.array(np.concatenate(kept).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), lists,
                     pa.array(list(signatures(h, off)), pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "n", "digest", "prefix", "sig"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        lean(sets), "doc_id long, text_hash long, n long, digest binary, prefix array<long>, sig array<long>")
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "sets")


def _hint(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def postings(sets: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """(token, cls, n, place, match): the chosen prefixes' tokens that several classes have; place counts from 0."""
    one = sets.join(_hint(classes.select(F.col("cls").alias("row"))), "row", "left_semi")
    tokens = one.select(F.col("row").alias("cls"), "n", F.posexplode("prefix").alias("place", "token"))
    several = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    listed = materialize(tokens.join(several, "token").select("token", "cls", "n", "place", "df"), "postings")
    # cost of each match length: postings read, and candidates that may remain, each of which shares l tokens
    least = F.ceil(F.col("n") * rule.percent / 100)

    def cost(match):
        read = F.sum(F.when(F.col("place") < F.col("n") - least + match, F.col("df") - 1).otherwise(0))
        return read + F.lit(VERIFY) * read / match

    choice = listed.groupBy(F.col("cls").alias("_c")).agg(*[cost(m).alias(f"c{m}") for m in range(1, MOST + 1)], F.first(least).alias("least"))
    best = F.least(*[F.col(f"c{m}") for m in range(1, MOST + 1)])
    match = F.lit(1)
    for m in range(MOST, 0, -1):   # the shortest of equal cost; no longer than the intersection must be
        match = F.when((F.col(f"c{m}") <= best) & ((F.lit(m) <= F.col("least")) | F.lit(m == 1)), F.lit(m)).otherwise(match)
    choice = choice.select("_c", match.alias("match"))
    return materialize(listed.join(choice, F.col("cls") == F.col("_c")).where(F.col("place") < F.col("n") - least + F.col("match"))
                       .select("token", "cls", "n", "place", "match"), "prefixes")


def close(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b, ...) whose signatures do not rule out a link: linked sets differ in
    at most (100 - percent) / (100 + percent) of their sizes' sum."""
    one = sets.select(F.col("row").alias("_a"), F.col("n").alias("_na"), F.col("sig").alias("_sa"))
    two = sets.select(F.col("row").alias("_b"), F.col("n").alias("_nb"), F.col("sig").alias("_sb"))
    both = pairs.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))
    differ = F.aggregate(F.zip_with("_sa", "_sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return both.where(differ * (100 + rule.percent) <= (F.col("_na") + F.col("_nb")) * (100 - rule.percent)).select(*pairs.columns)


def whole_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, set) of the classes ``wanted`` (cls), made again from the text of one document each."""
    owners = materialize(sets.join(_hint(wanted), F.col("row") == F.col("cls")).select("cls", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")), "owners")

    def rebuild(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, off = shingle_sets(part.column("text"), width)
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("cls"), lists], names=["cls", "set"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    text = keyed.join(_hint(owners), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h")))
    made = text.select("cls", "text").mapInArrow(lean(rebuild), "cls long, set array<long>")
    return materialize(made.dropDuplicates(["cls"]), "whole-sets")


class WholeSets:
    """Whole sets of the classes asked for so far; a class is made once."""

    def __init__(self, docs: DataFrame, sets: DataFrame, width: int):
        self.docs, self.sets, self.width, self.have = docs, sets, width, None

    def of(self, pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        if self.have is not None:
            wanted = wanted.join(self.have.select("cls"), "cls", "left_anti")
        wanted = materialize(wanted, "wanted")
        if not wanted.isEmpty():
            new = whole_sets(self.docs, self.sets, wanted, self.width)
            self.have = new if self.have is None else self.have.unionByName(new)
        return self.have


def verify(pairs: DataFrame, whole: WholeSets, rule: Rule) -> DataFrame:
    """The pairs (a, b) that are linked. b's set is held while the sets of its a's stream past."""
    pairs = materialize(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    sets = whole.of(pairs)
    share = pairs.groupBy(F.col("b").alias("_b")).agg(F.ceil(F.count(F.lit(1)) / LEADER_ROWS).cast("int").alias("parts"))
    asked = pairs.join(share, F.col("b") == F.col("_b")).withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).select("a", "b", "part")
    members = sets.join(_hint(asked), F.col("cls") == F.col("a")).select("b", "part", F.lit(1).alias("kind"), "cls", "set")
    heads = share.select("_b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    leaders = sets.join(_hint(heads), F.col("cls") == F.col("_b")).select(F.col("_b").alias("b"), "part", F.lit(0).alias("kind"), "cls", "set")

    def compare(batches):
        held_key, held = None, None
        for key, part in Groups(batches, "b", "part", "kind"):
            lists = part.column("set")
            values = np.asarray(lists.flatten())
            ends = np.append(0, np.cumsum(np.asarray(lists.value_lengths())))
            if key[2] == 0:
                held_key, held = key[:2], values[:ends[1]]
                continue
            if key[:2] != held_key:
                raise RuntimeError("a leader's set is missing")
            hit = [c for c, x, y in zip(part.column("cls").to_pylist(), ends, ends[1:])
                   if rule.linked(int(y - x), len(held), len(np.intersect1d(values[x:y], held, assume_unique=True)))]
            if hit:
                yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array([int(key[0])] * len(hit), pa.int64())], names=["a", "b"])

    rows = leaders.unionByName(members).repartition("b", "part").sortWithinPartitions("b", "part", "kind")
    return materialize(rows.mapInArrow(lean(compare), "a long, b long"), "linked")


def _with_component(listed: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Posting lists that still hold several components."""
    if comp is None:
        rows = listed.withColumn("comp", F.col("cls"))
    else:
        rows = (listed.join(_hint(comp), F.col("cls") == F.col("id"), "left").withColumn("comp", F.coalesce("component", "cls"))
                .drop("id", "component"))
    rows = materialize(rows, "merged-postings")
    mixed = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    return rows.join(mixed, "token", "left_semi")


def star_pairs(rows: DataFrame, sets: DataFrame, rule: Rule, turn: int) -> DataFrame:
    """For every class the close leader it has most tokens in common with, of another component and a size that fits."""
    # every other turn the leader is the one with least before the token: what copies were made of has nothing rare of its own
    rows = rows.withColumn("bucket", rule.bucket(F.col("n")))
    first = F.col("place") if turn % 2 == 0 else F.lit(0)
    leaders = rows.groupBy(F.col("token").alias("_t"), F.col("bucket").alias("_b")).agg(
        F.min(F.struct(first.alias("p"), F.xxhash64("cls", F.lit(turn)).alias("h"), F.col("cls").alias("cls"), F.col("n").alias("n"), F.col("comp").alias("comp"))).alias("l"))
    near = rows.select("*", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)).alias("at"))
    met = (near.join(leaders, (F.col("token") == F.col("_t")) & (F.col("at") == F.col("_b")))
           .where((F.col("comp") != F.col("l.comp")) & rule.fits(F.col("n"), F.col("l.n"))))
    counted = met.groupBy(F.col("cls").alias("a"), F.col("l.cls").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    return close(counted, sets, rule).groupBy("a").agg(F.max_by("b", F.struct("c", "b")).alias("b"))


def merged_tokens(rows: DataFrame) -> DataFrame:
    """One row for all tokens that the same classes have, with the first of their places and
    their number (``weight``): long common passages meet once, not at every token."""
    sets = rows.groupBy("token").agg(F.struct(F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("y"),
                                              F.count(F.lit(1)).alias("c")).alias("list"))
    return rows.join(sets, "token").groupBy(F.col("list").alias("token"), "cls").agg(
        F.min("place").alias("place"), F.min("earlier").alias("earlier"), F.count(F.lit(1)).alias("weight"), *[F.first(c).alias(c) for c in ("n", "match", "comp")])


def folded(sets: DataFrame) -> DataFrame:
    """(_c, fold): signatures of FOLD words. Parities of several bins together are parities again,
    so two of them differ in no more bits than the sets differ in tokens."""
    words = SIGNATURE // 64
    bits = [F.col("sig")[k] for k in range(words)]
    fold = []
    for k in range(FOLD):
        word = bits[k]
        for more in bits[k + FOLD::FOLD]:
            word = word.bitwiseXOR(more)
        fold.append(word)
    return sets.select(F.col("row").alias("_c"), F.array(*fold).alias("fold"))


def remaining_pairs(rows: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """All close pairs in two components that share enough prefix tokens.

    A pair meets at a token only if the token can be among the first ``need`` they have in common. At places
    i and j, as the o-th of them, it leaves room for o - 1 + min(n - i, m - j) common tokens; and o is at most
    one more than the listed tokens that either has before it, as earlier common tokens are listed too. The
    smaller set (m) needs fewer of its tokens listed for that than the larger one. A pair whose small signatures
    differ in more bits than linked sets differ in tokens does not meet either."""
    p, whole = rule.percent, 100 + rule.percent
    rows = rows.withColumn("earlier", F.row_number().over(Window.partitionBy("cls").orderBy("place")) - 1)   # of one document's prefix
    rows = merged_tokens(rows).join(folded(sets), F.col("cls") == F.col("_c")).drop("_c")
    rows = materialize(rows.withColumn("slack", F.least(F.col("match") - 1, F.col("earlier"))).drop("earlier"), "merged-tokens")
    other = (rows.where((F.col("n") - F.col("place") + F.col("slack")) * whole >= 2 * p * F.col("n"))
             .select(F.col("token").alias("_t"), F.col("cls").alias("b"), F.col("n").alias("m"), F.col("place").alias("_place"), F.col("slack").alias("_slack"),
                     F.col("match").alias("_match"), F.col("comp").alias("_comp"), F.col("fold").alias("_fold")))
    need = F.least("match", "_match")
    room = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("_place")) + F.least("slack", "_slack")
    larger = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("b") < F.col("cls")))
    differ = sum((F.bit_count(F.col("fold")[k].bitwiseXOR(F.col("_fold")[k])) for k in range(1, FOLD)), F.bit_count(F.col("fold")[0].bitwiseXOR(F.col("_fold")[0])))
    met = rows.join(other, (F.col("token") == F.col("_t")) & larger & (F.col("comp") != F.col("_comp"))
                    & rule.fits(F.col("n"), F.col("m")) & (room * whole >= p * (F.col("n") + F.col("m")))
                    & (differ * whole <= (F.col("n") + F.col("m")) * (100 - p)))
    counted = met.groupBy(F.col("cls").alias("a"), "b").agg(F.sum("weight").alias("c"), F.first(need).alias("need"))
    return close(counted.where("c >= need").select("a", "b"), sets, rule)


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, component) of every row of ``docs``;
    ``component`` numbers components (null for empty sets), ``text_hash`` tells rows of one doc_id apart."""
    rule = Rule(percent)
    sets = document_sets(docs, width, rule)
    classes = materialize(sets.where("n > 0").groupBy("digest", "n").agg(F.min("row").alias("cls"), F.min("doc_id").alias("least")), "classes")
    listed = postings(sets, classes, rule)
    whole = WholeSets(docs, sets, width)
    links, comp = None, None

    def merged(new):
        both = new if links is None else links.unionByName(new)
        return both, components(both)

    members = listed.select("cls").distinct().count()
    for turn in range(STAR_ROUNDS):
        new = verify(star_pairs(_with_component(listed, comp), sets, rule, turn), whole, rule)
        found = new.count()
        if found:
            links, comp = merged(new)
        if found * STAR_GAIN < members:   # little is left of large groups
            break
    new = verify(remaining_pairs(_with_component(listed, comp), sets, rule), whole, rule)
    if not new.isEmpty():
        links, comp = merged(new)
    named = classes.select(F.col("digest").alias("_d"), "cls", "least")
    if comp is not None:
        named = named.join(comp, F.col("cls") == F.col("id"), "left").withColumn("component", F.coalesce("component", "cls"))
        lowest = named.groupBy(F.col("component").alias("_c")).agg(F.min("least").alias("component_id"))
        named = named.join(lowest, F.col("component") == F.col("_c")).select("_d", "component_id", "component")
    else:
        named = named.select("_d", F.col("least").alias("component_id"), F.col("cls").alias("component"))
    full = F.col("n") > 0
    return (sets.select("doc_id", "text_hash", "n", "digest").join(named, F.when(full, F.col("digest")) == F.col("_d"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(full, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "text_hash", "component"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with all their columns, of each component only the row
    with the smallest doc_id (nulls first), then text hash. Rows with empty sets all stay."""
    found = materialize(jaccard_components(docs, width, percent), "components")
    first = found.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select("k.*")
    empty = found.where("component is null").select("doc_id", "text_hash").distinct()
    kept = materialize(first.withColumn("one", F.lit(True)).unionByName(empty.withColumn("one", F.lit(False))), "kept")
    # rows that are the same in doc_id and text: only these have to meet to become one
    again = found.where("component is not null").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_h"), F.struct(*docs.columns).alias("row"))   # names of other columns are theirs
    keys = kept.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_k"), "one")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_k"))
    rows = keyed.join(_hint(keys), same)
    again = materialize(again.select(F.col("doc_id").alias("_rid"), F.col("text_hash").alias("_rh")), "repeated")
    if not again.isEmpty():
        repeated = F.col("doc_id").cast("long").eqNullSafe(F.col("_rid")) & (F.col("_h") == F.col("_rh"))
        single = rows.join(_hint(again), repeated, "left_anti")
        rows = single.unionByName(rows.join(_hint(again), repeated, "left_semi").dropDuplicates(["doc_id", "_h"]))
    return rows.select("row.*")
