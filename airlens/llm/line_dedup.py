r"""Operator 4 [native]: line dedup by a deletion-neighbourhood join.

Lines are compared lower-cased and trimmed, as sequences of the words between
single blanks (two blanks in a row enclose an empty word). A line that is not
blank and has at least ``min_words`` words (one, so every such line) goes if an
earlier line (by doc_id, text hash, line number) is the same, and a line of at least ``near_words`` words also if an earlier one
is within one word edit (a word replaced, inserted or left out). Two lines are
that close exactly if they have a common deletion variant (the line without
one word, or the line itself); variants are joined by hash and every pair found
is verified on the words. A line is measured against all earlier lines, gone
or not, so the result does not depend on any order of work.

How the work stays small, without a Python function, a pair within a group or
an array of variants:

* equal lines are merged first (map-side partial aggregation), so a line that a
  third of all rows repeat is one row from then on;
* one edit leaves the first or the second half of a line as it is, so only lines
  that share a half (of the lengths in question) with another line make
  variants: the others have no partner;
* the hash of a variant is the exclusive or of its words' hashes with their
  places, so a running window gives all variants of a line in linear time;
* lines with a variant in common at the same place are all one replacement
  apart: each is checked against the earliest of them only, and a line against
  its own variants' owners, so candidates grow with the lines, not with pairs.

A table is broadcast only if its counted rows are at most ``BROADCAST_ROWS``;
beyond that the same join shuffles.

Defined cases: null text stays null with no lines; blank lines
always stay; a row repeated as a whole counts as one document (both rows keep
the same lines); null doc_ids come first; a document may be left with the empty
text; other columns are carried along by ``dedup_documents``; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airlens.llm.common import materialize

MIN_WORDS, NEAR_WORDS = 1, 8
#: Rows (of at most about 100 bytes) up to which a counted table is broadcast.
BROADCAST_ROWS = 400_000


def small(df: DataFrame) -> DataFrame:
    """``df``, materialized; with a broadcast hint if it is counted to be small."""
    df = materialize(df, "lines")
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("doc_hash"), "text")


def _lines(keyed: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, line_no, line) of every line, lower-cased and trimmed."""
    lines = keyed.select("doc_id", "doc_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    return lines.select("doc_id", "doc_hash", "line_no", F.lower(F.trim("raw")).alias("line"))


def _line_key() -> Column:
    return F.struct(F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def _words() -> Column:
    """The number of words: one more than blanks."""
    return F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1


def _halves() -> Column:
    """Keys that two lines within one edit have in common: for the line's own
    length and the one below (a longer partner's view), the first and the second half."""
    def pair(length: Column) -> list[Column]:
        first = F.floor(length / 2).cast("int")
        return [F.xxhash64(length, F.lit(side), F.call_function("substring_index", F.col("line"), F.lit(" "), count))
                for side, count in ((0, first), (1, first - length))]

    return F.array(*pair(F.col("n")), *pair(F.col("n") - 1))


def distinct_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """One row per different line, not blank, of at least ``min_words`` words: id, key, first place, copies, n, halves."""
    lines = _lines(_keyed(docs)).withColumn("n", _words()).where((F.col("line") != "") & (F.col("n") >= min_words))
    rows = lines.select(_line_key().alias("key"), F.struct("doc_id", "doc_hash", "line_no").alias("place"), "n",
                        F.when(F.col("n") >= near_words, _halves()).alias("halves"))
    merged = rows.groupBy("key").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies"),
                                     F.first("n").alias("n"), F.first("halves").alias("halves"))
    return materialize(merged.withColumn("id", F.monotonically_increasing_id()), "distinct-lines")


def _after_prefix(a: Column, b: Column) -> Column:
    """The first place (from 1) where two word arrays differ, one past the shorter if none."""
    same = F.array_position(F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))),
                                       lambda x, y: x == y), F.lit(False))
    return F.when(same == 0, F.least(F.size(a), F.size(b)) + 1).otherwise(same).cast("int")


def within_one_edit(a: Column, b: Column, at: Column) -> Column:
    """Whether one replacement, insertion or deletion at ``at`` (see ``_after_prefix``) makes b of a."""
    def rest(x, start):
        return F.slice(x, start, F.greatest(F.size(x) - start + 1, F.lit(0)))

    return (F.when(F.size(a) == F.size(b), rest(a, at + 1) == rest(b, at + 1))
             .when(F.size(a) == F.size(b) + 1, rest(a, at + 1) == rest(b, at))
             .when(F.size(b) == F.size(a) + 1, rest(b, at + 1) == rest(a, at)).otherwise(F.lit(False)))


def near_pairs(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(id, earlier) of lines and an earlier line within one edit (the lines themselves differ)."""
    exploded = distinct.where("halves is not null").select("id", F.explode(F.array_distinct("halves")).alias("half"))
    shared = small(exploded.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half"))
    ids = small(exploded.join(shared, "half", "left_semi").select("id").distinct())
    wanted = small(distinct.join(ids, "id", "left_semi").select("id", "place", "n"))

    # the words of these lines, from the documents that hold their first places
    owners = small(wanted.select(F.col("place.doc_id").alias("_id"), F.col("place.doc_hash").alias("_hash")).distinct())
    holding = _keyed(docs).join(owners, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_hash") == F.col("_hash")), "left_semi")
    at = F.struct("doc_id", "doc_hash", "line_no")
    words = materialize(_lines(holding).select(at.alias("at"), "line").join(wanted, F.col("at").eqNullSafe(F.col("place")))
                        .select("id", "place", "n", F.split("line", " ").alias("words")).dropDuplicates(["id"]), "near-words")

    # every variant's hash in linear time: words before the gap at their own places, words after it one place down
    each = words.select("id", "place", "n", F.posexplode("words").alias("i", "word")).select(
        "id", "place", "n", "i", F.xxhash64("word", "i").alias("own"), F.xxhash64("word", F.col("i") - 1).alias("down"))
    line = Window.partitionBy("id")
    upto = line.orderBy("i")
    variants = each.select(
        "id", "place", "n", "i",
        F.coalesce(F.bit_xor("own").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
        .bitwiseXOR(F.bit_xor("down").over(line))
        .bitwiseXOR(F.bit_xor("down").over(upto.rowsBetween(Window.unboundedPreceding, 0))).alias("variant"))
    variants = materialize(variants, "variants")
    whole = each.groupBy("id", "place", "n").agg(F.bit_xor("own").alias("whole"))

    # one replacement apart: the same variant with the gap at the same place
    group = ["n", "i", "variant"]
    first = variants.groupBy(*group).agg(F.min(F.struct("place", "id")).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    replaced = (variants.join(first.select(*group, "first"), group).where(F.col("id") != F.col("first.id"))
                .select("id", F.col("first.id").alias("earlier")))
    # one insertion apart: a line that is the variant of a longer one
    longer = variants.select(F.col("id").alias("long_id"), F.col("place").alias("long_place"), (F.col("n") - 1).alias("n"), "variant").distinct()
    shorter = whole.select(F.col("id").alias("short_id"), F.col("place").alias("short_place"), "n", F.col("whole").alias("variant"))
    both = longer.join(shorter, ["n", "variant"])
    inserted = both.where(F.col("short_place") < F.col("long_place")).select(F.col("long_id").alias("id"), F.col("short_id").alias("earlier"))
    left_out = (both.where(F.col("long_place") < F.col("short_place")).groupBy("short_id")
                .agg(F.min(F.struct("long_place", "long_id")).alias("first")).select(F.col("short_id").alias("id"), F.col("first.long_id").alias("earlier")))
    pairs = replaced.unionByName(inserted).unionByName(left_out).distinct()

    own = words.select(F.col("id").alias("_a"), F.col("words").alias("wa"))
    other = words.select(F.col("id").alias("_b"), F.col("words").alias("wb"))
    checked = (pairs.join(own, F.col("id") == F.col("_a")).join(other, F.col("earlier") == F.col("_b"))
               .withColumn("differ", _after_prefix(F.col("wa"), F.col("wb")))
               .where(within_one_edit(F.col("wa"), F.col("wb"), F.col("differ"))))
    return checked.select("id", "earlier")


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """(doc_id, doc_hash, lines) of documents that lose lines; ``lines`` are their numbers from 0."""
    distinct = distinct_lines(docs, min_words, near_words)
    near = near_pairs(docs, distinct).select("id").distinct()
    # a line near an earlier one goes wherever it stands, a repeated one everywhere but at its first place
    marked = distinct.join(small(near.withColumnRenamed("id", "_near")), F.col("id") == F.col("_near"), "left")
    rule = small(marked.where("_near is not null or copies > 1")
                 .select(F.col("key").alias("_key"), F.when(F.col("_near").isNull(), F.col("place")).alias("place")))
    lines = _lines(_keyed(docs)).select("doc_id", "doc_hash", "line_no", _line_key().alias("key"))
    hits = (lines.join(rule, F.col("key") == F.col("_key"))
            .where(F.col("place").isNull() | ~F.struct("doc_id", "doc_hash", "line_no").eqNullSafe(F.col("place"))))
    return hits.groupBy("doc_id", "doc_hash").agg(F.collect_set("line_no").alias("lines"))


def dedup_documents(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` with all its columns, the text without the dropped lines, and n_lines, n_dropped
    (in place of columns of these names, if it has any)."""
    drop = small(dropped_lines(docs, min_words, near_words)).select(F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_hash"), F.col("lines").alias("_drop"))
    all_lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_drop"))
    text = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))   # names of other columns are theirs
    joined = packed.join(drop, same, "left")
    return joined.select(*[text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")],
                         F.coalesce(F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1,
                                    F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_table(docs: DataFrame) -> DataFrame:
    return dedup_documents(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", "text")


ORACLE = rf"""
WITH lines AS (
  SELECT doc_id, line, i - 1 AS line_no, string_split(lower(trim(line)), ' ') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
d AS (SELECT w, len(w) AS n, min((doc_id, line_no)) AS place FROM lines WHERE len(w) >= {MIN_WORDS} AND w <> [''] GROUP BY w),
v AS (SELECT w, n, place, i, hash(w[1:i - 1] || w[i + 1:]) AS v, len(w) - 1 AS vn
      FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d WHERE n >= {NEAR_WORDS})),
f AS (SELECT w, n, place, hash(w) AS v FROM d WHERE n >= {NEAR_WORDS}),
near AS (SELECT DISTINCT a.w FROM v a JOIN v b ON a.v = b.v AND a.n = b.n AND a.i = b.i AND b.place < a.place
         UNION SELECT a.w FROM v a JOIN f b ON a.v = b.v AND a.vn = b.n AND b.place < a.place
         UNION SELECT b.w FROM v a JOIN f b ON a.v = b.v AND a.vn = b.n AND a.place < b.place),
marked AS (SELECT l.*, len(l.w) >= {MIN_WORDS} AND l.w <> [''] AND (d.place <> (l.doc_id, l.line_no) OR near.w IS NOT NULL) AS gone
           FROM lines l LEFT JOIN d ON d.w = l.w LEFT JOIN near ON near.w = l.w)
SELECT doc_id, count(line_no)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT coalesce(gone, false)), '') AS text
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL"""
