"""Operator 11: Merkle manifest of a dataset, with a proof per row.

A row's leaf is the hash of its fields. Per ``tree`` (a lang) leaves are ranked, and every 2
consecutive nodes become one node of the next level until one is left, the subroot; subroots in
order of their langs give the root the same way.

Levels are built and stored as pages, the rows of a linked table: a page holds PAGE_LEVELS levels
above up to 256 consecutive nodes and links to the page above it by number. So building takes one
aggregation for every PAGE_LEVELS levels, and no group has more than 256 nodes. A page above the
lowest serves all leaves below it; it is stored once for each lowest page, as the path from there,
so no key of the climb has more than 256 leaves, however large a tree is.

A Spark recursive query then climbs from every leaf, page by page: a step joins the page that the
leaf stands under, appends the siblings met there and folds the (possibly tampered) hash with them.
Every step is a row of its own (``tier``), so siblings travel once; a leaf's rows in order are its
proof. Hashes travel as 32 bytes and are hashed as hex text.

Defined cases: null fields count as ``-``, so a null text and an empty one differ; leaves with equal or
null doc_id ascend by leaf (nulls first), and repeated rows are leaves of their own; a null lang is
a tree of its own, before all others; a lone leaf is its subroot, a lone subroot the root, with the
proof of no siblings; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from airlens.llm.common import crc32_sql, materialize
from airlens.operators.ranking import rank_within

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a page, which stands above 2 ** PAGE_LEVELS nodes at most.
PAGE_LEVELS = 8
#: One in so many ids (by crc32) has one added to n_chars.
TAMPER = 7
#: Steps of a climb that Spark allows; 13 reach beyond 2 ** 100 leaves.
MOST_STEPS = 100


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def text(h: Column) -> Column:
    return F.lower(F.hex(h))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, pos, doc_id, leaf, changed); ``changed`` is the tampered leaf, where there is one."""
    columns = {c: F.col(c) for c in FIELDS}
    plus = columns | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = (F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0) & F.col("n_chars").isNotNull()
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_hash(list(columns.values())).alias("leaf"), F.when(hit, leaf_hash(list(plus.values()))).alias("changed"))
    ranked = rank_within(materialize(rows, "leaves"), ["tree"], ["doc_id", "leaf"], out="pos")
    return materialize(ranked.withColumn("pos", F.col("pos") - 1), "ranked-leaves")


def _above(level: Column) -> Column:
    """The next level: every 2 consecutive nodes become one."""
    pair = lambda i: F.concat(text(F.get(level, 2 * i)), F.coalesce(text(F.get(level, 2 * i + 1)), F.lit("")))
    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(level) / 2).cast("int") - 1), lambda i: F.unhex(F.sha2(pair(i), 256)))


def pages(nodes: DataFrame) -> DataFrame:
    """(tree, pos, levels, top) from the nodes (tree, pos, hash) of one level: a page's levels from
    these nodes up, without its top. A tree of one page ends where one node is left."""
    count = nodes.groupBy("tree").agg(F.max("pos").alias("last"))   # positions are gapless from 0
    made = (nodes.groupBy("tree", F.shiftright("pos", PAGE_LEVELS).alias("page"))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"]).alias("nodes")))
    # ceil(log2(n)) levels lead from n nodes to one; last = n - 1 has so many binary digits
    digits = F.when(F.col("last") == 0, 0).otherwise(F.length(F.bin("last")))
    made = made.join(count.select(F.col("tree").alias("_t"), F.least(digits, F.lit(PAGE_LEVELS)).alias("up")), F.col("tree") == F.col("_t"))
    climb = F.when(F.col("up") > 0, F.sequence(F.lit(1), F.col("up"))).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(climb, F.array("nodes"), lambda done, _: F.concat(done, F.array(_above(F.element_at(done, -1)))))
    made = made.select("tree", F.col("page").alias("pos"), levels.alias("levels"))
    return made.select("tree", "pos", F.slice("levels", 1, F.size("levels") - 1).alias("levels"), F.get(F.element_at("levels", -1), F.lit(0)).alias("top"))


def paths(above: DataFrame) -> DataFrame:
    """(tree, pos, at, levels) of every node that a page stands on: ``levels`` holds, level by level,
    nothing but its sibling there (null: none); ``at`` is its place below the page."""
    under = F.when(F.size("levels") > 0, F.size(F.get("levels", F.lit(0)))).otherwise(F.lit(1))
    each = above.select("tree", "pos", "levels", "top", F.explode(F.sequence(F.lit(0), under - 1)).alias("at"))
    sibling = F.transform("levels", lambda level, k: F.array(F.get(level, F.call_function("shiftright", F.col("at"), k).bitwiseXOR(F.lit(1)))))
    return each.select("tree", (F.shiftleft("pos", PAGE_LEVELS) + F.col("at")).alias("pos"), "at", sibling.alias("levels"), "top")


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pages of every tier, lowest first, and the tops (tree, hash) of all trees."""
    tiers, tops = [], []
    while True:
        tier = materialize(pages(nodes), "pages")
        tiers.append(tier)
        wide = tier.groupBy("tree").agg(F.max("pos").alias("last"), F.max("top").alias("hash"))
        wide = materialize(wide, "tops")
        tops.append(wide.where("last = 0").select("tree", "hash"))
        left = wide.where("last > 0").select(F.col("tree").alias("_t"))
        if left.isEmpty():
            return tiers, materialize(reduce(DataFrame.unionByName, tops), "roots")
        nodes = tier.join(left, F.col("tree") == F.col("_t"), "left_semi").select("tree", "pos", F.col("top").alias("hash"))


def steps(ranked: DataFrame) -> tuple[DataFrame, str | None]:
    """The linked rows (tree, page, tier, at, levels, subroot) that a leaf of the lowest ``page`` climbs by,
    and the root. The last rows of a tree are those of the tree of subroots."""
    tiers, tops = build(ranked.select("tree", "pos", F.col("leaf").alias("hash")))
    none, no_hash = F.lit(None).cast("int"), F.lit(None).cast("binary")
    lowest = tiers[0].select("tree", F.col("pos").alias("page"))
    rows = [tiers[0].select("tree", F.col("pos").alias("page"), F.lit(0).alias("tier"), none.alias("at"), "levels", no_hash.alias("subroot"))]
    for t, tier in enumerate(tiers[1:], 1):
        way = paths(tier).select(F.col("tree").alias("_t"), F.col("pos").alias("_p"), "at", "levels")
        under = lowest.join(way, (F.col("tree") == F.col("_t")) & (F.shiftright("page", PAGE_LEVELS * (t - 1)) == F.col("_p")))
        rows.append(under.select("tree", "page", F.lit(t).alias("tier"), "at", "levels", no_hash.alias("subroot")))
    # the tree of subroots: its leaves are ranked by tree, its pages follow the tree's own
    heads = materialize(rank_within(tops, [], ["tree"], out="rank").select("tree", "hash", (F.col("rank") - 1).alias("pos"), F.lit("").alias("all")), "subroots")
    upper, root = build(heads.select(F.col("all").alias("tree"), "pos", "hash"))
    own = tiers[0].select("tree", F.lit(1).alias("t"))
    for t, tier in enumerate(tiers[1:], 2):
        own = own.unionByName(tier.select("tree", F.lit(t).alias("t")))
    own = own.groupBy(F.col("tree").alias("_o")).agg(F.max("t").alias("own"))
    trees = materialize(heads.join(own, F.col("tree") == F.col("_o")).select(F.col("tree").alias("_t"), F.col("hash").alias("subroot"), "pos", "own"), "trees")
    for t, tier in enumerate(upper):
        way = paths(tier).select(F.col("pos").alias("_p"), "at", "levels")
        above = trees.join(way, F.shiftright("pos", PAGE_LEVELS * t) == F.col("_p")).select("_t", "subroot", "own", "at", "levels")
        rows.append(lowest.join(above, F.col("tree") == F.col("_t")).select("tree", "page", (F.col("own") + t).alias("tier"), "at", "levels", "subroot"))
    found = root.first()
    return materialize(reduce(DataFrame.unionByName, rows), "steps"), text(F.lit(found.hash)) if found else None


CLIMB = f"""
WITH RECURSIVE climb(tree, pos, tier, folded, siblings, subroot) MAX RECURSION LEVEL {MOST_STEPS} AS (
  SELECT tree, pos, 0, coalesce(changed, leaf), CAST('' AS BINARY), CAST(NULL AS BINARY) FROM {{leaves}}
  UNION ALL
  SELECT tree, pos, tier + 1, fold.h, fold.met, subroot FROM (
    SELECT tree, pos, tier, subroot, aggregate(
      IF(size(levels) > 0, sequence(0, size(levels) - 1), CAST(array() AS ARRAY<INT>)), named_struct('h', folded, 'met', CAST('' AS BINARY)),
      (f, k) -> named_struct(
        'h', unhex(sha2(CASE WHEN get(levels[k], IF(on_path, 0, shiftright(place, k) ^ 1)) IS NULL THEN lower(hex(f.h))
                             WHEN shiftright(place, k) & 1 = 1 THEN lower(hex(get(levels[k], IF(on_path, 0, shiftright(place, k) ^ 1)) || f.h))
                             ELSE lower(hex(f.h || get(levels[k], IF(on_path, 0, shiftright(place, k) ^ 1)))) END, 256)),
        'met', f.met || coalesce(get(levels[k], IF(on_path, 0, shiftright(place, k) ^ 1)), CAST('' AS BINARY)))) AS fold
    FROM (SELECT c.tree, c.pos, c.tier, c.folded, s.subroot, s.levels, s.at IS NOT NULL AS on_path,
                 coalesce(s.at, CAST(c.pos & {(1 << PAGE_LEVELS) - 1} AS INT)) AS place
          FROM climb c JOIN {{steps}} s ON s.tree = c.tree AND s.page = shiftright(c.pos, {PAGE_LEVELS}) AND s.tier = c.tier)))
SELECT tree, pos, tier, folded, siblings, subroot FROM climb"""


def climb(ranked: DataFrame, linked: DataFrame) -> DataFrame:
    """(tree, pos, tier, folded, siblings, subroot): where each leaf stands after each step."""
    spark = ranked.sparkSession
    names = {"leaves": f"merkle_leaves_{id(ranked)}", "steps": f"merkle_steps_{id(linked)}"}
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    ranked.createOrReplaceTempView(names["leaves"])
    linked.createOrReplaceTempView(names["steps"])
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")   # the steps end the climb, not a number of rows
    try:
        return materialize(spark.sql(CLIMB.format(**names)), "climb")
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
        for name in names.values():
            spark.catalog.dropTempView(name)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, lang) of every row of ``docs``."""
    ranked = leaves(docs)
    linked, root = steps(ranked)
    empty = F.lit(None)
    rows = climb(ranked, linked).unionByName(
        ranked.select("tree", "pos", F.lit(-1).alias("tier"), *[empty.cast("binary").alias(c) for c in ("folded", "siblings", "subroot")], "doc_id", "leaf"),
        allowMissingColumns=True)
    met = F.transform(F.array_sort(F.collect_list(F.when(F.col("tier") > 0, F.struct("tier", text(F.col("siblings")).alias("s"))))), lambda x: x["s"])
    whole = rows.groupBy("tree", "pos").agg(F.max("doc_id").alias("doc_id"), F.max("leaf").alias("leaf"), F.max("subroot").alias("subroot"),
                                            F.max_by("folded", "tier").alias("folded"), F.sha2(F.array_join(met, ""), 256).alias("proof_sha256"))
    root = F.lit(None).cast("string") if root is None else root
    return whole.select("doc_id", text(F.col("leaf")).alias("leaf"), text(F.col("subroot")).alias("subroot"), root.alias("root"), "proof_sha256",
                        text(F.col("folded")).alias("folded_root"), (text(F.col("folded")) == root).alias("verified"))


def _sql_field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT *, coalesce('=' || lang, '') AS tree, {_sql_leaf('n_chars')} AS leaf,
         CASE WHEN {crc32_sql('doc_id')} % {TAMPER} = 0 AND n_chars IS NOT NULL THEN {_sql_leaf('(n_chars + 1)')} END AS changed
  FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
up(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM ranked
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM up WHERE n > 1 GROUP BY tree, level, pos // 2),
subs AS (SELECT tree, level AS depth, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM up WHERE n = 1),
top(level, pos, h, n) AS (
  SELECT 0, place, subroot, count(*) OVER () FROM subs
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2),
sib AS (
  SELECT r.tree, r.pos, u.level, u.h, u.pos % 2 AS other FROM ranked r JOIN up u ON u.tree = r.tree AND u.pos = xor(r.pos >> u.level, 1)
  UNION ALL
  SELECT r.tree, r.pos, s.depth + t.level, t.h, t.pos % 2 FROM ranked r JOIN subs s USING (tree) JOIN top t ON t.pos = xor(s.place >> t.level, 1)),
proof AS (SELECT tree, pos, sha256(string_agg(h, '' ORDER BY level)) AS p FROM sib GROUP BY ALL),
height AS (SELECT tree, depth, depth + (SELECT max(level) FROM top) AS total FROM subs),
fold(tree, pos, level, h) AS (
  SELECT tree, pos, 0, coalesce(changed, leaf) FROM ranked
  UNION ALL
  SELECT f.tree, f.pos, f.level + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.other = 0 THEN s.h || f.h ELSE f.h || s.h END)
  FROM fold f JOIN height USING (tree) LEFT JOIN sib s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level WHERE f.level < total)
SELECT r.doc_id, r.leaf, s.subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(p.p, sha256('')) AS proof_sha256,
       f.h AS folded_root, f.h = (SELECT h FROM top WHERE n = 1) AS verified
FROM ranked r JOIN subs s USING (tree) LEFT JOIN proof p ON p.tree = r.tree AND p.pos = r.pos
JOIN height ON height.tree = r.tree JOIN fold f ON f.tree = r.tree AND f.pos = r.pos AND f.level = height.total"""
