"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airlens.llm import chat, embedding_dedup, language, line_dedup, merkle, mixing, neighbours, ngram_join, packing, pii, prefix_trie, token_counts, token_files
from airlens.llm.common import table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_OP6 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS d, vec_id AS r FROM embeddings UNION SELECT reach.d, l.b FROM reach JOIN l ON l.a = reach.r)
SELECT d AS vec_id, (SELECT count(*) FROM l WHERE l.a = d)::BIGINT AS n_links, min(r) AS component_id, min(r) = d AS kept
FROM reach GROUP BY d"""

_OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                     ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, e.b FROM reach JOIN e ON e.a = reach.r)
SELECT d AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d"""


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@register("op1_token_files")
def op1(spark, sf_dir):
    return token_files.encode_table(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)


@register("op2_chat_format", chat.ORACLE)
def op2(spark, sf_dir):
    return chat.format_table(spark, chat.with_probe(table(spark, sf_dir, "conversations")), chat.TEMPLATE)


@register("op3_token_counts")
def op3(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), limit=4096)


@register("op4_line_dedup", line_dedup.ORACLE)
def op4(spark, sf_dir):
    return line_dedup.dedup_table(table(spark, sf_dir, "documents"))


@register("op5_source_mix", mixing.ORACLE)
def op5(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("_h")


@register("op6_embedding_dedup", _OP6)
def op6(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@register("op7_language_id")
def op7(spark, sf_dir):
    return language.predict_table(table(spark, sf_dir, "documents"))


@register("op8_best_fit_packing")
def op8(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


@register("op9_ngram_jaccard", _OP9)
def op9(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85).drop("text_hash", "component")


@register("op10_nearest_neighbours")
def op10(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"), k=10, every=100)


@register("op11_merkle_manifest", merkle.ORACLE)
def op11(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


@register("op13_prefix_trie", prefix_trie.ORACLE)
def op13(spark, sf_dir):
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


@register("op12_personal_data")
def op12(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))
