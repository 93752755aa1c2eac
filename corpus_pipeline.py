"""From raw documents to packed training sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

1. language_id: documents without a language (no text, no letter, or no language
   likely) go;
2. line_dedup: repeated and almost repeated lines go, the earliest stays; a
   document that had words and has none left goes;
3. ngram_jaccard: of every group of near copies one document stays;
4. source_mix: documents in the order of the target mixture, all of them: the
   files written from it are the mixture in turn;
5. best_fit_packing: pieces of at most 2048 tokens, their sequences and places;
   pieces of a length are taken in the order of the files, so in the mixture's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens.llm import language, line_dedup, mixing, ngram_join, packing
from airlens.llm.common import materialize, table, tokenizer_path
from airlens.session import ensure_checkpoint_dir, ship_package

#: Documents that a Python worker is handed at once.
ARROW_ROWS = "2000"
#: A document goes if its best language has a lower score (one in four is chance with four languages).
MIN_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = language.identify(docs, language.train(docs))
    return known.where((F.col("lang_pred") != language.UND) & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def _has_words(text: str):
    return F.trim(F.translate(text, "\n\t\r", "   ")) != ""


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = docs.select("doc_id", "text", F.coalesce(_has_words("text"), F.lit(False)).alias("had"), F.struct(*docs.columns).alias("row"))
    clean = line_dedup.dedup_documents(packed).where(~F.col("had") | _has_words("text"))
    own = {"text": F.col("text"), "n_chars": F.length("text")}
    return clean.select(*[own.get(c, F.col("row")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048, stored_order=True)


def _ready(fn):
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
        return fn(spark, docs, sf_dir)
    return stage


STAGES = [(name, _ready(fn)) for name, fn in (
    ("language_id", language_id), ("line_dedup", line_dedup_stage), ("ngram_jaccard", ngram_jaccard),
    ("source_mix", source_mix), ("best_fit_packing", best_fit_packing))]

#: Learned and global steps have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
