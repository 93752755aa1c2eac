"""The registered queries: oracle SQL on sf0.001, entry, and the pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from airlens.llm import language, line_dedup, mixing
from airlens.llm.common import materialize
from airlens.llm.queries import ORACLES, QUERIES
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_ngrams import brute as brute_groups
from tests.llm.test_tokens import check_packing, ordered
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "ngram_jaccard", "source_mix", "best_fit_packing"]

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    known = stages["language_id"](spark, docs, SF).cache()
    model = language.identify(docs, language.train(docs))
    assert rows(known) == rows(model.where(f"lang_pred <> 'und' and score >= {corpus_pipeline.MIN_SCORE}").select(*docs.columns))

    clean = stages["line_dedup"](spark, known, SF).cache()
    want = brute_lines(ordered(known), line_dedup.MIN_WORDS, line_dedup.NEAR_WORDS)
    left = [(r.doc_id, want[(r.doc_id, r.text)][2], r.lang, r.source) for r in known.collect()]
    assert rows(clean) == sorted([(d, t, l, s, len(t)) for d, t, l, s in left if t.strip()], key=str)

    single = stages["ngram_jaccard"](spark, clean, SF).cache()
    groups, _ = brute_groups([(r.doc_id, r.text) for r in clean.collect()], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, n, c in groups if n == 0 or d == c)

    mixed = stages["source_mix"](spark, single, SF)
    assert rows(mixed) == rows(single)
    got, _ = check_packing(mixed, 2048)
    out = stages["best_fit_packing"](spark, mixed, SF)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in out.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in got)


def test_stages_take_hard_rows(spark, hard, nothing):
    for docs in (hard.select("doc_id", "text", "lang", "source", "n_chars"), nothing.select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema) if name != "best_fit_packing" else stage(spark, docs, SF)
        docs.count()


def test_the_mixture_decides_the_sequences(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}", "en", f"s{i % 3}", 6) for i in range(3000)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    stage, places = dict(corpus_pipeline.STAGES)["best_fit_packing"], []
    for weights in ({"s0": 0.8, "s1": 0.1, "s2": 0.1}, {"s0": 0.1, "s1": 0.1, "s2": 0.8}):
        mixed = mixing.mix_documents(docs, weights)
        order = [r.doc_id for r in mixed.collect()]
        for frame in (materialize(mixed, "mixed"), mixed):
            out = stage(spark, frame, SF).collect()
            assert {r.length for r in out} == {out[0].length}
            assert [r.doc_id for r in sorted(out, key=lambda r: (r.sequence_id, r.offset))] == order
        places.append({r.doc_id: (r.sequence_id, r.offset) for r in out})
    assert places[0] != places[1]


def test_columns_of_any_name_pass_the_stages(spark, sample):
    """Names that stages use themselves: every kept row has its own values in them."""
    names = ["one", "_id", "_h", "_position", "_had", "n_lines", "row", "had"]
    docs = sample.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert out.where(" OR ".join(f"`{n}` <> concat('{n}', doc_id)" for n in names)).count() == 0
        assert 0 < out.count() <= docs.count()
        docs = out
