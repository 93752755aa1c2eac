"""Operator 3: token counts without a shuffle of pre-tokens.

A first pass lets every task summarise its own pre-tokens in a bounded table
(Misra-Gries: at most ``SUMMARY`` counters, so whatever is frequent in the task
stays) and adds up only those summaries. The ``FREQUENT`` most frequent
pre-tokens get their lengths once and are broadcast as a compact hash table
(bounded: entries times ``chunks.MAX_KEY`` bytes). The second pass looks each
distinct pre-token of a slice up there and encodes the misses through the
worker's cache. The tables only decide what is cheap: counts are the
library's, whatever is in them.

Defined cases: null and empty text have 0 bytes and 0 tokens; doc_id may be
null or repeated (one row out per row in); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from airlens.llm.chunks import MAX_KEY, ChunkEncoder, cut, tokenizer
from airlens.llm.common import most_frequent, slices

SUMMARY, FREQUENT = 4096, 32768


def frequent_chunks(docs: DataFrame, path: str, size: int = FREQUENT) -> list[bytes]:
    """The most frequent pre-tokens as the tasks' bounded summaries have them."""
    def summarise(batches):
        tok, counts = tokenizer(path), {}
        for batch in batches:
            for piece in slices(batch, "text"):
                chunks, _ = cut(tok.prepare(piece.column("text")), marks=not tok.piece)
                if len(chunks) == 0:
                    continue
                coded = chunks.dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                short = pc.less_equal(pc.binary_length(coded.dictionary), MAX_KEY).to_numpy(zero_copy_only=False)
                top = np.flatnonzero(short)
                if len(top) > 2 * SUMMARY:
                    top = top[np.argpartition(-n[top], 2 * SUMMARY)[:2 * SUMMARY]]
                for k, v in zip(coded.dictionary.take(pa.array(top)).to_pylist(), n[top].tolist()):
                    counts[k] = counts.get(k, 0) + v
                if len(counts) > SUMMARY:   # take the largest dropped count off all that stay
                    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
                    off = ranked[SUMMARY][1]
                    counts = {k: v - off for k, v in ranked[:SUMMARY] if v > off}
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                             names=["chunk", "n"])

    found = most_frequent(docs.select("text").mapInArrow(summarise, "chunk binary, n long").groupBy("chunk").agg(F.sum("n").alias("n")), size)
    return sorted(found.column("chunk").to_pylist())


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``."""
    keys = frequent_chunks(docs, path)
    lengths = np.array([len(i) for i in tokenizer(path).pieces(keys)], np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((keys, lengths))

    def count(batches):
        keys, lengths = shared.value
        frequent, enc = pa.array(keys, pa.binary()), ChunkEncoder(path)
        for batch in batches:
            for piece in slices(batch, "text"):
                n = enc.count(piece.column("text"), frequent, lengths)
                size = pc.cast(pc.fill_null(pc.binary_length(piece.column("text")), 0), pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), size, pa.array(n, pa.int64()), pa.array(n > limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
