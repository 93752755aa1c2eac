"""Operator 7: language identification with string kernels.

The kernel of two texts is the number of character n-grams (n = 1 to 4, over
the bytes of the lower-cased text, letters and one blank for everything else)
that occur in both, divided by the square root of the two texts' own numbers:
a blended-spectrum presence kernel. A classifier is fitted with Nystrom
landmarks: ``LANDMARKS`` training texts of every language taken together span
the functions, and one ridge regression per language (one versus rest)
minimises the squared error over the sample. As the kernel is an inner product
of presence vectors, landmarks times coefficients make one weight matrix
(n-gram x language), and a batch of texts is scored by one product of its
sparse presence matrix with it.

The fit sees a bounded sample, ``PER_LANGUAGE`` documents of each language with
the smallest hashes (a documented parameter); everything else covers whole
texts of all documents. N-grams are hashed into ``BINS`` bins, so a text's
presence is a row of ``BINS`` bits. Tasks make the kernels of the sample with the
landmarks and their sums of products; the driver gets those sums (landmarks
squared, and landmarks times languages) and the landmarks' bits, never the sample.
There are at most ``MARKS`` landmarks: with many languages fewer of each, with more
languages than that those of the smallest hashes. Any number of languages is
learned. While the weight matrix has at most ``WEIGHT_BYTES`` it is what texts are
multiplied with; beyond, kernels with the landmarks are multiplied with their
coefficients, which is the same product in another order.

Defined cases: null text or a text without a letter is ``und`` with score 0;
a null doc_id counts as held out; rows without language are never learned
from, equal rows are learned from once; without anything to learn from everything
is ``und``; languages with equal scores: the first by name; repeated rows are
scored alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from airlens.llm.chunks import release
from airlens.llm.common import lean, materialize, slices

BINS = 1 << 17
PER_LANGUAGE, LANDMARKS = 300, 64
RIDGE, SHARPNESS = 1e-2, 4.0
#: Landmarks of all languages together, and bytes of the largest weight matrix that is made (128 languages).
MARKS, WEIGHT_BYTES = 1024, 1 << 26
#: Bytes of text that are scored at once, and of one text whose n-grams are made at once.
SLICE, PIECE = 1 << 19, 1 << 18
UND = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: bytes of ASCII letters and of non-ASCII characters stay, everything else is a blank
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_BLANKS = re.compile(rb" +")


def present(text: str) -> np.ndarray:
    """The bins of the n-grams that occur in the whole text, each once."""
    raw = b" " + _BLANKS.sub(b" ", text.lower().encode("utf-8").translate(_FOLD)).strip() + b" "
    seen = np.zeros(BINS, bool)
    for start in range(0, len(raw), PIECE):   # pieces overlap by the longest n-gram less one
        b = np.frombuffer(raw[start:start + PIECE + 3], np.uint8).astype(np.uint32)
        code = np.zeros(len(b), np.uint32)
        for n in range(1, 5):
            if len(b) < n:
                break
            code = (code[:len(b) - n + 1] << np.uint32(8)) | b[n - 1:]
            seen[((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(15)] = True
    return np.flatnonzero(seen).astype(np.int32)


def scores(bins: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Presence matrix (rows of normalised presence) times the weight matrix."""
    size = np.fromiter(map(len, bins), np.int64, len(bins))
    rows = weights[np.concatenate(bins)]
    return np.add.reduceat(rows, np.cumsum(size) - size, axis=0) / np.sqrt(size)[:, None]


def packed(bins: np.ndarray) -> np.ndarray:
    """Presence as BINS bits in 64-bit words."""
    seen = np.zeros(BINS, np.uint8)
    seen[bins] = 1
    return np.packbits(seen).view(np.uint64)


def kernels(rows: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel values of every row with every landmark, from rows of bits."""
    both = np.empty((len(rows), len(marks)))
    for i, row in enumerate(rows):
        for a in range(0, len(marks), 64):
            both[i, a:a + 64] = np.bitwise_count(row & marks[a:a + 64]).sum(axis=1)
    size = [np.bitwise_count(x).sum(axis=1).astype(np.float64) for x in (rows, marks)]
    return both / np.sqrt(np.outer(*size))


def solve(square: np.ndarray, right: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Coefficients (landmarks x languages) from the sums K'K and K'y over the sample."""
    k_mm = kernels(marks, marks)
    return np.linalg.solve(square + RIDGE * (k_mm + k_mm.T) / 2 + 1e-8 * np.eye(len(marks)), right)


def folded(marks: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    """The weight matrix (bins x languages): landmarks times coefficients."""
    weights = np.zeros((BINS, coefficients.shape[1]), np.float32)
    for a in range(0, len(marks), 32):
        bits = marks[a:a + 32]
        phi = np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32)
        phi /= np.sqrt(phi.sum(axis=1, keepdims=True))
        weights += phi.T @ coefficients[a:a + 32].astype(np.float32)
    return weights


def fit(sample: list[tuple[str, np.ndarray]]) -> tuple[list[str], np.ndarray]:
    """(languages, weights) from a small list of (language, bins) in a fixed order: what ``train`` does with tables."""
    langs = sorted({x[0] for x in sample})
    if not langs:
        return [], np.zeros((BINS, 0), np.float32)
    taken: dict[str, int] = {}
    marks = []
    for lang, bins in sample:
        if taken.setdefault(lang, 0) < LANDMARKS:
            taken[lang] += 1
            marks.append(packed(bins))
    marks = np.array(marks)
    k = kernels(np.array([packed(b) for _, b in sample]), marks)
    y = np.array([[1.0 if lang == c else -1.0 for c in langs] for lang, _ in sample])
    return langs, folded(marks, solve(k.T @ k, k.T @ y, marks))


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _words(column) -> np.ndarray:
    return np.array([np.frombuffer(x.as_buffer(), np.uint64) for x in column]).reshape(len(column), BINS // 64)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> tuple[list[str], object]:
    """(languages, model) from the labelled documents that are not held out. The model is a weight
    matrix, or (landmarks, coefficients) if that had more than ``WEIGHT_BYTES``."""
    spark = docs.sparkSession
    rows = (docs.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("_h"), held_out().alias("_held"))
                .where("not _held and lang is not null and text is not null"))
    # hashes below a bound that leaves about twice as many as are taken, so that a frequent language is no large group
    span = 1 << 62
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("_h").alias("n")).collect()   # a row per language
    if not counts:
        return [], np.zeros((BINS, 0), np.float32)
    bounds = spark.createDataFrame([(r.lang, min(span, int(span * min(1.0, 2 * per_language / r.n)))) for r in counts], "_lang string, _bound long")
    near = (rows.join(F.broadcast(bounds), F.col("lang") == F.col("_lang")).where(F.pmod("_h", F.lit(span)) < F.col("_bound"))
            .select("lang", "_h", "text"))

    def features(batches):
        release()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                keep = [(l, h, packed(present(t)).tobytes()) for l, h, t in
                        zip(*(part.column(c).to_pylist() for c in ("lang", "_h", "text"))) if _LETTER.search(t)]
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.string()), pa.array([k[1] for k in keep], pa.int64()),
                                                  pa.array([k[2] for k in keep], pa.binary())], names=["lang", "h", "bits"])

    found = near.mapInArrow(lean(features), "lang string, h long, bits binary").dropDuplicates(["lang", "h"])
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    sample = materialize(ranked.where(F.col("rank") <= per_language), "language-sample")
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((BINS, 0), np.float32)
    each = max(1, min(landmarks, MARKS // len(langs)))
    chosen = sample.where(F.col("rank") <= each).select("h", "lang", "bits").orderBy("h", "lang").limit(MARKS).toArrow()
    marks = _words(chosen.column("bits").combine_chunks())
    shared = spark.sparkContext.broadcast((marks, {c: i for i, c in enumerate(langs)}))   # at most MARKS x BINS bits

    def products(batches):
        marks, at = shared.value
        square, mine, rows = np.zeros((len(marks), len(marks))), np.zeros((len(at), len(marks))), 0
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                k = kernels(_words(part.column("bits")), marks)
                square += k.T @ k
                np.add.at(mine, [at[c] for c in part.column("lang").to_pylist()], k)
                rows += part.num_rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (square, mine)], names=["square", "mine"])

    sums = (sample.select("lang", "h", "bits").coalesce(8).sortWithinPartitions("lang", "h")
            .mapInArrow(lean(products), "square binary, mine binary").collect())   # eight rows at most
    square = sum(np.frombuffer(r.square).reshape(len(marks), len(marks)) for r in sums)
    mine = sum(np.frombuffer(r.mine).reshape(len(langs), len(marks)) for r in sums)
    coefficients = solve(square, (2 * mine - mine.sum(axis=0)).T, marks)   # one versus rest: 1 for its own, -1 for all others
    return langs, folded(marks, coefficients) if 4 * BINS * len(langs) <= WEIGHT_BYTES else (marks, coefficients)


def values(bins: list[np.ndarray], model) -> np.ndarray:
    """One value per text and language."""
    if isinstance(model, tuple):
        return np.concatenate([kernels(packed(b)[None, :], model[0]) for b in bins]) @ model[1]
    return scores(bins, model).astype(np.float64)


def identify(docs: DataFrame, model: tuple[list[str], object]) -> DataFrame:
    """``docs`` plus lang_pred and score (columns of these names are replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # WEIGHT_BYTES, or MARKS x BINS bits and MARKS numbers per language
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches):
        release()
        langs, weights = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                names, probs = [UND] * len(texts), np.zeros(len(texts))
                rows = [i for i, t in enumerate(texts) if langs and t and _LETTER.search(t)]
                if rows:
                    f = SHARPNESS * values([present(texts[i]) for i in rows], weights)
                    e = np.exp(f - f.max(axis=1, keepdims=True))
                    p = e / e.sum(axis=1, keepdims=True)
                    for i, c, v in zip(rows, p.argmax(axis=1), p.max(axis=1)):
                        names[i], probs[i] = langs[c], v
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(probs, pa.float64())],
                                                 names=[*keep, "lang_pred", "score"])

    return docs.select(*keep).mapInArrow(lean(predict), schema)


def predict_table(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, train(docs)).select("doc_id", "held_out", "lang_pred", "score")
