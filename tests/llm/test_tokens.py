"""Token files, token counts and packing against the tokenizers themselves."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from airlens.llm import packing, token_counts, token_files
from airlens.llm.chunks import ChunkEncoder, tokenizer
from airlens.llm.common import tokenizer_path
from airlens.session import scratch_path

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
PARTS = list(" \n\t\r  　▁aZé'sñ09.,!?;:") + ["<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "'ll", "  ", "\n\n",
                                                                "\x1c", "\x85", "日本", "😀", "é", "tion", " the", "́"]


def ordered(docs):
    """Rows by doc_id (nulls first), then a hash of the text."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    return [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), min_size=1, max_size=6))
def test_pre_tokens_change_no_id(name, texts):
    path = tokenizer_path(name)
    ids, off = ChunkEncoder(path).encode(pa.array(texts))
    want = tokenizer(path).whole(texts)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want
    assert ChunkEncoder(path).count(pa.array(texts)).tolist() == list(map(len, want))


@pytest.mark.parametrize("entries", [0, 3, 1000])
def test_a_full_cache_changes_nothing(entries):
    path = tokenizer_path("byte_bpe_50k.json")
    texts = [f"some words {i % 7} and {i}" for i in range(50)]
    enc = ChunkEncoder(path, entries=entries)
    enc.ids = {}
    ids, off = enc.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == tokenizer(path).whole(texts)


class Counting:
    """A tokenizers library that counts the texts it is given."""

    def __init__(self, lib):
        self.lib, self.texts = lib, 0

    def __getattr__(self, name):
        return getattr(self.lib, name)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.lib.encode_batch_fast(texts, **options)


def test_new_words_go_to_the_library_in_few_texts(monkeypatch):
    path = tokenizer_path("byte_bpe_50k.json")
    enc = ChunkEncoder(path, entries=0)
    enc.ids = {}
    counting = Counting(enc.tok.lib)
    monkeypatch.setattr(enc.tok, "lib", counting)
    texts = [" ".join(f"wörd{i * 37 + j}x" for j in range(500)) for i in range(0, 400, 20)]
    ids, off = enc.encode(pa.array(texts))
    assert counting.texts < 100   # of 10 000 words
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [e.ids for e in counting.lib.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), min_size=1, max_size=5).map("".join), min_size=1, max_size=40))
def test_pre_tokens_in_any_order_keep_their_ids(name, chunks):
    tok = tokenizer(tokenizer_path(name))
    raw = [c.encode() for c in chunks]
    ids, off = tok.flat(raw)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == tok.pieces(raw)


def test_a_token_across_pre_tokens_keeps_them_apart():
    from tokenizers import AddedToken
    from airlens.llm.chunks import Tokenizer

    tok = Tokenizer(tokenizer_path("byte_bpe_50k.json"))
    tok.lib.add_tokens([AddedToken("a b", normalized=False)])
    tok.bytes_of = tok._bytes_of()
    assert tok.bytes_of is not None and tok._joined([b"a", b" b"]) is None
    ids, off = tok.flat([b"a", b" b", b" c"])
    assert [ids[x:y].tolist() for x, y in zip(off, off[1:])] == tok.pieces([b"a", b" b", b" c"])


def test_only_byte_level_ids_are_told_apart_by_bytes():
    assert [tokenizer(tokenizer_path(n)).bytes_of is not None for n in FILES] == [False, True, False]


def expect_files(rows, path, end):
    start, out = 0, []
    for doc_id, text in rows:
        ids = tokenizer(path).whole([text or ""])[0] + [end]
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("which", ["sample", "hard", "nothing"])
def test_token_files_round_trip(request, spark, which):
    docs = request.getfixturevalue(which)
    path = tokenizer_path("word_bpe_49k.json")
    out = token_files.write_tokens(docs, scratch_path(spark, "t"), path, 2, shard_bytes=4096)
    got = [tuple(r) for r in token_files.read_tokens(spark, out).collect()]
    assert sorted(got, key=lambda r: r[1]) == expect_files(ordered(docs), path, 2)
    for r in docs.select("doc_id", "text").where("doc_id is not null").limit(3).collect():
        assert tokenizer(path).whole([r.text or ""])[0] + [2] in token_files.read_document(spark, out, r.doc_id)


def test_files_refuse_another_dictionary():
    open_ids = token_files.open_frames(__import__("hashlib").sha256(b"").hexdigest(), b"")
    with pytest.raises(ValueError):
        open_ids("other", b"")
    with pytest.raises(ValueError):
        token_files.open_frames("other", b"")


def test_ids_above_two_bytes_round_trip():
    for ids in ([], [1, 65535], [65536, 2, 2 ** 31]):
        assert token_files.deserialize(token_files.serialize(np.array(ids, np.uint32))).tolist() == ids


@pytest.mark.parametrize("which", ["sample", "hard", "nothing"])
def test_counts_are_the_librarys(request, which):
    docs = request.getfixturevalue(which)
    path = tokenizer_path("piece_bpe_32k.model")
    got = Counter(tuple(r) for r in token_counts.token_counts(docs, path, 50).collect())
    want = Counter()
    for r in docs.collect():
        n = len(tokenizer(path).whole([r.text or ""])[0])
        want[(r.doc_id, len((r.text or "").encode()), n, n > 50)] += 1
    assert got == want


def optimum(items, capacity):
    """The least number of bins, by trying."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1:]])
        place(i + 1, [*bins, items[i]])
    place(0, [])
    return best


@settings(max_examples=300, deadline=None)
@given(st.integers(5, 20), st.lists(st.integers(1, 20), max_size=8))
def test_reduction_keeps_an_optimum(capacity, items):
    items = [min(i, capacity) for i in items]
    fixed, rest = packing.reduce_dominated(Counter(items), capacity)
    assert sum(n for n, _ in fixed) + optimum(list(Counter(rest).elements()), capacity) == optimum(items, capacity)
    whole = packing.plan(Counter(items), capacity)
    held = Counter()
    for n, lengths in whole:
        assert n > 0 and sum(lengths) <= capacity
        for w in lengths:
            held[w] += n
    assert held == Counter(items)


@pytest.mark.parametrize("hist", [{1500: 100000, 500: 100000, 200: 10}, {900: 100001, 300: 20}, {1500: 100000, 500: 70000, 300: 50}])
def test_the_plan_does_not_grow_with_the_pieces(hist):
    fixed, rest = packing.reduce_dominated(hist, 2048)
    assert len(fixed) < 50
    assert len(packing.runs(packing.plan(hist, 2048))) < 100
    held = Counter(rest)
    for n, lengths in fixed:
        for w in lengths:
            held[w] += n
    assert held == Counter(hist)


def check_packing(docs, capacity):
    path = tokenizer_path("byte_bpe_50k.json")
    got = packing.pack(docs, path, 0, capacity).collect()
    want = Counter()
    for r in docs.collect():
        ids = tokenizer(path).whole([r.text or ""])[0] + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r.doc_id, j, a, b - a, crc(ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return got, bins


@pytest.mark.parametrize("which", ["sample", "hard", "nothing"])
def test_packing_places_every_piece_once(request, which):
    got, bins = check_packing(request.getfixturevalue(which), 512)
    if got:
        assert len(bins) <= 1.02 * sum(r.length for r in got) / 512 + 2


def test_one_length_for_most_pieces(spark):
    docs = spark.createDataFrame([(i, "alike") for i in range(300)] + [(300, "a b c d e f g")], "doc_id long, text string")
    got, bins = check_packing(docs.repartition(4), 16)
    assert len(bins) == 61   # five of three tokens to a sequence, and the long one
