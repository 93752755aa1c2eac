"""Cutting texts into pre-tokens without changing what a tokenizer makes of them.

A pre-token here is a run of white space followed by the characters up to the
next run. A cut is made only before an ASCII space or newline whose previous
character is certainly not white space, so every tokenizer used by this
package gives the same ids for the pieces in turn as for the whole text (the
tests compare both). ``ChunkEncoder`` encodes each distinct pre-token of a
slice once, through a cache that lives as long as the Python worker. Those that
miss it go to the library joined to longer texts where every token stands for
bytes of its own (the byte-level vocabulary): each call costs as much as the ids.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from airlens.llm.common import utf8

#: Pre-tokens longer than this are encoded but not kept in a cache.
MAX_KEY = 64
#: Entries of a worker's cache. A full cache keeps what came first (mostly the
#: frequent pre-tokens) until most of a slice misses it; then it starts anew.
CACHE_ENTRIES = 700_000
#: Bytes of pre-tokens that the library gets as one text.
JOINED_BYTES = 8192


_MARK = np.isin(np.arange(256), np.frombuffer(b",.!?;:", np.uint8))
_ALNUM = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))


def _starts(data: np.ndarray, marks: bool) -> np.ndarray:
    """Which bytes of a text begin a pre-token, whatever stands around."""
    start = (data == 32) | (data == 10)
    p1 = np.empty_like(data)
    p1[0], p1[1:] = 0, data[:-1]
    start &= p1 > 32
    # after a non-ASCII character: keep white space of that kind (and U+2581) with what follows
    at = np.flatnonzero(start & (p1 >= 0x80))
    at2, at3 = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    maybe_space = (at2 == 0xC2) | ((at3 >= 0xE1) & (at3 <= 0xE3) & np.isin(at2, (0x80, 0x81, 0x96, 0x9A)))
    start[at[maybe_space]] = False
    if marks:
        at = np.flatnonzero(_MARK[data] & (_ALNUM[p1] | (p1 >= 0x80)))
        plain, before = _ALNUM[p1[at]], data[np.maximum(at - 2, 0)]
        start[at[plain | ((before == 0xC3) & (p1[at] != 0x97) & (p1[at] != 0xB7))]] = True
    return start


def cut(texts: pa.Array, marks: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Pre-tokens of all texts as one binary array, and for each text the range
    of its pre-tokens (n + 1 offsets). Null and empty texts have none.
    ``marks``: cut before , . ! ? ; : after a letter or digit as well, where
    the tokenizer never joins the two."""
    data, offsets = utf8(texts)
    n = len(data)
    if n == 0:
        return pa.array([], pa.binary()), np.zeros(len(offsets), np.int64)
    start = _starts(data, marks)
    first = offsets[:-1]
    start[first[first < n]] = True
    where = np.append(np.flatnonzero(start), n).astype(np.int32)
    chunks = pa.Array.from_buffers(pa.binary(), len(where) - 1, [None, pa.py_buffer(where), pa.py_buffer(np.ascontiguousarray(data))])
    return chunks, np.searchsorted(where[:-1], offsets)


class Tokenizer:
    """Ids of whole texts and of pre-tokens from a public vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.piece = path.endswith(".model")
        if self.piece:
            import sentencepiece

            self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer as Lib

            self.lib = Lib.from_file(path)
            self.lib.no_truncation()
            self.lib.no_padding()
        self.bytes_of = None if self.piece else self._bytes_of()

    def _bytes_of(self) -> np.ndarray | None:
        """How many bytes of a text each id stands for; None where ids do not stand for all of them in turn."""
        from tokenizers import models, pre_tokenizers

        before, model = self.lib.pre_tokenizer, self.lib.model
        if self.lib.normalizer is not None or not isinstance(before, pre_tokenizers.ByteLevel) or not isinstance(model, models.BPE):
            return None
        if before.add_prefix_space or not before.use_regex or model.continuing_subword_prefix or model.end_of_word_suffix or model.dropout:
            return None
        vocabulary, added = self.lib.get_vocab(with_added_tokens=False), self.lib.get_added_tokens_decoder()
        if not vocabulary.keys() >= set(pre_tokenizers.ByteLevel.alphabet()) or any(t.lstrip or t.rstrip or t.normalized for t in added.values()):
            return None
        size = np.zeros(max([*vocabulary.values(), *added]) + 1, np.int64)
        for token, i in vocabulary.items():
            size[i] = len(token)   # a character for each byte
        for i, token in added.items():
            size[i] = len(token.content.encode("utf-8"))
        return size

    def whole(self, texts: list[str]) -> list[list[int]]:
        if self.piece:
            return self.lib.encode(texts, num_threads=1)
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def prepare(self, texts: pa.Array) -> pa.Array:
        """The sentence-piece library puts a space before a text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.piece:
            return texts
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar(""))
        return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, spaced)

    def pieces(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens cut from prepared texts."""
        texts = [c.decode("utf-8") for c in chunks]
        if not self.piece:
            return self.whole(texts)
        # the library's own space stands for a leading one; before a newline it is dropped again
        ids = self.whole([t[1:] if t[0] == " " else t for t in texts])
        return [(i or [self.lib.piece_to_id("\u2581")]) if t[0] == " " else i[1:] for i, t in zip(ids, texts)]

    def flat(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(uint32 ids of all pre-tokens, n + 1 offsets)."""
        found = self._joined(chunks) if self.bytes_of is not None else None
        if found is None:
            each = self.pieces(chunks)
            ends = np.zeros(len(chunks) + 1, np.int64)
            np.cumsum(np.fromiter(map(len, each), np.int64, len(each)), out=ends[1:])
            found = np.fromiter(chain.from_iterable(each), "<u4", int(ends[-1])), ends
        return found

    def _joined(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same from texts of many pre-tokens: one follows another where a text
        is cut between the two, and the bytes that ids stand for tell them apart."""
        raw = b"".join(chunks)
        ends = np.zeros(len(chunks) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)), out=ends[1:])
        first = ends[:-1]
        alone = ~_starts(np.frombuffer(raw, np.uint8), marks=True)[first]
        alone |= np.diff(first // JOINED_BYTES, prepend=-1) > 0
        cuts = [*first[alone].tolist(), len(raw)]
        texts = [raw[a:b].decode("utf-8") for a, b in zip(cuts, cuts[1:])]
        ids = np.concatenate([np.array(i, "<u4") for i in self.whole(texts)])
        at = np.append(0, np.cumsum(self.bytes_of[ids]))
        tokens = np.searchsorted(at, ends)
        return (ids, tokens) if at[-1] == ends[-1] and np.array_equal(at[tokens], ends) else None


_TOKENIZERS: dict[str, Tokenizer] = {}
_CACHES: dict[str, dict] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer per worker process and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


def release() -> None:
    """Give up this worker's caches: for operators that do not use them and follow one that did."""
    for cache in _CACHES.values():
        cache.clear()


def _keys(chunks: pa.Array) -> list[bytes]:
    return chunks.to_numpy(zero_copy_only=False).tolist()


class ChunkEncoder:
    """Ids or token counts of texts through the worker's cache of pre-tokens."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        self.tok = tokenizer(path)
        self.entries = entries
        self.ids = _CACHES.setdefault(path + "|ids", {})
        self.lens = _CACHES.setdefault(path + "|lens", {})

    def _through(self, cache: dict, keys: list[bytes], make) -> list:
        """A value for each pre-token; ``make`` gives those of the ones that are not in the cache."""
        found = list(map(cache.get, keys))
        miss = [i for i, v in enumerate(found) if v is None]
        if miss:
            missed = [keys[i] for i in miss]
            if len(cache) >= self.entries and 2 * len(missed) > len(keys):
                cache.clear()   # the kind of text has changed
            room = self.entries - len(cache)
            for i, key, value in zip(miss, missed, make(missed)):
                found[i] = value
                if room > 0 and len(key) <= MAX_KEY:
                    cache[key] = value
                    room -= 1
        return found

    def _packed(self, keys: list[bytes]) -> list[bytes]:
        ids, ends = self.tok.flat(keys)
        raw, bounds = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _lengths(self, keys: list[bytes]) -> list[int]:
        return list(map(len, self.tok.pieces(keys)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(uint32 ids of all texts, n + 1 offsets)."""
        chunks, ranges = cut(self.tok.prepare(texts), marks=not self.tok.piece)
        if len(chunks) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(ranges), np.int64)
        coded = chunks.dictionary_encode()
        values = self._through(self.ids, _keys(coded.dictionary), self._packed)
        taken = pa.array(values, pa.large_binary()).take(coded.indices)
        _, offsets, body = taken.buffers()
        ends = np.frombuffer(offsets, np.int64)[taken.offset:taken.offset + len(taken) + 1] // 4
        ids = np.frombuffer(body, "<u4", int(ends[-1])) if ends[-1] else np.zeros(0, np.uint32)
        return ids, ends[ranges]

    def count(self, texts: pa.Array, frequent: pa.Array | None = None, lengths: np.ndarray | None = None) -> np.ndarray:
        """Tokens of each text. ``frequent`` and ``lengths``: the first tier, a
        table of frequent pre-tokens; the rest goes through the worker's cache."""
        chunks, ranges = cut(self.tok.prepare(texts), marks=not self.tok.piece)
        if len(chunks) == 0:
            return np.zeros(len(ranges) - 1, np.int64)
        coded = chunks.dictionary_encode()
        size = np.zeros(len(coded.dictionary), np.int64)
        rest = np.ones(len(size), bool)
        if frequent is not None and len(frequent):
            at = pc.fill_null(pc.index_in(coded.dictionary, value_set=frequent), -1).to_numpy()
            rest = at < 0
            size[~rest] = lengths[at[~rest]]
        if rest.any():
            keys = _keys(coded.dictionary.filter(pa.array(rest)))
            size[rest] = self._through(self.lens, keys, self._lengths)
        ends = np.zeros(len(chunks) + 1, np.int64)
        np.cumsum(size[coded.indices.to_numpy()], out=ends[1:])
        return np.diff(ends[ranges])
