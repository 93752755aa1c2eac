"""Word shingles of whole texts as sets of 64-bit hashes.

Words are maximal runs of bytes other than ASCII white space, A-Z lower-cased.
A shingle is ``width`` words in a row; a text with fewer words has its whole
sequence as its one shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from airlens.llm.common import utf8

_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(2024)
#: a random 64-bit number for every byte, an odd base, and odd factors for the words of a shingle
_BYTE = _RNG.integers(0, 2 ** 64, 256, dtype=np.uint64)[_LOWER]
_BASE = int(_RNG.integers(0, 2 ** 63, dtype=np.uint64)) * 2 + 1
_INVERSE = pow(_BASE, -1, 2 ** 64)
_FACTORS = _RNG.integers(0, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes of text whose words are hashed at once.
_BLOCK = 1 << 19
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _POWERS:
        for longer in [k for k in _POWERS if k > 1 << 20]:   # those of one very long word
            del _POWERS[longer]
        _POWERS[size] = tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]))
                              for b in (np.uint64(_BASE), np.uint64(_INVERSE)))
    return _POWERS[size]


def _scramble(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, n + 1 offsets of the texts' words)."""
    data, offsets = utf8(texts)
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)   # a word starts or ends before this byte
    edge[1:n] = inside[1:] != inside[:-1]
    edge[0], edge[n] = inside[0], inside[n - 1]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < n]
    starts_here[first] = inside[first]   # a text's first word
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    last = offsets[1:] - 1
    last = last[last >= 0]
    ends_here[last] = inside[last]
    starts, ends = np.flatnonzero(starts_here), np.flatnonzero(ends_here) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):   # block by block, as the sums take eight bytes for each byte of text
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _BLOCK, "right")))
        a, b = starts[i:j] - base, ends[i:j] - base
        power, inverse = _powers(int(b[-1]) + 1)
        sums = np.zeros(int(b[-1]) + 1, np.uint64)
        np.cumsum(_BYTE[data[base:base + b[-1]]] * power[:b[-1]], out=sums[1:])
        hashes[i:j] = _scramble((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        i = j
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of the texts in turn, n + 1 offsets)."""
    words, off = word_hashes(texts)
    count = np.diff(off)
    n_docs = len(count)
    if len(words) == 0:
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    h = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        h += words[k:k + len(h)] * _FACTORS[k]
    h = _scramble(h)
    sets, sizes = [], np.zeros(n_docs + 1, np.int64)
    for d in np.flatnonzero(count).tolist():   # sorting many short runs costs less than one long sort
        a, n = off[d], count[d]
        if n < width:
            own = np.bitwise_xor.reduce(_scramble(words[a:a + n] * _FACTORS[width:width + n] + np.uint64(n)), keepdims=True)
        else:
            own = np.sort(h[a:a + n - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        sets.append(own)
        sizes[d + 1] = len(own)
    return np.concatenate(sets), np.cumsum(sizes)
