"""Trees as balanced parentheses: a range min-max tree over the excess, and what follows from it.

A preorder walk writes ``(`` when it enters a node and ``)`` when it leaves it. The excess at a
place is the number of nodes open after it. Blocks of the excess keep their least and greatest
value, so the parenthesis that closes a node (the first later place with an excess one lower) is
found by a scan of its block, a climb over blocks that cannot hold it, and a scan of one block
more; all nodes ask at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    def __init__(self, bits: np.ndarray):
        """``bits``: True for an opening parenthesis; balanced, preorder."""
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1)).astype(np.int64)
        self.opens = np.flatnonzero(bits)
        blocks = max(1, -(-len(bits) // BLOCK))
        self.leaves = 1 << (blocks - 1).bit_length()
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max // 2, np.int64)
        padded[:len(bits)] = self.excess
        low = np.full(2 * self.leaves, np.iinfo(np.int64).max // 2, np.int64)
        high = np.full(2 * self.leaves, -1, np.int64)
        low[self.leaves:self.leaves + blocks] = padded.reshape(blocks, BLOCK).min(axis=1)
        padded[len(bits):] = -1
        high[self.leaves:self.leaves + blocks] = padded.reshape(blocks, BLOCK).max(axis=1)
        for first in (self.leaves >> k for k in range(1, self.leaves.bit_length())):
            low[first:2 * first] = np.minimum(low[2 * first:4 * first:2], low[2 * first + 1:4 * first:2])
            high[first:2 * first] = np.maximum(high[2 * first:4 * first:2], high[2 * first + 1:4 * first:2])
        self.low, self.high = low, high
        # leaf pairs "()" that end at or before a place
        pair = np.zeros(len(bits), np.int64)
        pair[1:] = bits[:-1] & ~bits[1:]
        self.pairs = np.cumsum(pair)

    def _scan(self, at: np.ndarray, aim: np.ndarray, ask: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Look for ``aim`` from place ``at`` to the end of its block; returns the queries not answered."""
        end = np.minimum((at // BLOCK + 1) * BLOCK, len(self.bits))
        while len(ask):
            hit = self.excess[at] == aim
            found[ask[hit]] = at[hit]
            on = ~hit & (at + 1 < end)
            left = ask[~hit & ~on]
            if len(left):
                yield left
            at, aim, ask, end = at[on] + 1, aim[on], ask[on], end[on]

    def find_close(self) -> np.ndarray:
        """For every node in preorder the place of its closing parenthesis."""
        n = len(self.opens)
        aim = self.excess[self.opens] - 1
        found = np.zeros(n, np.int64)
        same_block = self.opens % BLOCK < BLOCK - 1
        start = np.flatnonzero(same_block)
        rest = [np.flatnonzero(~same_block), *self._scan(self.opens[start] + 1, aim[start], start, found)]
        ask = np.concatenate(rest)
        # up: while a node is a right child or its right neighbour cannot hold the aim
        node = self.leaves + self.opens[ask] // BLOCK
        going = np.ones(len(ask), bool)
        while going.any():
            right = node + 1
            holds = going & (node % 2 == 0) & (self.low[np.minimum(right, len(self.low) - 1)] <= aim[ask]) & (aim[ask] <= self.high[np.minimum(right, len(self.high) - 1)])
            node = np.where(holds, right, np.where(going, node >> 1, node))
            going &= ~holds
        while (node < self.leaves).any():   # down: to the first block that holds it
            inner = node < self.leaves
            left = 2 * node
            here = inner & (self.low[np.where(inner, left, 0)] <= aim[ask]) & (aim[ask] <= self.high[np.where(inner, left, 0)])
            node = np.where(inner, np.where(here, left, left + 1), node)
        if len(ask):
            missing = list(self._scan((node - self.leaves) * BLOCK, aim[ask], ask, found))
            if missing:
                raise ValueError("parentheses are not balanced")
        return found

    def subtrees(self) -> tuple[np.ndarray, np.ndarray]:
        """(size, leaves) of the subtree of every node in preorder, itself included."""
        close = self.find_close()
        before = self.pairs[self.opens]   # no pair ends at an opening parenthesis
        return (close - self.opens + 1) // 2, self.pairs[close] - before


def preorder(depths: np.ndarray) -> np.ndarray:
    """The parentheses of a tree from the depths of its nodes in preorder (the first is the root, 0)."""
    closes = np.append(depths[:-1] - depths[1:] + 1, depths[-1] + 1)   # after each node, how many end
    total = len(depths) + int(closes.sum())
    bits = np.zeros(total, bool)
    bits[np.arange(len(depths)) + np.append(0, np.cumsum(closes)[:-1])] = True
    return bits


def within(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (by node in preorder) over the subtree of every node."""
    total = np.append(0, np.cumsum(values))
    first = np.arange(len(size))
    return total[first + size] - total[first]
