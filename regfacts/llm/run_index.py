"""Run-length index: a run-compressed Burrows-Wheeler transform with samples at run ends.

In a repetitive collection the transform has few runs. The length that a
suffix shares with its neighbour in suffix order needs to be stored only at
run ends: elsewhere the suffix and its neighbour continue the same neighbours
one place earlier in the text, and share one symbol less. Streaming through
the text turns the samples into the matching statistics of every place.
"""

from __future__ import annotations

import numpy as np


def _ordered(key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places by (key, place), and the keys in that order."""
    bits = n.bit_length()
    if int(key.max(initial=0)) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        return order, key[order]
    # one number sorts much faster than an indirect sort
    packed = key << bits | np.arange(n)
    packed.sort()
    return packed & ((1 << bits) - 1), packed >> bits


class RunLengthIndex:
    """Index of several byte strings; matches do not cross their ends.

    heads, symbols: first row of every run of the transform, and its symbol
    top, bottom: text places of a run's first and last row
    above, below: symbols that these share with the row before and after
    """

    def __init__(self, bodies: list[bytes]):
        size = np.fromiter(map(len, bodies), np.int64, len(bodies))
        self.starts = np.cumsum(size + 1) - size - 1
        raw = np.frombuffer(b"\0".join([*bodies, b""]), np.uint8)
        self.n = n = len(raw)
        ends = self.starts + size
        stop = np.zeros(n, bool)
        stop[ends] = True
        used = np.bincount(raw[~stop], minlength=256) > 0
        code = np.cumsum(used) * used
        text = code[raw].astype(np.int64)
        text[stop] = 0
        place = np.arange(n)
        #: symbols from a place to the end of its string
        self.left = np.repeat(ends, size + 1) - place
        levels, final = self._ranks(text, int(code.max(initial=0)), int(size.max(initial=0)) + 1)
        order = _ordered(final, n)[0]
        before = np.where(order > 0, text[order - 1], 0)
        head = np.ones(n, bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.heads = np.flatnonzero(head)
        tails = np.append(self.heads[1:], n) - 1
        self.symbols = before[self.heads]
        self.top, self.bottom = order[self.heads], order[tails]
        self.above = self._shared(text, levels, order[np.maximum(self.heads - 1, 0)], self.top)
        self.above[self.heads == 0] = 0
        self.below = self._shared(text, levels, self.bottom, order[np.minimum(tails + 1, n - 1)])
        self.below[tails == n - 1] = 0

    def _ranks(self, text: np.ndarray, top: int, longest: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
        """Ranks of all suffixes by their first 1, 2, 4 ... packs of symbols."""
        n = len(text)
        bits = max(1, top.bit_length())
        step = max(1, (63 - n.bit_length()) // bits)
        padded = np.append(text, np.zeros(step, np.int64))
        key = np.zeros(n, np.int64)
        for t in range(step):
            key = (key << bits) | np.where(self.left > t, padded[t:t + n], 0)
        levels, h = [], step
        while True:
            order, ordered = _ordered(key, n)
            rank = np.empty(n, np.int32)
            rank[order] = np.append(0, np.cumsum(ordered[1:] != ordered[:-1]))
            levels.append((h, rank))
            if h >= longest:
                return levels, rank.astype(np.int64)
            wide = rank.astype(np.int64)
            key = wide * (n + 1)
            m = max(0, n - h)
            key[:m] += np.where(self.left[:m] >= h, wide[h:] + 1, 0)
            h *= 2

    def _shared(self, text: np.ndarray, levels: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.n
        most = np.minimum(self.left[a], self.left[b])
        length = np.zeros(len(a), np.int64)
        for h, rank in reversed(levels):
            x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
            length += np.where((rank[x] == rank[y]) & (length < most), h, 0)
        live = length < most
        for _ in range(levels[0][0]):
            x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
            live &= (text[x] == text[y]) & (length < most)
            length += live
        return np.minimum(length, most)

    def matching_statistics(self) -> np.ndarray:
        """For every place, the longest match that starts at any other place."""
        place = np.arange(self.n)
        out = np.zeros(self.n, np.int64)
        for at, length in ((self.top, self.above), (self.bottom, self.below)):
            reach = np.zeros(self.n, np.int64)
            reach[at] = at + length
            known = np.zeros(self.n, np.int64)
            known[at] = at
            out = np.maximum(out, reach[np.maximum.accumulate(known)] - place)
        return out
