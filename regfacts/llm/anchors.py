"""Content-defined anchors: equal windows of a sequence meet at the same anchor.

Every window of `length` symbols holds an anchor, the leftmost k-gram of least
hash in it. Equal windows have it at the same place, so windows need be
compared only where an anchor is shared. The windows of one anchor are
consecutive: they form a frame. About 2 anchors come from `length` symbols.
"""

from __future__ import annotations

from functools import cache

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_AT_BITS = 24
_AT = np.uint64((1 << _AT_BITS) - 1)
#: Symbols handled at once; positions must fit _AT_BITS.
CHUNK = 1 << 21


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    out = np.full(n, base, np.uint64)
    out[0] = 1
    back = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    back[0] = 1
    return np.multiply.accumulate(out), np.multiply.accumulate(back)


@cache
def byte_symbols() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


def kgram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of every k-gram of 64-bit symbols."""
    n = len(symbols)
    power, back = _powers(1 << max(12, int(n).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(symbols * power[:n], out=total[1:])
    h = (total[k:] - total[:-k]) * back[:n - k + 1]
    h ^= h >> np.uint64(32)
    h *= _ODD
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of every w consecutive ones."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def frames(symbols: np.ndarray, starts: np.ndarray, length: int, k: int,
           penalty: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first window, last window) of all frames of several sequences.

    `symbols` is the sequences one after another, `starts` their begins and the
    end; at most 2^24 symbols. `penalty` (0-3 for each k-gram) moves a k-gram
    behind those of less penalty.
    """
    n = len(symbols)
    if n < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    h = kgram_hashes(symbols, k)
    order = h >> np.uint64(2)
    if penalty is not None:
        order |= penalty.astype(np.uint64) << np.uint64(62)
    order = (order & ~_AT) | np.arange(len(h), dtype=np.uint64)
    at = (_sliding_min(order, length - k + 1) & _AT).astype(np.int64)
    # windows that lie in one sequence
    valid = np.zeros(n + 1, np.int64)
    size = np.diff(starts)
    long = size >= length
    np.add.at(valid, starts[:-1][long], 1)
    np.add.at(valid, starts[1:][long] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(valid)[:len(at)] > 0)
    at = at[window]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return h[at[first]], at[first], window[first], window[last]
