"""Vectorised text primitives that the operators of this folder share.

A batch of texts becomes one array of code points; words, hashes and sliding minima are then whole-array numpy
operations, so Python runs a few calls a batch and none a word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK = 2_000_000  # code points handled at once; a longer text is a chunk of its own
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.empty(max(n, 4096), U)
        have[0] = 1
        done = 1
        while done < len(have):
            step = min(done, len(have) - done)
            np.multiply(have[:step], U(pow(base, done, 1 << 64)), out=have[done : done + step])
            done += step
        if len(have) <= CHUNK + 4096:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: a bijection in which every input bit reaches every output bit."""
    x = x + U((seed * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def chunks(texts: Sequence[str], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts whose lengths sum to at most ``limit``, one text at least."""
    low = total = 0
    for i, text in enumerate(texts):
        if i > low and total + len(text) > limit:
            yield low, i
            low, total = i, 0
        total += len(text)
    if low < len(texts):
        yield low, len(texts)


def codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the offset of each text (one more than there are texts)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), offsets


def words(c: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without ASCII white space, and the text that each is in."""
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~((c == 32) | ((c - np.uint32(9)) < 5))
    edge = np.zeros(len(c) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate([[False], solid[:-1]])))
    ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def prefix(values: np.ndarray) -> np.ndarray:
    """Sums s with s[j] - s[i] = sum of values[i:j] * BASE**position, modulo 2**64."""
    out = np.zeros(len(values) + 1, U)
    terms = values.astype(U)
    terms += U(1)
    terms *= powers(BASE, len(values))
    np.cumsum(terms, out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span that depends on its content alone, from the sums of ``prefix``."""
    if not len(starts):
        return np.zeros(0, U)
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts] + (ends - starts).astype(U))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive values (64-bit)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for j in range(k):
        out *= U(0x9FB21C651E98DF25)
        out += values[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by block-wise running minima from both sides."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    if w == 1:
        return values.copy()
    blocks = -(-len(values) // w)
    full = np.full(blocks * w, np.iinfo(values.dtype).max, values.dtype)
    full[: len(values)] = values
    grid = full.reshape(blocks, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def distinct(values: np.ndarray) -> np.ndarray:
    """The values in order, each once. numpy's own function goes through a hash table, which costs many times as much."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def runs(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of lengths, one after another."""
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(begin, lengths)
