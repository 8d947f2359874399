"""Word n-gram sets of texts, exact and hashed."""

from __future__ import annotations

import numpy as np

from .text import U, codes, distinct, mix, prefix, rolling, span_hash, words

N = 3


def word_ngrams(text: str, n: int = N) -> set:
    """The exact n-gram set: tuples of words between ASCII white space."""
    parts = text.translate(_BLANKS).split(" ")
    parts = [p for p in parts if p]
    return {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} or ({tuple(parts)} if parts else set())


_BLANKS = {i: " " for i in (9, 10, 11, 12, 13)}


def gram_sets(texts: list[str], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(text index, 44-bit n-gram hash), sorted and each once."""
    c, offsets = codes(texts)
    starts, ends, which = words(c, offsets)
    h = span_hash(prefix(c), starts, ends)
    grams = rolling(h, n)
    inside = which[: len(grams)] == which[n - 1 : n - 1 + len(grams)] if len(grams) else np.zeros(0, bool)
    count = np.bincount(which, minlength=len(texts))
    few = np.flatnonzero((count > 0) & (count < n))
    at = np.searchsorted(which, few)
    tail = h[at] * U(3)
    for j in range(1, n - 1):
        more = count[few] > j
        tail[more] = mix(tail[more] ^ h[at[more] + j])
    text = np.concatenate([which[: len(grams)][inside], few]).astype(U)
    value = np.concatenate([grams[inside], mix(tail, 5)])
    pairs = distinct(text << U(44) | value >> U(20))
    return (pairs >> U(44)).astype(np.int64), pairs & U((1 << 44) - 1)
