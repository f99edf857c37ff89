"""Word-shingle sets of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from starledger.llm.common import LOWER, mix64, span_hashes, word_spans

WORDS = 5


def shingle_sets(offsets: np.ndarray, raw: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``words``-word shingles; a row
    with fewer words has its whole sequence as one; one without words has none.
    A-Z count as a-z."""
    n = len(offsets) - 1
    low = LOWER[raw]
    starts, ends, rows = word_spans(offsets, low)
    h = span_hashes(low, starts, ends)
    first = np.searchsorted(rows, np.arange(n + 1))
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for i in range(words):
        rolled = mix64(rolled + h[i:i + len(rolled)] + np.uint64(i + 1)) if len(rolled) else rolled
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            v = np.zeros(1, np.uint64)
            for i in range(a, b):
                v = mix64(v + h[i:i + 1] + np.uint64(i - a + 1))
            out.append(mix64(v + np.uint64(0xA5A5 + int(b - a))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
