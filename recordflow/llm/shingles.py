"""Word shingles as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd

WORD = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's ``width``-word shingles.

    A-Z are lower-cased, and words end at ASCII white space. A text of fewer words has its whole
    sequence as one shingle, and one without words has none.
    """
    words = (text or "").encode().lower().split()  # bytes: both work on ASCII only
    if not words:
        return np.empty(0, np.uint64)
    hashes = pd.util.hash_array(np.array(words, object), categorize=False)
    size = min(width, len(words))
    shingles = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        shingles = mix(shingles * WORD + hashes[i : i + len(shingles)])
    return np.unique(shingles)
