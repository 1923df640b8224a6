"""Sets of word shingles as sorted digests, and digests of whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from labelloom.llm.words import WordCodes, codes_at, joined, window_digests, word_bounds

# Words worked on together.
TOGETHER = 300_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct digests of each text's shingles.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z in lower case, other letters as they are. A text with fewer
    words than a shingle is one shingle; one without words has none. No word is kept afterwards: a
    worker's memory does not grow with the different words it has met.
    """
    encoded = [(t or "").encode() for t in texts]
    raw = b" ".join(encoded).translate(_LOWER)
    begins, ends = word_bounds(raw)
    codes = np.ascontiguousarray(codes_at(raw, begins, ends, WordCodes())[:, 0])
    bounds = np.searchsorted(begins, np.cumsum([0, *(len(e) + 1 for e in encoded)]))
    digests = window_digests(codes, words) if len(codes) >= words else codes[:0]
    made, at = [], 0
    for n in np.diff(bounds).tolist():
        if n >= words:
            made.append(np.unique(digests[at : at + n - words + 1]))
        elif n:
            short = np.array([n], np.uint64)
            for code in codes[at : at + n]:
                short = joined(short, np.array([code]))
            made.append(short)
        else:
            made.append(codes[:0])
        at += n
    return made


def batched(texts: list[str | None]) -> Iterator[list[int]]:
    rows: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        rows.append(i)
        size += len(text or "") // 5
        if size >= TOGETHER or i + 1 == len(texts):
            yield rows
            rows, size = [], 0


def set_digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of every set; sums over distinct members do not depend on their order."""
    whole = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    low = np.bitwise_xor.reduceat(joined(whole, whole), starts)
    return low, np.add.reduceat(joined(whole, ~whole), starts)
