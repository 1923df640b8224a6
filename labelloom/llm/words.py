"""Words of texts as numbers, and digests of word windows, for numpy code in tasks."""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import blake2b

import numpy as np

from labelloom.llm.columns import once_per_worker

# Words whose codes a worker keeps; beyond that the table is emptied. Codes never change.
KEPT_WORDS = 500_000

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd numbers that spread bits, fixed values
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SHIFT = np.uint64(33)
LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)

# Bytes of the words that are numbered without a digest: with the length, two numbers hold them.
SHORT = 15

_IN_WORD = np.ones(256, np.int8)
_IN_WORD[list(b" \t\n\x0b\f\r")] = 0


class WordCodes:
    """Two 64-bit numbers for every word, from a 128-bit digest of its bytes."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.codes = np.zeros((1024, 2), np.uint64)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The codes of the words, one row each."""
        place = self.place
        new = set(words).difference(place)
        if len(place) + len(new) > KEPT_WORDS and place:
            place.clear()
            new = set(words)
        if new:
            first = len(place)
            while first + len(new) > len(self.codes):
                self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
            place.update(zip(new, range(first, first + len(new)), strict=True))
            digests = b"".join([blake2b(w, digest_size=16).digest() for w in new])
            self.codes[first : first + len(new)] = np.frombuffer(digests, "<u8").reshape(-1, 2)
        return self.codes[np.fromiter(map(place.__getitem__, words), np.int64, len(words))]


def word_codes() -> WordCodes:
    return once_per_worker("word codes", WordCodes)


def split_all(texts: Iterable[str | None]) -> tuple[list[bytes], np.ndarray]:
    """The words [^\\x20\\x09-\\x0D]+ of all texts, one after the other, and how many each has."""
    words: list[bytes] = []
    counts = []
    for text in texts:
        own = (text or "").encode().split()
        counts.append(len(own))
        words += own
    return words, np.array(counts, np.int64)


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words [^\\x20\\x09-\\x0D]+ of a text begin, and where they end."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _IN_WORD[np.frombuffer(raw, np.uint8)]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in _MIX:
        x = (x ^ (x >> _SHIFT)) * factor
    return x ^ (x >> _SHIFT)


def codes_at(raw: bytes, begins: np.ndarray, ends: np.ndarray, table: WordCodes | None = None) -> np.ndarray:
    """Two 64-bit numbers for each of the words of raw, one row each.

    Words of up to SHORT bytes are told apart with certainty: their bytes and length fill the two
    numbers, which are then mixed in steps that can be undone. Longer ones go by a digest of 128 bits,
    which the table holds (the worker's own, unless one is given).
    """
    eights = np.lib.stride_tricks.as_strided(
        np.frombuffer(raw + bytes(16), "<u8", 1 + len(raw) // 8), (len(raw) + 1,), (1,), writeable=False
    )
    sizes = ends - begins
    bits = (8 * np.minimum(sizes, 8)).astype(np.uint64)
    rest = (8 * np.clip(sizes - 8, 0, 7)).astype(np.uint64)
    a = eights[begins] & (LARGEST >> (np.uint64(64) - bits))
    b = eights[np.minimum(begins + 8, len(raw))] & ((np.uint64(1) << rest) - np.uint64(1))
    b |= np.minimum(sizes, SHORT + 1).astype(np.uint64) << np.uint64(56)
    for _ in range(2):
        b = b ^ _mixed(a + _STEP)
        a = a ^ _mixed(b + _STEP)
    codes = np.stack([a, b], axis=1)
    long = np.flatnonzero(sizes > SHORT)
    if len(long):
        spans = zip(begins[long].tolist(), ends[long].tolist(), strict=True)
        codes[long] = (word_codes() if table is None else table)([raw[i:j] for i, j in spans])
    return codes


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A digest of each pair of digests, in order."""
    x = a * _STEP + b
    for factor in _MIX:
        x ^= x >> _SHIFT
        x *= factor
    x ^= x >> _SHIFT
    return x


def window_digests(codes: np.ndarray, length: int) -> np.ndarray:
    """A digest for every window of ``length`` codes, by doubling.

    Two windows of 1, 2, 4, ... codes make one of twice the length; the last two may overlap.
    """
    size, made = 1, codes
    while size * 2 <= length:
        made, size = joined(made[:-size], made[size:]), size * 2
    if size < length:
        made = joined(made[: len(made) - (length - size)], made[length - size :])
    return made


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    size, made = 1, values
    while size * 2 <= width:
        made, size = pick(made[:-size], made[size:]), size * 2
    if size < width:
        made = pick(made[: len(made) - (width - size)], made[width - size :])
    return made


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    return _slide(values, width, np.minimum)


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    return _slide(values, width, np.maximum)
