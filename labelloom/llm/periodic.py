"""Periodic runs of words in each text, by an enhanced suffix array.

A run is a stretch of words that repeats itself with some period and that no neighbouring word
continues. The last square of a run, that is the last two periods of it, is a branching tandem
repeat: the suffixes at its two halves agree in exactly one period. So in the suffix array both
lie in the LCP interval whose depth is the period, in different children of it. For every
interval the suffixes of all children but the largest look whether the suffix one depth further
on, or one depth back, is in the interval too, by its place in the inverse suffix array. Each
suffix is in a smaller child at most log2(n) times, so n log n looks do. Rotating a square to the
left as long as the words agree leads to the start of its run; squares with a multiple of a
run's period end in the same stretch and fall to the smallest one.

No tree is made: intervals are pairs of bounds found over the LCP array, and their children are
cuts of them. Texts are worked on together, many short ones or one long one at a time, as one
array of words that differ between texts. A text needs about 100 bytes of memory a word, plus
4 for each doubling of its longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelloom.llm.columns import append_columns
from labelloom.llm.words import split_all

# Words worked on together; a longer text is worked on by itself.
TOGETHER = 300_000

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RUN_ARROW = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups of equal neighbours begin, and their sizes."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return first, np.diff(first, append=len(keys))


def suffix_order(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and ranks of all suffixes by their first 1, 2, 4, ... words.

    codes must differ between texts; ends is where each word's text ends. Equal ranks mean equal
    words. The last ranks are the inverse suffix array. Every rank array has one more place,
    for the end. Only suffixes that still have an equal are sorted again.
    """
    n = len(codes)
    order = np.argsort(codes)
    first, sizes = _groups(codes[order])
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.repeat(first, sizes)
    levels = [rank]
    places = np.flatnonzero(np.repeat(sizes > 1, sizes))
    reach = 1
    while len(places):
        at = order[places]
        ahead = at + reach
        second = np.where(ahead < ends[at], rank[np.minimum(ahead, n)], -1)
        keys = rank[at].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(keys)
        at = at[by]
        order[places] = at
        first, sizes = _groups(keys[by])
        rank = rank.copy()
        rank[at] = np.repeat(places[first], sizes)
        levels.append(rank)
        places = places[np.repeat(sizes > 1, sizes)]
        reach *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words each suffix has in common with the one before it in order; 0 at both ends."""
    lengths = np.zeros(len(order) + 1, np.int64)
    places = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    one, other = order[places - 1], order[places]
    found = np.zeros(len(places), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][one + found] == levels[level][other + found]
        found += same.astype(np.int64) << level
    lengths[places] = found
    return lengths


def _nearest_smaller(lengths: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """For each place, the nearest one on one side with a smaller length, by jumps over larger ones."""
    near = np.arange(len(lengths)) + step
    open_ = places
    while len(open_):
        at = near[open_]
        larger = lengths[at] >= lengths[open_]
        open_, at = open_[larger], at[larger]
        near[open_] = near[at]
    return near[places]


def _smaller_children(lengths: np.ndarray, fewest) -> tuple[np.ndarray, ...]:
    """(low, high, depth, own low, own high, suffix place) for suffixes of all but the largest child.

    low to high is an LCP interval of at least fewest(depth) suffixes, own low to own high the
    child of it that holds the place.
    """
    cuts = np.flatnonzero(lengths > 0)
    low, high = _nearest_smaller(lengths, cuts, -1), _nearest_smaller(lengths, cuts, 1)
    wide = high - low >= fewest(lengths[cuts])
    cuts, low, high = cuts[wide], low[wide], high[wide]
    # Cuts of one interval side by side, in order.
    by = np.lexsort((cuts, high, low))
    cuts, low, high = cuts[by], low[by], high[by]
    first, counts = _groups(low * len(lengths) + high)
    low, high, depth = low[first], high[first], lengths[cuts[first]] if len(first) else cuts
    starts = first + np.arange(len(first))
    inner = np.ones(len(cuts) + len(first), bool)
    inner[starts] = False
    begin = np.empty(len(inner), np.int64)
    begin[inner], begin[starts] = cuts, low
    inner[starts], inner[starts + counts] = True, False
    end = np.empty(len(inner), np.int64)
    end[inner], end[starts + counts] = cuts, high
    sizes = end - begin
    of = np.repeat(np.arange(len(first)), counts + 1)
    if len(first):
        largest = np.flatnonzero(sizes == np.maximum.reduceat(sizes, starts)[of])
        sizes[largest[_groups(of[largest])[0]]] = 0
    child = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(child)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[child]
    of = of[child]
    return low[of], high[of], depth[of], begin[child], end[child], place


def find_runs(codes: np.ndarray, ends: np.ndarray, least_length: int, least_exponent: int) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period.

    A run has at least least_length words and least_exponent periods (2 or more).
    """
    order, levels = suffix_order(codes, ends)
    lengths = common_prefixes(order, levels)
    # A run of k periods holds its last period's words k times, one after the other.
    low, high, depth, own_low, own_high, place = _smaller_children(
        lengths, lambda d: np.maximum(least_length, least_exponent * d) // d
    )
    inverse = levels[-1]
    here = order[place]

    def partners(other: np.ndarray) -> np.ndarray:
        inside = (other >= 0) & (other < len(codes))
        at = inverse[np.where(inside, other, len(codes))]
        return inside & (at >= low) & (at < high) & ~((at >= own_low) & (at < own_high))

    ahead, behind = partners(here + depth), partners(here - depth)
    start = np.concatenate([here[ahead], (here - depth)[behind]])
    period = np.concatenate([depth[ahead], depth[behind]])
    end = start + 2 * period
    for level in range(len(levels) - 1, -1, -1):
        back = start - (1 << level)
        same = levels[level][np.maximum(back, 0)] == levels[level][np.maximum(back, 0) + period]
        start = np.where(same & (back >= 0), back, start)
    long = end - start >= np.maximum(least_length, least_exponent * period)
    start, end, period = start[long], end[long], period[long]
    by = np.lexsort((period, end, start))
    runs = np.stack([start[by], end[by], period[by]], axis=1)
    if len(runs):
        runs = runs[_groups(runs[:, 0] * (len(codes) + 1) + runs[:, 1])[0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in parts of TOGETHER words or so."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "") // 5
        if size >= TOGETHER or i + 1 == len(texts):
            yield texts[at : i + 1]
            at, size = i + 1, 0


def _strongest(runs: np.ndarray) -> tuple[int, int, int]:
    """The run with most periods; of equal ones the first, then that of the smallest period."""
    return max(runs.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


def collapse(texts: list[str | None], least_length: int, least_exponent: int) -> Iterator[tuple[np.ndarray, str]]:
    """For every text its runs (start, length, period) and its words without their repetitions."""
    words, counts = split_all(texts)
    if not words:
        for _ in texts:
            yield np.zeros((0, 3), np.int64), ""
        return
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    codes += np.repeat(np.arange(len(counts)) * len(place), counts)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    runs = find_runs(codes, np.repeat(bounds[1:], counts), least_length, least_exponent)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 1], -1)
    kept = (np.cumsum(cover[:-1]) == 0).tolist()
    own = np.searchsorted(runs[:, 0], bounds)
    for i in range(len(texts)):
        found, begin, end = runs[own[i] : own[i + 1]], bounds[i], bounds[i + 1]
        left = words[begin:end] if not len(found) else compress(words[begin:end], kept[begin:end])
        rows = np.stack([found[:, 0] - begin, found[:, 1] - found[:, 0], found[:, 2]], axis=1)
        yield rows, b" ".join(left).decode()


def collapse_runs(
    df: DataFrame, text: str = "text", least_length: int = 6, least_exponent: int = 4
) -> DataFrame:
    """Adds n_runs, runs, strongest and collapsed to every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words with smallest
    period q (words q apart are equal), of at least max(least_length, least_exponent * q) words,
    that no neighbouring word extends with period q. runs lists (start, length, period) by start,
    then period; strongest is that with most periods, exactly compared (of equal ones the first,
    then the smallest period), null without runs. collapsed holds the words left, joined by one
    space, after dropping those that any run contains after its first q words.

    A null text is an empty one: no runs, collapsed ''. Repeated rows are rows of their own, an
    empty table stays empty, ids are not needed. Columns named like a result are replaced,
    others stay. No shuffle: texts are worked on where they are read, whole.
    """
    if least_exponent < 2 or least_length < 1:
        raise ValueError("runs have two periods or more, and a word at least")

    def run(texts: pa.Array) -> list[pa.Array]:
        counts, listed, best, left = [], [], [], []
        for part in _parts(texts.to_pylist()):
            for runs, kept in collapse(part, least_length, least_exponent):
                counts.append(len(runs))
                listed.append(runs)
                best.append(dict(zip(RUN.names, _strongest(runs), strict=True)) if len(runs) else None)
                left.append(kept)
        flat = np.concatenate([np.zeros((0, 3), np.int64), *listed])
        columns = [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)]
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return [
            pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, RUN.names)),
            pa.array(best, RUN_ARROW),
            pa.array(left, pa.string()),
        ]

    results = [("n_runs", T.LongType()), ("runs", T.ArrayType(RUN)), ("strongest", RUN), ("collapsed", T.StringType())]
    return append_columns(df, [text], results, run)
