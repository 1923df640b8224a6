"""Removal of word windows that occur more than once, found level by level.

A window of n words can only repeat if the shorter windows inside it do. So short windows
are counted first; those that repeat are extended to twice their length and counted again,
until the full length is reached or no candidate survives. At the short levels it is enough
to count, of the short windows inside every full one, the one with the smallest digest: equal
windows pick equal ones. That is about one position in fourteen at a quarter of the length.
Between levels only the stretches of text whose windows all survived are kept.

Counting: windows met twice within a task's buffer are known to repeat at once, and one of them is
sent on for all, so a window in every document arrives a few times per task and no more.
The rest are counted by digest after one shuffle. Full windows are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.llm.columns import discard, quoted, without, written
from labelloom.llm.words import (
    LARGEST,
    codes_at,
    joined,
    sliding_max,
    sliding_min,
    window_digests,
    word_bounds,
)

# Words worked on together, and windows gathered before their repeats are told.
TOGETHER = 300_000
GATHERED = 400_000

# Levels shorter than this many words would repeat by chance.
SHORTEST = 8

# What names a stretch of text: its row's id and text (as numbers), its first word's place.
STRETCH = ["__llm_id", "__llm_text_hash", "__llm_start"]
STRETCH_TYPES = [pa.int64(), pa.int32(), pa.int32()]


def level_lengths(window: int) -> list[int]:
    """The lengths below the window's: a half, a quarter, ..., rounded up, shortest first."""
    lengths, length = [], -(-window // 2)
    while length >= SHORTEST:
        lengths.append(length)
        length = -(-length // 2)
    return lengths[::-1]


class Stretches:
    """Some stretches of text, one after the other, with their windows of the full length."""

    def __init__(self, names: list[list[int]], texts: list[str], window: int) -> None:
        own = [(text or "").encode() for text in texts]
        self.raw = b"\n".join(own)
        self.word_begins, self.word_ends = word_bounds(self.raw)
        self.window = window
        self.names = np.array(names, np.int64).reshape(-1, 3)
        ends = np.searchsorted(self.word_begins, np.cumsum([len(o) + 1 for o in own]))
        counts = np.diff(ends, prepend=0)
        self.begins = ends - counts
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self.codes = codes_at(self.raw, self.word_begins, self.word_ends)
        last = len(self.owner) - window + 1
        places = np.arange(max(last, 0))
        self.whole = places + window <= ends[self.owner[: max(last, 0)]]

    def words(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The words from each first up to each last, one space between them."""
        spans = zip(self.word_begins[first].tolist(), self.word_ends[last - 1].tolist(), strict=True)
        return [b" ".join(self.raw[a:b].split()) for a, b in spans]

    def short(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Digests of all shorter windows, and the smallest inside each full window."""
        digests = window_digests(self.codes[:, 0], length)
        return digests, sliding_min(digests, self.window - length + 1)

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and digests of the shorter windows that are the smallest in a full one."""
        if not self.whole.any():
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        digests, smallest = self.short(length)
        width = self.window - length + 1
        edge = np.zeros(width - 1, np.uint64)
        wanted = sliding_max(np.concatenate([edge, np.where(self.whole, smallest, 0).astype(np.uint64), edge]), width)
        places = np.flatnonzero((wanted == digests) & (wanted > 0))
        return places, digests[places]

    def surviving(self, length: int, kept: np.ndarray) -> np.ndarray:
        """For each full window, whether its smallest shorter window is among the kept places."""
        digests, smallest = self.short(length)
        left = np.full_like(digests, LARGEST)
        left[kept] = digests[kept]
        return self.whole & (sliding_min(left, self.window - length + 1) == smallest)

    def full(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the full windows, and two digests of each."""
        places = np.flatnonzero(self.whole)
        if not len(places):
            return places, *[np.zeros(0, np.uint64)] * 2
        low, high = (window_digests(self.codes[:, lane], self.window)[places] for lane in (0, 1))
        return places, low, high

    def named(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The names of the stretches the places lie in, and the places counted in them."""
        owner = self.owner[places]
        return self.names[owner], places - self.begins[owner]


def _groups(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[tuple[Stretches, list[int], pa.RecordBatch]]:
    """The batches' stretches, as many together as make TOGETHER words or so."""
    for batch in batches:
        texts = batch.column("__llm_body").to_pylist()
        names = list(zip(*[batch.column(c).to_pylist() for c in STRETCH], strict=True))
        rows: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            rows.append(i)
            size += len(text or "") // 4
            if size >= TOGETHER or i + 1 == len(texts):
                yield Stretches([names[r] for r in rows], [texts[r] for r in rows], window), rows, batch
                rows, size = [], 0


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _rows(low: np.ndarray, high: np.ndarray, names: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """Windows as rows, where those met twice here are marked as sure.

    One of a sure window's places keeps the digest, for other tasks to meet. The others need
    no meeting: places in a row become one row, under a digest of their own.
    """
    order = np.lexsort((high, low))
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    group = np.cumsum(new) - 1
    often = np.bincount(group, minlength=1)[group] > 1
    sure, first = np.zeros(len(order), bool), np.zeros(len(order), bool)
    sure[order], first[order] = often, new
    rest = np.flatnonzero(sure & ~first)
    heads = np.ones(len(rest), bool)
    if len(rest):
        same = (names[rest][1:] == names[rest][:-1]).all(axis=1) & (places[rest][1:] == places[rest][:-1] + 1)
        heads[1:] = ~same
    runs = np.diff(np.append(np.flatnonzero(heads), len(rest)))
    rest = rest[heads]
    sent = np.flatnonzero(first)
    rows = np.concatenate([sent, rest])
    own = joined(joined(names[rest, 0].view(np.uint64), names[rest, 1].view(np.uint64)), places[rest].view(np.uint64))
    columns = [
        _signed(np.concatenate([low[sent], own])),
        _signed(np.concatenate([high[sent], np.zeros(len(rest), np.uint64)])),
        *[pa.array(names[rows, i].astype(t.to_pandas_dtype())) for i, t in enumerate(STRETCH_TYPES)],
        pa.array(places[rows].astype(np.int32)),
        pa.array(np.concatenate([np.ones(len(sent), np.int32), runs.astype(np.int32)])),
        pa.array(sure[rows]),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.name for f in WINDOWS])


WINDOWS = T.StructType(
    [
        T.StructField("__llm_low", T.LongType()),
        T.StructField("__llm_high", T.LongType()),
        T.StructField("__llm_id", T.LongType()),
        T.StructField("__llm_text_hash", T.IntegerType()),
        T.StructField("__llm_start", T.IntegerType()),
        T.StructField("__llm_place", T.IntegerType()),
        T.StructField("__llm_run", T.IntegerType()),
        T.StructField("__llm_sure", T.BooleanType()),
    ]
)
PIECES = T.StructType([*WINDOWS.fields[2:5], T.StructField("__llm_body", T.StringType())])


def _counted(pieces: DataFrame, window: int, length: int | None) -> DataFrame:
    """The windows of the pieces that occur more than once: of a shorter length, or full ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, ...]] = []
        size = 0
        for stretches, _, _ in _groups(batches, window):
            if length is None:
                places, low, high = stretches.full()
            else:
                places, low = stretches.anchors(length)
                high = np.zeros_like(low)
            gathered.append((low, high, *stretches.named(places)))
            size += len(places)
            if size >= GATHERED:
                yield _rows(*[np.concatenate(c) for c in zip(*gathered, strict=True)])
                gathered, size = [], 0
        if size:
            yield _rows(*[np.concatenate(c) for c in zip(*gathered, strict=True)])

    rows = pieces.mapInArrow(run, WINDOWS)
    if length is not None:
        rows = rows.drop("__llm_high")
    keys = [c for c in ("__llm_low", "__llm_high") if c in rows.columns]
    met = F.count("*").over(Window.partitionBy(*keys))
    counted = rows.withColumn("__llm_met", met)
    return counted.filter("__llm_sure OR __llm_met > 1").select(*STRETCH, "__llm_place", "__llm_run")


def _places(column: pa.Array) -> list[np.ndarray]:
    """Lists of (place, run) structs as arrays of places."""
    flat = column.flatten()
    place = flat.field(0).to_numpy(zero_copy_only=False)
    run = flat.field(1).to_numpy(zero_copy_only=False)
    made, at = [], 0
    for n in column.value_lengths().to_pylist():
        firsts, runs = place[at : at + n], run[at : at + n]
        if (runs == 1).all():
            made.append(firsts.astype(np.int64))
        else:
            steps = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
            made.append(np.repeat(firsts, runs).astype(np.int64) + steps)
        at += n
    return made


def _narrowed(pieces: DataFrame, found: DataFrame, window: int, length: int) -> DataFrame:
    """The stretches whose full windows all hold a shorter one that was found to repeat."""
    grouped = found.groupBy(*STRETCH).agg(F.collect_list(F.struct("__llm_place", "__llm_run")).alias("__llm_found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stretches, rows, batch in _groups(batches, window):
            if not stretches.whole.any():
                continue
            found = _places(batch.column("__llm_found").take(pa.array(rows)))
            kept = np.concatenate([p + b for p, b in zip(found, stretches.begins, strict=True)])
            alive = np.flatnonzero(stretches.surviving(length, kept))
            if not len(alive):
                continue
            owner = stretches.owner[alive]
            opens = np.ones(len(alive), bool)
            opens[1:] = (np.diff(alive) > 1) | (np.diff(owner) > 0)
            first = alive[opens]
            last = alive[np.append(np.flatnonzero(opens)[1:], len(alive)) - 1] + window
            names, places = stretches.named(first)
            bodies = stretches.words(first, last)
            names[:, 2] += places
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(names[:, i].astype(t.to_pandas_dtype())) for i, t in enumerate(STRETCH_TYPES)],
                    pa.array(bodies, pa.binary()).cast(pa.string()),
                ],
                PIECES.names,
            )

    return pieces.join(grouped, STRETCH).mapInArrow(run, PIECES)


def _key(df: DataFrame, id_column: str, text: str) -> list[Column]:
    """A row's name: its id, and a hash of its text to tell rows of one id apart."""
    column = df[quoted(id_column)]
    whole = isinstance(df.schema[id_column].dataType, T.IntegralType)
    number = F.coalesce(column.cast("long"), F.lit(-1)) if whole else F.xxhash64(column)
    return [number.alias(STRETCH[0]), F.hash(df[quoted(text)]).alias(STRETCH[1])]


def _cut(text: str | None, removed: np.ndarray | None, window: int) -> tuple[int, int, str | None]:
    """Words, removed words and the text without them; removed are the windows' places."""
    if removed is None or not len(removed):
        return len((text or "").encode().split()), 0, text
    raw = text.encode()
    begins, ends = word_bounds(raw)
    size = len(begins)
    steps = np.bincount(removed, minlength=size + 1) - np.bincount(removed + window, minlength=size + 1)
    gone = np.cumsum(steps)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    kept, at = [], 0
    for first, after in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if after < size:
            kept.append(raw[at : begins[first]])
            at = begins[after]
        else:
            kept.append(raw[at : ends[first - 1]] if first else b"")
            at = len(raw)
    kept.append(raw[at:])
    return size, int(gone.sum()), b"".join(kept).decode()


def repeated_windows(df: DataFrame, window: int = 35, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (the row's key, start, run): windows from start on, run of them, occur elsewhere."""
    pieces = df.select(*_key(df, id_column, text), F.lit(0).alias(STRETCH[2]), df[quoted(text)].alias("__llm_body"))
    # Each level's tables are deleted as soon as the next one's are written, and so are its shuffles.
    last: list[DataFrame] = []
    for length in level_lengths(window):
        pieces = written(_narrowed(pieces, _counted(pieces, window, length), window, length), f"stretches-{length}")
        discard(*last)
        last = [pieces]
    found = written(_counted(pieces, window, None), "windows")
    discard(*last)
    return found.withColumn("__llm_place", F.col("__llm_place") + F.col(STRETCH[2])).drop(STRETCH[2])


def remove_repeats(df: DataFrame, window: int = 35, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Cuts out every word that lies in a window whose words also start anywhere else.

    All columns stay; n_words and n_removed are added (given ones replaced), and the text
    holds the words that are left, with the white space between them as it was. A text from
    which nothing is removed is unchanged. Windows are judged on the given texts: all copies
    of a passage go, in the same row too, and so do repeated rows. Words are [^\\x20\\x09-\\x0D]+.

    A null text has no words and stays null; a text shorter than the window keeps all words.
    Rows may share an id or have none. An empty table stays empty. Long texts are worked on
    whole.
    """
    names = ["n_words", "n_removed"]
    if df.schema[text].dataType != T.StringType():
        raise ValueError("the text column must hold strings")
    found = repeated_windows(df, window, id_column, text)
    grouped = found.groupBy(*STRETCH[:2]).agg(
        F.collect_list(F.struct("__llm_place", "__llm_run")).alias("__llm_found")
    )
    kept = without(df, names)
    keyed = df.select(*[df[quoted(c)] for c in kept], *_key(df, id_column, text))
    marked = keyed.join(grouped, STRETCH[:2], "left").select(*[F.col(quoted(c)) for c in kept], "__llm_found")
    at = [c.lower() for c in kept].index(text.lower())
    schema = T.StructType(
        [marked.schema[i] for i in range(len(kept))] + [T.StructField(n, T.LongType()) for n in names]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(len(kept))
            places = iter(_places(lists.drop_null()))
            made = [
                _cut(value, next(places) if has else None, window)
                for value, has in zip(batch.column(at).to_pylist(), lists.is_valid().to_pylist(), strict=True)
            ]
            columns = [batch.column(i) for i in range(len(kept))]
            columns[at] = pa.array([m[2] for m in made], pa.string())
            columns += [pa.array([m[i] for m in made], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return marked.mapInArrow(run, schema)
