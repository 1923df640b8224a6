"""Token counts of the parts of documents, from one encoding of the whole document.

A document is encoded once. Its tokens are spans of characters, and each is joined with the
part it lies in. A token that crosses a boundary goes by a rule: to the part of its first
character, of its last, or of most of its bytes (the earlier part if equal). So the counts
of all parts, and of what lies in none, add up to the document's tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelloom.llm.bpe import BytePairs, SharedTokenizer
from labelloom.llm.columns import once_per_worker, quoted, slices
from labelloom.llm.library_ids import library_encoder

RULES = ("first", "last", "most")

COUNTS = [
    ("part", T.IntegerType()),
    ("part_start", T.LongType()),
    ("part_end", T.LongType()),
    ("n_tokens", T.LongType()),
    ("n_crossing", T.LongType()),
    ("doc_tokens", T.LongType()),
]
ARROW = [pa.int32(), *[pa.int64()] * 5]


def token_lengths(pairs: BytePairs) -> np.ndarray:
    """Bytes of every token, by id."""
    lengths = np.zeros(max(pairs.spelling) + 1, np.int64)
    for i, spelled in pairs.spelling.items():
        lengths[i] = len(spelled)
    return lengths


def count_parts(raw: bytes, sizes: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, ...]:
    """Tokens of each part, and of those the ones that cross into or out of it.

    sizes: bytes of the tokens, in order. Parts are character spans in order, without
    overlap. A last entry counts the tokens that go to no part.
    """
    # Byte offsets of all characters, so that spans of characters and of tokens can be joined.
    letters = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    offsets = np.append(letters, len(raw))
    starts, ends = offsets[np.clip(starts, 0, len(letters))], offsets[np.clip(ends, 0, len(letters))]
    to = np.cumsum(sizes)
    since = to - sizes
    none = len(starts)

    def part_at(byte: np.ndarray) -> np.ndarray:
        """The part that holds each byte, by a binary search over the parts' starts."""
        found = np.searchsorted(starts, byte, "right") - 1
        return np.where((found >= 0) & (byte < np.append(ends, 0)[found]), found, none)

    first, last = part_at(since), part_at(to - 1)
    crossing = first != last
    owner = first.copy()
    if rule == "last":
        owner = last
    elif rule == "most":
        for t in np.flatnonzero(crossing):
            held = np.bincount(part_at(np.arange(since[t], to[t])), minlength=none + 1)
            owner[t] = held.argmax()
    return np.bincount(owner, minlength=none + 1), np.bincount(owner[crossing], minlength=none + 1)


def count_tokens(
    df: DataFrame,
    path: str,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    parts: str | None = None,
    rule: str = "first",
) -> DataFrame:
    """One row per part of every document: its tokens, and those that cross its boundary.

    parts names a column of arrays of structs (start, end), character spans in order and
    without overlap: others fail the job with a ValueError. A null span, or one with a null end,
    is an empty part where the one before it ends. Without it the parts are the lines, each with its line feed. part is the
    part's place from 0; a row with part -1 counts the tokens in no part, if there are any.
    n_crossing are those of n_tokens that reach into another part or out of all. doc_tokens
    are the whole document's.

    A null or empty text has no tokens: its lines are one empty part. A null array of parts
    has none. Null values in carried columns are carried. Repeated rows count each. An empty
    table gives no rows. Long texts are encoded whole. Columns that are not carried are left
    out, so extra ones cannot clash.
    """
    if rule not in RULES:
        raise ValueError(f"the rule must be one of {RULES}")
    names = [n for n, _ in COUNTS]
    if {c.lower() for c in carry} & set(names):
        raise ValueError(f"carried columns must not be named like {names}")
    shared = SharedTokenizer(df.sparkSession, path)
    source = df.select(
        *[df[quoted(c)] for c in carry],
        df[quoted(text)].alias("__llm_text"),
        *([df[quoted(parts)].alias("__llm_parts")] if parts else []),
    )
    schema = T.StructType([source.schema[i] for i in range(len(carry))] + [T.StructField(n, t) for n, t in COUNTS])

    def spans(value: str, given: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
        if parts:
            listed, at = [], 0
            for p in given or []:
                known = p and p["start"] is not None and p["end"] is not None
                start, end = (p["start"], p["end"]) if known else (at, at)
                if not at <= start <= end:
                    raise ValueError(f"parts must be in order, without overlap: {start} to {end} after {at}")
                listed.append((start, end))
                at = end
            starts, ends = np.array(listed, np.int64).reshape(-1, 2).T
            return starts, ends
        ends = np.cumsum([len(line) + 1 for line in value.split("\n")])
        ends[-1] -= 1  # no line feed after the last line
        return np.append(0, ends[:-1]), ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = once_per_worker(("lengths", shared.key), lambda: token_lengths(shared.pairs()))
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("__llm_text").to_pylist()]
            given = batch.column("__llm_parts").to_pylist() if parts else [None] * len(texts)
            rows, made = [], []
            for i, (value, ids, own) in enumerate(zip(texts, library_encoder(shared).encode_batch(texts), given, strict=True)):
                sizes = lengths[np.frombuffer(ids, "<u4")]
                starts, ends = spans(value, own)
                counts, crossing = count_parts(value.encode(), sizes, starts, ends, rule)
                number = np.arange(len(counts))
                number[-1] = -1
                keep = len(counts) if counts[-1] else len(counts) - 1
                columns = [
                    number, np.append(starts, 0), np.append(ends, 0), counts, crossing, np.full(len(counts), len(sizes))
                ]
                rows.append(np.full(keep, i))
                made.append([c[:keep] for c in columns])
            where = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(where) for i in range(len(carry))]
                + [pa.array(np.concatenate(c)).cast(t) for c, t in zip(zip(*made, strict=True), ARROW, strict=True)],
                [*carry, *names],
            )

    return source.mapInArrow(run, schema)
