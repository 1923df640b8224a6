"""Large JSON array files, cut into their elements by several tasks.

Spark reads a file in blocks of spark.sql.files.maxPartitionBytes, here in pieces that end with
a closing brace, so no task ever holds more of a file than a batch of pieces. Whether a block
begins inside a string, and how deep, is not known where it is read. So a first pass sums up each
block both ways: quotes flip one into the other, and brackets count in the parts outside strings.
Running over a file's sums, a few numbers a block, tells how each block really begins. A second
pass then cuts the elements at the commas of the outermost array. What is left at the ends of
blocks is put together with its neighbours'.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.session import staged

FILE = "__file"
RECORD = "__record"

# White space of JSON.
SPACE = b" \t\r\n"

# The byte order mark some writers put at the start of a file.
MARK = b"\xef\xbb\xbf"

_END = b"}"
_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_STEPS = np.zeros(256, np.int8)
_STEPS[[ord("["), ord("{")]] = 1
_STEPS[[ord("]"), ord("}")]] = -1

# Pieces of elements: the end of one begun in an earlier block, a whole one, the start of one that
# goes on in a later block, a whole block inside one; and the end of the array.
HEAD, WHOLE, TAIL, INNER, CLOSED = range(5)

# Where the text before a cut stands.
BEFORE, WITHIN, AFTER = range(3)


def _structure(text: bytes, in_string: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes without escapes, whether each is inside a string, and what each adds to the depth
    where it is not. A text begins and ends after a brace, so never between escape and escaped."""
    plain = np.frombuffer(_ESCAPED.sub(b"  ", text), np.uint8)
    inside = (np.cumsum(plain == ord('"')) + in_string) % 2 == 1
    return plain, inside, _STEPS[plain]


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict, bytes]]:
    """The text of each run of pieces of one block, with the block's key columns."""
    for batch in batches:
        starts = np.concatenate([batch.column(k).to_numpy(zero_copy_only=False)[:, None] for k in ("__path", "__start")], axis=1)
        changes = np.flatnonzero((starts[1:] != starts[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *changes], [*changes, batch.num_rows], strict=True):
            if low < high:
                pieces = batch.column("value").slice(low, high - low).to_pylist()
                yield {k: batch.column(k)[int(low)].as_py() for k in keys}, b"".join(p + _END for p in pieces)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: odd number of quotes, depth gained if it begins outside or inside a
    string, bytes, and the first byte that is no white space."""
    schema = pa.schema(
        [("__path", pa.string()), ("__start", pa.int64()), (FILE, pa.string()), ("size", pa.int64()), ("odd", pa.bool_())]
        + [(n, pa.int64()) for n in ("outside", "inside", "bytes")]
        + [("first", pa.string())]
    )
    held: dict = {}
    for key, text in _blocks(batches, ["__path", "__start", FILE, "size"]):
        if held and (held["__path"], held["__start"]) != (key["__path"], key["__start"]):
            yield pa.RecordBatch.from_pylist([held], schema)
            held = {}
        held = held or {**key, "odd": False, "outside": 0, "inside": 0, "bytes": 0, "first": ""}
        _, inside, steps = _structure(text, held["odd"])
        held["outside"] += int(steps[~inside].sum())
        held["inside"] += int(steps[inside].sum())
        held["odd"] = bool(inside[-1])
        held["bytes"] += len(text)
        held["first"] = held["first"] or text.removeprefix(MARK).lstrip(SPACE)[:1].decode("latin-1")
    if held:
        yield pa.RecordBatch.from_pylist([held], schema)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each block of a file begins; added: the brace at the end is none of the file's."""
    schema = pa.schema(
        [("__path", pa.string()), ("__start", pa.int64()), ("in_string", pa.bool_()), ("depth", pa.int64())]
        + [(FILE, pa.string()), ("array", pa.bool_()), ("added", pa.bool_())]
    )
    for batch in batches:
        for path, blocks in zip(batch.column("__path").to_pylist(), batch.column("blocks").to_pylist(), strict=True):
            made, in_string, depth = [], False, 0
            for block in blocks:
                made.append({"__path": path, "__start": block["__start"], "in_string": in_string, "depth": depth})
                depth += block["inside" if in_string else "outside"]
                in_string ^= block["odd"]
            # Every piece was given a brace at its end. That of the last one is no part of the
            # file unless the bytes add up (a byte order mark, of three, is not among them).
            added = sum(b["bytes"] for b in blocks) - blocks[0]["size"] in (1, -2)
            array = blocks[0]["first"] == "["
            rest = {FILE: blocks[0][FILE], "array": array, "added": added}
            yield pa.RecordBatch.from_pylist([m | rest for m in made], schema)


class _Cutter:
    """Cuts the text of one block, given in order, into pieces (kind, text)."""

    def __init__(self, start: int, in_string: bool, depth: int, array: bool) -> None:
        self.in_string, self.depth, self.array = in_string, depth, array
        self.stands = BEFORE if start == 0 else WITHIN if depth > 0 or in_string else AFTER
        self.continued = start > 0
        self.held: list[bytes] = []

    def feed(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        if not self.array:
            yield INNER, text
            return
        if self.stands == AFTER:
            return
        plain, inside, steps = _structure(text, self.in_string)
        depth = self.depth + np.cumsum(np.where(inside, 0, steps))
        opening, closing = (plain == ord("[")) & (depth == 1), (plain == ord("]")) & (depth == 0)
        cuts = np.flatnonzero(~inside & (opening | closing | ((plain == ord(",")) & (depth == 1))))
        at = 0
        for cut in cuts.tolist():
            if self.stands == WITHIN:
                yield (HEAD if self.continued else WHOLE), b"".join([*self.held, text[at:cut]])
            self.held, self.continued, self.stands = [], False, WITHIN
            at = cut + 1
            if closing[cut]:
                yield CLOSED, b""
                self.stands = AFTER
                return
        self.held.append(text[at:])
        self.in_string, self.depth = bool(inside[-1]), int(depth[-1])

    def end(self) -> Iterator[tuple[int, bytes]]:
        if self.stands == WITHIN and self.array:
            yield (INNER if self.continued else TAIL), b"".join(self.held)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["__path", "__start", "seq", "kind", "piece"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    cutter, current, made, seq = None, None, [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(*made, strict=True) if made else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for key, text in _blocks(batches, ["__path", "__start", "in_string", "depth", "array"]):
        if current != (key["__path"], key["__start"]):
            if cutter is not None:
                made += [(*current, seq, *piece) for piece in cutter.end()]
            current, seq = (key["__path"], key["__start"]), 0
            cutter = _Cutter(key["__start"], key["in_string"], key["depth"], key["array"])
        for piece in cutter.feed(text):
            made.append((*current, seq, *piece))
            seq += 1
        yield batch()
        made = []
    if cutter is not None:
        made += [(*current, seq, *piece) for piece in cutter.end()]
        yield batch()


def array_elements(spark: SparkSession, directory: str, pattern: str, larger_than: int) -> DataFrame:
    """(file name, text) of the records in the files of more than so many bytes.

    An array gives its elements, any other file is one record; what follows the array's end is not
    looked at. An array that is no JSON gives one row, the first of its parts that is none, or an
    opening bracket if it has no end: nothing that a reader takes for a record.
    One row a block is sent to all executors; the driver has listed as many blocks already.
    """
    pieces = (
        spark.read.option("pathGlobFilter", pattern)
        .option("lineSep", _END.decode())
        .text(directory)
        .select(
            F.col("_metadata.file_path").alias("__path"),
            F.col("_metadata.file_block_start").alias("__start"),
            F.col("_metadata.file_name").alias(FILE),
            F.col("_metadata.file_size").alias("size"),
            F.col("value").cast("binary").alias("value"),
        )
        .filter(F.col("size") > larger_than)
    )
    sums = pieces.mapInArrow(_sums, f"__path string, __start long, {FILE} string, size long, odd boolean, outside long, inside long, bytes long, first string")
    listed = sums.groupBy("__path").agg(
        F.sort_array(F.collect_list(F.struct("__start", FILE, "size", "odd", "outside", "inside", "bytes", "first"))).alias("blocks")
    )
    states = staged(
        listed.mapInArrow(_states, f"__path string, __start long, in_string boolean, depth long, {FILE} string, array boolean, added boolean"),
        "blocks",
    )
    begun = pieces.join(F.broadcast(states.drop(FILE, "added")), ["__path", "__start"])
    cut = staged(begun.mapInArrow(_pieces, "__path string, __start long, seq long, kind int, piece binary"), "pieces")
    text = F.col("piece").cast("string")
    order = Window.partitionBy("__path").orderBy("__start", "seq")
    ends = cut.filter(F.col("kind").isin(HEAD, TAIL, INNER)).withColumn(
        "number", F.sum((F.col("kind") == TAIL).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    joined = ends.groupBy("__path", "number").agg(
        F.min(F.struct("__start", "seq")).alias("at"),
        F.array_sort(F.collect_list(F.struct("__start", "seq", text.alias("text")))).alias("parts"),
    )
    stitched = joined.select("__path", "at", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    at = F.struct("__start", "seq").alias("at")
    whole = cut.filter(F.col("kind") == WHOLE).select("__path", at, text.alias("text"))
    ended = cut.filter(F.col("kind") == CLOSED).groupBy("__path").agg(F.min(at).alias("ended"))
    files = states.groupBy("__path").agg(F.first(FILE).alias(FILE), F.first("array").alias("array"), F.first("added").alias("added"))
    files = files.join(ended, "__path", "left")
    # A file that is no array ends as it does, without the brace it was given.
    unended = F.when(F.col("added"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    shown = F.when(F.col("array"), F.trim("text", F.lit(SPACE.decode()))).otherwise(unended)
    elements = whole.unionByName(stitched).join(F.broadcast(files), "__path")
    elements = elements.filter(F.col("ended").isNull() | (F.col("at") < F.col("ended"))).select(
        "__path", FILE, "at", "array", (F.col("array") & F.col("ended").isNull()).alias("endless"), shown.alias("text")
    )
    fault = F.col("array") & (F.col("text") != "") & F.try_parse_json("text").isNull()
    elements = staged(elements.withColumn("fault", fault), "elements")
    empty = F.col("array") & (F.col("text") == "")
    judged = elements.groupBy("__path", FILE).agg(
        F.count("*").alias("elements"),
        F.count_if(empty).alias("empty"),
        F.min(F.when(F.col("fault"), F.struct("at", "text"))).alias("worst"),
        F.bool_or("endless").alias("endless"),
    )
    good = F.col("worst").isNull() & ~F.col("endless") & ((F.col("empty") == 0) | (F.col("elements") == 1))
    judged = judged.select("__path", FILE, good.alias("good"), F.coalesce("worst.text", F.lit("[")).alias("worst"))
    kept = elements.join(F.broadcast(judged.filter("good").select("__path")), "__path").filter(~empty)
    # An element's text as the reader of small files gives it: white space, strings, null.
    element = F.get(F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>"), F.lit(0))
    record = F.when(F.col("array"), element).otherwise(F.col("text"))
    return kept.select(FILE, record.alias(RECORD)).union(judged.filter("NOT good").select(FILE, "worst"))
