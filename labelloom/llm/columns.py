"""Column helpers the operators of this package share.

Every operator keeps the columns it is given. A result column replaces a given column of
the same name (names compare without case, as in Spark). Working columns start with
``__llm_``, which is reserved.
"""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelloom.session import _delete, staged

# What Python's bytes.split() and the contracts' pattern [^\x20\x09-\x0D]+ divide at.
WHITE = " \t\n\x0b\f\r"

# Rows worked on together in a task.
ROWS_TOGETHER = 500

Field = tuple[str, T.DataType]


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of df that none of the names would replace."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def once_per_worker(key: object, make: Callable[[], object]) -> object:
    """A value made once in each Python worker process.

    Functions travel to workers by value, so a module global would be made anew for every
    task; the process's own table is not.
    """
    store = sys.__dict__.setdefault("_labelloom_llm", {})
    if key not in store:
        store[key] = make()
    return store[key]


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that what is made of a part stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_TOGETHER):
            yield batch.slice(at, ROWS_TOGETHER)


def written(df: DataFrame, name: str) -> DataFrame:
    """session.staged, after letting go of the shuffle files of earlier steps.

    Spark deletes a shuffle's files when the driver's JVM has collected the plan that made
    them, which in a job of many steps can be long after its rows were written.
    """
    spark = df.sparkSession
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return staged(df, name)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables of which all that is made of them is written itself."""
    for df in tables:
        for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
            _delete(df.sparkSession, folder)


def append_columns(
    df: DataFrame,
    inputs: Sequence[str],
    outputs: Sequence[Field],
    function: Callable[..., Sequence[pa.Array]],
) -> DataFrame:
    """All columns of df with the output columns after them.

    function gets the input columns of one Arrow batch and returns the output columns, of
    the same length. It runs without a shuffle, one batch at a time.
    """
    names = [n for n, _ in outputs]
    kept = without(df, names)
    marked = [f"__llm_in{i}" for i in range(len(inputs))]
    source = df.select(
        *[df[quoted(c)] for c in kept],
        *[df[quoted(c)].alias(m) for c, m in zip(inputs, marked, strict=True)],
    )
    schema = T.StructType(
        [source.schema[i] for i in range(len(kept))] + [T.StructField(n, t) for n, t in outputs]
    )
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = function(*[part.column(width + i) for i in range(len(marked))])
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(width)] + list(made), part.schema.names[:width] + names
            )

    return source.mapInArrow(run, schema)
