"""Batched scoring with a caller's model, and prompts to predictions."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from labelloom.functions.prompts import build_prompt, chat_text
from labelloom.functions.values import named
from labelloom.operators.answers import parse_model_output
from labelloom.operators.columns import shape_result

_INPUT = "__input"

# A scorer maps a list of inputs to as many results; a factory makes one per worker process.
# Inputs are texts, or dicts where several columns are given.
Scorer = Callable[[list], list]


def _once_per_process(key: str, factory: Callable[[], Scorer]) -> Scorer:
    """The process's own scorer. Functions come to a worker anew for every task, so it is
    kept in the process's table of modules' values, under a key made by the driver."""
    kept = sys.__dict__.setdefault("_labelloom_scorers", {})
    if key not in kept:
        kept[key] = factory()
    return kept[key]


def score_batches(
    df: DataFrame,
    text: str | Sequence[str],
    factory: Callable[[], Scorer],
    keep: Sequence[str],
    batch_size: int = 4,
    name: str = "raw_model_output",
    result_type: T.DataType | None = None,
    prepare: Callable[[list], list] | None = None,
) -> DataFrame:
    """Kept columns and the scorer's result for each row.

    text names the column to score; the scorer gets a list of its values. Several names, such
    as ids and mask, give it a list of dicts. The factory runs once per Python worker process,
    so a model is loaded there, not for every task, and never sent. The scorer is called with
    batch_size rows at a time, the last call of a task excepted, and each call's results go out
    at once, so a lost task repeats no more than it must. Kept columns travel along as Arrow
    data, unchanged, so results need no join back.
    """
    kept = list(keep)
    inputs = [text] if isinstance(text, str) else list(text)
    marked = [f"{_INPUT}{i}" for i in range(len(inputs))]
    result = T.StructField(name, result_type or T.StringType())
    schema = T.StructType([df.schema[c] for c in kept] + [result])
    arrow_type = to_arrow_type(result.dataType)
    key = uuid.uuid4().hex

    def values(rows: pa.Table) -> list:
        if isinstance(text, str):
            return rows.column(marked[0]).to_pylist()
        return rows.select(marked).rename_columns(inputs).to_pylist()

    def scored(rows: pa.Table, scorer: Scorer) -> Iterator[pa.RecordBatch]:
        for start in range(0, rows.num_rows, batch_size):
            batch = rows.slice(start, batch_size)
            given = values(batch) if prepare is None else prepare(values(batch))
            found = list(scorer(given))
            if len(found) != batch.num_rows:
                raise ValueError(f"scorer gave {len(found)} results for {batch.num_rows} rows")
            out = batch.drop_columns(marked).append_column(name, pa.array(found, type=arrow_type))
            yield from out.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            full = rows.num_rows - rows.num_rows % batch_size
            if full:
                yield from scored(rows.slice(0, full), _once_per_process(key, factory))
            rest = rows.slice(full)
        if rest is not None and rest.num_rows:
            yield from scored(rest, _once_per_process(key, factory))

    rows = df.select(
        *[named(c) for c in kept], *[named(c).alias(m) for c, m in zip(inputs, marked, strict=True)]
    )
    return rows.mapInArrow(run, schema)


def generative_predict(
    df: DataFrame,
    columns: Sequence[str],
    labels: Sequence[str],
    factory: Callable[[], Scorer],
    id_column: str = "problem_id",
    batch_size: int = 4,
    prefix: str = "pred_",
    system: str | None = None,
) -> DataFrame:
    """Prompts, scorer answers and parsed predictions: id, truth, predictions, raw answer.

    With a system text the prompt is given as a chat: system turn, user turn, open answer.
    """
    keep = [c for c in (id_column, *labels) if c in df.columns]
    prompt = build_prompt(columns, labels)
    prompt = prompt if system is None else chat_text(prompt, system)
    prompted = df.select(*[named(c) for c in keep], prompt.alias("__prompt"))
    answered = score_batches(prompted, "__prompt", factory, keep, batch_size)
    parsed = parse_model_output(answered, "raw_model_output", labels, prefix, status=None)
    return shape_result(parsed, labels, id_column, prefix, extra=["raw_model_output"])
