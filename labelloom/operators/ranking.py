"""Exact global order without moving all rows to one task.

A window over the whole table numbers rows in a single task. Here Spark's range
partitioning sorts the table, each row keeps its partition and its position there, and
the rows before each partition (one number per partition) are added afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.values import fingerprint, named
from labelloom.session import staged

_PART, _POS, _BEFORE = "__part", "__pos", "__before"
_POSITION_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class Placed:
    """A sorted table on disk with the rows counted per partition."""

    rows: DataFrame
    before: dict[int, int]
    total: int


def _placed(df: DataFrame, order_by: Sequence[str], name: str) -> Placed:
    """Sort and write once. Positions are part of the written rows, so a repeated task
    or a second read cannot change them."""
    keys = [named(c).asc_nulls_last() for c in order_by]
    rows = staged(
        df.orderBy(*keys).select(
            "*",
            F.spark_partition_id().alias(_PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias(_POS),
        ),
        name,
    )
    # One entry per sort partition, so as many as spark.sql.shuffle.partitions at most.
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(_PART).agg(F.count("*")).collect())
    ends = list(accumulate(n for _, n in sizes))
    before = {part: end - n for (part, n), end in zip(sizes, ends, strict=True)}
    return Placed(rows, before, ends[-1] if ends else 0)


def with_tie_breaker(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds a digest of the row's values: it settles ties the same way on every run."""
    return df.withColumn(name, fingerprint([named(c) for c in columns or df.columns]))


def number_rows(df: DataFrame, order_by: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Adds start, start + 1, ... in the given order, nulls last.

    order_by must be a total order: end it with an id or a tie-breaker column.
    """
    placed = _placed(df, order_by, "numbered")
    offsets = df.sparkSession.createDataFrame(
        list(placed.before.items()), f"{_PART} int, {_BEFORE} long"
    )
    number = (F.col(_POS) + F.col(_BEFORE) + F.lit(start)).cast("long")
    return placed.rows.join(F.broadcast(offsets), _PART).select(
        *[named(c) for c in df.columns], number.alias(name)
    )


def creation_order(
    df: DataFrame, time_column: str | None, ties: Sequence[str] = (), name: str = "creation_order"
) -> DataFrame:
    """Numbers rows 1..N by creation time; without ties columns a row digest settles ties.

    A table without the time column is numbered by the ties columns alone.
    """
    order = [time_column] if time_column is not None and time_column in df.columns else []
    if ties:
        return number_rows(df, order + list(ties), name)
    tied = with_tie_breaker(df, "__tie")
    return number_rows(tied, [*order, "__tie"], name).drop("__tie")


def dense_row_id(df: DataFrame, order_by: Sequence[str], name: str = "problem_id") -> DataFrame:
    """0-based row id in the given order, placed first."""
    numbered = number_rows(df, order_by, name, start=0)
    return numbered.select(named(name), *[named(c) for c in df.columns])


def _plain(name: str, dtype: T.DataType) -> Column:
    """A key as a value that comes to the driver and back unchanged.

    A timestamp does not where clocks are set back: one local time stands for two.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(named(name))
    if isinstance(dtype, T.TimestampNTZType):
        return named(name).cast("string")
    return named(name)


def _literal(value: object, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(dtype)


def _not_after(schema: T.StructType, bound: Row) -> Column:
    """Row is at or before the bound in ascending order, nulls last."""
    result: Column = F.lit(True)
    for key, value in reversed(list(zip(schema.fields, bound, strict=True))):
        if value is None:
            earlier, same = named(key.name).isNotNull(), named(key.name).isNull()
        else:
            limit = _literal(value, key.dataType)
            earlier = F.coalesce(named(key.name) < limit, F.lit(False))
            same = F.coalesce(named(key.name) == limit, F.lit(False))
        result = earlier | (same & result)
    return result


def first_rows(df: DataFrame, order_by: Sequence[str], wanted) -> tuple[Column, int, int]:
    """A condition that holds for the first rows in order, with their number and the total.

    wanted is a function from the total to the number of rows. Only the order columns are
    sorted; the table itself is not moved, since the result is a comparison with the last
    wanted key.
    """
    keys = df.select(*[named(c) for c in order_by])
    placed = _placed(keys, order_by, "keys")
    total = placed.total
    number = max(0, min(int(wanted(total)), total))
    if number == 0:
        return F.lit(False), 0, total
    if number == total:
        return F.lit(True), total, total

    def at(position: int) -> Row:
        part = max(p for p, n in placed.before.items() if n <= position)
        place = (F.col(_PART) == part) & (F.col(_POS) == position - placed.before[part])
        columns = [_plain(f.name, f.dataType).alias(f.name) for f in keys.schema.fields]
        return placed.rows.filter(place).select(*columns).first()

    last, following = at(number - 1), at(number)
    if last == following:
        raise ValueError(f"{list(order_by)} is not a total order: rows share a key")
    return _not_after(keys.schema, last), number, total


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
