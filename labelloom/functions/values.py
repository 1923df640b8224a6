"""Column expressions for numbers, label flags and list values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- Fixed values: number patterns -----------------------------------------------
LEADING_NUMBER = r"([0-9.]+)"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def named(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def leading_number(text: Column) -> Column:
    """First run of digits and dots as a double; null when there is none or it is malformed."""
    return F.regexp_extract(text, LEADING_NUMBER, 1).try_cast("double")


def finite_number(value: Column, dtype: T.DataType) -> Column:
    """Value as a finite double, else null."""
    if isinstance(dtype, T.StringType):
        number = F.when(value.rlike(NUMBER), F.trim(value).try_cast("double"))
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        number = value.cast("double")
    else:
        return F.lit(None).cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def label_flag(value: Column, dtype: T.DataType) -> Column:
    """Value as an int label; anything that is not a number counts as 0."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.coalesce(value.cast("int"), F.lit(0))
    return F.coalesce(finite_number(value, dtype).try_cast("int"), F.lit(0))


def multi_hot(tags: Column, labels: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column per label: is the label an element of the list."""
    return {
        label: F.coalesce(F.array_contains(tags, F.lit(label)), F.lit(False)).cast("int")
        for label in labels
    }


def _quoted(item: Column) -> Column:
    """An element as a Python string literal."""
    body = item
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(plain), F.lit(escaped))
    single, double = F.contains(item, F.lit("'")), F.contains(item, F.lit('"'))
    return (
        F.when(item.isNull(), F.lit("None"))
        .when(single & ~double, F.concat(F.lit('"'), body, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def list_text(items: Column) -> Column:
    """A string list as text: ['greedy', 'math']; a null list is 'None'."""
    inner = F.array_join(F.transform(items, _quoted), ", ")
    return F.coalesce(F.concat(F.lit("["), inner, F.lit("]")), F.lit("None"))


def lowered(text: Column, null_text: str | None) -> Column:
    """Lower-cased text; a null becomes null_text, or stays null when that is None."""
    value = text.cast("string")
    if null_text is not None:
        value = F.coalesce(value, F.lit(null_text))
    return F.lower(value)


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def sampling_key(row_id: Column, seed: int) -> Column:
    """Seeded hex key of a row: the same on any partitioning of the table."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string")))


def fingerprint(columns: Sequence[Column]) -> Column:
    """Hex digest of a row's values. Each is written with its length, a null as '-'."""

    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.md5(F.concat(*[part(c) for c in columns]))
