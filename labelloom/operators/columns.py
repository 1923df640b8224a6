"""Projections, filters and checks on a table's columns."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.values import (
    finite_number,
    label_flag,
    leading_number,
    list_text,
    lowered,
    multi_hot,
    named,
)


def _replaced(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """All changes in one projection; columns not in the table come last."""
    kept = [changes.get(c, named(c)).alias(c) for c in df.columns]
    added = [column.alias(c) for c, column in changes.items() if c not in df.columns]
    return df.select(*kept, *added)


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Old to new names; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(renames))


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the table has, in the wanted order."""
    return df.select(*[named(c) for c in wanted if c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str], warn_only: bool = False) -> DataFrame:
    """Raises with the missing names before any job starts, or only warns of them."""
    missing = [c for c in required if c not in df.columns]
    if missing and warn_only:
        warnings.warn(f"missing columns: {missing}", stacklevel=2)
    elif missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def add_missing_features(
    df: DataFrame, features: Sequence[str], critical: Sequence[str] = ()
) -> DataFrame:
    """Absent feature columns become null doubles; an absent critical column raises."""
    require_columns(df, critical)
    absent = {f: F.lit(None).cast("double") for f in features if f not in df.columns}
    return _replaced(df, absent)


def filter_min_labels(df: DataFrame, labels: Sequence[str], minimum: int) -> DataFrame:
    """Rows with at least the minimum number of labels set."""
    if minimum <= 0:
        return df
    return df.filter(active_labels(labels) >= minimum)


def active_labels(labels: Sequence[str]) -> Column:
    """Number of labels set in a row."""
    flags = [F.coalesce(named(c).cast("int"), F.lit(0)) for c in labels]
    return reduce(lambda a, b: a + b, flags, F.lit(0))


def add_label_columns(df: DataFrame, tags: str, labels: Sequence[str]) -> DataFrame:
    """One 0/1 column per label from a list column; zeros when the table has no such column."""
    if tags not in df.columns:
        return _replaced(df, {label: F.lit(0) for label in labels})
    return _replaced(df, multi_hot(named(tags), labels))


def parse_leading_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Texts like '0.5 seconds' to their first number."""
    changes = {c: leading_number(named(c).cast("string")) for c in columns if c in df.columns}
    return _replaced(df, changes)


def list_to_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """List columns to their text form."""
    return _replaced(df, {c: list_text(named(c)) for c in columns if c in df.columns})


def lowercase_text(
    df: DataFrame, columns: Sequence[str], null_text: str | None = "none"
) -> DataFrame:
    """Lower-cased text columns, nulls as null_text."""
    return _replaced(df, {c: lowered(named(c), null_text) for c in columns if c in df.columns})


def fill_text(df: DataFrame, columns: Sequence[str], value: str = "") -> DataFrame:
    """Null text to a value."""
    return _replaced(df, {c: F.coalesce(named(c), F.lit(value)) for c in columns})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns to finite doubles; texts that are no number, NaN and infinities become null."""
    changes = {
        c: finite_number(named(c), df.schema[c].dataType) for c in columns if c in df.columns
    }
    return _replaced(df, changes)


def coerce_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Columns to int labels, nulls and non-numbers to 0."""
    changes = {c: label_flag(named(c), df.schema[c].dataType) for c in labels if c in df.columns}
    return _replaced(df, changes)


def resolve_label_columns(df: DataFrame, labels: Sequence[str]) -> dict[str, str]:
    """Label -> its column: the label itself, else tag_<label with underscores>."""
    found = {}
    for label in labels:
        for candidate in (label, "tag_" + label.replace(" ", "_")):
            if candidate in df.columns:
                found[label] = candidate
                break
    return found


def complete_predictions(
    df: DataFrame, labels: Sequence[str], keep: Sequence[str] = (), prefix: str = "pred_"
) -> DataFrame:
    """Kept columns and one prediction per label in order; absent or null predictions are 0."""
    predictions = [
        (F.coalesce(named(prefix + label).cast("int"), F.lit(0)) if prefix + label in df.columns else F.lit(0)).alias(
            prefix + label
        )
        for label in labels
    ]
    return df.select(*[named(c) for c in keep], *predictions)


def shape_result(
    df: DataFrame,
    labels: Sequence[str],
    id_column: str = "problem_id",
    prefix: str = "pred_",
    extra: Sequence[str] = (),
    keep: str = "id_truth",
) -> DataFrame:
    """The columns of a prediction table.

    keep="id_truth" gives id and truth columns where present, predictions and extras;
    keep="all" gives every input column.
    """
    if keep == "all":
        return df
    if keep != "id_truth":
        raise ValueError(f"keep must be 'id_truth' or 'all', not {keep!r}")
    leading = [c for c in (id_column, *labels) if c in df.columns]
    predictions = [prefix + label for label in labels]
    require_columns(df, [*predictions, *extra])
    return df.select(*[named(c) for c in (*leading, *predictions, *extra)])
