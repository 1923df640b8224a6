"""Splits, seeded samples and class balancing, exact and the same on any partitioning.

A seeded choice takes the rows with the smallest digest of seed and id. Its last digest
is found by counting rows per digest prefix, so the table itself is only filtered:
nothing is sorted, shuffled or collected but the counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.values import label_flag, named, sampling_key
from labelloom.operators.ranking import any_of, first_rows

# Hex digits added per counting pass: 4 096 counts at most for each open prefix.
_DIGITS = 3
_KEY_DIGITS = 32
_PAST_ANY_DIGIT = "g"
_KEY = "__key"


def _smallest_keys(
    keyed: DataFrame,
    members: dict[str, Column],
    wanted: Callable[[dict[str, int]], dict[str, int]],
) -> tuple[dict[str, Column], dict[str, int]]:
    """Per member set, a condition true for exactly the wanted number of smallest keys.

    keyed holds the key column and what the member flags (0/1) read; wanted maps the set
    sizes to the numbers of rows. Also returns the sizes.
    """
    names = list(members)
    sums = [F.sum(members[n]).alias(f"m{i}") for i, n in enumerate(names)]

    def counts(length: int, open_prefixes: list[str]) -> list[tuple[str, list[int]]]:
        rows = keyed
        if open_prefixes:
            within = F.substring(F.col(_KEY), 1, len(open_prefixes[0])).isin(open_prefixes)
            rows = rows.filter(within)
        found = rows.groupBy(F.substring(F.col(_KEY), 1, length).alias("p")).agg(*sums).collect()
        return sorted((r[0], [int(v or 0) for v in r[1:]]) for r in found)

    length = _DIGITS
    table = counts(length, [])
    sizes = {n: sum(v[i] for _, v in table) for i, n in enumerate(names)}
    goals = wanted(sizes)
    cuts: dict[str, Column] = {}
    # Set name -> prefix that holds its last wanted key, rows taken before that prefix.
    open_sets: dict[str, tuple[str, int]] = {}
    for name in names:
        if goals[name] <= 0:
            cuts[name] = F.lit(False)
        elif goals[name] >= sizes[name]:
            cuts[name] = F.lit(True)
        else:
            open_sets[name] = ("", 0)
    while open_sets:
        still_open: dict[str, tuple[str, int]] = {}
        for name, (prefix, taken) in open_sets.items():
            position = names.index(name)
            for bucket, values in table:
                if not bucket.startswith(prefix):
                    continue
                after = taken + values[position]
                if after == goals[name]:
                    cuts[name] = F.col(_KEY) < F.lit(bucket + _PAST_ANY_DIGIT)
                    break
                if after > goals[name]:
                    still_open[name] = (bucket, taken)
                    break
                taken = after
        open_sets = still_open
        if open_sets:
            if length >= _KEY_DIGITS:
                raise ValueError(f"rows share a sampling id: {sorted(open_sets)}")
            length = min(length + _DIGITS, _KEY_DIGITS)
            table = counts(length, sorted({prefix for prefix, _ in open_sets.values()}))
    return cuts, sizes


def sample_n(df: DataFrame, n: int, id_column: str, seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement; all rows when n is not positive or too large."""
    if n <= 0:
        return df
    key = sampling_key(named(id_column), seed)
    keyed = df.select(key.alias(_KEY))
    cuts, _ = _smallest_keys(keyed, {"all": F.lit(1)}, lambda _: {"all": n})
    return df.withColumn(_KEY, key).filter(cuts["all"]).drop(_KEY)


def head_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first n rows in table order, n < 0 for all."""
    if n < 0:
        return df
    within, _, _ = first_rows(df, order_by, lambda total: n)
    return df.filter(within)


def chronological_split(
    df: DataFrame, order_by: Sequence[str], test_size: float = 0.25, name: str = "split"
) -> DataFrame:
    """Adds 'train' for the first int(n * (1 - test_size)) rows in order, 'test' for the rest."""
    within, _, _ = first_rows(df, order_by, lambda total: int(total * (1 - test_size)))
    return df.withColumn(name, F.when(within, F.lit("train")).otherwise(F.lit("test")))


def validation_split(
    df: DataFrame,
    percent: float,
    id_column: str,
    seed: int = 42,
    name: str = "split",
    smallest: int = 11,
) -> DataFrame:
    """Adds 'validation' for a seeded ceil(n * percent / 100) rows, 'train' for the rest.

    No row is held out when percent is not positive or the table has fewer rows than
    ``smallest``.
    """
    key = sampling_key(named(id_column), seed)

    def wanted(sizes: dict[str, int]) -> dict[str, int]:
        total = sizes["all"]
        held = math.ceil(total * (percent / 100.0)) if percent > 0 and total >= smallest else 0
        return {"all": held}

    cuts, _ = _smallest_keys(df.select(key.alias(_KEY)), {"all": F.lit(1)}, wanted)
    split = F.when(cuts["all"], F.lit("validation")).otherwise(F.lit("train"))
    return df.withColumn(_KEY, key).withColumn(name, split).drop(_KEY)


def balance_conditions(
    df: DataFrame, labels: Sequence[str], id_column: str, seed: int = 42
) -> tuple[dict[str, Column], Column]:
    """Per label with both classes, which rows undersampling keeps; and the key they read.

    All rows of the smaller class stay, with as many seeded rows of the other. Labels
    with one class only are left out. The conditions read the column '__key'; add it
    with the returned expression.
    """
    key = sampling_key(named(id_column), seed)
    flags = [
        label_flag(named(label), df.schema[label].dataType).alias(f"y{i}")
        for i, label in enumerate(labels)
    ]
    keyed = df.select(key.alias(_KEY), *flags)
    members: dict[str, Column] = {}
    for i in range(len(labels)):
        members[f"{i}/1"] = (F.col(f"y{i}") == 1).cast("int")
        members[f"{i}/0"] = (F.col(f"y{i}") != 1).cast("int")

    def wanted(sizes: dict[str, int]) -> dict[str, int]:
        smaller = {i: min(sizes[f"{i}/0"], sizes[f"{i}/1"]) for i in range(len(labels))}
        return {name: smaller[int(name.split("/")[0])] for name in sizes}

    cuts, sizes = _smallest_keys(keyed, members, wanted)
    kept: dict[str, Column] = {}
    for i, label in enumerate(labels):
        if sizes[f"{i}/0"] and sizes[f"{i}/1"]:
            flag = label_flag(named(label), df.schema[label].dataType)
            kept[label] = F.when(flag == 1, cuts[f"{i}/1"]).otherwise(cuts[f"{i}/0"])
    return kept, key


def undersample_majority(
    df: DataFrame, labels: Sequence[str], id_column: str, seed: int = 42
) -> DataFrame:
    """Adds keep_<label>, true for the rows a balanced training of that label uses.

    Labels with one class only get no column. Rows no label keeps are dropped.
    """
    kept, key = balance_conditions(df, labels, id_column, seed)
    marked = df.withColumn(_KEY, key).select(
        "*", *[condition.alias(f"keep_{label}") for label, condition in kept.items()]
    )
    return marked.filter(any_of([named(f"keep_{label}") for label in kept])).drop(_KEY)


def skip_single_class(df: DataFrame, labels: Sequence[str]) -> list[str]:
    """The labels present in the table with both classes, from one aggregate."""
    present = [label for label in labels if label in df.columns]
    if not present:
        return []
    bounds = []
    for i, label in enumerate(present):
        flag = label_flag(named(label), df.schema[label].dataType)
        bounds += [F.min(flag).alias(f"lo{i}"), F.max(flag).alias(f"hi{i}")]
    row = df.agg(*bounds).first()
    return [
        label
        for i, label in enumerate(present)
        if row[f"lo{i}"] is not None and row[f"lo{i}"] < row[f"hi{i}"]
    ]
