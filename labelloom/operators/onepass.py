"""Several statistics of one table from a single scan.

A statistic names the values it reads, the aggregates it needs and the result rows it
makes of them. Any number of statistics share one projection and one aggregation; the
rows are then made of its one result. Aggregates and rows are SQL text, since a report
has hundreds and each Column operation is several calls into the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


@dataclass
class Statistic:
    """Values and aggregates by name, and the rows made of them as column -> SQL."""

    values: dict[str, Column] = field(default_factory=dict)
    aggregates: dict[str, str] = field(default_factory=dict)
    rows: list[dict[str, str]] = field(default_factory=list)
    # Rows whose condition is not true are left out.
    shown: list[str] = field(default_factory=list)
    # Columns of the result, for a statistic that may have no rows.
    columns: str = ""

    def value(self, name: str, column: Column) -> str:
        """A value computed once per row, however many aggregates read it."""
        self.values[name] = column
        return name

    def add(self, shown: str = "true", **row: str) -> None:
        self.rows.append(row)
        self.shown.append(shown)


def totals(df: DataFrame, statistics: Sequence[Statistic]) -> DataFrame:
    """One row with the aggregates of all statistics, equal names computed once."""
    values: dict[str, Column] = {}
    wanted: dict[str, str] = {}
    for statistic in statistics:
        values.update(statistic.values)
        wanted.update(statistic.aggregates)
    if not wanted:
        return df.limit(0).select()
    read = df.select(*[column.alias(name) for name, column in values.items()])
    return read.selectExpr(*[f"{sql} AS {name}" for name, sql in wanted.items()])


def spread(row: DataFrame, statistic: Statistic) -> DataFrame:
    """The result rows of a statistic from the one row of totals."""
    if not statistic.rows and statistic.columns:
        return row.sparkSession.createDataFrame([], statistic.columns)
    structs = []
    for made, shown in zip(statistic.rows, statistic.shown, strict=True):
        cells = ", ".join(f"{sql} AS `{name}`" for name, sql in made.items())
        structs.append(f"struct({shown} AS __shown, {cells})")
    exploded = row.selectExpr(f"inline(array({', '.join(structs)}))")
    return exploded.filter("__shown").drop("__shown")


def one_pass(df: DataFrame, statistic: Statistic) -> DataFrame:
    return spread(totals(df, [statistic]), statistic)
