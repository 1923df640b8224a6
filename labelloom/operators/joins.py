"""Putting predictions beside their rows, and unions of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.values import named


def check_one_to_one(left: DataFrame, right: DataFrame, id_column: str) -> None:
    """Raises unless every id stands exactly once on both sides.

    Reads the id columns only and adds the two sides up before the shuffle, so even an
    id repeated in a third of all rows is one row per task there.
    """

    def side(df: DataFrame, is_left: int) -> DataFrame:
        flags = [F.lit(is_left).alias("l"), F.lit(1 - is_left).alias("r")]
        return df.select(named(id_column).alias("id"), *flags)

    counted = side(left, 1).unionByName(side(right, 0)).groupBy("id")
    sums = counted.agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    bad = sums.filter((F.col("l") != 1) | (F.col("r") != 1) | F.col("id").isNull()).take(5)
    if bad:
        shown = [(r["id"], r["l"], r["r"]) for r in bad]
        raise ValueError(f"ids do not match one to one (id, rows left, rows right): {shown}")


def attach_predictions(
    rows: DataFrame, predictions: DataFrame, id_column: str, check: bool = True
) -> DataFrame:
    """Rows with their predictions, one to one on the id.

    The check is part of the join, so each side is shuffled and sorted once: ids are numbered
    where they meet, and a full join shows those of one side only. A query over the result fails
    with the first id that is null, repeated, or on one side only.
    """
    if not check:
        return rows.join(predictions, id_column, "inner")
    order = Window.partitionBy(named(id_column)).orderBy(named(id_column))
    left, right = (df.withColumn(c, F.row_number().over(order)) for df, c in ((rows, "__left"), (predictions, "__right")))
    met = F.coalesce((F.col("__left") == 1) & (F.col("__right") == 1), F.lit(False))
    told = F.concat(F.lit("ids do not match one to one: "), F.coalesce(named(id_column).cast("string"), F.lit("null")))
    checked = left.join(right, id_column, "full").filter(F.when(met, F.lit(True)).otherwise(F.raise_error(told).cast("boolean")))
    return checked.drop("__left", "__right")


def attach_scores_left(
    rows: DataFrame, predictions: DataFrame, scores: DataFrame, id_column: str
) -> DataFrame:
    """All rows, with predictions and scores where there are any."""
    return rows.join(predictions, id_column, "left").join(scores, id_column, "left")


def union_records(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables under the union of their columns; missing values are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def split_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """The full set again from its two parts."""
    return train.unionByName(test)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row of each set of rows equal in every column; nulls are equal to each other."""
    return df.dropDuplicates()
