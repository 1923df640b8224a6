"""Raw records to the clean table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.config import DEFAULT, LabelConfig
from labelloom.functions.prompts import build_prompt, gold_output
from labelloom.functions.values import named
from labelloom.operators.columns import (
    add_label_columns,
    filter_min_labels,
    list_to_string,
    lowercase_text,
    parse_leading_number,
    rename_columns,
    select_available,
)
from labelloom.operators.joins import drop_duplicates
from labelloom.operators.profile import label_distribution, missing_counts, parsed_counts
from labelloom.operators.ranking import creation_order, dense_row_id
from labelloom.session import staging
from labelloom.sources.records import quarantine_corrupt, scan_json_records
from labelloom.sources.tables import write_snapshot


def normalized_records(raw: DataFrame, config: LabelConfig = DEFAULT) -> DataFrame:
    """Renamed, pruned, parsed and lower-cased rows: one projection, no shuffle."""
    wanted = [*config.kept, config.time_column, config.tags_column]
    rows = select_available(rename_columns(raw, config.renames), wanted)
    rows = parse_leading_number(rows, config.parsed_limits)
    return lowercase_text(rows, config.lowercased, config.null_text)


def clean_table(raw: DataFrame, config: LabelConfig = DEFAULT) -> DataFrame:
    """The clean table: distinct rows in creation order with labels, prompt and output.

    Two shuffles: one removes duplicates, one sorts. Columns that follow from others
    (labels, the tags' text, prompt, output) are made after both, so they are never moved.
    """
    rows = normalized_records(raw, config)
    ordered = creation_order(drop_duplicates(rows), config.time_column, name=config.order_column)
    labelled = add_label_columns(ordered, config.tags_column, config.labels)
    lists = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType)]
    labelled = list_to_string(labelled, lists)
    order = config.order_column
    if config.min_labels > 0:
        kept = filter_min_labels(labelled, config.labels, config.min_labels)
        numbered = dense_row_id(kept, [order], config.id_column)
    else:
        numbered = labelled.withColumn(config.id_column, F.col(order) - 1)
    columns = [config.id_column, *rows.columns, *config.labels, order]
    present = [c for c in config.instruction_columns if c in rows.columns]
    return numbered.select(
        *[named(c) for c in columns],
        build_prompt(present, config.labels).alias("prompt"),
        gold_output({label: named(label) for label in config.labels}).alias("output"),
    )


class Cleaned(NamedTuple):
    """A written clean table and what its job has to tell."""

    path: str
    missing: DataFrame
    labels: DataFrame
    parsed: DataFrame
    bad_records: DataFrame


def clean_directory(
    spark: SparkSession, directory: str, output: str, prefix: str, config: LabelConfig = DEFAULT
) -> Cleaned:
    """Reads a directory of records, writes the clean table as a snapshot.

    Returns its path, the nulls per column, the label distribution, how many of the raw limits
    held a number, and the records that could not be read.
    """
    raw = scan_json_records(spark, directory)
    with staging(spark):
        path = write_snapshot(clean_table(raw, config), output, prefix)
    clean = spark.read.parquet(path)
    renamed = rename_columns(raw, config.renames)
    limits = [c for c in config.parsed_limits if c in renamed.columns]
    return Cleaned(
        path,
        missing_counts(clean),
        label_distribution(clean, config.labels),
        parsed_counts(renamed, limits),
        quarantine_corrupt(spark, directory),
    )
