"""Rows for a token classifier: fixed-length ids, mask and label vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.config import DEFAULT, LabelConfig
from labelloom.functions.prompts import input_text
from labelloom.functions.values import named
from labelloom.operators.answers import labels_from_output
from labelloom.operators.columns import require_columns
from labelloom.operators.sampling import sample_n, validation_split
from labelloom.operators.vocabulary import encode_fixed_length, fit_vocabulary, tokenize, word_ids


def with_words(
    rows: DataFrame, config: LabelConfig = DEFAULT, columns: Sequence[str] | None = None
) -> DataFrame:
    """Adds input_text and its words (no stop-word list)."""
    texts = rows.withColumn("input_text", input_text(config.instruction_columns if columns is None else columns))
    return tokenize(texts, "input_text", "words", stop_words=())


def fit_word_ids(rows: DataFrame, config: LabelConfig = DEFAULT) -> dict[str, int]:
    """Ids of the max_features most frequent words of the input texts."""
    words = with_words(rows, config)
    return word_ids(fit_vocabulary(words, "words", config.max_features, min_df=1, max_df=1.0))


def classification_dataset(
    rows: DataFrame,
    ids: dict[str, int],
    config: LabelConfig = DEFAULT,
    max_length: int = 512,
    validation_percent: float = 10.0,
    subset_size: int = -1,
) -> DataFrame:
    """Id, input_ids, attention_mask, labels and split, from texts and the output column."""
    require_columns(rows, [*config.instruction_columns, "output"])
    rows = sample_n(rows, subset_size, config.id_column, config.seed)
    split = validation_split(rows, validation_percent, config.id_column, config.seed)
    labelled = labels_from_output(with_words(split, config), "output", config.labels)
    encoded = encode_fixed_length(labelled, "words", ids, max_length)
    return encoded.select(
        named(config.id_column), "input_ids", "attention_mask", F.col("labels"), "split"
    )
