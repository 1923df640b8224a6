"""Predictions of a token classifier: texts to ids, scores, probabilities and labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.config import DEFAULT, LabelConfig
from labelloom.functions.values import named
from labelloom.operators.columns import require_columns
from labelloom.operators.metrics import sigmoid_threshold
from labelloom.operators.scoring import Scorer, score_batches
from labelloom.operators.vocabulary import fixed_length_inputs
from labelloom.plans.classification import with_words

SCORES, WORDS = "__scores", "__words"


def classifier_predict(
    rows: DataFrame,
    ids: dict[str, int],
    factory: Callable[[], Scorer],
    config: LabelConfig = DEFAULT,
    max_length: int = 512,
    batch_size: int = 16,
) -> DataFrame:
    """All input columns with pred_* and prob_* of every label.

    The scorer gets dicts of input_ids and attention_mask and returns as many raw scores per
    row as there are labels. Text columns the table lacks are only warned of.
    """
    require_columns(rows, config.instruction_columns, warn_only=True)
    present = tuple(c for c in config.instruction_columns if c in rows.columns)
    worded = with_words(rows, config, present)
    # Ids are looked up by the worker that scores: another one would hold each batch once more, and
    # padded ids and masks of all its rows would be sent.
    cut = worded.select(*[named(c) for c in rows.columns], F.slice("words", 1, max_length).alias(WORDS))
    scored = score_batches(
        cut,
        WORDS,
        factory,
        rows.columns,
        batch_size,
        SCORES,
        T.ArrayType(T.DoubleType()),
        fixed_length_inputs(rows, ids, max_length),
    )
    labelled = sigmoid_threshold(
        scored, SCORES, config.labels, config.threshold, config.score_prefix, config.prediction_prefix
    )
    return labelled.select(*[named(c) for c in labelled.columns if c != SCORES])
