"""The profile of a clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labelloom.config import DEFAULT, LabelConfig
from labelloom.operators.columns import coerce_labels, coerce_numeric, select_available
from labelloom.operators.profile import profile_report


def profile_table(clean: DataFrame, config: LabelConfig = DEFAULT) -> DataFrame:
    """The long profile of the configured columns, from one scan."""
    wanted = list(dict.fromkeys([*config.kept, *config.labels, *config.numeric_features]))
    rows = select_available(clean, wanted)
    labels = [c for c in config.labels if c in rows.columns]
    rows = coerce_numeric(coerce_labels(rows, labels), config.numeric_features)
    return profile_report(rows, labels, config.numeric_features, config.profiled_text)
