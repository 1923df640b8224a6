"""labelloom: multi-label text tables on Spark, DataFrame in and DataFrame out."""

from labelloom.config import DEFAULT, LabelConfig

__all__ = ["DEFAULT", "LabelConfig"]
