"""Word tokens and n-grams as Spark SQL text.

SQL text serves both DataFrame operators (through F.expr) and saved feature pipelines
(through SQLTransformer), so both always agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

# ---- Fixed values: a word is two or more letters, digits or underscores ----------
WORD = r"[\p{L}\p{N}_]{2,}"


@lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """The English list that ships with Spark."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tokens_sql(column: str, stop_words: Sequence[str] = ()) -> str:
    """Lower-cased words of a text column in order, stop words removed."""
    words = f"regexp_extract_all(lower(coalesce({quoted(column)}, '')), r'{WORD}', 0)"
    # A word list no token can equal needs no entry: tokens hold word characters only.
    listed = [w.lower() for w in stop_words if len(w) > 1 and "'" not in w]
    if not listed:
        return words
    return f"filter({words}, w -> w NOT IN ({', '.join(sql_text(w) for w in listed)}))"


def ngrams_sql(words: str) -> str:
    """Words followed by their pairs of neighbours, given an array column's name."""
    array = quoted(words)
    following = f"slice({array}, 2, greatest(size({array}) - 1, 0))"
    pairs = f"zip_with({array}, {following}, (a, b) -> a || ' ' || b)"
    return f"concat({array}, slice({pairs}, 1, greatest(size({array}) - 1, 0)))"
