"""From documents to packed training sequences: the stages, and run() over all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import lines, near_duplicates, packing, quality, substrings
from labelloom.llm.columns import quoted
from labelloom.llm.queries import TOKENIZER
from labelloom.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# Columns the operators read. All others go through them under names that no result has.
READ = ("doc_id", "text", "source")


def _given(docs: DataFrame) -> DataFrame:
    """The documents with every column that no operator reads under a reserved name."""
    return docs.select(*[docs[quoted(c)].alias(c if c in READ else f"__given{i}") for i, c in enumerate(docs.columns)])


def _as_documents(docs: DataFrame, changed: DataFrame, text_changed: bool = False) -> DataFrame:
    """The columns of the documents, with n_chars brought up to date where texts were cut."""
    columns = {c: F.col(c if c in READ else f"__given{i}").alias(c) for i, c in enumerate(docs.columns)}
    if text_changed and "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.length(F.col("text")).cast(kind).alias("n_chars")
    return changed.select(*columns.values())


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, and whose host does."""
    return _as_documents(docs, quality.judge(_given(docs)).filter("kept"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are near copies of earlier ones."""
    return _as_documents(docs, lines.remove_near_lines(_given(docs)), text_changed=True)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return _as_documents(docs, near_duplicates.components(_given(docs)).filter("kept"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 35 words or more that occur elsewhere too."""
    return _as_documents(docs, substrings.remove_repeats(_given(docs)), text_changed=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER).drop("piece_ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near dedup", keep_one_of_each),
    ("substring dedup", cut_repeats),
    ("packing", pack_sequences),
]

# Tokens cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
