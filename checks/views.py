"""The test tables seen as labelled tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.config import LABELS, LabelConfig

FLAGS = ["quality", "toxic", "english", "long text"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- documents with truth labels and rule-made predictions ------------------------

SCORED_SQL = """
scored AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
         coalesce(l.quality, 0) AS quality,
         coalesce(l.toxic, 0) AS toxic,
         CAST(d.lang = 'en' AS INTEGER) AS english,
         CAST(d.n_chars > 4000 AS INTEGER) AS "long text",
         CAST(d.n_chars % 3 <> 0 AS INTEGER) AS pred_quality,
         CAST(d.doc_id % 7 = 0 AS INTEGER) AS pred_toxic,
         CAST(d.n_chars % 5 <> 1 AS INTEGER) AS pred_english,
         CAST(d.n_chars > 3000 AS INTEGER) AS "pred_long text"
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their four labels; labels that are not there are null."""
    documents = table(spark, sf_dir, "documents")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        *documents.columns,
        "quality",
        "toxic",
        (F.col("lang") == "en").cast("int").alias("english"),
        (F.col("n_chars") > 4000).cast("int").alias("long text"),
    )


def predicted(rows: DataFrame) -> DataFrame:
    """Adds predictions made by rules."""
    return rows.select(
        "*",
        (F.col("n_chars") % 3 != 0).cast("int").alias("pred_quality"),
        (F.col("doc_id") % 7 == 0).cast("int").alias("pred_toxic"),
        (F.col("n_chars") % 5 != 1).cast("int").alias("pred_english"),
        (F.col("n_chars") > 3000).cast("int").alias("pred_long text"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth with nulls as 0, and predictions."""
    return predicted(truth(spark, sf_dir).fillna(0, ["quality", "toxic"]))


# ---- documents as raw records ------------------------------------------------------

TAG_STEPS = {**dict(zip(LABELS, (2, 3, 5, 7, 11, 13, 17, 19), strict=True)), "greedy": 4}

_TAG_CASES = ", ".join(f"CASE WHEN n_chars % {step} = 0 THEN '{tag}' END" for tag, step in TAG_STEPS.items())

RAW_SQL = f"""
raw AS (
  SELECT CASE WHEN n_chars % 9 = 0 THEN 'unlimited' WHEN n_chars % 10 = 0 THEN NULL
              ELSE CAST(n_chars % 5 + 1 AS VARCHAR)
                   || CASE WHEN n_chars % 2 = 0 THEN '.5 seconds' ELSE ' s' END
         END AS prob_desc_time_limit,
         '["' || lang || '"]' AS prob_desc_sample_outputs,
         'uid' || CAST(doc_id AS VARCHAR) AS src_uid,
         CASE WHEN n_chars % 2 = 1 THEN 'Note ' || lang END AS prob_desc_notes,
         text AS prob_desc_description,
         upper(lang) AS prob_desc_output_spec,
         'Read ' || CAST(n_chars AS VARCHAR) AS prob_desc_input_spec,
         lang AS lang,
         CASE WHEN n_chars % 50 = 0 THEN NULL ELSE 800 + (n_chars % 28) * 100 END AS difficulty,
         CAST(64 * (n_chars % 4 + 1) AS VARCHAR) || ' megabytes' AS prob_desc_memory_limit,
         '[' || CAST(n_chars AS VARCHAR) || ']' AS prob_desc_sample_inputs,
         'PASSED' AS exec_outcome,
         'print(' || CAST(n_chars AS VARCHAR) || ')' AS source_code,
         CAST(1269100800 + (n_chars * 37 % 400) * 86400 AS VARCHAR) AS prob_desc_created_at,
         list_filter([{_TAG_CASES}], lambda x: x IS NOT NULL) AS tags
  FROM documents
)"""


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a raw record; all but src_uid follow from text, lang and length."""
    n = F.col("n_chars")
    tags = [F.when(n % step == 0, F.lit(tag)) for tag, step in TAG_STEPS.items()]
    seconds = F.when(n % 2 == 0, ".5 seconds").otherwise(" s")
    limit = (
        F.when(n % 9 == 0, F.lit("unlimited"))
        .when(n % 10 == 0, F.lit(None))
        .otherwise(F.concat((n % 5 + 1).cast("string"), seconds))
    )
    return table(spark, sf_dir, "documents").select(
        limit.alias("prob_desc_time_limit"),
        F.concat(F.lit('["'), "lang", F.lit('"]')).alias("prob_desc_sample_outputs"),
        F.concat(F.lit("uid"), F.col("doc_id").cast("string")).alias("src_uid"),
        F.when(n % 2 == 1, F.concat(F.lit("Note "), "lang")).alias("prob_desc_notes"),
        F.col("text").alias("prob_desc_description"),
        F.upper("lang").alias("prob_desc_output_spec"),
        F.concat(F.lit("Read "), n.cast("string")).alias("prob_desc_input_spec"),
        "lang",
        F.when(n % 50 != 0, 800 + (n % 28) * 100).alias("difficulty"),
        F.concat((64 * (n % 4 + 1)).cast("string"), F.lit(" megabytes")).alias("prob_desc_memory_limit"),
        F.concat(F.lit("["), n.cast("string"), F.lit("]")).alias("prob_desc_sample_inputs"),
        F.lit("PASSED").alias("exec_outcome"),
        F.concat(F.lit("print("), n.cast("string"), F.lit(")")).alias("source_code"),
        (1269100800 + (n * 37 % 400) * 86400).cast("string").alias("prob_desc_created_at"),
        F.array_compact(F.array(*tags)).alias("tags"),
    )


# ---- settings of the labelled documents --------------------------------------------

DOCUMENTS = LabelConfig(
    renames={},
    kept=("text", "lang", "source", "n_chars"),
    labels=tuple(FLAGS),
    lowercased=("text",),
    parsed_limits=(),
    text_features=("text",),
    code_features=(),
    numeric_features=("n_chars",),
    profiled_text=("text", "lang", "source"),
    id_column="doc_id",
)
