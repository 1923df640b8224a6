"""Generated answers back to labels, in native expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.tokens import sql_text
from labelloom.functions.values import named

# ---- Fixed values: where an answer stands in a text ------------------------------
TAGGED = r"(?isU)<output>\s*(\{.*?\})\s*</output>"
FIRST_OBJECT = r"(?s)\{.*?\}"

# A string of a JSON text. Possessive, so a long string needs no deep stack in Java.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'

_TAGGED_TEXT, _JSON, _VARIANT, _MAP = "__tagged", "__json", "__variant", "__pairs"


def _key_path(label: str) -> str:
    return '$["' + label.replace("\\", "\\\\").replace('"', '\\"') + '"]'


def _one_object(json: Column) -> Column:
    """True when the text is a single object: braces outside strings close just once."""
    braces = F.regexp_extract_all(F.regexp_replace(json, _STRING, ""), F.lit("[{}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed"))

    def step(state: Column, brace: Column) -> Column:
        depth = state["depth"] + F.when(brace == "{", 1).otherwise(-1)
        closed = state["closed"] + F.when(depth == 0, 1).otherwise(0)
        return F.struct(depth.alias("depth"), closed.alias("closed"))

    return F.aggregate(braces, start, step, lambda s: (s["depth"] == 0) & (s["closed"] == 1))


def _value(label: str, kind: str) -> str:
    """SQL for a label's number: 0 when the key is absent, -1 when it is not a number."""
    path = sql_text(_key_path(label))
    # Text the variant parser rejects for a repeated key: the last entry counts.
    entries = f"filter(map_entries({_MAP}), e -> e.key = {sql_text(label)})"
    return f"""CAST(CASE
      WHEN {_VARIANT} IS NOT NULL THEN CASE
        WHEN variant_get({_VARIANT}, {path}, 'variant') IS NULL THEN 0
        ELSE coalesce(try_variant_get({_VARIANT}, {path}, '{kind}'), -1) END
      WHEN {_MAP} IS NULL THEN -1
      WHEN size({entries}) = 0 THEN 0
      ELSE coalesce(try_variant_get(element_at({entries}, -1).value, '$', '{kind}'), -1) END AS {kind})"""


def _with_json(df: DataFrame, text: str, fallback: bool) -> DataFrame:
    """Adds the answer's JSON text and its parsed forms, each computed once."""
    body = named(text).cast("string")
    df = df.withColumn(_TAGGED_TEXT, F.regexp_extract(body, TAGGED, 1))
    found = F.when(F.col(_TAGGED_TEXT) != "", F.col(_TAGGED_TEXT))
    if fallback:
        found = F.coalesce(found, F.regexp_extract(body, FIRST_OBJECT, 0))
    df = df.withColumn(_JSON, found)
    df = df.withColumn(
        _VARIANT, F.when(F.col(_JSON) != "", F.try_parse_json(F.col(_JSON)))
    )
    pairs = F.from_json(F.col(_JSON), "map<string,variant>", {"allowSingleQuotes": "false"})
    return df.withColumn(_MAP, F.when(F.col(_VARIANT).isNull() & (F.col(_JSON) != ""), pairs))


def _parsed(df: DataFrame, text: str, labels: Sequence[str], kind: str, fallback: bool) -> DataFrame:
    df = _with_json(df, text, fallback)
    values = ", ".join(_value(label, kind) for label in labels)
    df = df.withColumn("__values", F.expr(f"array({values})"))
    valid = (
        (F.col(_JSON) != "")
        & _one_object(F.col(_JSON))
        & F.forall(F.col("__values"), lambda v: (v == 0) | (v == 1))
    )
    return df.withColumn("__valid", F.coalesce(valid, F.lit(False)))


def parse_model_output(
    df: DataFrame,
    text: str,
    labels: Sequence[str],
    prefix: str = "pred_",
    status: str | None = "parse_status",
) -> DataFrame:
    """Adds one 0/1 column per label read from a generated answer.

    The answer is the object between output tags, else the first object in the text.
    Any label that is not 0 or 1 makes the whole row zeros. The status column says
    which way was taken: tagged, fallback or error.
    """
    parsed = _parsed(df, text, labels, "int", fallback=True)
    columns = [named(c) for c in df.columns]
    for position, label in enumerate(labels):
        value = F.when(F.col("__valid"), F.col("__values")[position]).otherwise(F.lit(0))
        columns.append(value.alias(prefix + label))
    if status is not None:
        way = (
            F.when(~F.col("__valid"), "error")
            .when(F.col(_TAGGED_TEXT) != "", "tagged")
            .otherwise("fallback")
        )
        columns.append(way.alias(status))
    return parsed.select(*columns)


def parse_status(df: DataFrame, text: str, labels: Sequence[str]) -> DataFrame:
    """How many answers were read which way."""
    return (
        parse_model_output(df, text, labels).groupBy("parse_status").agg(F.count("*").alias("n_rows"))
    )


def labels_from_output(
    df: DataFrame, text: str, labels: Sequence[str], name: str = "labels"
) -> DataFrame:
    """Adds the label vector of a gold output; zeros when any value is not exactly 0 or 1."""
    parsed = _parsed(df, text, labels, "double", fallback=False)
    zeros = F.array(*[F.lit(0.0) for _ in labels])
    vector = F.when(F.col("__valid"), F.col("__values")).otherwise(zeros)
    return parsed.select(*[named(c) for c in df.columns], vector.alias(name))
