"""Projections, filters, joins and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.views import DOCUMENTS, FLAGS, SCORED_SQL, predicted, scored, table, truth
from labelloom.functions.values import named
from labelloom.operators import columns as ops
from labelloom.operators import joins
from labelloom.operators.sampling import chronological_split

COLOURS = ["red", "small", "ring", "plate", "no such word"]


@query(
    "rename_columns",
    "SELECT p_partkey AS part_id, p_name AS title, p_brand, p_type, p_size, p_retailprice AS price FROM part",
)
def rename_columns(spark, sf):
    names = {"p_partkey": "part_id", "p_name": "title", "p_retailprice": "price", "absent": "x"}
    return ops.rename_columns(table(spark, sf, "part"), names)


@query("select_available", "SELECT doc_id, lang, n_chars FROM documents")
def select_available(spark, sf):
    return ops.select_available(table(spark, sf, "documents"), ["doc_id", "lang", "tags", "n_chars"])


@query("add_missing_features", "SELECT c_custkey, c_acctbal, CAST(NULL AS DOUBLE) AS rating FROM customer")
def add_missing_features(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return ops.add_missing_features(rows, ["c_acctbal", "rating"], critical=["c_custkey"])


@query(
    "filter_min_labels",
    f'WITH {SCORED_SQL} SELECT doc_id, quality, toxic, english, "long text" FROM scored '
    'WHERE quality + toxic + english + "long text" >= 2',
)
def filter_min_labels(spark, sf):
    return ops.filter_min_labels(scored(spark, sf), FLAGS, 2).select("doc_id", *FLAGS)


@query(
    "multi_hot",
    "SELECT p_partkey, "
    + ", ".join(
        f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS INTEGER) AS \"{w}\"" for w in COLOURS
    )
    + " FROM part",
)
def multi_hot(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("tags"))
    return ops.add_label_columns(parts, "tags", COLOURS).drop("tags")


NUMBER_TEXTS = """
texts AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN 'none'
              WHEN p_partkey % 7 = 2 THEN '1.5.' || CAST(p_size AS VARCHAR)
              ELSE 'about ' || CAST(p_size AS VARCHAR) || '.5 units of 2' END AS size_text,
         p_brand AS brand_text
  FROM part)"""


def _number_texts(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = (
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 7 == 1, "none")
        .when(key % 7 == 2, F.concat(F.lit("1.5."), size))
        .otherwise(F.concat(F.lit("about "), size, F.lit(".5 units of 2")))
    )
    return table(spark, sf, "part").select(
        "p_partkey", text.alias("size_text"), F.col("p_brand").alias("brand_text")
    )


@query(
    "parse_leading_number",
    f"""WITH {NUMBER_TEXTS}
    SELECT p_partkey, TRY_CAST(regexp_extract(size_text, '([0-9.]+)', 1) AS DOUBLE) AS size_text,
           TRY_CAST(regexp_extract(brand_text, '([0-9.]+)', 1) AS DOUBLE) AS brand_text
    FROM texts""",
)
def parse_leading_number(spark, sf):
    return ops.parse_leading_number(_number_texts(spark, sf), ["size_text", "brand_text"])


@query(
    "list_to_string",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'None' WHEN p_partkey % 5 = 1 THEN '[]'
       ELSE '[''' || array_to_string(string_split(p_name, ' '), ''', ''') || ''', "it''s"]' END AS tags
       FROM part""",
)
def list_to_string(spark, sf):
    key = F.col("p_partkey")
    words = F.concat(F.split("p_name", " "), F.array(F.lit("it's")))
    tags = F.when(key % 5 == 1, F.array().cast("array<string>")).when(key % 5 > 1, words)
    return ops.list_to_string(table(spark, sf, "part").select("p_partkey", tags.alias("tags")), ["tags"])


@query(
    "lowercase_text",
    """SELECT conv_id, turn, lower(text) AS text,
       lower(CASE WHEN turn % 3 = 0 THEN 'none' ELSE role END) AS role FROM conversations""",
)
def lowercase_text(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("role", F.when(F.col("turn") % 3 != 0, F.col("role")))
    return ops.lowercase_text(rows, ["text", "role"])


@query("fill_text", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS text FROM documents")
def fill_text(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("text")
    )
    return ops.fill_text(rows, ["text"])


@query(
    "coerce_numeric",
    """SELECT event_id,
       CASE WHEN event_id % 6 IN (0, 1, 2, 3) THEN NULL WHEN event_id % 6 = 4 THEN value
            ELSE CAST(event_id AS DOUBLE) / 4 END AS number,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value
       FROM events""",
)
def coerce_numeric(spark, sf):
    key = F.col("event_id")
    text = (
        F.when(key % 6 == 0, "x")
        .when(key % 6 == 1, "inf")
        .when(key % 6 == 2, "NaN")
        .when(key % 6 == 4, F.col("value").cast("string"))
        .when(key % 6 == 5, (key / 4).cast("string"))
    )
    value = (
        F.when(key % 8 == 0, F.lit(float("inf"))).when(key % 8 == 4, F.lit(float("nan"))).otherwise(F.col("value"))
    )
    rows = table(spark, sf, "events").select("event_id", text.alias("number"), value.alias("value"))
    return ops.coerce_numeric(rows, ["number", "value"])


@query(
    "coerce_labels",
    """SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic,
       CASE WHEN d.doc_id % 3 = 0 THEN 1 ELSE 0 END AS english
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def coerce_labels(spark, sf):
    text = F.when(F.col("doc_id") % 3 == 0, "1.0").when(F.col("doc_id") % 3 == 1, "yes")
    rows = truth(spark, sf).select("doc_id", "quality", "toxic", text.alias("english"))
    return ops.coerce_labels(rows, FLAGS)


@query(
    "complete_predictions",
    f"""WITH {SCORED_SQL}
    SELECT doc_id, pred_quality, 0 AS pred_toxic, pred_english, 0 AS "pred_long text" FROM scored""",
)
def complete_predictions(spark, sf):
    rows = scored(spark, sf).select("doc_id", "pred_english", "pred_quality")
    return ops.complete_predictions(rows, FLAGS, keep=["doc_id"])


@query(
    "shape_result",
    f"""WITH {SCORED_SQL}
    SELECT doc_id, quality, toxic, english, "long text", pred_quality, pred_toxic, pred_english,
           "pred_long text", lang AS raw_model_output FROM scored""",
)
def shape_result(spark, sf):
    rows = scored(spark, sf).withColumnRenamed("lang", "raw_model_output")
    return ops.shape_result(rows, FLAGS, "doc_id", extra=["raw_model_output"])


# ---- joins and unions --------------------------------------------------------------


@query(
    "attach_predictions",
    f"""WITH {SCORED_SQL}
    SELECT doc_id, lang, source, pred_quality, pred_toxic, pred_english, "pred_long text" FROM scored""",
)
def attach_predictions(spark, sf):
    documents = table(spark, sf, "documents")
    predictions = predicted(documents).select("doc_id", *DOCUMENTS.prediction_columns)
    return joins.attach_predictions(documents.select("doc_id", "lang", "source"), predictions, "doc_id")


@query(
    "attach_scores_left",
    """SELECT d.doc_id, d.lang, CAST(l.toxic AS INTEGER) AS pred_toxic,
       CASE WHEN d.doc_id % 2 = 0 THEN d.n_chars / 1000.0 END AS prob_toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def attach_scores_left(spark, sf):
    documents = table(spark, sf, "documents")
    predictions = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("pred_toxic"))
    scores = documents.filter(F.col("doc_id") % 2 == 0).select(
        "doc_id", (F.col("n_chars") / 1000.0).alias("prob_toxic")
    )
    return joins.attach_scores_left(documents.select("doc_id", "lang"), predictions, scores, "doc_id")


@query(
    "union_records",
    """SELECT doc_id, lang, n_chars, CAST(NULL AS INTEGER) AS quality, CAST(NULL AS INTEGER) AS toxic FROM documents
       UNION ALL SELECT doc_id, NULL, NULL, quality, toxic FROM labels""",
)
def union_records(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return joins.union_records([documents, table(spark, sf, "labels")])


@query("split_union", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def split_union(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    split = chronological_split(orders, ["o_orderdate", "o_orderkey"])
    train, test = (split.filter(named("split") == part).drop("split") for part in ("train", "test"))
    return joins.split_union(train, test)
