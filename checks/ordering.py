"""Order, splits, samples and class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.views import FLAGS, SCORED_SQL, scored, table
from labelloom.functions.values import named
from labelloom.operators import joins, ranking, sampling
from labelloom.operators.columns import filter_min_labels


@query("drop_duplicates", "SELECT DISTINCT text, lang, n_chars FROM documents")
def drop_duplicates(spark, sf):
    return joins.drop_duplicates(table(spark, sf, "documents").select("text", "lang", "n_chars"))


@query(
    "creation_order",
    """SELECT o_orderkey, o_custkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey) AS creation_order FROM orders""",
)
def creation_order(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ranking.creation_order(rows, "o_orderdate", ["o_orderkey"])


@query(
    "dense_row_id",
    f"""WITH {SCORED_SQL}
    SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS problem_id
    FROM scored WHERE quality + toxic + english + "long text" >= 1""",
)
def dense_row_id(spark, sf):
    kept = filter_min_labels(scored(spark, sf), FLAGS, 1).select("doc_id", "n_chars")
    return ranking.dense_row_id(kept, ["n_chars", "doc_id"])


@query(
    "chronological_split",
    """SELECT o_orderkey, o_orderdate, CASE WHEN rank <= floor(n * 0.75) THEN 'train' ELSE 'test' END AS split
       FROM (SELECT o_orderkey, o_orderdate, count(*) OVER () AS n,
                    row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rank FROM orders)""",
)
def chronological_split(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return sampling.chronological_split(rows, ["o_orderdate", "o_orderkey"], 0.25)


@query(
    "sample_n",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)) LIMIT 1000""",
)
def sample_n(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_n(rows, 1000, "o_orderkey")


@query("head_n", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500")
def head_n(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return sampling.head_n(rows, 500, ["o_orderdate", "o_orderkey"])


@query(
    "validation_split",
    """SELECT doc_id, CASE WHEN rank <= ceil(n * 0.1) THEN 'validation' ELSE 'train' END AS split
       FROM (SELECT doc_id, count(*) OVER () AS n,
                    row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR))) AS rank
             FROM documents)""",
)
def validation_split(spark, sf):
    return sampling.validation_split(table(spark, sf, "documents").select("doc_id"), 10, "doc_id")


_LONG_FLAGS = " UNION ALL ".join(
    f"SELECT doc_id, '{flag}' AS label, \"{flag}\" AS class_value FROM scored" for flag in FLAGS
)


@query(
    "undersample_majority",
    f"""WITH {SCORED_SQL}, long AS ({_LONG_FLAGS}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY label, class_value
                                   ORDER BY md5('42:' || CAST(doc_id AS VARCHAR))) AS rank,
             sum(class_value) OVER (PARTITION BY label) AS ones,
             count(*) OVER (PARTITION BY label) AS n
      FROM long)
    SELECT label, doc_id, class_value FROM ranked WHERE rank <= least(ones, n - ones)""",
)
def undersample_majority(spark, sf):
    rows = scored(spark, sf).select("doc_id", *FLAGS)
    kept = sampling.undersample_majority(rows, FLAGS, "doc_id")
    cells = [
        F.struct(F.lit(flag).alias("label"), named(flag).alias("class_value"), named(f"keep_{flag}").alias("keep"))
        for flag in FLAGS
    ]
    return kept.select("doc_id", F.inline(F.array(*cells))).filter("keep").drop("keep")


@query(
    "skip_single_class",
    f"""WITH {SCORED_SQL}, long AS ({_LONG_FLAGS}
      UNION ALL SELECT doc_id, 'always', 1 FROM scored)
    SELECT label FROM long GROUP BY label HAVING min(class_value) < max(class_value)""",
)
def skip_single_class(spark, sf):
    rows = scored(spark, sf).withColumn("always", F.lit(1))
    trainable = sampling.skip_single_class(rows, [*FLAGS, "always", "absent"])
    return spark.createDataFrame([(label,) for label in trainable], "label string")
