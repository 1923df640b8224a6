"""Evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.views import FLAGS, SCORED_SQL, scored, table
from labelloom.functions.values import named
from labelloom.operators import metrics

LONG = " UNION ALL ".join(
    f"SELECT '{f}' AS label, \"{f}\" AS t, \"pred_{f}\" AS p FROM scored" for f in FLAGS
)
COUNTS = f"""{SCORED_SQL}, long AS ({LONG}),
counts AS (SELECT label, sum(t * p) AS tp, sum(p) AS pp, sum(t) AS ap FROM long GROUP BY label)"""


def prf(tp: str = "tp", pp: str = "pp", ap: str = "ap") -> str:
    return (
        f"round(CASE WHEN {pp} = 0 THEN 0 ELSE CAST({tp} AS DOUBLE) / {pp} END, 6) AS precision, "
        f"round(CASE WHEN {ap} = 0 THEN 0 ELSE CAST({tp} AS DOUBLE) / {ap} END, 6) AS recall, "
        f"round(CASE WHEN {pp} + {ap} = 0 THEN 0 ELSE 2.0 * {tp} / ({pp} + {ap}) END, 6) AS f1_score"
    )


MACRO = "avg(CASE WHEN pp + ap = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (pp + ap) END)"
T = [f'"{f}"' for f in FLAGS]
P = [f'"pred_{f}"' for f in FLAGS]
EXACT = " AND ".join(f"{t} = {p}" for t, p in zip(T, P, strict=True))
SOME = " OR ".join(f"({t} = 1 AND {p} = 1)" for t, p in zip(T, P, strict=True))
CLEAN = " AND ".join(f"({p} = 0 OR {t} = 1)" for t, p in zip(T, P, strict=True))
INSTANCE = f"""
SELECT count(*) AS total_samples,
       count(*) FILTER (WHERE {EXACT}) AS perfect_match_count,
       round(100.0 * count(*) FILTER (WHERE {EXACT}) / count(*), 2) AS perfect_match_percent,
       count(*) FILTER (WHERE {SOME}) AS at_least_one_correct,
       round(100.0 * count(*) FILTER (WHERE {SOME}) / count(*), 2) AS at_least_one_correct_percent,
       count(*) FILTER (WHERE ({SOME}) AND {CLEAN}) AS no_wrong_and_some_correct,
       round(100.0 * count(*) FILTER (WHERE ({SOME}) AND {CLEAN}) / count(*), 2)
         AS no_wrong_and_some_correct_percent
FROM scored"""


def rounded(df, skip=()):
    """Doubles to six digits, for comparison."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.round(named(c), 6).alias(c) if kinds[c] == "double" and c not in skip else named(c)
            for c in df.columns
        ]
    )


@query("per_label_metrics", f"WITH {COUNTS} SELECT label, {prf()}, ap AS support FROM counts")
def per_label_metrics(spark, sf):
    return rounded(metrics.per_label_metrics(scored(spark, sf), FLAGS))


@query("macro_f1", f"WITH {COUNTS} SELECT round({MACRO}, 6) AS macro_f1 FROM counts")
def macro_f1(spark, sf):
    return rounded(metrics.macro_f1(scored(spark, sf), FLAGS))


MICRO = "SELECT sum(tp) AS tp, sum(pp) AS pp, sum(ap) AS ap FROM counts"


@query("micro_metrics", f"WITH {COUNTS}, total AS ({MICRO}) SELECT {prf()} FROM total")
def micro_metrics(spark, sf):
    return rounded(metrics.micro_metrics(scored(spark, sf), FLAGS))


@query("instance_metrics", f"WITH {SCORED_SQL} {INSTANCE}")
def instance_metrics(spark, sf):
    return metrics.instance_metrics(scored(spark, sf), FLAGS)


STATS = [
    "total_samples",
    "perfect_match_count",
    "perfect_match_percent",
    "at_least_one_correct",
    "at_least_one_correct_percent",
    "no_wrong_and_some_correct",
    "no_wrong_and_some_correct_percent",
]

BUNDLE_SQL = f"""WITH {COUNTS}, total AS ({MICRO}), micro AS (SELECT {prf()} FROM total),
per AS (SELECT label, {prf()}, ap FROM counts), inst AS ({INSTANCE})
SELECT 'per_tag' AS section, label AS key, 'precision' AS metric, precision AS value FROM per
UNION ALL SELECT 'per_tag', label, 'recall', recall FROM per
UNION ALL SELECT 'per_tag', label, 'f1_score', f1_score FROM per
UNION ALL SELECT 'per_tag', label, 'support', CAST(ap AS DOUBLE) FROM per
UNION ALL SELECT 'macro', '', 'f1_score', round({MACRO}, 6) FROM counts
UNION ALL SELECT 'micro', '', 'precision', precision FROM micro
UNION ALL SELECT 'micro', '', 'recall', recall FROM micro
UNION ALL SELECT 'micro', '', 'f1_score', f1_score FROM micro
""" + " ".join(f"UNION ALL SELECT 'stats', '', '{m}', CAST({m} AS DOUBLE) FROM inst" for m in STATS)


def bundle_rows(bundle):
    """A nested evaluation result as (section, key, metric, value)."""

    def cell(section, key, metric, value):
        value = F.round(value.cast("double"), 6)
        return F.struct(
            F.lit(section).alias("section"), key.alias("key"), F.lit(metric).alias("metric"), value.alias("value")
        )

    none = F.lit("")
    fixed = [cell("macro", none, "f1_score", F.col("macro_average_f1"))]
    for m in ("precision", "recall", "f1_score"):
        fixed.append(cell("micro", none, m, F.col("micro_average_metrics")[m]))
    for m in STATS:
        fixed.append(cell("stats", none, m, F.col("custom_stats")[m]))
    per_label = bundle.select(F.explode("per_tag_metrics").alias("k", "v"))
    rows = [cell("per_tag", F.col("k"), m, F.col("v")[m]) for m in ("precision", "recall", "f1_score", "support")]
    return bundle.select(F.inline(F.array(*fixed))).unionByName(per_label.select(F.inline(F.array(*rows))))


@query("evaluation_bundle", BUNDLE_SQL)
def evaluation_bundle(spark, sf):
    return bundle_rows(metrics.evaluation_bundle(scored(spark, sf), FLAGS))


# ---- raw scores --------------------------------------------------------------------

# Every element of a test vector is a label; the vectors have 64.
N_LOGITS = 64
LOGITS = [f"label_{i}" for i in range(1, N_LOGITS + 1)]
_PROB = "1.0 / (1.0 + exp(-CAST(embedding[{i}] AS DOUBLE) * 10))"
LOGITS_SQL = "probs AS (SELECT vec_id, label, " + ", ".join(
    f"{_PROB.format(i=i)} AS p{i}" for i in range(1, N_LOGITS + 1)
) + " FROM embeddings)"


def _logits(spark, sf):
    scores = F.transform("embedding", lambda x: x.cast("double") * 10)
    return table(spark, sf, "embeddings").select("vec_id", "label", scores.alias("scores"))


@query(
    "sigmoid_threshold",
    f"WITH {LOGITS_SQL} SELECT vec_id, "
    + ", ".join(
        f"round(p{i}, 6) AS prob_label_{i}, CAST(p{i} >= 0.5 AS INTEGER) AS pred_label_{i}" for i in range(1, N_LOGITS + 1)
    )
    + " FROM probs",
)
def sigmoid_threshold(spark, sf):
    return rounded(metrics.sigmoid_threshold(_logits(spark, sf), "scores", LOGITS).drop("scores", "label"))


_SCORE_CELLS = " UNION ALL ".join(
    f"SELECT {i} AS label_no, CAST(label % {i + 1} = 0 AS INTEGER) AS t, CAST(p{i} >= 0.5 AS INTEGER) AS p FROM probs"
    for i in range(1, N_LOGITS + 1)
)
_SCORE_EXACT = " AND ".join(f"(label % {i + 1} = 0) = (p{i} >= 0.5)" for i in range(1, N_LOGITS + 1))


@query(
    "score_metrics",
    f"""WITH {LOGITS_SQL}, cells AS ({_SCORE_CELLS}),
    counts AS (SELECT label_no, sum(t * p) AS tp, sum(p) AS pp, sum(t) AS ap FROM cells GROUP BY label_no)
    SELECT round((SELECT CAST(2 * sum(tp) AS DOUBLE) / (sum(pp) + sum(ap)) FROM counts), 6) AS f1_micro,
           round((SELECT {MACRO} FROM counts), 6) AS f1_macro,
           round(CAST(count(*) FILTER (WHERE {_SCORE_EXACT}) AS DOUBLE) / count(*), 6) AS subset_accuracy
    FROM probs""",
)
def score_metrics(spark, sf):
    rows = _logits(spark, sf).select(
        "scores",
        *[(F.col("label") % (i + 2) == 0).cast("int").alias(name) for i, name in enumerate(LOGITS)],
    )
    return rounded(metrics.score_metrics(rows, "scores", LOGITS))
