"""Profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.columns import NUMBER_TEXTS, _number_texts
from checks.metrics import rounded
from checks.ordering import _LONG_FLAGS
from checks.views import FLAGS, SCORED_SQL, scored, table, truth
from labelloom.operators import profile
from labelloom.operators.sampling import chronological_split

TRUTH_SQL = """
truth AS (
  SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _missing_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS n_missing, count(*) AS n_rows FROM {source}"
        for c in columns
    )


@query("missing_counts", f"WITH {TRUTH_SQL} " + _missing_sql("truth", ["doc_id", "lang", "quality", "toxic"]))
def missing_counts(spark, sf):
    return profile.missing_counts(truth(spark, sf), ["doc_id", "lang", "quality", "toxic"])


_NUMBER = "TRY_CAST(regexp_extract({c}, '([0-9.]+)', 1) AS DOUBLE)"


@query(
    "parsed_counts",
    f"WITH {NUMBER_TEXTS} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({_NUMBER.format(c=c)}) AS n_parsed,
            count(*) FILTER (WHERE {c} IS NOT NULL AND {_NUMBER.format(c=c)} IS NULL) AS n_malformed
            FROM texts"""
        for c in ("size_text", "brand_text")
    ),
)
def parsed_counts(spark, sf):
    return profile.parsed_counts(_number_texts(spark, sf), ["size_text", "brand_text"])


@query(
    "label_distribution",
    f"""WITH {SCORED_SQL}, long AS ({_LONG_FLAGS})
    SELECT label, sum(class_value) AS n_rows, round(100.0 * sum(class_value) / count(*), 6) AS percent
    FROM long GROUP BY label""",
)
def label_distribution(spark, sf):
    return rounded(profile.label_distribution(truth(spark, sf), FLAGS))


@query(
    "class_counts",
    f"""WITH {SCORED_SQL}, long AS ({_LONG_FLAGS}),
    totals AS (SELECT label, sum(class_value) AS ones, count(*) AS n FROM long GROUP BY label),
    counts AS (SELECT label, class_value, count(*) AS n_before FROM long GROUP BY label, class_value)
    SELECT c.label, c.class_value, c.n_before,
           CASE WHEN least(t.ones, t.n - t.ones) > 0 THEN least(t.ones, t.n - t.ones) ELSE c.n_before END AS n_after
    FROM counts c JOIN totals t ON c.label = t.label""",
)
def class_counts(spark, sf):
    return profile.class_counts(truth(spark, sf), FLAGS)


@query(
    "label_cooccurrence",
    f"WITH {SCORED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS label_a, '{b}' AS label_b, sum(\"{a}\" * \"{b}\") AS n_rows FROM scored"
        for a in FLAGS
        for b in FLAGS
    ),
)
def label_cooccurrence(spark, sf):
    return profile.label_cooccurrence(truth(spark, sf), FLAGS)


# Hundreds of labels: a document has those whose number divides its place.
MANY = 500


@query(
    "label_cooccurrence_many",
    f"""WITH active AS (
      SELECT doc_id, unnest(list_filter(range({MANY}), lambda i: doc_id % (i + 2) = 0)) AS i FROM documents),
    pairs AS (
      SELECT a.i AS a, b.i AS b, count(*) AS n FROM active a JOIN active b ON a.doc_id = b.doc_id GROUP BY a.i, b.i)
    SELECT 'divides ' || (x.i + 2) AS label_a, 'divides ' || (y.i + 2) AS label_b, coalesce(n, 0) AS n_rows
    FROM range({MANY}) x(i) CROSS JOIN range({MANY}) y(i) LEFT JOIN pairs ON a = x.i AND b = y.i""",
)
def label_cooccurrence_many(spark, sf):
    labels = {f"divides {i}": (F.col("doc_id") % i == 0).cast("int").alias(f"divides {i}") for i in range(2, MANY + 2)}
    return profile.label_cooccurrence(table(spark, sf, "documents").select(*labels.values()), list(labels))


_ACTIVE = 'quality + toxic + english + "long text"'


@query(
    "labels_per_row",
    f"""WITH {SCORED_SQL}
    SELECT {_ACTIVE} AS n_labels, count(*) AS n_rows,
           round(100.0 * count(*) / (SELECT count(*) FROM scored), 6) AS percent
    FROM scored GROUP BY {_ACTIVE}""",
)
def labels_per_row(spark, sf):
    return rounded(profile.labels_per_row(truth(spark, sf), FLAGS))


@query("avg_labels", f"WITH {SCORED_SQL} SELECT round(avg({_ACTIVE}), 6) AS avg_labels FROM scored")
def avg_labels(spark, sf):
    return rounded(profile.avg_labels(truth(spark, sf), FLAGS))


# ---- splits ------------------------------------------------------------------------

SPLIT_SQL = """
ranked AS (
  SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rank FROM orders),
split AS (
  SELECT *, CASE WHEN rank <= floor(n * 0.75) THEN 'train' ELSE 'test' END AS split,
         CAST(o_orderstatus = 'F' AS INTEGER) AS filled,
         CAST(o_totalprice > 200000 AS INTEGER) AS large,
         CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent
  FROM ranked)"""
ORDER_FLAGS = ["filled", "very large", "urgent"]
_ORDER_COLUMNS = {"filled": "filled", "very large": "large", "urgent": "urgent"}
DRIFT_SQL = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{label}' AS label,
        100.0 * avg({c}) FILTER (WHERE split = 'train') AS train_percent,
        100.0 * avg({c}) FILTER (WHERE split = 'test') AS test_percent FROM split"""
    for i, (label, c) in enumerate(_ORDER_COLUMNS.items())
)


def split_orders(spark, sf):
    """Orders in date order; 'very large' is stored under its underscored name."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderdate",
        (F.col("o_orderstatus") == "F").cast("int").alias("filled"),
        (F.col("o_totalprice") > 200000).cast("int").alias("tag_very_large"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"),
    )
    return chronological_split(rows, ["o_orderdate", "o_orderkey"])


@query(
    "split_sizes",
    f"""WITH {SPLIT_SQL}
    SELECT split, count(*) AS n_rows, round(100.0 * count(*) / (SELECT count(*) FROM split), 6) AS percent
    FROM split GROUP BY split""",
)
def split_sizes(spark, sf):
    return rounded(profile.split_sizes(split_orders(spark, sf)))


@query(
    "split_drift",
    f"""WITH {SPLIT_SQL}, drift AS ({DRIFT_SQL})
    SELECT label, round(train_percent, 6) AS train_percent, round(test_percent, 6) AS test_percent,
           round(2 * (test_percent - train_percent), 6) AS drift FROM drift""",
)
def split_drift(spark, sf):
    return rounded(profile.split_drift(split_orders(spark, sf), [*ORDER_FLAGS, "absent"]))


@query(
    "drift_summary",
    f"""WITH {SPLIT_SQL}, drift AS ({DRIFT_SQL}),
    sized AS (SELECT *, abs(2 * (test_percent - train_percent)) AS size FROM drift)
    SELECT round((SELECT avg(size) FROM sized), 6) AS avg_abs_drift, round(size, 6) AS max_abs_drift, label,
           round(train_percent, 6) AS train_percent, round(test_percent, 6) AS test_percent
    FROM sized ORDER BY size DESC, position LIMIT 1""",
)
def drift_summary(spark, sf):
    return rounded(profile.drift_summary(split_orders(spark, sf), ORDER_FLAGS))


# ---- correlations ------------------------------------------------------------------

NUMBERS_SQL = """
numbers AS (
  SELECT l_quantity AS quantity, l_extendedprice AS price,
         CASE WHEN l_discount > 0.02 THEN l_discount END AS discount,
         CASE WHEN l_linenumber > 2 THEN CAST(l_linenumber AS DOUBLE) END AS line,
         1.5 AS constant, CAST(NULL AS DOUBLE) AS nothing,
         CAST(l_returnflag = 'R' AS INTEGER) AS returned, CAST(l_tax > 0.04 AS INTEGER) AS taxed
  FROM lineitem)"""
NUMBERS = ["quantity", "price", "discount", "line", "constant", "nothing"]
NUMBER_FLAGS = ["returned", "taxed"]


def _numbers(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.when(F.col("l_discount") > 0.02, F.col("l_discount")).otherwise(F.lit(float("nan"))).alias("discount"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")).alias("line"),
        F.lit(1.5).alias("constant"),
        F.lit("none").alias("nothing"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        (F.col("l_tax") > 0.04).cast("int").alias("taxed"),
    )


def _corr(a: str, b: str) -> str:
    value = f"corr({a}, {b})"
    return f"round(CASE WHEN isnan({value}) THEN NULL ELSE {value} END, 6)"


def _corr_sql(rows: list[str], others: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_corr(a, b)} AS correlation FROM numbers"
        for a in rows
        for b in others
    )


@query("correlation_matrix", f"WITH {NUMBERS_SQL} " + _corr_sql(NUMBERS[:-1], NUMBERS[:-1]))
def correlation_matrix(spark, sf):
    return rounded(profile.correlation_matrix(_numbers(spark, sf), NUMBERS))


@query("numeric_label_correlation", f"WITH {NUMBERS_SQL} " + _corr_sql(NUMBERS[:-1], NUMBER_FLAGS))
def numeric_label_correlation(spark, sf):
    return rounded(profile.numeric_label_correlation(_numbers(spark, sf), NUMBERS, NUMBER_FLAGS))


# ---- texts and the whole report ----------------------------------------------------

TEXTS_SQL = """
texts AS (
  SELECT text, CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS source,
         CAST(NULL AS VARCHAR) AS nothing, doc_id, n_chars, n_chars % 2 AS even_odd,
         CAST(lang = 'en' AS INTEGER) AS english, CAST(n_chars > 4000 AS INTEGER) AS "long text"
  FROM documents)"""


def _texts(spark, sf):
    source = F.when(F.col("doc_id") % 4 == 0, F.lit("")).when(F.col("doc_id") % 5 != 0, F.col("source"))
    return table(spark, sf, "documents").select(
        "text",
        source.alias("source"),
        F.lit(None).cast("string").alias("nothing"),
        "doc_id",
        "n_chars",
        (F.col("n_chars") % 2).alias("even_odd"),
        (F.col("lang") == "en").cast("int").alias("english"),
        (F.col("n_chars") > 4000).cast("int").alias("long text"),
    )


def _text_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column",
            round(100.0 * count(*) FILTER (WHERE {c} IS NULL OR {c} = '') / count(*), 2) AS missing_percent,
            round(coalesce(avg(CASE WHEN {c} <> '' THEN length({c}) END), 0), 2) AS avg_length FROM texts"""
        for c in columns
    )


@query("text_stats", f"WITH {TEXTS_SQL} " + _text_sql(["text", "source", "nothing"]))
def text_stats(spark, sf):
    return profile.text_stats(_texts(spark, sf), ["text", "source", "nothing", "absent"])


_REPORT_COLUMNS = ["text", "source", "nothing", "n_chars"]
_REPORT_FLAGS = ["english", "long text"]
_REPORT_NUMBERS = ["n_chars", "even_odd"]


def _report_sql() -> str:
    rows = ["SELECT 'table' AS section, '' AS key, 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM texts"]
    for c in _REPORT_COLUMNS:
        rows.append(f"SELECT 'missing', '{c}', 'n_missing', CAST(count(*) - count({c}) AS DOUBLE) FROM texts")
    for a in _REPORT_FLAGS:
        for b in _REPORT_FLAGS:
            rows.append(f"""SELECT 'cooccurrence', '{a}|{b}', 'n_rows', CAST(sum("{a}" * "{b}") AS DOUBLE) FROM texts""")
    per_row = """(SELECT english + "long text" AS k, count(*) AS n FROM texts GROUP BY 1)"""
    rows.append(f"SELECT 'labels_per_row', CAST(k AS VARCHAR), 'n_rows', CAST(n AS DOUBLE) FROM {per_row}")
    rows.append(
        f"""SELECT 'labels_per_row', CAST(k AS VARCHAR), 'percent',
            round(100.0 * n / (SELECT count(*) FROM texts), 6) FROM {per_row}"""
    )
    rows.append("""SELECT 'avg_labels', '', 'avg_labels', round(avg(english + "long text"), 6) FROM texts""")
    for m in ("missing_percent", "avg_length"):
        stats = f"({_text_sql(['text', 'source', 'nothing'])})"
        rows.append(f"""SELECT 'text', "column", '{m}', {m} FROM {stats}""")
    pairs = [("correlation", a, b) for a in _REPORT_NUMBERS for b in _REPORT_NUMBERS]
    pairs += [("label_correlation", a, b) for a in _REPORT_NUMBERS for b in _REPORT_FLAGS]
    for section, a, b in pairs:
        rows.append(f"""SELECT '{section}', '{a}|{b}', 'correlation', {_corr(f'"{a}"', f'"{b}"')} FROM texts""")
    return " UNION ALL ".join(rows)


@query("profile_report", f"WITH {TEXTS_SQL} " + _report_sql())
def profile_report(spark, sf):
    report = profile.profile_report(
        _texts(spark, sf), _REPORT_FLAGS, _REPORT_NUMBERS, ["text", "source", "nothing"], _REPORT_COLUMNS
    )
    return rounded(report)
