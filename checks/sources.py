"""Sources and sinks, on files that Spark writes from the test tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import query
from checks.metrics import BUNDLE_SQL, bundle_rows
from checks.views import FLAGS, RAW_SQL, raw_records, scored, table
from labelloom.functions.values import named
from labelloom.operators.metrics import evaluation_bundle
from labelloom.session import new_path
from labelloom.sources import records, runs, tables

DAY = date(2025, 4, 17)

# Records per file; the number of files grows with the table.
PER_FILE = 100


@query(
    "scan_json_records",
    f"""WITH {RAW_SQL}
    SELECT src_uid, prob_desc_time_limit, prob_desc_description, prob_desc_notes, difficulty,
           CAST(NULL AS VARCHAR) AS code_uid, array_to_string(tags, ',') AS tags FROM raw""",
)
def scan_json_records(spark, sf):
    raw = raw_records(spark, sf)
    number = F.substring("src_uid", 4, 20).cast("long")
    files = (
        raw.select((number / PER_FILE).cast("long").alias("file"), F.to_json(F.struct("*")).alias("record"))
        .groupBy("file")
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ",\n"), F.lit("]")).alias("value"))
    )
    directory = new_path(spark, "records")
    files.select("value").write.option("maxRecordsPerFile", 1).text(directory)
    found = records.scan_json_records(spark, directory, pattern="*.txt")
    return found.select(
        "src_uid",
        "prob_desc_time_limit",
        "prob_desc_description",
        "prob_desc_notes",
        "difficulty",
        "code_uid",
        F.array_join("tags", ",").alias("tags"),
    )


@query(
    "quarantine_corrupt",
    """SELECT CASE item_id % 4 WHEN 0 THEN '{"item_id": ' || CAST(item_id AS VARCHAR) || ', "text": bad'
              ELSE '{"item_id": "no number", "text": "x' || CAST(item_id AS VARCHAR) || '"}' END AS record,
              'txt' AS extension
       FROM benchmark WHERE item_id % 4 < 2""",
)
def quarantine_corrupt(spark, sf):
    key = F.col("item_id").cast("string")
    good = F.to_json(F.struct("item_id", "text"))
    text = (
        F.when(F.col("item_id") % 4 == 0, F.concat(F.lit('{"item_id": '), key, F.lit(', "text": bad')))
        .when(
            F.col("item_id") % 4 == 1,
            F.concat(F.lit('{"item_id": "no number", "text": "x'), key, F.lit('"}')),
        )
        .otherwise(good)
    )
    directory = new_path(spark, "corrupt")
    rows = table(spark, sf, "benchmark").select(text.alias("value"))
    rows.write.option("maxRecordsPerFile", 1).text(directory)
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
    bad = records.quarantine_corrupt(spark, directory, schema, pattern="*.txt")
    return bad.select(
        F.regexp_replace("record", "\n$", "").alias("record"),
        F.substring_index("file_name", ".", -1).alias("extension"),
    )


@query("scan_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv(spark, sf):
    documents = table(spark, sf, "documents")
    path = new_path(spark, "csv")
    documents.write.option("header", True).option("escape", '"').csv(path)
    return tables.scan_csv(spark, path, documents.schema)


@query("sink_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_csv(spark, sf):
    customers = table(spark, sf, "customer")
    path = new_path(spark, "csv")
    tables.sink_csv(customers.select(*reversed(customers.columns)), path, first="c_custkey")
    return tables.scan_csv(spark, path)


@query(
    "write_snapshot",
    """SELECT 'customers_2025-04-17' AS snapshot, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'customers_2025-04-17_1', count(*) FROM customer
       UNION ALL SELECT 'customers_2025-04-17_2', count(*) FROM customer""",
)
def write_snapshot(spark, sf):
    directory = new_path(spark, "snapshots")
    found = []
    for _ in range(3):
        path = tables.write_snapshot(table(spark, sf, "customer"), directory, "customers", DAY)
        written = spark.read.parquet(path)
        found.append(written.agg(F.lit(path.split("/")[-1]).alias("snapshot"), F.count("*").alias("n_rows")))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("latest_snapshot", "SELECT s_suppkey, s_acctbal * 2 AS s_acctbal FROM supplier")
def latest_snapshot(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    directory = new_path(spark, "snapshots")
    tables.write_snapshot(suppliers, directory, "suppliers", DAY)
    doubled = suppliers.withColumn("s_acctbal", F.col("s_acctbal") * 2)
    tables.write_snapshot(doubled, directory, "suppliers", DAY)
    return tables.latest_snapshot(spark, directory)


# ---- run names ---------------------------------------------------------------------

NAMES_SQL = """
names AS (
  SELECT CASE o_orderkey % 6
           WHEN 0 THEN 'forest_' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
           WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_custkey AS VARCHAR)
           WHEN 2 THEN 'run_20251341_' || CAST(o_orderkey AS VARCHAR)
           WHEN 3 THEN 'forest' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
           WHEN 4 THEN 'forest_' || strftime(o_orderdate, '%Y%m%d') || '_last'
           ELSE 'notes' END AS path, o_orderkey, o_orderdate, o_custkey
  FROM orders)"""


def _names(spark, sf):
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    index = F.lpad((key % 1000).cast("string"), 3, "0")
    path = (
        F.when(key % 6 == 0, F.concat(F.lit("forest_"), day, F.lit("_"), index))
        .when(key % 6 == 1, F.concat(day, F.lit("_"), F.col("o_custkey").cast("string")))
        .when(key % 6 == 2, F.concat(F.lit("run_20251341_"), key.cast("string")))
        .when(key % 6 == 3, F.concat(F.lit("forest"), day, F.lit("_"), index))
        .when(key % 6 == 4, F.concat(F.lit("forest_"), day, F.lit("_last")))
        .otherwise(F.lit("notes"))
    )
    return table(spark, sf, "orders").select(path.alias("path"))


@query(
    "latest_run",
    f"""WITH {NAMES_SQL}, parsed AS (
      SELECT path, CAST(o_orderdate AS DATE) AS run_date,
             CAST(CASE o_orderkey % 6 WHEN 0 THEN o_orderkey % 1000 ELSE o_custkey END AS INTEGER) AS run_idx
      FROM names WHERE o_orderkey % 6 IN (0, 1))
    SELECT path, strftime(run_date, '%Y-%m-%d') AS run_date, run_idx FROM parsed
    ORDER BY parsed.run_date DESC, run_idx DESC, path DESC LIMIT 1""",
)
def latest_run(spark, sf):
    found = runs.latest_run(_names(spark, sf))
    return found.withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd"))


@query(
    "next_run_index",
    f"""WITH {NAMES_SQL}, used AS (
      SELECT coalesce(max(TRY_CAST(string_split(path, '_')[-1] AS INTEGER)), 0) + 1 AS run_idx
      FROM names WHERE starts_with(path, 'forest_19980102_'))
    SELECT run_idx, 'forest_19980102_' || CASE WHEN run_idx < 1000 THEN lpad(CAST(run_idx AS VARCHAR), 3, '0')
           ELSE CAST(run_idx AS VARCHAR) END AS run_name FROM used""",
)
def next_run_index(spark, sf):
    return runs.next_run_index(_names(spark, sf), "forest_", date(1998, 1, 2))


@query(
    "run_manifest",
    """SELECT 'runs/forest_20250417_001' AS path,
       '{"prefix":"forest_","run_date":"2025-04-17","run_idx":1,"path":"runs/forest_20250417_001","kind":"train",'
       || '"input_path":"orders","row_count":' || CAST(count(*) AS VARCHAR)
       || ',"params_json":"{\\"trees\\": 200}","created_at":"2025-04-17T12:00:00.000Z"}' AS json FROM orders""",
)
def run_manifest(spark, sf):
    n_rows = table(spark, sf, "orders").count()
    manifest = runs.run_manifest(
        spark,
        "forest_",
        DAY,
        1,
        "runs/forest_20250417_001",
        "train",
        "orders",
        n_rows,
        {"trees": 200},
        datetime(2025, 4, 17, 12),
    )
    ledger = new_path(spark, "ledger")
    runs.append_run(manifest, ledger)
    return runs.manifest_json(runs.read_runs(spark, ledger))


@query("sink_eval_json", BUNDLE_SQL)
def sink_eval_json(spark, sf):
    bundle = evaluation_bundle(scored(spark, sf), FLAGS)
    path = new_path(spark, "evaluation")
    runs.sink_eval_json(bundle, path)
    return bundle_rows(spark.read.schema(bundle.schema).json(path).select(*[named(c) for c in bundle.columns]))
