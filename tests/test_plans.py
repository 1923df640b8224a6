import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from labelloom import session
from labelloom.config import LabelConfig
from labelloom.plans import cleaning, splitting

CONFIG = LabelConfig(
    renames={"raw_text": "body"},
    kept=("body", "limit", "absent"),
    labels=("a", "b c"),
    lowercased=("body",),
    parsed_limits=("limit",),
    text_features=("body",),
    code_features=(),
    time_column="at",
)


def raw(spark):
    rows = [
        ("X one", "2 s", "30", ["a"]),
        ("x ONE", "2.0 sec", "30", ["a"]),
        ("two", None, "20", []),
        ("three", "1 s", "20", ["b c", "z"]),
        (None, "1 s", None, ["a", "b c"]),
        ("four", "1 s", "9", None),
    ]
    return spark.createDataFrame(rows, "raw_text string, `limit` string, at string, tags array<string>")


def test_clean_rows(spark):
    clean = cleaning.clean_table(raw(spark), CONFIG).orderBy("problem_id").collect()
    # The first two are equal after cleaning; times are compared as text, null last.
    assert [r["at"] for r in clean] == ["20", "20", "30", "9", None]
    assert [r["problem_id"] for r in clean] == [0, 1, 2, 3, 4]
    assert [r["creation_order"] for r in clean] == [1, 2, 3, 4, 5]
    assert clean[2]["body"] == "x one" and clean[2]["limit"] == 2.0 and clean[2]["tags"] == "['a']"
    assert clean[4]["body"] == "none" and clean[4]["output"] == '<output>{"a": 1, "b c": 1}</output>'
    assert clean[3]["tags"] == "None" and (clean[3]["a"], clean[3]["b c"]) == (0, 0)


def test_clean_is_the_same_on_any_partitioning(spark):
    one = cleaning.clean_table(raw(spark).repartition(1), CONFIG)
    many = cleaning.clean_table(raw(spark).repartition(17), CONFIG)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_numbering_precedes_the_label_filter(spark):
    config = LabelConfig(**{**CONFIG.__dict__, "min_labels": 1})
    clean = cleaning.clean_table(raw(spark), config).orderBy("problem_id").collect()
    assert [r["problem_id"] for r in clean] == [0, 1, 2]
    assert clean[1]["creation_order"] == 3 and clean[2]["creation_order"] == 5


def test_split_parts_make_up_the_table(spark, tmp_path):
    clean = spark.range(1, 9).select(
        F.col("id").alias("problem_id"), F.col("id").alias("creation_order"), (F.col("id") % 2).alias("a"), F.lit(1).alias("b c")
    )
    split = splitting.split_table(clean, CONFIG)
    train, test, full = splitting.split_parts(split)
    assert (train.count(), test.count(), full.count()) == (6, 2, 8)
    assert train.unionByName(test).exceptAll(full).count() == 0
    path = splitting.write_split(split, str(tmp_path), "split")
    read = spark.read.parquet(path).filter("split = 'test'")
    assert read.count() == 2
    assert "PartitionFilters: [isnotnull(split" in read._jdf.queryExecution().executedPlan().toString()
    report = {(r["section"], r["key"], r["metric"]): r["value"] for r in splitting.split_report(split, CONFIG).collect()}
    assert report["size", "train", "n_rows"] == 6.0 and report["size", "test", "percent"] == 25.0


def test_split_numbers_a_table_without_order(spark):
    rows = spark.range(8).select(F.col("id").alias("problem_id"))
    split = splitting.split_table(rows, CONFIG)
    assert sorted(r["problem_id"] for r in split.filter("split = 'test'").collect()) == [6, 7]


@pytest.mark.parametrize(
    ("orders", "train"),
    [
        ([1, 1, 4, 4], [0, 1, 2]),  # least, greatest and sum of 1..4, but not these numbers
        ([2, 2, 2, 2], [0, 1, 2]),
        ([4, 3, 2, 1], [1, 2, 3]),
        ([1, 2, 3, 9], [0, 1, 2]),
        ([0, 1, 2, 3], [0, 1, 2]),
        ([None, 1, 2, 3], [1, 2, 3]),
        ([-5, -5, 1, 10**12], [0, 1, 2]),
        ([1, 2, 2, 4], [0, 1, 2]),
        ([7], []),
        ([], []),
    ],
)
def test_split_takes_the_first_rows_whatever_the_order_holds(spark, orders, train):
    rows = spark.createDataFrame(list(enumerate(orders)), "problem_id long, creation_order long").repartition(3)
    split = splitting.split_table(rows, CONFIG)
    assert sorted(r["problem_id"] for r in split.filter("split = 'train'").collect()) == train
    assert split.count() == len(orders)
    # Without an id rows of equal order go by their digests: the number is the same.
    nameless = splitting.split_table(rows.select("creation_order", F.col("problem_id").alias("x")), CONFIG)
    assert nameless.filter("split = 'train'").count() == len(train)
    assert nameless.columns == ["creation_order", "x", "split"]


def test_split_of_numbered_rows_reads_one_column(spark, plan, tmp_path):
    rows = spark.range(1, 101).selectExpr("id AS problem_id", "id AS creation_order", "'x' AS body")
    rows.write.parquet(str(tmp_path / "t"))
    split = splitting.split_table(spark.read.parquet(str(tmp_path / "t")), CONFIG)
    assert split.filter("split = 'train'").count() == 75
    assert "Exchange" not in plan(split) and plan(split).count("FileScan") == 1


def test_written_jobs_leave_nothing_staged(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(8):
        record = {"src_uid": str(i), "tags": ["math"], "prob_desc_created_at": str(i % 3), "source_code": str(i)}
        (raw / f"{i}.json").write_text(json.dumps(record))
    session.remove_staged(spark)
    cleaned = cleaning.clean_directory(spark, str(raw), str(tmp_path / "clean"), "clean")
    path, report = splitting.split_snapshot(spark, str(tmp_path / "clean"), str(tmp_path / "split"), "split")
    staged = Path(spark.conf.get("spark.checkpoint.dir"), "labelloom", spark.sparkContext.applicationId)
    assert not staged.exists() or not list(staged.iterdir())
    assert spark.read.parquet(cleaned.path).count() == 8 and cleaned.bad_records.count() == 0
    assert spark.read.parquet(path).groupBy("split").count().count() == 2
    assert report.filter("section = 'size' AND metric = 'n_rows'").agg({"value": "sum"}).first()[0] == 8


def test_split_report_is_one_scan(spark, plan, tmp_path):
    rows = spark.range(10).selectExpr("int(id) + 1 AS creation_order", "int(id % 2) AS math", "'train' AS split")
    rows.write.parquet(str(tmp_path / "t"))
    report = splitting.split_report(spark.read.parquet(str(tmp_path / "t")))
    assert plan(report).count("FileScan") == 1
