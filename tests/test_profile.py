from pyspark.sql import functions as F

from labelloom.operators import profile


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_text_stats(spark):
    texts = spark.createDataFrame([("",), (None,), ("abc",), ("😀é",)], "t string")
    assert rows_of(profile.text_stats(texts, ["t", "absent"])) == [("t", 50.0, 2.5)]
    assert rows_of(profile.text_stats(texts.limit(0), ["t"])) == []
    assert rows_of(profile.text_stats(texts.filter("t = ''"), ["t"])) == [("t", 100.0, 0.0)]


def test_correlation_of_constants_and_gaps(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, None), (3.0, None, 5.0, None), (None, 9.0, 5.0, None)],
        "a double, b double, c double, d double",
    )
    found = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(rows, ["a", "b", "c", "d"]).collect()}
    assert abs(found["a", "b"] - 1.0) < 1e-12 and found["a", "b"] == found["b", "a"]
    assert abs(found["a", "a"] - 1.0) < 1e-12
    assert found["a", "c"] is None and found["c", "c"] is None
    assert not any("d" in pair for pair in found)
    assert profile.correlation_matrix(rows, ["a"]).count() == 0


def test_negative_correlation(spark):
    rows = spark.range(10).select(F.col("id").cast("double").alias("a"), (-F.col("id")).cast("double").alias("b"))
    found = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(rows, ["a", "b"]).collect()}
    assert abs(found["a", "b"] + 1.0) < 1e-12


def test_cooccurrence_keeps_labels_nobody_has(spark):
    rows = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0)], "a int, b int, c int")
    found = {(r[0], r[1]): r[2] for r in profile.label_cooccurrence(rows, ["a", "b", "c"]).collect()}
    assert len(found) == 9
    assert (found["a", "a"], found["b", "b"], found["a", "b"], found["b", "a"], found["c", "c"]) == (2, 2, 1, 1, 0)


def test_labels_per_row_shows_only_numbers_that_occur(spark):
    rows = spark.createDataFrame([(0, 0, 0), (0, 0, None), (1, 1, 1), (1, 0, 0)], "a int, b int, c int")
    assert rows_of(profile.labels_per_row(rows, ["a", "b", "c"])) == [(0, 2, 50.0), (1, 1, 25.0), (3, 1, 25.0)]
    assert profile.avg_labels(rows, ["a", "b", "c"]).first()[0] == 1.0


def test_distribution_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int")
    assert rows_of(profile.label_distribution(empty, ["a"])) == [("a", 0, 0.0)]


def test_drift_is_doubled_and_ties_go_to_the_first_label(spark):
    rows = spark.createDataFrame(
        [("train", 0, 1, 0), ("train", 1, 0, 0), ("test", 1, 1, 0)], "split string, a int, b int, tag_c_d int"
    )
    drift = {r["label"]: r for r in profile.split_drift(rows, ["a", "b", "c d", "e"]).collect()}
    assert drift["a"]["drift"] == 100.0 and set(drift) == {"a", "b", "c d"}
    worst = profile.drift_summary(rows, ["a", "b", "c d"]).first()
    assert (worst["label"], worst["max_abs_drift"], worst["train_percent"]) == ("a", 100.0, 50.0)


def test_report_scans_once(spark, plan, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).selectExpr("id", "id % 2 AS a", "id % 3 AS b", "cast(id AS string) t").write.parquet(path)
    report = profile.profile_report(spark.read.parquet(path), ["a", "b"], ["id", "b"], ["t"])
    assert plan(report).count("FileScan") == 1
    found = {(r["section"], r["key"], r["metric"]): r["value"] for r in report.collect()}
    assert found["table", "", "n_rows"] == 50.0
    assert found["missing", "t", "n_missing"] == 0.0


def test_constant_column_over_many_partitions_has_no_correlation(spark):
    rows = spark.range(0, 10007, 1, 13).select(
        F.lit(0.1).alias("c"), (F.col("id") * 0.37 % 11).alias("x"), F.when(F.col("id") < 9, F.lit(0.3)).alias("few")
    )
    rows = rows.withColumn("c", F.when(F.col("x") >= 0, F.col("c")))
    found = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(rows, ["c", "x", "few"]).collect()}
    assert found["c", "x"] is None and found["few", "x"] is None and found["x", "x"] is not None


def test_labels_of_any_number(spark):
    rows = spark.createDataFrame([(2, 1), (0, 1), (1, 0), (-1, 0)], "a int, b int")
    found = {(r[0], r[1]): r[2] for r in profile.label_cooccurrence(rows, ["a", "b"]).collect()}
    assert found == {("a", "a"): 6, ("a", "b"): 2, ("b", "a"): 2, ("b", "b"): 2}
    assert rows_of(profile.labels_per_row(rows, ["a", "b"])) == [(-1, 1, 25.0), (1, 2, 50.0), (3, 1, 25.0)]


def test_no_label_column_gives_typed_empty_tables(spark):
    rows = spark.createDataFrame([(1, "train")], "x int, split string")
    for made in (
        profile.label_distribution(rows, ["a"]),
        profile.class_counts(rows, ["a"]),
        profile.label_cooccurrence(rows, ["a"]),
        profile.split_drift(rows, ["a"]),
    ):
        assert made.count() == 0 and len(made.columns) >= 3
    assert profile.drift_summary(rows, ["a"]).first()["avg_abs_drift"] is None


def test_many_labels_give_the_pairs_of_few(spark, monkeypatch):
    rows = [(1, 0, 2), (1, 1, None), (0, 0, 0), (None, None, None), (1, 1, -1)]
    df = spark.createDataFrame(rows, "a int, `b c` int, d int")
    few = sorted(tuple(r) for r in profile.label_cooccurrence(df, ["a", "b c", "d", "absent"]).collect())
    nothing = sorted(tuple(r) for r in profile.label_cooccurrence(df.limit(0), ["a", "b c"]).collect())
    monkeypatch.setattr(profile, "FEW_LABELS", 1)
    many = profile.label_cooccurrence(df, ["a", "b c", "d", "absent"])
    assert sorted(tuple(r) for r in many.collect()) == few and len(few) == 9
    assert sorted(tuple(r) for r in profile.label_cooccurrence(df.limit(0), ["a", "b c"]).collect()) == nothing


def test_hundreds_of_labels(spark):
    names = [f"l{i}" for i in range(500)]
    df = spark.range(60).select(*[(F.col("id") % (i + 1) == 0).cast("int").alias(n) for i, n in enumerate(names)])
    made = {(r["label_a"], r["label_b"]): r["n_rows"] for r in profile.label_cooccurrence(df, names).collect()}
    assert len(made) == 500 * 500
    for a, b in ((0, 0), (1, 2), (2, 1), (5, 9), (400, 499)):
        assert made[f"l{a}", f"l{b}"] == sum(n % (a + 1) == 0 and n % (b + 1) == 0 for n in range(60))
