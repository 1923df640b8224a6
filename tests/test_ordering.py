import pytest
from pyspark.sql import functions as F

from labelloom.operators import ranking, sampling
from labelloom.operators.columns import filter_min_labels


def times(spark, n, step=7):
    """Ids with many equal times, some null."""
    t = F.when(F.col("id") % 13 != 0, ((F.col("id") * 7919) % step).cast("string"))
    return spark.range(n).select("id", t.alias("t"))


def ranked(df):
    return {r["id"]: r["creation_order"] for r in df.collect()}


def test_order_is_total_and_the_same_on_any_partitioning(spark):
    rows = times(spark, 500)
    expected = sorted(rows.collect(), key=lambda r: (r["t"] is None, r["t"] or "", r["id"]))
    expected = {r["id"]: i + 1 for i, r in enumerate(expected)}
    for n in (1, 4, 17):
        assert ranked(ranking.creation_order(rows.repartition(n), "t", ["id"])) == expected


def test_order_without_ties_columns_is_repeatable(spark):
    rows = times(spark, 300)
    first = ranked(ranking.creation_order(rows.repartition(3), "t"))
    assert first == ranked(ranking.creation_order(rows.repartition(11), "t"))
    assert sorted(first.values()) == list(range(1, 301))


def test_one_hot_time_spreads_over_partitions(spark):
    rows = spark.range(20000).withColumn("t", F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")))
    # So small a table would be joined into one partition again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ranking._placed(rows, ["t", "id"], "hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.total == 20000
    found = placed.rows.groupBy("__part").agg(F.count("*").alias("n"), F.count_if(F.col("t") == "same").alias("hot"))
    parts = found.collect()
    assert sum(r["n"] for r in parts) == 20000
    assert len(parts) == 4 and max(r["n"] for r in parts) < 20000 / 2
    assert sum(r["hot"] > 0 for r in parts) > 1


def test_no_window_gathers_the_table(spark, plan):
    text = plan(ranking.creation_order(times(spark, 100), "t", ["id"]))
    assert "Window" not in text and "SinglePartition" not in text


def test_dense_id_after_a_filter(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 0)], "creation_order int, a int")
    kept = filter_min_labels(rows, ["a"], 1)
    numbered = ranking.dense_row_id(kept, ["creation_order"]).orderBy("problem_id").collect()
    assert [tuple(r) for r in numbered] == [(0, 2, 1), (1, 3, 1)]


def test_empty_table(spark):
    rows = times(spark, 0)
    assert ranking.creation_order(rows, "t", ["id"]).count() == 0
    assert sampling.chronological_split(rows, ["t", "id"]).count() == 0
    assert sampling.sample_n(rows, 5, "id").count() == 0
    assert sampling.validation_split(rows, 10, "id").count() == 0


@pytest.mark.parametrize(
    ("n", "share", "train"), [(4982, 0.25, 3736), (3, 0.25, 2), (10, 0.9, 0), (8, 0.0, 8), (8, 1.0, 0)]
)
def test_split_sizes(spark, n, share, train):
    split = sampling.chronological_split(times(spark, n), ["t", "id"], share)
    counts = {r[0]: r[1] for r in split.groupBy("split").count().collect()}
    assert (counts.get("train", 0), counts.get("test", 0)) == (train, n - train)


def test_train_comes_before_test(spark):
    split = sampling.chronological_split(times(spark, 400).repartition(5), ["t", "id"], 0.25)
    keys = [((r["t"] is None, r["t"] or "", r["id"]), r["split"]) for r in split.collect()]
    assert max(k for k, s in keys if s == "train") < min(k for k, s in keys if s == "test")


def test_split_only_filters_the_table(spark, plan):
    split = sampling.chronological_split(times(spark, 400), ["t", "id"], 0.25)
    assert "Exchange" not in plan(split)


def test_split_refuses_an_order_with_ties(spark):
    with pytest.raises(ValueError, match="total order"):
        sampling.chronological_split(spark.range(100).withColumn("t", F.lit(1)), ["t"], 0.25)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_sample_size_and_repeatability(spark):
    rows = spark.range(1000)
    first = ids(sampling.sample_n(rows.repartition(1), 10, "id"))
    assert len(first) == 10
    assert first == ids(sampling.sample_n(rows.repartition(17), 10, "id"))
    assert first != ids(sampling.sample_n(rows, 10, "id", seed=7))
    assert sampling.sample_n(rows, 0, "id").count() == 1000
    assert sampling.sample_n(rows, 5000, "id").count() == 1000
    for n in (1, 499, 999):
        assert sampling.sample_n(rows, n, "id").count() == n


def test_sample_takes_the_smallest_digests(spark):
    rows = spark.range(20000)
    by_sort = rows.orderBy(F.md5(F.concat_ws(":", F.lit("42"), F.col("id").cast("string")))).limit(4321)
    assert ids(sampling.sample_n(rows, 4321, "id")) == ids(by_sort)


def test_sample_refuses_repeated_ids(spark):
    rows = spark.range(100).select(F.lit(1).alias("id"))
    with pytest.raises(ValueError, match="share a sampling id"):
        sampling.sample_n(rows, 10, "id")


def test_sample_only_filters_the_table(spark, plan):
    assert "Exchange" not in plan(sampling.sample_n(spark.range(1000), 10, "id"))


def test_head(spark):
    rows = times(spark, 100)
    head = sampling.head_n(rows, 9, ["t", "id"])
    assert sorted((r["t"], r["id"]) for r in head.collect()) == sorted(
        (r["t"], r["id"]) for r in rows.orderBy(F.col("t").asc_nulls_last(), "id").limit(9).collect()
    )
    assert sampling.head_n(rows, -1, ["t", "id"]).count() == 100
    assert sampling.head_n(rows, 1000, ["t", "id"]).count() == 100


@pytest.mark.parametrize(("n", "held"), [(100, 10), (101, 11), (10, 0), (11, 2)])
def test_validation_split(spark, n, held):
    split = sampling.validation_split(spark.range(n), 10, "id")
    assert split.filter("split = 'validation'").count() == held
    assert split.count() == n


def test_undersampling(spark):
    rows = spark.range(100).select(
        "id", (F.col("id") < 10).cast("int").alias("a"), F.lit(0).alias("b"), (F.col("id") % 2).alias("c")
    )
    kept = sampling.undersample_majority(rows.repartition(7), ["a", "b", "c"], "id")
    assert "keep_b" not in kept.columns
    balanced = {r["a"]: r["count"] for r in kept.filter("keep_a").groupBy("a").count().collect()}
    assert balanced == {0: 10, 1: 10}
    assert kept.filter("keep_c").count() == 100
    again = sampling.undersample_majority(rows.coalesce(1), ["a", "b", "c"], "id")
    assert ids(kept.filter("keep_a")) == ids(again.filter("keep_a"))


def test_single_class_labels_are_skipped(spark):
    rows = spark.range(4).select((F.col("id") % 2).alias("a"), F.lit(1).alias("b"), F.lit(None).cast("int").alias("c"))
    assert sampling.skip_single_class(rows, ["a", "b", "c", "absent"]) == ["a"]
    assert sampling.skip_single_class(rows.limit(0), ["a", "b"]) == []


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(20,4)"])
def test_split_bound_is_exact_for_any_key_type(spark, kind, tmp_path):
    """Also where clocks are set back, and down to the microsecond."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        start = 1_729_983_600_000_000  # an hour before the clocks were set back in 2024
        step = {"date": 86_400_000_000}.get(kind, 1_800_000_000)
        moment = F.timestamp_micros(F.lit(start) + F.col("id") * step + F.col("id"))
        plain = F.col("id") / 3
        key = plain.cast(kind) if kind in ("double", "decimal(20,4)") else moment.cast(kind)
        spark.range(12).select("id", key.alias("t")).write.parquet(str(tmp_path / "rows"))
        rows = spark.read.parquet(str(tmp_path / "rows"))
        for share in (0.25, 0.5, 0.75):
            split = sampling.chronological_split(rows, ["t", "id"], share)
            expected = rows.orderBy("t", "id").limit(int(12 * (1 - share)))
            assert ids(split.filter("split = 'train'")) == ids(expected)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_staged_tables_can_be_removed(spark):
    from pathlib import Path

    from labelloom import session

    path = session.new_path(spark, "x")
    spark.range(1).write.parquet(path)
    session.remove_staged(spark)
    assert not Path(path).exists()


def test_tie_breaker_tells_all_rows_apart(spark):
    rows = [("a\x1fb", "c"), ("a", "b\x1fc"), ("\x00", "q"), (None, "q"), ("-", "q"), ("1:a", ""), ("", "1:a")]
    table = spark.createDataFrame(rows, "x string, y string")
    assert ranking.with_tie_breaker(table, "tie").select("tie").distinct().count() == len(rows)
