import math

import pytest
from pyspark.sql import functions as F

from labelloom.operators import columns as ops
from labelloom.operators.joins import (
    attach_predictions,
    check_one_to_one,
    drop_duplicates,
    union_records,
)


def values(df, column):
    return [r[column] for r in df.orderBy("i").collect()]


def frame(spark, items, kind):
    return spark.createDataFrame(list(enumerate(items)), f"i int, v {kind}")


def test_multi_hot_is_exact_and_null_safe(spark):
    rows = frame(spark, [["math", "greedy"], [], None, ["Math"], [None]], "array<string>")
    assert values(ops.add_label_columns(rows, "v", ["math"]), "math") == [1, 0, 0, 0, 0]
    assert values(ops.add_label_columns(rows, "absent", ["math"]), "math") == [0] * 5


def test_leading_number(spark):
    texts = ["1 second", "0.5 seconds", "2.0 s", "none", None, "1.5.2", "...", "at most 3"]
    rows = ops.parse_leading_number(frame(spark, texts, "string"), ["v", "absent"])
    assert values(rows, "v") == [1.0, 0.5, 2.0, None, None, None, None, 3.0]


def test_list_to_string_reads_like_python(spark):
    lists = [["greedy", "math"], [], None, ["it's"], ['it\'s "x"'], ["a\\b", "c\nd"], [None]]
    rows = ops.list_to_string(frame(spark, lists, "array<string>"), ["v"])
    assert values(rows, "v") == [str(x) for x in lists]


def test_lowercase_text(spark):
    rows = frame(spark, ["AbC", None, "ÉA"], "string")
    assert values(ops.lowercase_text(rows, ["v"]), "v") == ["abc", "none", "éa"]
    assert values(ops.lowercase_text(rows, ["v"], None), "v") == ["abc", None, "éa"]


def test_coerce_numeric(spark):
    texts = ["3.5", "x", "inf", "NaN", None, "1e3", " 7 ", "3d", "1_0", "-.5", "1e999"]
    rows = ops.coerce_numeric(frame(spark, texts, "string"), ["v"])
    assert values(rows, "v") == [3.5, None, None, None, None, 1000.0, 7.0, None, None, -0.5, None]
    numbers = frame(spark, [1.0, math.inf, -math.inf, math.nan, None], "double")
    assert values(ops.coerce_numeric(numbers, ["v"]), "v") == [1.0, None, None, None, None]


def test_coerce_labels(spark):
    rows = ops.coerce_labels(frame(spark, ["1", "1.0", None, "x", "0"], "string"), ["v"])
    assert values(rows, "v") == [1, 1, 0, 0, 0]
    assert dict(rows.dtypes)["v"] == "int"


def test_missing_columns_raise_before_a_job(spark):
    rows = frame(spark, ["a"], "string")
    with pytest.raises(ValueError, match="nope"):
        ops.require_columns(rows, ["v", "nope"])
    with pytest.raises(ValueError, match="text"):
        ops.add_missing_features(rows, ["x"], critical=["text"])
    assert ops.add_missing_features(rows, ["x"]).schema["x"].dataType.typeName() == "double"


def test_label_columns_resolve_by_name_then_underscores(spark):
    rows = spark.range(1).select(F.lit(1).alias("a b"), F.lit(1).alias("tag_c_d"))
    assert ops.resolve_label_columns(rows, ["a b", "c d", "e"]) == {"a b": "a b", "c d": "tag_c_d"}


def test_predictions_are_completed_in_order(spark):
    rows = spark.createDataFrame([(1, None, 1)], "id int, pred_b int, pred_a int")
    done = ops.complete_predictions(rows, ["a", "b", "c"], keep=["id"])
    assert done.columns == ["id", "pred_a", "pred_b", "pred_c"]
    assert tuple(done.first()) == (1, 1, 0, 0)


def test_shape_result(spark):
    rows = spark.createDataFrame([(1, 1, 0, "x")], "id int, a int, pred_a int, other string")
    assert ops.shape_result(rows, ["a"], "id").columns == ["id", "a", "pred_a"]
    assert ops.shape_result(rows, ["a"], "id", keep="all").columns == rows.columns
    assert ops.shape_result(rows.drop("a", "id"), ["a"], "id").columns == ["pred_a"]


def test_minimum_labels(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (None, 1)], "a int, b int")
    counts = [ops.filter_min_labels(rows, ["a", "b"], n).count() for n in (0, 1, 2)]
    assert counts == [4, 3, 1]


def test_duplicates_and_nulls(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("A", "x"), ("a", "x")], "t string, n string")
    lowered = ops.lowercase_text(rows, ["t"])
    assert drop_duplicates(lowered).count() == 2


def test_union_fills_missing_columns(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([(2, 3.0)], "a int, c double")
    united = union_records([one, two])
    assert sorted(tuple(r) for r in united.select("a", "b", "c").collect()) == [(1, "x", None), (2, None, 3.0)]


def test_predictions_must_match_one_to_one(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    good = spark.createDataFrame([(2, 1), (1, 0)], "id int, pred_x int")
    assert attach_predictions(rows, good, "id").count() == 2
    for bad in ([(1, 0)], [(1, 0), (2, 0), (3, 0)], [(1, 0), (1, 0), (2, 0)]):
        with pytest.raises(ValueError, match="one to one"):
            check_one_to_one(rows, spark.createDataFrame(bad, "id int, pred_x int"), "id")


def test_predictions_must_match_one_to_one(spark, plan):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, x string")
    good = [(3, 30), (1, 10), (2, 20)]
    made = attach_predictions(rows, spark.createDataFrame(good, "id int, pred int"), "id")
    assert made.columns == ["id", "x", "pred"]
    assert plan(made).count("Exchange hashpartitioning") == 2
    assert sorted(tuple(r) for r in made.collect()) == [(1, "a", 10), (2, "b", 20), (3, "c", 30)]
    for bad in ([*good, (3, 31)], good[:2], [*good, (4, 40)], [*good[:2], (None, 1)], []):
        attached = attach_predictions(rows, spark.createDataFrame(bad, "id int, pred int"), "id")
        # Also where the query reads none of the columns.
        for run in (attached.collect, attached.count):
            with pytest.raises(Exception, match="one to one"):
                run()
    for left in ([(1, "a"), (1, "z"), (2, "b"), (3, "c")], [(None, "n"), (1, "a"), (2, "b"), (3, "c")]):
        attached = attach_predictions(spark.createDataFrame(left, "id int, x string"), spark.createDataFrame(good, "id int, pred int"), "id")
        with pytest.raises(Exception, match="one to one"):
            attached.count()
    none = attach_predictions(rows.limit(0), spark.createDataFrame([], "id int, pred int"), "id")
    assert none.collect() == []
