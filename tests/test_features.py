import math
import random
import sys

import pytest
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.config import LabelConfig
from labelloom.operators import features, forests, scoring, vocabulary
from labelloom.plans import classification, classifier, forest
from labelloom.session import new_path
from labelloom.sources.models import load_model, save_model

register_pickle_by_value(sys.modules[__name__])

TEXTS = ["The cat sat", "the cat ran", "a dog, a cat", "", None, "dog_1 dog_1 Été x"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")


def test_words_and_pairs(texts):
    words = vocabulary.tokenize(texts, "t", "words", ["the"])
    found = {r["id"]: r["terms"] for r in vocabulary.ngrams(words).collect()}
    assert found[0] == ["cat", "sat", "cat sat"]
    assert found[2] == ["dog", "cat", "dog cat"]
    assert found[3] == [] and found[4] == []
    assert found[5] == ["dog_1", "dog_1", "été", "dog_1 dog_1", "dog_1 été"]


def test_default_stop_words_are_dropped(texts):
    found = {r["id"]: r["words"] for r in vocabulary.tokenize(texts, "t").collect()}
    assert found[0] == ["cat", "sat"]


def test_vocabulary_bounds_and_ties(texts):
    words = vocabulary.tokenize(texts, "t", "words", ["the"])
    all_terms = vocabulary.fit_vocabulary(words, "words", 10, min_df=1, max_df=1.0)
    found = [tuple(r) for r in all_terms.collect()]
    assert found[:2] == [("cat", 3, 3), ("dog_1", 2, 1)]
    assert [f[0] for f in found[2:]] == ["dog", "ran", "sat", "été"]
    assert [r["term"] for r in vocabulary.fit_vocabulary(words, "words", 10, min_df=2, max_df=1.0).collect()] == ["cat"]
    assert vocabulary.fit_vocabulary(words, "words", 10, min_df=1, max_df=0.4).filter("term = 'cat'").count() == 0
    assert vocabulary.fit_vocabulary(words, "words", 3, min_df=1, max_df=1.0).count() == 3


def test_arrays_are_made_once(texts, plan):
    words = vocabulary.tokenize(texts, "t", "words", ["the"])
    assert plan(vocabulary.term_counts(words, "words")).count("regexp_extract_all") == 1


def test_weights(spark):
    rows = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a"]), (3, [])], "id int, terms array<string>")
    found = {(r["id"], r["term"]): r["weight"] for r in vocabulary.tfidf(rows, "id", "terms", min_df=1, max_df=1.0).collect()}
    a, b = 2 * (math.log(4 / 3) + 1), math.log(4 / 2) + 1
    norm = math.sqrt(a * a + b * b)
    assert found == {(1, "a"): pytest.approx(a / norm), (1, "b"): pytest.approx(b / norm), (2, "a"): pytest.approx(1.0)}


def test_fixed_length(spark):
    rows = spark.createDataFrame([(1, ["a", "zz", "b"]), (2, []), (3, ["b"] * 6), (4, None)], "id int, w array<string>")
    ids = {"a": 2, "b": 3}
    found = {r["id"]: r for r in vocabulary.encode_fixed_length(rows, "w", ids, 4).collect()}
    assert found[1]["input_ids"] == [2, 1, 3, 0] and found[1]["attention_mask"] == [1, 1, 1, 0]
    assert found[2]["input_ids"] == [0] * 4 and found[2]["attention_mask"] == [0] * 4
    assert found[3]["input_ids"] == [3] * 4 and found[3]["attention_mask"] == [1] * 4
    assert found[4]["input_ids"] == [0] * 4
    left = {r["id"]: r for r in vocabulary.encode_fixed_length(rows, "w", ids, 4, pad_left=True).collect()}
    assert left[1]["input_ids"] == [0, 2, 1, 3] and left[1]["attention_mask"] == [0, 1, 1, 1]


def test_impute_and_scale(spark):
    rows = spark.createDataFrame([(1.0, 5.0, None), (3.0, 5.0, None), (None, 5.0, None)], "a double, b double, c double")
    assert sorted(r["a"] for r in features.impute_mean(rows, ["a", "b"]).collect()) == [1.0, 2.0, 3.0]
    scales, n = features.fit_scales(rows, ["a", "b", "c"])
    assert n == 3 and [s.column for s in scales] == ["a", "b"]
    assert scales[0].spread == pytest.approx(math.sqrt(2 / 3)) and scales[1].spread == 1.0
    scaled = features.standard_scale(rows, ["a", "b"]).collect()
    assert [r["a"] for r in scaled] == pytest.approx([-math.sqrt(1.5), math.sqrt(1.5), 0.0])
    assert [r["b"] for r in scaled] == [0.0, 0.0, 0.0]


def labelled(spark, n=120):
    word = F.when(F.col("id") % 4 == 0, F.lit("tree tree root")).otherwise(F.lit("number prime"))
    text = F.concat(word, F.lit(" filler"), (F.col("id") % 6).cast("string"))
    return spark.range(n).select(
        F.col("id").alias("problem_id"),
        text.alias("problem_description"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 7).cast("string")).alias("time_limit"),
        (F.col("id") % 4 == 0).cast("int").alias("trees"),
        F.lit(0).alias("games"),
        (F.col("id") % 4).cast("int").alias("number theory"),
    ).withColumn("number theory", (F.col("number theory") != 0).cast("int"))


CONFIG = LabelConfig(labels=("trees", "games", "number theory"), trees=5, depth=3, min_df=2)


def test_features_learn_from_train_only(spark):
    train = labelled(spark).filter("problem_id < 60")
    model = features.fit_features(train, "problem_description", ["time_limit", "absent"], min_df=2)
    test = labelled(spark).withColumn("problem_description", F.lit("unseen words only"))
    vectors = features.assemble_features(test, model, ["time_limit"], ["problem_id"])
    again = features.fit_features(train, "problem_description", ["time_limit"], min_df=2)
    other = features.assemble_features(test, again, ["time_limit"], ["problem_id"])
    arrays = [sorted(tuple(r) for r in v.select("problem_id", vector_to_array("features")).collect()) for v in (vectors, other)]
    assert arrays[0] == arrays[1]
    # Words not in train have no weight; only the scaled number is left.
    assert all(sum(1 for x in values if x) <= 1 for _, values in arrays[0])


def test_transform_needs_no_shuffle(spark, plan):
    model = features.fit_features(labelled(spark), "problem_description", ["time_limit"], min_df=2)
    assert "Exchange" not in plan(features.assemble_features(labelled(spark), model, ["time_limit"], ["problem_id"]))


def test_no_frequent_term_raises(spark):
    with pytest.raises(ValueError, match="no term"):
        features.fit_features(labelled(spark), "problem_description", [], min_df=10_000)


def test_forests_learn_and_survive_saving(spark):
    rows = labelled(spark)
    models = forest.train_forests(rows, CONFIG)
    assert sorted(models.forests) == ["number theory", "trees"]
    assert models.forests["trees"].getNumTrees == 5
    predicted = forest.predict_forests(rows, models, CONFIG)
    assert predicted.columns == [
        "problem_id", "trees", "games", "number theory", "pred_trees", "pred_games", "pred_number theory",
    ]
    good = predicted.filter("trees = pred_trees").count()
    assert good > 110 and predicted.filter("pred_games != 0").count() == 0
    path = new_path(spark, "model")
    save_model(spark, models, path)
    loaded = load_model(spark, path)
    assert loaded.params == models.params
    again = forest.predict_forests(rows, loaded, CONFIG)
    assert again.exceptAll(predicted).count() == 0
    # A feature the new rows lack is imputed; the text column must be there.
    assert forest.predict_forests(rows.drop("time_limit"), loaded, CONFIG).count() == 120
    with pytest.raises(ValueError, match="problem_description"):
        forest.predict_forests(rows.drop("problem_description"), loaded, CONFIG)


def test_label_without_a_model_is_zero(spark):
    model = features.fit_features(labelled(spark), "problem_description", [], min_df=2)
    vectors = features.assemble_features(labelled(spark), model, [], ["problem_id"])
    predicted = forests.predict_per_label(vectors, {}, ["trees"])
    assert predicted.filter("pred_trees = 0").count() == 120 and predicted.columns == ["problem_id", "pred_trees"]


def counting_factory():
    calls = []

    def score(batch):
        calls.append(len(batch))
        return [f"{len(calls)}:{len(batch)}:{text}" for text in batch]

    return score


def test_batches_have_a_fixed_size_and_one_scorer_per_task(spark):
    rows = spark.range(0, 10, 1, 1).select("id", F.concat(F.lit("t"), "id").alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        scored = scoring.score_batches(rows, "text", counting_factory, ["id"], batch_size=4)
        found = [r["raw_model_output"] for r in scored.orderBy("id").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = ["1:4"] * 4 + ["2:4"] * 4 + ["3:2"] * 2
    assert found == [f"{e}:t{i}" for i, e in enumerate(expected)]


def loading_factory():
    import os

    def score(batch):
        return [f"{os.getpid()}:{id(score)}" for _ in batch]

    return score


def test_one_scorer_per_worker_process(spark):
    rows = spark.range(0, 64, 1, 16).select("id", F.lit("t").alias("text"))
    found = scoring.score_batches(rows, "text", loading_factory, ["id"]).collect()
    loads = {r["raw_model_output"] for r in found}
    assert len(loads) == len({load.split(":")[0] for load in loads})


def pair_factory():
    return lambda batch: [[float(sum(row["ids"])), float(len(row["mask"]))] for row in batch]


def test_arrays_as_input(spark):
    rows = spark.createDataFrame([(1, [1, 2], [1]), (2, [], [0, 0])], "id long, ids array<int>, mask array<int>")
    found = scoring.score_batches(rows, ["ids", "mask"], pair_factory, ["id"], 1, "scores", T.ArrayType(T.DoubleType()))
    assert {r["id"]: r["scores"] for r in found.collect()} == {1: [3.0, 1.0], 2: [0.0, 2.0]}


def test_word_ids_of_null_and_empty_lists(spark):
    rows = spark.createDataFrame([(1, ["a", "zz", "b"]), (2, []), (3, None)], "i int, words array<string>").coalesce(1)
    found = vocabulary.encode_fixed_length(rows, "words", {"a": 2, "b": 3}, 4).orderBy("i").collect()
    assert [r["input_ids"] for r in found] == [[2, 1, 3, 0], [0] * 4, [0] * 4]
    assert [sum(r["attention_mask"]) for r in found] == [3, 0, 0]


def answer_factory():
    return lambda batch: ['<output>{"trees": 1}</output>' if "tree" in text else "?" for text in batch]


def test_generative_prediction(spark):
    rows = labelled(spark, 12).drop("games")
    found = scoring.generative_predict(rows, ["problem_description"], ["trees", "games"], answer_factory)
    assert found.columns == ["problem_id", "trees", "pred_trees", "pred_games", "raw_model_output"]
    # Every prompt names the label trees.
    assert found.filter("pred_trees = 1 and pred_games = 0").count() == 12


def test_classification_rows(spark):
    config = LabelConfig(labels=("trees",), text_features=("problem_description",), code_features=(), max_features=50)
    output = F.concat(F.lit('<output>{"trees": '), F.col("trees").cast("string"), F.lit("}</output>"))
    rows = labelled(spark).withColumn("output", output)
    ids = classification.fit_word_ids(rows, config)
    dataset = classification.classification_dataset(rows, ids, config, max_length=8)
    assert dataset.columns == ["problem_id", "input_ids", "attention_mask", "labels", "split"]
    found = dataset.collect()
    assert all(len(r["input_ids"]) == 8 == len(r["attention_mask"]) for r in found)
    assert sum(r["split"] == "validation" for r in found) == 12
    assert all(r["labels"] == [float(r["problem_id"] % 4 == 0)] for r in found)
    with pytest.raises(ValueError, match="output"):
        classification.classification_dataset(rows.drop("output"), ids, config)


def test_kept_columns_pass_unchanged(spark):
    big = 2**62 + 1
    rows = spark.createDataFrame(
        [(big, "a", [1, None]), (None, "bb", None)], "id long, text string, items array<int>"
    ).coalesce(1)
    scored = scoring.score_batches(
        rows, "text", vector_factory, ["id", "items"], 8, "scores", T.ArrayType(T.DoubleType())
    )
    found = sorted((tuple(r) for r in scored.collect()), key=str)
    assert found == sorted([(big, [1, None], [1.0, 0.5]), (None, None, [2.0, 0.5])], key=str)


def vector_factory():
    return lambda batch: [[float(len(text)), 0.5] for text in batch]


def test_vocabulary_cut_is_exact(spark, monkeypatch):
    from collections import Counter

    rnd = random.Random(3)
    texts = [[f"t{int(rnd.paretovariate(0.6)) % 400}" for _ in range(rnd.randint(0, 80))] for _ in range(200)]
    texts += [None, [], [None, "t1", None]]
    df = spark.createDataFrame([(t,) for t in texts], "terms array<string>").repartition(3)
    tf = Counter(w for t in texts for w in t or [] if w is not None)
    found = Counter(w for t in texts for w in {*(t or [])} - {None})
    ranked = sorted(tf, key=lambda w: (-tf[w], w))
    for together in (50, 10**6):
        monkeypatch.setattr(vocabulary, "TERMS_TOGETHER", together)
        for wanted in (1, 2, 17, 60, 150, 10**6):
            made = vocabulary.fit_vocabulary(df, "terms", wanted, min_df=1, max_df=1.0).collect()
            assert [(r["term"], r["tf"], r["df"]) for r in made] == [(w, tf[w], found[w]) for w in ranked[:wanted]]


def test_tfidf_cuts_texts_once(spark, plan, monkeypatch):
    df = spark.createDataFrame([(1, "Cat dog cat"), (2, None), (3, "dog bird"), (None, "cat")], "id long, text string")
    staged, plans = vocabulary.staged, []
    monkeypatch.setattr(vocabulary, "staged", lambda df, name: plans.append(plan(df)) or staged(df, name))
    weights = vocabulary.tfidf(vocabulary.tokenize(df, "text"), "id", "words", min_df=1, max_df=1.0)
    assert sum(p.count("regexp_extract_all") for p in [*plans, plan(weights)]) == 1
    assert "Exchange" not in plan(weights)
    made = {(r["id"], r["term"]): round(r["weight"], 6) for r in weights.collect()}
    assert len(made) == 5 and made[None, "cat"] == 1.0
    assert round(made[1, "cat"] ** 2 + made[1, "dog"] ** 2, 5) == 1
    assert vocabulary.tfidf(vocabulary.tokenize(df, "text"), "id", "words", min_df=9).collect() == []


def test_pairs_are_counted_from_words(spark):
    rows = [
        (1, ["a", "b", "a", "b", None, "c"]),
        (2, ["a b", "a", "b"]),
        (3, []),
        (4, None),
        (5, ["a b", "c", "a", "b c"]),
        (1, ["b"]),
        (None, ["b", "c"]),
    ]
    df = spark.createDataFrame(rows, "id int, words array<string>").repartition(2)
    told = vocabulary.ngrams(df, "words", "terms")
    wanted = {tuple(r) for r in vocabulary.term_counts(told, "terms").collect()}
    assert {tuple(r) for r in vocabulary.term_counts(df, "words", pairs=True).collect()} == wanted
    exploded = told.select("id", F.explode("terms").alias("term")).filter("term IS NOT NULL")
    by_row = {tuple(r) for r in exploded.groupBy("id", "term").agg(F.count("*")).collect()}
    assert {tuple(r) for r in vocabulary.row_terms(df, "id", "words").collect()} == by_row


def test_terms_of_rows_are_not_shuffled(spark, plan):
    df = spark.createDataFrame([(1, ["a", "b"])], "id int, words array<string>")
    text = plan(vocabulary.row_terms(df, "id", "words"))
    assert text.count("Exchange") == 1 and "Generate" not in text


def test_fits_have_no_more_tasks_than_cores(spark, monkeypatch):
    rows = [(i, Vectors.dense([float(i % 7), float(i % 3)]), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, ["id", "features", "y"])
    seen, fit = [], RandomForestClassifier.fit

    def watched(self, given, params=None):
        seen.append((given.rdd.getNumPartitions(), given.count()))
        return fit(self, given, params)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    many = df.repartition(40)
    forests.train_per_label(many, ["y"], "id", trees=2, depth=2)
    assert seen == [(spark.sparkContext.defaultParallelism, 60)]
    monkeypatch.setattr(forests, "ROWS_TOGETHER", 3)
    forests.train_per_label(many, ["y"], "id", trees=2, depth=2)
    assert seen[1] == (20, 60)


def test_classifier_looks_ids_up_where_it_scores(spark, plan):
    ids = {"aa": 2, "bb": 3}
    lists = [["aa", "zz", None, "bb"], [], None, ["bb"] * 9]
    table = spark.createDataFrame(list(enumerate(lists)), "i int, words array<string>")
    encoded = vocabulary.encode_fixed_length(table, "words", ids, 5).orderBy("i").select("input_ids", "attention_mask")
    assert vocabulary.fixed_length_inputs(table, ids, 5)(lists) == [r.asDict() for r in encoded.collect()]

    config = LabelConfig(text_features=("text",), code_features=(), labels=("x",))
    rows = spark.createDataFrame([(1, "aa bb zz"), (2, None), (3, "bb " * 9)], "i int, text string")
    by_columns = vocabulary.encode_fixed_length(classification.with_words(rows, config, ("text",)), "words", ids, 5)
    expected = {r["i"]: int(sum(r["input_ids"]) > 7.5) for r in by_columns.collect()}
    predicted = classifier.classifier_predict(
        rows, ids, lambda: lambda given: [[sum(r["input_ids"]) - 7.5] for r in given], config, max_length=5, batch_size=2
    )
    assert "ArrowEvalPython" not in plan(predicted) and plan(predicted).count("MapInArrow") == 1
    assert {r["i"]: r["pred_x"] for r in predicted.collect()} == expected
    assert set(expected.values()) == {0, 1}


def test_pairs_of_rare_words_are_not_counted(spark, monkeypatch):
    rnd = random.Random(8)
    words = [f"w{min(int(rnd.expovariate(0.08)), 60)}" for _ in range(3000)]
    lists = [[w if rnd.random() > 0.02 else None for w in words[i : i + rnd.choice([0, 1, 2, 40])]] for i in range(0, 3000, 30)]
    whole = []
    count = vocabulary.term_counts
    monkeypatch.setattr(vocabulary, "term_counts", lambda df, terms, pairs=False: whole.append(pairs) or count(df, terms, pairs))

    def fitted(given, **options):
        table = spark.createDataFrame([(i, w) for i, w in enumerate(given)], "id int, words array<string>").repartition(3)
        whole.clear()
        found = [tuple(r) for r in vocabulary.fit_vocabulary(table, "words", pairs=True, **options).collect()]
        all_counted = whole.count(True)
        # Every term counted by itself: the words, and the pairs of neighbours that are both there.
        terms = [None if w is None else [x for x in w if x] + [f"{a} {b}" for a, b in zip(w, w[1:]) if a and b] for w in given]
        plain = spark.createDataFrame([(t,) for t in terms], "terms array<string>")
        assert found == [tuple(r) for r in vocabulary.fit_vocabulary(plain, "terms", **options).collect()] and found
        return all_counted

    for options in ({"max_features": 12, "min_df": 1}, {"max_features": 40, "min_df": 2, "max_df": 0.3}, {"max_features": 5000, "min_df": 3}):
        assert fitted([*lists, None], **options) == 0
    assert fitted([*lists, ["w1 w2", "w3"]], max_features=20, min_df=1) == 1  # a word that equals a pair
    monkeypatch.setattr(vocabulary, "PAIRED_WORDS", 5)
    assert fitted(lists, max_features=30, min_df=2) == 1
