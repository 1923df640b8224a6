"""Tokens, vocabularies, features, models and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.metrics import rounded
from checks.text import PROMPT_COLUMNS, PROMPT_SQL, prompt_rows
from checks.views import DOCUMENTS, FLAGS, SCORED_SQL, scored, table
from labelloom.functions.values import named
from labelloom.operators import features, forests, scoring, vocabulary
from labelloom.operators.sampling import chronological_split, undersample_majority
from labelloom.plans.forest import predict_forests, train_forests
from labelloom.session import new_path, staged
from labelloom.sources.models import load_model, save_model

# A fixed short list, so that the SQL can name it.
STOP_WORDS = ("the", "and", "of", "in", "le", "la", "les", "der", "die", "und", "el", "que")
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
WORDS_SQL = f"""
words AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                             lambda w: w NOT IN ({_STOPS})) AS words
  FROM documents)"""


def terms_sql(fitted: str) -> str:
    """Terms of all documents, and the vocabulary of the fitted ones."""
    return f"""{WORDS_SQL},
placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM words),
terms AS (
  SELECT doc_id, word AS term FROM placed
  UNION ALL
  SELECT a.doc_id, a.word || ' ' || b.word FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
n_docs AS (SELECT count(*) AS n FROM {fitted}),
vocabulary AS (
  SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df
  FROM terms WHERE doc_id IN (SELECT doc_id FROM {fitted}) GROUP BY term
  HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) <= 0.8 * (SELECT n FROM n_docs)
  ORDER BY tf DESC, term LIMIT 5000)"""


TERMS_SQL = terms_sql("documents")


def words(spark, sf):
    return vocabulary.tokenize(table(spark, sf, "documents"), "text", "words", STOP_WORDS)


def terms(spark, sf):
    return vocabulary.ngrams(words(spark, sf)).select("doc_id", "terms")


@query("tokenize", f"WITH {WORDS_SQL} SELECT doc_id, array_to_string(words, ' ') AS words FROM words")
def tokenize(spark, sf):
    return words(spark, sf).select("doc_id", F.array_join("words", " ").alias("words"))


@query(
    "ngrams",
    f"WITH {TERMS_SQL} SELECT doc_id, term, count(*) AS n FROM terms GROUP BY doc_id, term",
)
def ngrams(spark, sf):
    return vocabulary.row_terms(words(spark, sf), "doc_id", "words")


@query("fit_vocabulary", f"WITH {TERMS_SQL} SELECT term, tf, df FROM vocabulary")
def fit_vocabulary(spark, sf):
    return vocabulary.fit_vocabulary(words(spark, sf), "words", pairs=True)


@query(
    "tfidf",
    f"""WITH {TERMS_SQL},
    weighted AS (
      SELECT t.doc_id, t.term, count(*) * (ln((1.0 + (SELECT n FROM n_docs)) / (1.0 + v.df)) + 1.0) AS w
      FROM terms t JOIN vocabulary v ON t.term = v.term GROUP BY t.doc_id, t.term, v.df)
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM weighted""",
)
def tfidf(spark, sf):
    return rounded(vocabulary.tfidf(terms(spark, sf), "doc_id", "terms"))


TEXT_IDS_SQL = """
tokens AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM tokens),
ids AS (
  SELECT term, 1 + row_number() OVER (ORDER BY tf DESC, term) AS id
  FROM (SELECT word AS term, count(*) AS tf FROM placed GROUP BY word ORDER BY tf DESC, term LIMIT 5000)),
coded AS (
  SELECT p.doc_id, p.pos, coalesce(i.id, 1) AS id FROM placed p LEFT JOIN ids i ON p.word = i.term WHERE p.pos <= 512),
joined AS (
  SELECT doc_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS ids, count(*) AS n FROM coded GROUP BY doc_id)"""
ENCODED_SQL = """coalesce(j.ids, '') || CASE WHEN coalesce(j.n, 0) IN (0, 512) THEN '' ELSE ',' END
       || rtrim(repeat('0,', CAST(512 - coalesce(j.n, 0) AS BIGINT)), ',') AS input_ids, coalesce(j.n, 0) AS n_tokens"""


@query(
    "encode_fixed_length",
    f"""WITH {TEXT_IDS_SQL}
    SELECT d.doc_id, {ENCODED_SQL} FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id""",
)
def encode_fixed_length(spark, sf):
    rows = vocabulary.tokenize(table(spark, sf, "documents"), "text", "words", stop_words=())
    rows = rows.select("doc_id", "words")
    ids = vocabulary.word_ids(vocabulary.fit_vocabulary(rows, "words", min_df=1, max_df=1.0))
    encoded = vocabulary.encode_fixed_length(rows, "words", ids, 512)
    return encoded.select(
        "doc_id",
        F.array_join(F.transform("input_ids", lambda x: x.cast("string")), ",").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_tokens"),
    )


# ---- numeric features --------------------------------------------------------------

GAPS_SQL = """
gaps AS (
  SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS DOUBLE) END AS size,
         CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS price, 7.0 AS constant FROM part)"""


def _gaps(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("size"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice").cast("string")).otherwise("?").alias("price"),
        F.lit(7.0).alias("constant"),
    )


_FILLED = "coalesce({c}, avg({c}) OVER ())"


@query(
    "impute_mean",
    f"""WITH {GAPS_SQL} SELECT p_partkey, constant, round({_FILLED.format(c="size")}, 6) AS size,
        round({_FILLED.format(c="price")}, 6) AS price FROM gaps""",
)
def impute_mean(spark, sf):
    return rounded(features.impute_mean(_gaps(spark, sf), ["size", "price", "constant"]))


@query(
    "standard_scale",
    f"""WITH {GAPS_SQL}, filled AS (
      SELECT p_partkey, {_FILLED.format(c="size")} AS size, {_FILLED.format(c="price")} AS price FROM gaps)
    SELECT p_partkey, 0.0 AS constant,
           round((size - avg(size) OVER ()) / stddev_pop(size) OVER (), 6) AS size,
           round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) AS price FROM filled""",
)
def standard_scale(spark, sf):
    scaled = features.standard_scale(_gaps(spark, sf), ["size", "price", "constant"])
    # Adding 0.0 turns -0.0 into 0.0.
    return rounded(scaled).select(
        "p_partkey", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("size", "price", "constant")]
    )


# ---- models (no SQL can fit a forest; tests check their invariants) -----------------


def _split(spark, sf):
    split = chronological_split(scored(spark, sf), ["n_chars", "doc_id"])
    return split.filter("split = 'train'"), split.filter("split = 'test'")


TRAIN_SQL = """
ranked AS (SELECT *, row_number() OVER (ORDER BY n_chars, doc_id) AS rank, count(*) OVER () AS n FROM documents),
train AS (SELECT * FROM ranked WHERE rank <= floor(n * 0.75)),
test AS (SELECT * FROM ranked WHERE rank > floor(n * 0.75))"""


def _block_sql(fitted: str, applied: str) -> str:
    """Terms of a document that the vocabulary has, and its scaled length."""
    return f"""found AS (
      SELECT t.doc_id, count(DISTINCT t.term) AS n FROM terms t JOIN vocabulary v ON t.term = v.term GROUP BY t.doc_id)
    SELECT d.doc_id, (SELECT count(*) FROM vocabulary) + 1 AS n_features, coalesce(f.n, 0) AS n_terms,
           round((d.n_chars - (SELECT avg(n_chars) FROM {fitted})) / (SELECT stddev_pop(n_chars) FROM {fitted}), 6)
             AS scaled_length
    FROM {applied} d LEFT JOIN found f ON d.doc_id = f.doc_id"""


def _blocks(vectors):
    """The same from feature vectors, which may be sparse or dense."""
    return vectors.select("doc_id", F.unwrap_udt("features").alias("v")).selectExpr(
        "doc_id",
        "if(v.type = 0, v.size, size(v.values)) AS n_features",
        """if(v.type = 0, size(filter(v.indices, i -> i < v.size - 1)),
              size(filter(slice(v.values, 1, size(v.values) - 1), x -> x != 0))) AS n_terms""",
        """round(if(v.type = 1 OR element_at(v.indices, -1) = v.size - 1, element_at(v.values, -1), 0D), 6)
              AS scaled_length""",
    )


@query("assemble_features", f"WITH {TERMS_SQL}, {_block_sql('documents', 'documents')}")
def assemble_features(spark, sf):
    rows = scored(spark, sf)
    model = features.fit_features(rows, "text", ["n_chars"], stop_words=STOP_WORDS)
    return _blocks(features.assemble_features(rows, model, ["n_chars"], ["doc_id"]))


@query("fit_transform_split", f"WITH {TRAIN_SQL}, {terms_sql('train')}, {_block_sql('train', 'test')}")
def fit_transform_split(spark, sf):
    train, test = _split(spark, sf)
    model = features.fit_features(train, "text", ["n_chars"], stop_words=STOP_WORDS)
    return _blocks(features.assemble_features(test, model, ["n_chars"], ["doc_id"]))


def _vectors(spark, sf):
    rows = scored(spark, sf)
    model = features.fit_features(rows, "text", ["n_chars"], stop_words=STOP_WORDS)
    return staged(features.assemble_features(rows, model, ["n_chars"], ["doc_id", *FLAGS]), "features")


_CLASSES_SQL = " UNION ALL ".join(
    f"""SELECT '{f}' AS label, sum("{f}") AS ones, count(*) - sum("{f}") AS zeros FROM scored""" for f in FLAGS
)


@query(
    "train_per_label",
    f"""WITH {SCORED_SQL}, classes AS ({_CLASSES_SQL})
    SELECT label, 200 AS n_trees, 2 AS n_classes, CAST(2 * least(ones, zeros) AS BIGINT) AS n_rows
    FROM classes WHERE least(ones, zeros) > 0""",
)
def train_per_label(spark, sf):
    vectors = _vectors(spark, sf)
    models = forests.train_per_label(vectors, FLAGS, "doc_id")
    made = [(label, m.getNumTrees, m.numClasses) for label, m in models.items()]
    balanced = undersample_majority(vectors, list(models), "doc_id")
    kept = [F.struct(F.lit(m).alias("label"), F.count_if(named(f"keep_{m}")).alias("n_rows")) for m in models]
    used = balanced.agg(F.array(*kept).alias("kept")).select(F.inline("kept"))
    return spark.createDataFrame(made, "label string, n_trees int, n_classes int").join(used, "label")


def learned(predicted, labels):
    """Per label the rows predicted, and whether rows that have it are predicted to more often."""
    cells = []
    for label in labels:
        hit, flag = named(f"pred_{label}"), named(label)
        rates = [F.coalesce(F.avg(F.when(flag == side, hit)), F.lit(0.0)) for side in (1, 0)]
        cells.append(
            F.struct(F.lit(label).alias("label"), F.count(hit).alias("n_rows"), (rates[0] > rates[1]).alias("learned"))
        )
    return predicted.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query(
    "predict_per_label",
    f"""WITH {SCORED_SQL}, classes AS ({_CLASSES_SQL})
    SELECT label, CAST(ones + zeros AS BIGINT) AS n_rows, label <> 'toxic' AND least(ones, zeros) > 0 AS learned
    FROM classes""",
)
def predict_per_label(spark, sf):
    vectors = _vectors(spark, sf)
    models = forests.train_per_label(vectors, FLAGS, "doc_id")
    models.pop("toxic", None)
    return learned(forests.predict_per_label(vectors, models, FLAGS), FLAGS)


@query("save_load_model", "SELECT count(*) AS n_rows, 0 AS n_different FROM documents")
def save_load_model(spark, sf):
    rows = scored(spark, sf)
    models = train_forests(rows, DOCUMENTS, stop_words=STOP_WORDS)
    path = new_path(spark, "model")
    save_model(spark, models, path)
    before = predict_forests(rows, models, DOCUMENTS)
    after = predict_forests(rows, load_model(spark, path), DOCUMENTS)
    mine = before.select("doc_id", F.struct(*[named(c) for c in DOCUMENTS.prediction_columns]).alias("p"))
    other = after.select("doc_id", F.struct(*[named(c) for c in DOCUMENTS.prediction_columns]).alias("q"))
    both = mine.join(other, "doc_id")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("p").eqNullSafe(F.col("q"))).alias("n_different"))


# ---- scoring with a caller's model --------------------------------------------------


def length_scorer():
    """A scorer whose answers follow from the length of the text."""

    def score(texts):
        return [
            f'<output>{{"quality": {len(t) % 2}, "long text": {int(len(t) % 3 == 0)}}}</output>' for t in texts
        ]

    return score


@query(
    "score_batches",
    """SELECT doc_id, lang, '<output>{"quality": ' || CAST(length(text) % 2 AS VARCHAR) || ', "long text": '
       || CAST(CAST(length(text) % 3 = 0 AS INTEGER) AS VARCHAR) || '}</output>' AS raw_model_output FROM documents""",
)
def score_batches(spark, sf):
    return scoring.score_batches(table(spark, sf, "documents"), "text", length_scorer, ["doc_id", "lang"], 8)


@query(
    "generative_predict",
    f"""WITH {SCORED_SQL}, prompts AS (SELECT *, length({PROMPT_SQL}) AS n FROM scored)
    SELECT doc_id, quality, toxic, english, "long text", n % 2 AS pred_quality, 0 AS pred_toxic, 0 AS pred_english,
           CAST(n % 3 = 0 AS INTEGER) AS "pred_long text",
           '<output>{{"quality": ' || CAST(n % 2 AS VARCHAR) || ', "long text": '
           || CAST(CAST(n % 3 = 0 AS INTEGER) AS VARCHAR) || '}}</output>' AS raw_model_output
    FROM prompts""",
)
def generative_predict(spark, sf):
    return scoring.generative_predict(
        prompt_rows(spark, sf), PROMPT_COLUMNS, FLAGS, length_scorer, "doc_id", batch_size=4
    )
