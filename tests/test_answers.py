import pytest

from labelloom.operators.answers import labels_from_output, parse_model_output, parse_status


def wrapped(body):
    return f"<output>{body}</output>"


# text, [a, "b c"], status
CASES = [
    (wrapped('{"a": 1, "b c": 0}'), [1, 0], "tagged"),
    ('x <OUTPUT>\n {"a":1}\n </Output> y', [1, 0], "tagged"),
    (wrapped('{"a": true, "b c": "1"}'), [1, 1], "tagged"),
    (wrapped('{"a": 1.9}'), [1, 0], "tagged"),
    (wrapped('{"a": "1.9", "b c": 1}'), [0, 0], "error"),
    (wrapped('{"a": null, "b c": 1}'), [0, 0], "error"),
    (wrapped('{"a": 2, "b c": 1}'), [0, 0], "error"),
    (wrapped('{"a": 1,}'), [0, 0], "error"),
    (wrapped('{"a": 1, "a": 0, "b c": 1}'), [0, 1], "tagged"),
    (wrapped('{"a": 1} x}'), [0, 0], "error"),
    (wrapped('{"z": {"q": 1}, "a": 1}'), [1, 0], "tagged"),
    ('{"a": 1}', [1, 0], "fallback"),
    ('{"z": {"q": 1}, "a": 1}', [0, 0], "error"),
    (wrapped('```json\n{"a": 1}\n```'), [1, 0], "fallback"),
    ('<output>{"a": 1', [0, 0], "error"),
    ("none", [0, 0], "error"),
    ("", [0, 0], "error"),
    (None, [0, 0], "error"),
    (wrapped('{"a": [1]}'), [0, 0], "error"),
    (wrapped('{"a": {"k":{"j":1}}, "b c":1}'), [0, 0], "error"),
    (wrapped('{"z":"}{", "a":1}'), [1, 0], "tagged"),
    (wrapped('{"z": "q\\"}", "a":1}'), [1, 0], "tagged"),
    (wrapped('{"a":1}{"a":0}'), [0, 0], "error"),
    (wrapped("{}"), [0, 0], "tagged"),
    (wrapped("{'a':1}"), [0, 0], "error"),
    (wrapped('{"z":NaN,"a":1}'), [1, 0], "tagged"),
    (wrapped('{"a":-0.5,"b c":" 1 "}'), [0, 1], "tagged"),
    (wrapped('{"a":2147483648}'), [0, 0], "error"),
    (wrapped('{"a":""}'), [0, 0], "error"),
    (wrapped('{"z":{"y":{"x":{"w":{"v":1}}}},"a":1}'), [1, 0], "tagged"),
    (wrapped('{"z":' * 12 + "{}" + "}" * 11 + ',"a":1}'), [1, 0], "tagged"),
    (wrapped('{"a":1}, {"b c":1}'), [0, 0], "error"),
    (wrapped('{"z":"' + "long \\\\" * 20000 + "\\n{" * 20000 + '","a":1}'), [1, 0], "tagged"),
]
# Cases where a vector differs: no fallback, and values must be exactly 0 or 1.
VECTOR_ZERO = {'{"a": 1}', wrapped('{"a": 1.9}'), wrapped('```json\n{"a": 1}\n```'), wrapped('{"a":-0.5,"b c":" 1 "}')}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")


def test_labels_and_status(rows):
    parsed = parse_model_output(rows, "t", ["a", "b c"]).orderBy("i").collect()
    for row, (text, labels, status) in zip(parsed, CASES, strict=True):
        assert ([row["pred_a"], row["pred_b c"]], row["parse_status"]) == (labels, status), text


def test_status_counts(rows):
    counts = {r[0]: r[1] for r in parse_status(rows, "t", ["a", "b c"]).collect()}
    for status in ("tagged", "fallback", "error"):
        assert counts[status] == sum(c[2] == status for c in CASES)


def test_vectors(rows):
    parsed = labels_from_output(rows, "t", ["a", "b c"]).orderBy("i").collect()
    for row, (text, labels, _) in zip(parsed, CASES, strict=True):
        expected = [0.0, 0.0] if text in VECTOR_ZERO else [float(x) for x in labels]
        assert row["labels"] == expected, text


def test_vector_accepts_a_number_in_a_string(spark):
    rows = spark.createDataFrame([(wrapped('{"a": "1.0"}'),)], "t string")
    assert labels_from_output(rows, "t", ["a"]).first()["labels"] == [1.0]
    assert parse_model_output(rows, "t", ["a"]).first()["parse_status"] == "error"


def test_parsing_needs_no_shuffle_and_no_python(rows, plan):
    text = plan(parse_model_output(rows, "t", ["a", "b c"]))
    assert "Exchange" not in text and "Python" not in text


def test_last_of_a_repeated_key_counts_by_its_kind(spark):
    body = ['{"a": 1, "a": true}', '{"a": 0, "a": "true"}', '{"a": 1, "a": false}', '{"a": 1, "a": 2}']
    rows = spark.createDataFrame([(i, wrapped(b)) for i, b in enumerate(body)], "i int, text string")
    found = parse_model_output(rows, "text", ["a"]).orderBy("i").collect()
    assert [(r["pred_a"], r["parse_status"]) for r in found] == [(1, "tagged"), (0, "error"), (0, "tagged"), (0, "error")]
