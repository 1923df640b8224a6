"""Periodic runs against brute force."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from labelloom.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words, least_length, least_exponent):
    """(start, length, period) of all maximal stretches, each with its smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least_length, least_exponent * q) and i > start:
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(text, least_length=6, least_exponent=4):
    words = WORD.findall(text or "")
    runs = runs_by_hand(words, least_length, least_exponent)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
    return len(runs), runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(rnd, count):
    for _ in range(count):
        vocabulary = rnd.choice([1, 2, 3, 40])
        words = [f"w{rnd.randrange(vocabulary)}é" for _ in range(rnd.randint(0, 40))]
        if words and rnd.random() < 0.6:
            at, period = rnd.randrange(len(words)), rnd.randint(1, 6)
            again = words[at : at + period]
            words = words[:at] + (again * 12)[: rnd.randint(0, 60)] + words[at:]
        yield "".join(w + rnd.choice([" ", "\n", " \t", "\x0b"]) for w in words)


@pytest.mark.parametrize(("least_length", "least_exponent"), [(6, 4), (2, 2), (9, 3)])
def test_runs_equal_brute_force(spark, monkeypatch, least_length, least_exponent):
    monkeypatch.setattr(periodic, "TOGETHER", 100)
    texts = [*periodic_texts(random.Random(least_length), 300), None, "", " \n", "a", "a " * 6, "a " * 5, "a\xa0a " * 9]
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate([*texts, texts[0]])], "id long, text string, RUNS string")
    made = periodic.collapse_runs(df, "text", least_length, least_exponent)
    assert made.columns == ["id", "text", "n_runs", "runs", "strongest", "collapsed"]
    rows = made.orderBy("id").collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        found = row["n_runs"], [tuple(r) for r in row["runs"]], row["strongest"] and tuple(row["strongest"]), row["collapsed"]
        assert found == expected(row["text"], least_length, least_exponent), row["text"]


@pytest.mark.parametrize(
    ("text", "runs"),
    [
        ("a " * 50_000, [(0, 50_000, 1)]),
        ("x " + "a b c " * 20_000 + "a b y", [(1, 60_002, 3)]),
        (" ".join(f"w{i}" for i in range(50_000)), []),
        ("a b " * 3 + "a a b " * 5, [(4, 17, 3)]),
        (" ".join("a " * n + "b" for n in range(6, 300)), None),
    ],
)
def test_long_texts(text, runs):
    found, _ = next(periodic.collapse([text], 6, 4))
    if runs is None:
        assert len(found) == 294 and set(found[:, 2].tolist()) == {1}
    else:
        assert [tuple(r) for r in found.tolist()] == runs


def test_runs_of_empty_tables_and_bad_limits(spark):
    empty = spark.createDataFrame([], "text string, n_runs string")
    assert periodic.collapse_runs(empty).collect() == []
    with pytest.raises(ValueError):
        periodic.collapse_runs(empty, least_exponent=1)


def test_planted_texts_follow_their_rule(spark):
    from zlib import crc32

    from labelloom.llm.queries import planted

    rows = [(i, " ".join(f"{i}w{j}" for j in range(i % 57))) for i in range(400)] + [(None, "a b"), (16, None), (16, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    changed = 0
    for row in df.select("doc_id", "text", planted(F.col("doc_id"), F.col("text")).alias("made")).collect():
        words = (row["text"] or "").split()
        n, h = len(words), crc32(str(row["doc_id"]).encode())
        if row["doc_id"] is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        assert (row["made"] or "").split() == words
    assert changed > 20
