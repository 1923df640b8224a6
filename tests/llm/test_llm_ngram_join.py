"""The n-gram Jaccard join against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from labelloom.llm import ngram_join
from labelloom.llm.shingles import shingle_sets
from labelloom.llm.words import word_codes

LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text, words):
    own = (text or "").translate(LOWER).split()
    own = [w for w in own if w]
    return {tuple(own[i : i + words]) for i in range(max(len(own) - words + 1, 1))} if own else set()


def joined_by_hand(rows, words, percent):
    """(n_shingles, component_id, n_links) of each row (id, text)."""
    sets = [grams(t, words) for _, t in rows]
    links = [set() for _ in rows]
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and rows[i][0] is not None and rows[j][0] is not None and 100 * len(x & y) >= percent * len(x | y):
                links[i].add(j)
                links[j].add(i)
    results = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        results.append((len(sets[i]), None if own is None else min(rows[j][0] for j in seen), len(links[i])))
    return results


def near_copies(rnd, count, base, changes):
    for _ in range(count):
        own = list(base)
        for _ in range(rnd.randint(0, changes)):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(10**6)}"
        yield " ".join(own)


def corpus(seed):
    rnd = random.Random(seed)
    texts = [None, "", " \n", "One", "one", "one two", "ONE TWO", "a b c d e", "É é", "é é"]
    shared = " ".join(f"s{i}" for i in range(25))
    for group, (count, length, changes) in enumerate([(70, 120, 8), (40, 60, 3), (30, 15, 1), (12, 400, 40), (6, 6, 1)]):
        texts += near_copies(rnd, count, [f"g{group}w{i}" for i in range(length)], changes)
    for i in range(60):
        own = " ".join(f"r{i}w{k}" for k in range(rnd.randint(5, 90)))
        texts.append(f"{own} {shared} end{i}" if i % 2 else own)
    texts += [texts[20]] * 9 + [texts[20].upper()]
    rnd.shuffle(texts)
    rows = [(3 * i + 7, t) for i, t in enumerate(texts)]
    return rows + [rows[5], (None, rows[30][1]), (None, None)]


@pytest.mark.parametrize(
    ("percent", "words", "least", "most", "long", "block", "group"),
    [(80, 5, 8, 32, 64, 128, 256), (80, 5, 2, 4, 5, 7, 6), (80, 5, 1, 1, 2, 3, 1), (60, 3, 3, 6, 10, 16, 30), (100, 5, 8, 12, 8, 4, 5), (85, 1, 4, 40, 20, 9, 15)],
)
def test_join_equals_brute_force(spark, monkeypatch, percent, words, least, most, long, block, group):
    for name, value in (("LEAST", least), ("MOST", most), ("BLOCK", block), ("COLUMNS", 50), ("GROUP", group)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(least)
    df = spark.createDataFrame([(i, t, k, "mine") for k, (i, t) in enumerate(rows)], "doc_id long, text string, at int, N_links string")
    made = ngram_join.join_components(df, words=words, percent=percent, long=long)
    assert made.columns == ["doc_id", "at", "n_shingles", "component_id", "n_links"]
    found = {r["at"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in made.collect()}
    expected = joined_by_hand(rows, words, percent)
    assert len(found) == len(rows)
    for k, row in enumerate(rows):
        assert found[k] == expected[k], (k, row)
    assert any(n > 8 for _, _, n in expected)


def test_a_large_group_makes_no_pairs(spark, monkeypatch):
    """500 near copies: none of their pairs is written, blocks are compared instead."""
    tables = {}

    def watched(df, name):
        tables.setdefault(name, []).append(written(df, name))
        return tables[name][-1]

    written = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", watched)
    rnd = random.Random(9)
    texts = list(near_copies(rnd, 500, [f"w{i}" for i in range(200)], 6))
    rows = list(enumerate(texts))
    made = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"))
    found = Counter((r["component_id"], r["n_links"]) for r in made.collect())
    assert found == Counter((c, n) for _, c, n in joined_by_hand(rows, 5, 80))
    assert tables["pairs"][0].count() < 3 * 500
    assert tables["meeting"][0].count() <= 10
    assert tables["cells"][0].count() < 10 * 4 * 128


def test_a_list_longer_than_a_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(i, " ".join(f"w{k}" for k in range(20)) + f" e{i}") for i in range(60)] + [(99, "w0 w1 w2 w3 w4 w5")]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for long in (2, 20, 64):
            found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.join_components(df, long=long).collect()}
            assert [found[i] for i, _ in rows] == joined_by_hand(rows, 5, 80)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_overlaps_are_counts(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 3)
    rnd = random.Random(4)
    sets, others = ([np.array(sorted(rnd.sample(range(-20, 20), rnd.randint(0, 15)))) for _ in range(9)] for _ in range(2))
    made = ngram_join.overlaps(sets, others)
    assert made.tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in others] for x in sets]


def test_empty_tables_and_bad_arguments(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert ngram_join.join_components(empty).collect() == []
    with pytest.raises(ValueError):
        ngram_join.join_components(empty, percent=50)
    with pytest.raises(ValueError):
        ngram_join.join_components(empty, id_column="source")


def test_sets_are_those_of_the_shingles_and_leave_no_words_behind():
    rng = random.Random(7)
    known = ["a", "B", "b", "\u00c4", "\u00e4", "eight888", "fifteen-letters", "sixteen--letters", "SIXTEEN--LETTERS", "longer than it"[:6] * 9, "\x00", "x\u00a0y", "x\x1fy"]
    gaps = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "  \n"]
    texts = [None, "", " \t ", "a", "b a", " A\nb a  "]
    texts += ["".join(rng.choice(known) + rng.choice(gaps) for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    held = len(word_codes().place)
    for words in (1, 2, 3, 5):
        named, numbers = {}, set()
        for text, own in zip(texts, shingle_sets(texts, words), strict=True):
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
            wanted = {tuple(lowered[i : i + words]) for i in range(max(len(lowered) - words + 1, 1))} if lowered else set()
            assert len(own) == len(wanted) and list(own) == sorted(set(own.tolist()))
            named.setdefault(frozenset(wanted), set()).add(own.tobytes())
            numbers.update(own.tolist())
        assert all(len(made) == 1 for made in named.values())
        assert len(numbers) == len(set().union(*named))
        alone = [shingle_sets([text], words)[0].tolist() for text in texts]
        assert alone == [own.tolist() for own in shingle_sets(texts, words)]
    assert shingle_sets([], 5) == []
    shingle_sets([" ".join(f"word{i} and-a-longer-one-{i}" for i in range(2000))], 5)
    assert len(word_codes().place) == held
