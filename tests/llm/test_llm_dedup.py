"""Substring, line and near-duplicate removal against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest

from labelloom.llm import lines, near_duplicates, shingles, substrings
from labelloom.llm import words as word_numbers
from labelloom.llm.components import smallest_reachable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def removed_by_hand(texts, window):
    split = [WORD.findall(t or "") for t in texts]
    starts = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    kept = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept.append([x for i, x in enumerate(w) if i not in gone])
    return split, kept


def test_words_are_numbered_where_they_stand(monkeypatch):
    rnd = random.Random(3)
    letters = [*"ab\x00\x1f\x0e\u00a0\u4e2d\U0001f600", " ", "\t", "\x0b", "\r"]
    texts = ["", " ", "a", "\na" * 9, *["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(500)]]
    texts += [c * n + end for c in "ab\x00" for n in range(1, 40) for end in ("", "c", "\x00")]
    raw = "\n".join(texts).encode()
    begins, ends = word_numbers.word_bounds(raw)
    found = [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
    assert found == raw.split()
    digested = []
    monkeypatch.setattr(word_numbers, "word_codes", lambda: lambda own, digest=word_numbers.WordCodes(): digested.extend(own) or digest(own))
    codes = word_numbers.codes_at(raw, begins, ends)
    for lane in (0, 1):
        by_word = dict(zip(found, codes[:, lane].tolist()))
        assert len(set(by_word.values())) == len(by_word)
        assert [by_word[w] for w in found] == codes[:, lane].tolist()
    assert digested and min(map(len, digested)) > word_numbers.SHORT


def passages(rnd, count, vocabulary, longest):
    """Texts put together from a few passages and random words."""
    stock = [[rnd.choice(vocabulary) for _ in range(rnd.randint(5, longest))] for _ in range(8)]
    texts = []
    for _ in range(count):
        words = []
        for _ in range(rnd.randint(0, 4)):
            own = rnd.choice(stock) if rnd.random() < 0.4 else [rnd.choice(vocabulary) for _ in range(rnd.randint(0, longest))]
            at = rnd.randint(0, len(own)) if rnd.random() < 0.3 else 0
            words += own[at:]
        texts.append("".join(w + rnd.choice([" ", "\n", "\t ", "\x0b"]) for w in words))
    return texts


@pytest.mark.parametrize(("window", "words", "seed"), [(35, 4000, 1), (20, 30, 2), (5, 4, 3), (16, 2, 4)])
def test_substrings_equal_brute_force(spark, monkeypatch, window, words, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(substrings, "TOGETHER", 200)
    monkeypatch.setattr(substrings, "GATHERED", 300)
    texts = passages(rnd, 60, [f"w{i}é" for i in range(words)], 3 * window)
    texts += [None, "", " \n", "a", texts[3], texts[3], "same " * (2 * window + 1), "once " * window]
    rows = [(i if i % 9 else None, t, 7, "x") for i, t in enumerate(texts)] + [(1, texts[1], 7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_WORDS int, extra string")
    marked = docs.selectExpr("*", "monotonically_increasing_id() AS row").repartition(5).cache()
    order = {r["row"]: r for r in marked.collect()}
    split, kept = removed_by_hand([order[k]["text"] for k in sorted(order)], window)
    got = {r["row"]: r for r in substrings.remove_repeats(marked, window).collect()}
    assert len(got) == len(rows)
    for k, words_in, words_kept in zip(sorted(order), split, kept, strict=True):
        row = got[k]
        assert WORD.findall(row["text"] or "") == words_kept
        assert (row["n_words"], row["n_removed"]) == (len(words_in), len(words_in) - len(words_kept))
        if words_in == words_kept:
            assert row["text"] == order[k]["text"]
    marked.unpersist()


def test_substrings_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(docs).columns == ["doc_id", "text", "n_words", "n_removed"]
    assert substrings.remove_repeats(docs).count() == 0


def test_levels_double_up_to_the_window():
    assert substrings.level_lengths(35) == [9, 18]
    assert substrings.level_lengths(8) == []


def later_lines_by_hand(docs, percent):
    sets = [(d, i, frozenset(WORD.findall(line))) for d, t in docs for i, line in enumerate((t or "").split("\n"))]
    sets = sorted((x for x in sets if x[2]), key=lambda x: (x[0] is not None, x[0], x[1]))
    kept = set()
    for k, (d, i, own) in enumerate(sets):
        if not any(100 * len(own & e) >= percent * len(own | e) for _, _, e in sets[:k]):
            kept.add((d, i))
    return kept


def similar_lines(rnd, count, vocabulary):
    stock = [[rnd.choice(vocabulary) for _ in range(rnd.randint(1, 25))] for _ in range(12)]
    made = []
    for _ in range(count):
        own = list(rnd.choice(stock)) if rnd.random() < 0.7 else [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 20))]
        for _ in range(rnd.randint(0, 4)):
            if own:
                own[rnd.randrange(len(own))] = rnd.choice([*vocabulary, "new", "newer"])
        made.append(" ".join(own))
    return made


@pytest.mark.parametrize(("few", "words", "seed"), [(32, 60, 1), (1, 40, 2), (3, 400, 3)])
def test_lines_equal_brute_force(spark, monkeypatch, few, words, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(lines, "FEW", few)
    pool = similar_lines(rnd, 260, [f"v{i}" for i in range(words)])
    docs = [(i, "\n".join(rnd.choices(pool, k=rnd.randint(0, 9)))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "\n \n\t"), (None, pool[0] + "\n" + pool[1])]
    table = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_lines int").repartition(3)
    kept = later_lines_by_hand(docs, 80)
    got = {(r["doc"], r["line"]) for r in lines.kept_lines(table).collect()}
    assert got == kept
    if seed == 1:
        changed = {r["doc_id"]: r for r in lines.remove_near_lines(table).collect()}
        for d, t in docs:
            own = (t or "").split("\n")
            left = [x for i, x in enumerate(own) if not WORD.search(x) or (d, i) in kept]
            worded = sum(bool(WORD.search(x)) for x in own)
            assert changed[d]["text"] == (None if t is None else "\n".join(left))
            assert (changed[d]["n_lines"], changed[d]["n_removed"]) == (worded, len(own) - len(left))


@pytest.mark.parametrize("percent", [50, 34, 20])
def test_lines_that_need_to_share_one_frequent_word_only(spark, monkeypatch, percent):
    monkeypatch.setattr(lines, "FEW", 1)
    rnd = random.Random(percent)
    docs = [(0, "a x y z p q r s"), (1, "a b"), (2, "a"), (3, "a c\nc"), (4, "c d e")]
    docs += [(5 + i, " ".join(rnd.choices([f"v{k}" for k in range(40)], k=rnd.choice([1, 2, 3, 8])))) for i in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc"], r["line"]) for r in lines.kept_lines(table, percent=percent).collect()}
    assert got == later_lines_by_hand(docs, percent)


def test_lines_meet_by_their_words_in_one_shuffle_and_pairs_by_two(spark, plan, monkeypatch):
    rnd = random.Random(5)
    vocabulary = [f"v{k}" for k in range(400)]
    docs = [(i, " ".join(rnd.sample(vocabulary, rnd.randint(150, 300)))) for i in range(60)]
    docs += [(60 + i, docs[i][1] + " more") for i in range(5)]
    made = []
    monkeypatch.setattr(lines, "written", lambda df, name, write=lines.written: made.append((name, df)) or write(df, name))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc"], r["line"]) for r in lines.kept_lines(table).collect()}
    assert got == later_lines_by_hand(docs, 80)
    assert max(plan(df).count("Exchange hashpartitioning(word") for _, df in made) == 1
    prefix = {r["id"]: set(r["prefix"][: r["n"] - -(-80 * r["n"] // 100) + 2]) for r in dict(made)["sets"].collect()}
    pairs = dict(made)["pairs"].collect()
    assert pairs and all(len(prefix[p["id"]] & prefix[p["other"]]) >= 2 for p in pairs)


def test_lines_that_share_one_word_do_not_meet_and_similar_ones_do(spark):
    own = [" ".join(f"v{i}_{k}" for k in range(40)) + " same" for i in range(30)]
    docs = [*enumerate(own), (30, own[0].replace("v0_3 ", "other ")), (31, own[1] + " more and more")]
    sets = lines._sets(spark.createDataFrame(docs, "doc long, text string"), 80)
    met = {}
    for r in lines._rows(sets, 80).collect():
        met.setdefault(r["words"], set()).add(r["id"]["doc"])
    assert {frozenset(m) for m in met.values() if len(m) > 1} == {frozenset({0, 30}), frozenset({1, 31})}


def test_lines_leave_few_tables_and_sizes_do_not_hide_long_lines(spark, monkeypatch):
    from pathlib import Path

    made, real = [], lines.written
    monkeypatch.setattr(lines, "written", lambda df, name: made.append((name, real(df, name))) or made[-1][1])
    # More words than a packed size can hold, and a frequent pair of words that few lines settle.
    monkeypatch.setattr(lines, "FEW", 2)
    long = [f"w{k}" for k in range(lines.SIZED + 100)]
    docs = [(0, " ".join(long)), (1, " ".join(long[60:])), (2, " ".join(long[:200]))]
    docs += [(3 + i, " ".join(["same", "pair", *[f"u{i}x{k}" for k in range(2)]])) for i in range(20)]
    docs += [(30 + i, docs[3 + i][1] + " u") for i in range(9)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    left = {r["doc_id"] for r in lines.remove_near_lines(table).collect() if not r["n_removed"]}
    assert left == {d for d, _ in later_lines_by_hand(docs, 80)} and left == {0, 2, *range(3, 23)}
    there = {name for name, df in made for f in df.inputFiles() if Path(f.removeprefix("file://").removeprefix("file:")).exists()}
    assert "kept" in there and not there & {"sets", "met", "lines", "settled"}


def test_lines_of_an_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lines.remove_near_lines(docs).count() == 0
    twice = spark.createDataFrame([(1, "a b\na b")] * 2, "doc_id long, text string")
    assert [r["text"] for r in lines.remove_near_lines(twice).collect()] == ["a b"] * 2


def shingles_by_hand(text, words=5):
    own = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(own) < words:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + words]) for i in range(len(own) - words + 1)}


def components_by_hand(docs, percent):
    sets = {d: shingles_by_hand(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(11)
    monkeypatch.setattr(shingles, "TOGETHER", 300)
    vocabulary = [f"W{i}" for i in range(500)]
    docs = []
    for d in range(14):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 30, 80, 200]))]
        for _ in range(rnd.randint(1, 9)):
            # Chains: each copy is changed a little more, so ends may only be linked through others.
            if rnd.random() < 0.8 and len(base) > 20:
                for _ in range(rnd.randint(0, 2)):
                    base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
            docs.append(" ".join(base) if rnd.random() < 0.7 else " ".join(base).lower())
    rnd.shuffle(docs)
    docs = list(enumerate(docs)) + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "x")]
    table = spark.createDataFrame([(d, t, "old") for d, t in docs], "doc_id long, text string, KEPT string").repartition(4)
    component, size = components_by_hand(docs, 80)
    got = {r["doc_id"]: r for r in near_duplicates.components(table, collections=24).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == component
    assert {d: r["n_shingles"] for d, r in got.items()} == size
    assert all(r["kept"] == (d == component[d]) for d, r in got.items())


def test_near_duplicates_miss_one_pair_in_a_million_at_most():
    given = near_duplicates.enough_collections
    assert given(80, 3) == 24 and near_duplicates.miss_rate(24, 3, 80) < 1e-6 < near_duplicates.miss_rate(23, 3, 80)
    assert 1.8e-4 < near_duplicates.miss_rate(16, 3, 80) < 1.9e-4 and 6e-6 < near_duplicates.miss_rate(16, 3, 85) < 7e-6
    assert given(100, 3) == 2 and all(near_duplicates.miss_rate(given(p, 3), 3, p) <= 1e-6 for p in range(70, 101))
    with pytest.raises(ValueError):
        given(20, 3)


def test_production_parameters_link_pairs_at_the_limit(spark):
    # Of 1000 words the last 111 differ: 885 of 1107 shingles are in both, just under 80 percent;
    # with 110 it is 886 of 1106, just over.
    rows = []
    for i in range(60):
        for j, changed in enumerate((0, 110, 111)):
            words = [f"w{i}x{k}" for k in range(1000 - changed)] + [f"v{i}x{j}x{k}" for k in range(changed)]
            rows.append((3 * i + j, " ".join(words)))
    got = near_duplicates.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: d - (d % 3 == 1) for d, _ in rows}


def test_crowded_buckets_of_texts_less_alike_than_asked_for(spark, monkeypatch):
    # All texts share a pattern: most pairs meet, few are links, and those not with a bucket's ends.
    asked = []
    exact = near_duplicates.join_components
    monkeypatch.setattr(near_duplicates, "join_components", lambda df, *more: asked.append(df.count()) or exact(df, *more))
    rnd = random.Random(5)
    pattern = [f"p{k}" for k in range(150)]
    docs = []
    for i in range(90):
        own = [f"u{i}x{k}" for k in range(22)]
        docs.append(" ".join([*pattern, *own]))
        if i % 5 == 0:
            docs.append(" ".join([*pattern, *own[:-2], "y", "z"]))
    rnd.shuffle(docs)
    docs = list(enumerate(docs))
    component, _ = components_by_hand(docs, 85)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = near_duplicates.components(table, percent=85, collections=16).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == component
    assert len(set(component.values())) == 90 and asked[0] > 50


def test_near_duplicates_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates.components(empty).count() == 0
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(1, same), (1, same), (None, same), (2, same), (3, "other words")]
    got = near_duplicates.components(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True),
    ]
    with pytest.raises(ValueError):
        near_duplicates.components(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_components_of_long_chains(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (100, 101), (7, 7), (101, 90)]
    rnd.shuffle(links)
    got = smallest_reachable(spark.createDataFrame(links + links[:5], "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(61)} | {90: 90, 100: 90, 101: 90}
    assert len(got) == len({r["node"] for r in got})
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).count() == 0


def test_levels_of_windows_leave_only_the_last(spark, monkeypatch):
    from pathlib import Path

    made, real = [], substrings.written

    def watched(df, name):
        table = real(df, name)
        made.append((name, table.inputFiles()))
        return table

    monkeypatch.setattr(substrings, "written", watched)
    rows = [(i, " ".join(f"w{k}" for k in range(i, 60))) for i in range(4)]
    cut = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in cut.collect()} == {0: 59, 1: 59, 2: 58, 3: 57}
    assert [name for name, _ in made] == ["stretches-9", "stretches-18", "windows"]
    there = [any(Path(f.removeprefix("file://").removeprefix("file:")).exists() for f in files) for _, files in made]
    assert there == [False, False, True]
