"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from labelloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked_by_hand(docs, queries, k):
    split = [(i, Counter(terms(t))) for i, t in docs]
    split = [(i, c) for i, c in split if c]
    held = Counter(t for _, c in split for t in c)
    total = sum(c.total() for _, c in split)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(terms(text))
    rows = []
    for item, own in asked.items():
        scored = []
        for i, counts in split:
            m = 10 + 90 * counts.total() * len(split) // total
            score = 0
            for t in own & counts.keys():
                weight = math.floor(1000 * math.log((2 * len(split) + 2) / (2 * held[t] + 1)))
                score += weight * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        rows += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(rows, key=repr)


def texts(rnd, count, longest):
    common, rare = [f"c{i}" for i in range(12)], [f"Ré{i}" for i in range(300)]
    for _ in range(count):
        words = [rnd.choice(common if rnd.random() < 0.7 else rare) for _ in range(rnd.randint(0, longest))]
        yield "".join(w + rnd.choice([" ", ",", "\x00-", "[", "\x7f", "\n"]) for w in words)


@pytest.mark.parametrize(("segment", "block", "paired", "least", "k"), [(1_000_000, 256, 12, 8, 10), (300, 3, 4, 1, 3), (1, 1, 12, 1, 5), (900, 7, 0, 8, 200)])
def test_search_equals_brute_force(spark, monkeypatch, segment, block, paired, least, k):
    for name, value in (("SEGMENT_TERMS", segment), ("BLOCK", block), ("PAIRED", paired), ("LEAST_LIST", least)):
        monkeypatch.setattr(lexical, name, value)
    rnd = random.Random(k)
    own = [*texts(rnd, 250, 60), None, "", "!?", "C1 c1", "c1" * 500, "c1 " * 3000, "ÀÉ àé ÀÉ"]
    docs = [(i * 3, t) for i, t in enumerate(own)] + [(3, own[9]), (3, own[9]), (None, own[7])]
    queries = [(i, t) for i, t in enumerate([*texts(rnd, 15, 25), None, "", "unheard of", "c1 C1", own[3], "ÀÉ"])]
    queries += [(2, "c3 c4"), (None, "c5 " + own[7])]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, SCORE string").repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in queries], "item_id int, text string, doc_id int")
    made = lexical.search(df, asked, k)
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in made.collect()), key=repr) == ranked_by_hand(docs, queries, k)


def test_empty_tables_and_bad_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string, item_id long")
    some = spark.createDataFrame([(1, "a b", 1)], "doc_id long, text string, item_id long")
    silent = spark.createDataFrame([(1, None, 1)], "doc_id long, text string, item_id long")
    for docs, asked in ((none, some), (some, none), (none, none), (silent, some), (some, silent)):
        assert lexical.search(docs, asked).collect() == []
    with pytest.raises(ValueError):
        lexical.search(some, some, id_column="text")


def segment_of(rnd, size, terms_, frequent):
    docs, scores = [], []
    for t in range(terms_):
        share = 0.4 if t < frequent else 0.02
        own = np.array([d for d in range(size) if rnd.random() < share] or [rnd.randrange(size)])
        docs.append(own)
        scores.append(np.array([rnd.randint(1, 100 if t < frequent else 2000) for _ in own]))
    return lexical.Segment(docs, scores, size)


def test_bounds_hold_and_pairs_tighten_them():
    rnd = random.Random(1)
    tighter = 0
    for _ in range(30):
        made = segment_of(rnd, 60, 14, 8)
        made.list_pairs([list(range(14))])
        order = sorted(range(14), key=lambda t: (made.most[t], t))
        bounds, sums = made.bounds(order), np.zeros(60, np.int64)
        for j, t in enumerate(order):
            assert bounds[j] >= sums.max(initial=0)
            sums[made.docs[t]] += made.scores[t]
            tighter += bounds[j + 1] < sum(made.most[x] for x in order[: j + 1])
    assert tighter > 30


def test_pairs_save_work():
    """Frequent terms that seldom meet are left out sooner with bounds of pairs than with single ones."""
    work = {}
    for paired in (True, False):
        rnd, done = random.Random(2), 0
        for _ in range(20):
            made = segment_of(rnd, 2000, 20, 0)
            for t in range(12):
                docs = np.array([d for d in range(t % 2, 2000, 2) if rnd.random() < 0.8])
                made.docs[t], made.scores[t] = docs, np.array([rnd.randint(100, 400) for _ in docs])
            made = lexical.Segment(made.docs, made.scores, 2000)
            if paired:
                made.list_pairs([list(range(20))])
            else:
                made.joint = dict.fromkeys(((a, b) for a in range(20) for b in range(a + 1, 20)), 10**9)
            found, score = made.best(list(range(20)), 10)
            full = np.zeros(2000, np.int64)
            for d, s in zip(made.docs, made.scores, strict=True):
                full[d] += s
            assert sorted(found.tolist()) == np.flatnonzero(full >= np.sort(full)[-10]).tolist()
            assert (score == full[found]).all()
            done += made.work
        work[paired] = done
    assert work[True] < 0.8 * work[False]
