"""BPE, packing, token counts, main text and quality rules against plain Python."""

import random
import re
import time
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelloom.llm import bpe, main_text, packing, quality, token_counts
from labelloom.llm.library_ids import LibraryEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def file():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


def odd_texts(count=3000):
    rnd = random.Random(7)
    letters = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　'sdlt<|endoftext|>aéñ漢字٣²½Ⅷ😀​́﻿.,!0129ABC"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(count)]
    wide = [rnd.choice([rnd.randint(1, 0xD7FF), rnd.randint(0xE000, 0x1FFFF), rnd.randint(32, 127)]) for _ in range(count)]
    made += ["".join(map(chr, wide[i : i + 12])) for i in range(0, count, 12)]
    return [*made, "", " ", "  a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "ha" * 900, "a" * 5000, " " * 3000 + "x"]


def ids_of(packed):
    return list(np.frombuffer(bytes(packed), "<u4"))


def test_encoders_equal_the_library(file, library):
    texts = odd_texts()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for encoder in (bpe.Encoder(bpe.BytePairs(file)), LibraryEncoder(file)):
        assert [ids_of(m) for m in encoder.encode_batch(texts)] == want


def test_full_tables_do_not_change_ids(file, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    monkeypatch.setattr(bpe, "KEPT_SEAMS", 5)
    monkeypatch.setattr(bpe, "TOGETHER", 50)
    texts = odd_texts(600)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids_of(m) for m in bpe.Encoder(bpe.BytePairs(file)).encode_batch(texts)] == want


def test_encode_and_decode_frames(spark, library):
    texts = [None, "", "Hello  world\n", "née <|endoftext|>", "Hello  world\n"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, IDS string")
    got = {r["doc_id"]: r for r in bpe.encode_and_decode(rows, PATH).collect()}
    assert set(got[0].asDict()) == {"doc_id", "text", "ids", "n_tokens", "decoded"}
    for i, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids_of(got[i]["ids"]) == want and got[i]["n_tokens"] == len(want)
        assert got[i]["decoded"] == (text or "")
    apart = bpe.decode(bpe.encode(rows, PATH), PATH).select("decoded", bpe.id_array().alias("list")).collect()
    assert sorted(r["decoded"] for r in apart) == sorted(t or "" for t in texts)
    assert sorted(map(len, (r["list"] for r in apart))) == sorted(r["n_tokens"] for r in got.values())
    assert bpe.encode(rows.limit(0), PATH).count() == 0


def test_decode_of_odd_ids(spark):
    rows = spark.createDataFrame([(b"\xff\xff\xff\x7f",), (None,), (b"",)], "ids binary")
    assert [r["decoded"] for r in bpe.decode(rows, PATH).collect()] == ["", "", ""]


@pytest.mark.parametrize("parts", [1, 3])
def test_packing_places_every_id_once(spark, library, parts):
    rnd = random.Random(3)
    texts = [None, "", "a"] + [" ".join(rnd.choices(["de", "lorem", "ipsum", "x"], k=rnd.randint(0, 900))) for _ in range(60)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
    capacity = 64
    got = packing.pack(rows, PATH, capacity=capacity).collect()
    for i, text in enumerate(texts):
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert [x for r in own for x in ids_of(r["piece_ids"])] == want
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
        assert {r["doc_tokens"] for r in own} == {len(want)}
        assert all(r["ids_crc32"] == crc32(bytes(r["piece_ids"])) for r in own)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    assert packing.pack(rows.limit(0), PATH).count() == 0


def test_packing_refuses_what_it_cannot_do(spark):
    rows = spark.createDataFrame([(1, "a")], "offset long, text string")
    with pytest.raises(ValueError):
        packing.pack(rows, PATH, carry=("offset",))
    with pytest.raises(ValueError):
        packing.pack(rows, PATH, carry=(), capacity=100)


def parts_by_hand(library, text, spans, rule):
    raw, counts = text.encode(), Counter()
    owner = [next((p for p, (a, b) in enumerate(spans) if a <= c < b), -1) for c in range(len(text))]
    by_byte = [owner[c] for c, letter in enumerate(text) for _ in letter.encode()]
    pairs = {v: k for k, v in library.get_vocab().items()}
    letters = bpe.byte_letters()
    at = 0
    for i in library.encode(text, add_special_tokens=False).ids:
        size = len(pairs[i]) if pairs[i] == "<|endoftext|>" else len(bytes(letters[c] for c in pairs[i]))
        held = by_byte[at : at + size]
        best = Counter(held)
        most = min(best, key=lambda p: (-best[p], p if p >= 0 else 10**9))
        counts[{"first": held[0], "last": held[-1], "most": most}[rule]] += 1
        at += size
    assert at == len(raw)
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_by_given_parts(spark, library, rule):
    texts = ["Grüße an alle, 漢字 lesen", "one two three four five", "", "x"]
    spans = [[(0, 3), (3, 9), (15, 17)], [(1, 5), (5, 6), (9, 30)], [(0, 0)], []]
    rows = spark.createDataFrame(
        [(i, t, [{"start": a, "end": b} for a, b in s]) for i, (t, s) in enumerate(zip(texts, spans, strict=True))],
        "doc_id long, text string, parts array<struct<start:int,end:int>>",
    )
    got = token_counts.count_tokens(rows, PATH, parts="parts", rule=rule).collect()
    for i, (text, own) in enumerate(zip(texts, spans, strict=True)):
        counts = {r["part"]: r["n_tokens"] for r in got if r["doc_id"] == i}
        want = parts_by_hand(library, text, own, rule)
        assert counts == {p: want[p] for p in [*range(len(own)), *([-1] if want[-1] else [])]}


def test_null_parts_are_empty_and_unordered_ones_are_refused(spark, library):
    kind = "doc_id long, text string, parts array<struct<start:int,end:int>>"
    spans = [None, (0, 5), None, (6, None), (None, 7), (6, 11), (11, 11)]
    given = [s and {"start": s[0], "end": s[1]} for s in spans]
    rows = spark.createDataFrame([(1, "hello world", given), (2, "x", None), (3, None, given[:1])], kind)
    made = token_counts.count_tokens(rows, PATH, parts="parts").collect()
    counts = {(r["doc_id"], r["part"]): r["n_tokens"] for r in made}
    want = parts_by_hand(library, "hello world", [(0, 0), (0, 5), (5, 5), (5, 5), (5, 5), (6, 11), (11, 11)], "first")
    assert counts == {**{(1, p): want[p] for p in [*range(7), *([-1] if want[-1] else [])]}, (2, -1): 1, (3, 0): 0}
    for bad in ([(6, 11), (0, 5)], [(0, 6), (5, 11)], [(3, 1)], [(-1, 2)]):
        given = [{"start": a, "end": b} for a, b in bad]
        with pytest.raises(Exception, match="parts must be in order"):
            token_counts.count_tokens(spark.createDataFrame([(1, "hello world", given)], kind), PATH, parts="parts").collect()


def test_token_counts_by_lines(spark, library):
    texts = [None, "", "a\n\nb c\n", "no line feed", "<|endoftext|>\nx"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = token_counts.count_tokens(rows, PATH).collect()
    for i, text in enumerate(texts):
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["part"])
        assert len(own) == (text or "").count("\n") + 1
        total = len(library.encode(text or "", add_special_tokens=False).ids)
        assert sum(r["n_tokens"] for r in own) == total and {r["doc_tokens"] for r in own} == {total}
    assert token_counts.count_tokens(rows.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(rows, PATH, rule="half")


BODY = "<p>A first paragraph that is long enough to be told from menus &amp; notices, by its length.</p>" * 3
TEXT = " ".join(["A first paragraph that is long enough to be told from menus & notices, by its length."] * 3)


@pytest.mark.parametrize(
    "html",
    [
        f"<html><head><title>T</title><script>var t='<p>no</p>';</script></head><body><nav>Home</nav><article>{BODY}</article>"
        "<footer>&copy; me</footer></body></html>",
        f"<body><header><h1>Site</h1></header><div id='content'>{BODY}</div><div class='sidebar'><p>{'link ' * 40}</p></div></body>",
        f"<div class='cookie-notice'>{'We use cookies. ' * 20}</div><main>{BODY}</main><section id=comments>"
        f"<article class='comment'><p>{'I agree. ' * 40}</p></article></section>",
        f"<ul><li><a href=/>One</a><li><a href=/>Two</a></ul><div>{BODY}</div><form>Name <input> <select><option>x</select></form>",
        f"<article>{BODY}<aside>See also</aside><div class='ad'>Buy</div><noscript>on</noscript><!-- no --></article>",
        f"<body class='has-sidebar'><p hidden>secret</p><div style='display: none'>x</div>{BODY}<div class=post-comments>"
        f"{'reply ' * 50}</div>",
        BODY.replace("</p>", "").replace("A first", "A\n\t first"),
    ],
)
def test_main_text_leaves_out_the_rest(html):
    assert main_text.main_text(html) == TEXT


@pytest.mark.parametrize(
    "part",
    [
        "<section id='search-algorithms'>{}</section>",
        "<section id='comments'>{}</section>",
        "<div class='section' id='navigation'>{}</div>",
        "<section id='social-effects'>{}</section>",
        "<div class='form-factor'>{}</div>",
        "<p class='share-price'>{}</p>",
        "<p class='notice'>{}</p>",
        "<h2 id='advertising'>{}</h2>",
        "<h2 id='http-header'>{}</h2>",
        "<p><math><mi>{}</mi></math></p>",
    ],
)
def test_names_of_topics_are_no_parts_to_drop(part):
    words = "words that " + "belong to the article " * 5 + "itself"
    page = part.format(words)
    for tag in ("article", "main"):
        dropped = "<div class='ad'>Buy</div><div id='comments'>I agree</div><ul class='menu'><li>Home</ul><div role='navigation'>Up</div>"
        assert main_text.main_text(f"<{tag}>{BODY}{page}{dropped}{BODY}</{tag}>") == f"{TEXT} {words} {TEXT}"
    if "comments" not in part and "notice" not in part:
        assert main_text.main_text(f"<body>{BODY}{page}{BODY}</body>") == f"{TEXT} {words} {TEXT}"


def test_formulas_stay_in_their_line():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x = 1</annotation></semantics></math>"
    assert main_text.main_text(f"<article><p>Let {formula} hold.</p></article>") == "Let x=1 hold."


def test_an_article_is_not_dropped_for_its_tags():
    page = f"<article class='post-12 post tag-search category-sponsored'>{BODY}</article><article class='comment'>{BODY}</article>"
    assert main_text.main_text(page) == TEXT


SHORT = "".join(f"<li>a short line {i}</li>" for i in range(10))
SHORT_TEXT = " ".join(f"a short line {i}" for i in range(10))


@pytest.mark.parametrize("before, after", [(True, True), (True, False), (False, True)])
def test_short_blocks_at_the_ends_of_unmarked_pages_stay(before, after):
    head, tail = f"<ol>{SHORT}</ol>" * before, f"<pre>{SHORT}</pre><div class='ad'>Buy</div><ul>{SHORT}</ul>" * after
    text = " ".join([SHORT_TEXT] * before + [TEXT] + [SHORT_TEXT, SHORT_TEXT] * after)
    links = "<ul>" + "<li><a href=/>Home of links</a>" * 4 + "</ul>"
    assert main_text.main_text(f"<body>{head}{BODY}{tail}</body>") == text
    assert main_text.main_text(f"<p>Our site</p>{links}{head}{BODY}{tail}{links}<p>All rights reserved</p>") == text
    # Long paragraphs after a gap are the article's too, as before.
    assert main_text.main_text(f"{head}{BODY}{links}{BODY}{tail}").endswith(TEXT + f" {SHORT_TEXT} {SHORT_TEXT}" * after)


@pytest.mark.parametrize("opened", ["<form id='aspnetForm'>", "<form id=form1 runat=server>", "<form action='/x' class='search-form'>"])
def test_forms_that_wrap_a_page_stay(opened):
    controls = "<label>Name</label><input><select><option>x</select><button>Go</button>"
    for page in (f"<article>{BODY}</article>", f"<main><div>{BODY}</div></main>", BODY):
        assert main_text.main_text(f"<body>{opened}{controls}<nav>Home</nav>{page}{controls}</form></body>") == TEXT
    assert main_text.main_text(f"<article>{BODY}<form>Write to us <input></form></article><form>{'Ask. ' * 30}</form>") == TEXT
    assert main_text.main_text("<form>Name <input></form>") == ""


def test_lists_of_links_at_the_ends_of_an_article_are_cut():
    links = "<ul>" + "<li><a href=/>Home of links</a>" * 4 + "</ul>"
    heading = "<h1><a href=/>A linked heading</a></h1>"
    assert main_text.main_text(f"<article>{links}{BODY}{links}</article>") == TEXT
    assert main_text.main_text(f"<article>{heading}{BODY}</article>") == f"A linked heading {TEXT}"
    inner = main_text.main_text(f"<article>{BODY}{links}{BODY}</article>")
    assert inner == " ".join([TEXT, *["Home of links"] * 4, TEXT])


@pytest.mark.parametrize("part", ["<div><font>", "</b><q>a", "<p>a<li>b", "<table><tr><td>x", "<form><p>y", "<head><b>"])
def test_pages_of_unclosed_tags_take_time_in_proportion(part):
    began = time.process_time()
    main_text.main_text(part * (500_000 // len(part)))
    assert time.process_time() - began < 20


def test_main_text_of_short_and_odd_pages():
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<nav>Home</nav>") == ""
    assert main_text.main_text("plain &lt;text&gt; only") == "plain <text> only"
    assert main_text.main_text("<article><h1>Hi</h1><p>one<b>two</b><br>three<p>four</article>") == "Hi onetwo three four"
    assert main_text.main_text("<article>a<![if x]>b<![endif]><p>c</article></div></p>") == "ab c"
    assert main_text.main_text("<p>" + "long " * 200_000 + "</p>").count("long") == 200_000


def test_extract_keeps_columns_and_nulls(spark):
    rows = spark.createDataFrame([(1, None, "old"), (2, f"<article>{BODY}</article>", "old")], "page_id long, html string, TEXT string")
    got = {r["page_id"]: r for r in main_text.extract(rows).collect()}
    assert got[1]["text"] == "" and got[1]["n_chars"] == 0
    assert got[2]["text"] == TEXT and got[2]["n_chars"] == len(TEXT) and "TEXT" not in got[2].asDict()
    assert main_text.extract(rows.limit(0)).count() == 0


def measures_by_hand(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_equal_plain_python(spark):
    rnd = random.Random(5)
    texts = [None, "", " \n\t", "a", "a a", "a a a", "a a a a", "a\x1cb\xa0c 😀 é|$", "x y z x y z w x y z"]
    texts += [" ".join(rnd.choices("abc", k=rnd.randint(0, 60))) + rnd.choice(["", "\nab\nab\n"]) for _ in range(200)]
    rows = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, N_WORDS int")
    got = {r["doc_id"]: r for r in quality.measure(rows).collect()}
    for i, text in enumerate(texts):
        want = measures_by_hand(text)
        assert tuple(got[i][n] for n in quality.MEASURES) == want
        assert got[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_hosts_are_shrunk_and_rejected(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(f"good{h}", good) for h in range(20) for _ in range(20)] + [("bad", "x")] * 60 + [("bad", good)] * 3
    rows += [("one", "x")] + [(None, "x"), (None, good), ("one", good)]
    docs = spark.createDataFrame([(i, t, s, "k") for i, (s, t) in enumerate(rows)], "doc_id long, text string, source string, kept string")
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    for i, (source, text) in enumerate(rows):
        assert got[i]["kept"] == (text == good and source != "bad")
    share = {r["source"]: r["host_share"] for r in got.values()}
    assert share["bad"] > 0.5 and 60 / 63 > share["bad"] and share["one"] < 0.5 and share[None] is None
    assert quality.judge(docs.limit(0)).count() == 0


def test_prior_without_spread_is_the_mean(spark):
    hosts = spark.createDataFrame([("a", 10, 5), ("b", 10, 5)], "h string, documents long, failed long")
    assert quality.beta_prior(hosts) == (0.5, float("inf"))
    assert quality.beta_prior(hosts.limit(0)) == (0.0, float("inf"))
    assert quality.beta_prior(hosts.withColumn("failed", F.lit(0).cast("long"))) == (0.0, float("inf"))
