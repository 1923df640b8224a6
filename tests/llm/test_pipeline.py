"""The pipeline's stages, each on what the one before kept, against brute force."""

from collections import defaultdict

import pytest
from test_llm_dedup import WORD, components_by_hand, later_lines_by_hand, removed_by_hand
from test_llm_text import measures_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from labelloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, documents before, rows after) of every stage, as run() passes them on."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        made = stage(spark, docs, SF_DIR)
        made.write.parquet(str(folder / name))
        columns, docs = docs.columns, spark.read.parquet(str(folder / name))
        found.append((name, before, docs.collect(), columns, docs.columns))
    return {f[0]: f[1:] for f in found}


def test_stages_return_the_columns_of_documents(stages):
    names = list(stages)
    assert len(names) == 5
    for name in names[:-1]:
        _, _, before, after = stages[name]
        assert before == after


def test_quality_keeps_clean_documents(stages):
    before, after, *_ = stages["quality rules"]
    good = set()
    for i, row in before.items():
        n_words, _, _, _, repeated = measures_by_hand(row["text"])
        if n_words >= 50 and 100 * repeated <= 50 * n_words:
            good.add(i)
    assert {r["doc_id"] for r in after} == good and all(r == before[r["doc_id"]] for r in after)


def test_line_dedup(stages):
    before, after, *_ = stages["line dedup"]
    kept = later_lines_by_hand([(i, r["text"]) for i, r in before.items()], 80)
    assert {r["doc_id"] for r in after} == set(before)
    for r in after:
        own = before[r["doc_id"]]["text"].split("\n")
        left = [x for i, x in enumerate(own) if not WORD.search(x) or (r["doc_id"], i) in kept]
        assert r["text"] == "\n".join(left) and r["n_chars"] == len(r["text"])


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after, *_ = stages["near dedup"]
    component, _ = components_by_hand([(i, r["text"]) for i, r in before.items()], 80)
    assert {r["doc_id"] for r in after} == {i for i, c in component.items() if i == c}
    assert all(r == before[r["doc_id"]] for r in after)


def test_substring_dedup(stages):
    before, after, *_ = stages["substring dedup"]
    ids = sorted(before)
    split, kept = removed_by_hand([before[i]["text"] for i in ids], 35)
    made = {r["doc_id"]: r for r in after}
    assert set(made) == set(ids)
    for i, words, left in zip(ids, split, kept, strict=True):
        assert WORD.findall(made[i]["text"]) == left and made[i]["n_chars"] == len(made[i]["text"])
        if words == left:
            assert made[i] == before[i]


def test_packing_places_all_tokens(stages):
    before, after, *_ = stages["packing"]
    library = Tokenizer.from_file(queries.TOKENIZER)
    pieces, sequences = defaultdict(int), defaultdict(int)
    for r in after:
        pieces[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]] += r["length"]
    assert pieces == {i: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in before.items()}
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sequences.values())


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    _, after, *_ = stages["packing"]
    keys = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(tuple(r[k] for k in keys) for r in rows) == sorted(tuple(r[k] for k in keys) for r in after)


def test_stages_bear_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 0


CLASHING = ["kept", "n_words", "base_failed", "host_share", "n_lines", "n_removed", "n_shingles", "component_id", "__given"]


def test_stages_give_back_columns_named_like_results(spark):
    rows = [(i, " ".join(f"w{i % 5}x{k}" for k in range(60 + i % 5)), "host", i, *[f"{c} {i}" for c in CLASHING]) for i in range(8)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", "n_chars", *CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF_DIR)
        assert made.schema == docs.schema, name
        found = made.collect()
        assert len(found) >= 5
        for r in found:
            assert [r[c] for c in CLASHING] == [f"{c} {r['doc_id']}" for c in CLASHING], name


def test_quality_drops_the_documents_of_a_rejected_host(spark):
    def text(i, n):
        return " ".join(f"d{i}w{k}" for k in range(n))

    rows = [(i, text(i, 60), "good.example", 0) for i in range(40)]
    rows += [(100 + i, text(i, 60 if i < 3 else 5), "bad.example", 0) for i in range(30)]
    rows += [(200, text(200, 60), None, 0), (201, text(201, 5), None, 0), (202, text(202, 60), "new.example", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_good(spark, docs, SF_DIR).collect()}
    # Three documents of the bad host pass the rules themselves.
    assert kept == {*range(40), 200, 202}
