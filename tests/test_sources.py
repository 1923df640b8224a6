import json
import time
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from labelloom.operators.metrics import evaluation_bundle
from labelloom.plans.cleaning import clean_directory
from labelloom.sources import records, runs, tables

RECORD = {
    "prob_desc_time_limit": "1 second",
    "prob_desc_description": "Some TEXT",
    "prob_desc_notes": None,
    "src_uid": "u1",
    "difficulty": 1500,
    "tags": ["greedy", "math"],
    "prob_desc_created_at": "1564936500",
    "source_code": "print(1)",
}


@pytest.fixture
def directory(tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    put("one.json", json.dumps(RECORD, indent=4))
    put("two.json", json.dumps([{**RECORD, "src_uid": "u2"}, {**RECORD, "src_uid": "u3", "extra": 1}]))
    put("broken.json", '{"src_uid": bad')
    put("mistyped.json", json.dumps({**RECORD, "tags": 5}))
    put("notes.txt", json.dumps(RECORD))
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "deep.json").write_text(json.dumps(RECORD))
    return str(tmp_path)


def test_objects_and_arrays_are_read_and_others_are_not(spark, directory):
    found = records.scan_json_records(spark, directory)
    assert sorted(r["src_uid"] for r in found.collect()) == ["u1", "u2", "u3"]
    assert found.count() == 3
    assert found.select("src_uid").distinct().count() == 3
    assert found.first()["tags"] == ["greedy", "math"]
    assert set(found.columns) == set(records.RAW_RECORD.fieldNames())


def test_bad_files_are_set_aside(spark, directory):
    bad = records.quarantine_corrupt(spark, directory)
    assert sorted(r["file_name"] for r in bad.collect()) == ["broken.json", "mistyped.json"]
    assert bad.count() == 2
    assert "bad" in {r["file_name"]: r["record"] for r in bad.collect()}["broken.json"]


def test_one_bad_field_costs_one_record(spark, tmp_path):
    array = [
        {**RECORD, "src_uid": "good1"},
        {**RECORD, "src_uid": "bad", "tags": 5},
        {**RECORD, "src_uid": "float", "difficulty": 1500.0},
        7,
        {**RECORD, "src_uid": "word", "difficulty": "hard"},
        {**RECORD, "src_uid": "good2", "prob_desc_notes": 12},
    ]
    (tmp_path / "array.json").write_text(json.dumps(array))
    (tmp_path / "empty.json").write_text("")  # holds no record, and no bad one
    found = {r["src_uid"]: r for r in records.scan_json_records(spark, str(tmp_path)).collect()}
    assert set(found) == {"good1", "float", "good2"}
    assert found["float"]["difficulty"] == 1500 and found["good2"]["prob_desc_notes"] == "12"
    bad = records.quarantine_corrupt(spark, str(tmp_path)).collect()
    assert sorted((r["file_name"], r["record"][:1]) for r in bad) == [
        ("array.json", "7"), ("array.json", "{"), ("array.json", "{"),
    ]


@pytest.mark.parametrize("start", ["\n", "\r\n\t ", "\t", "\ufeff", "\ufeff\n\t"])
def test_white_space_and_byte_order_marks_may_lead(spark, tmp_path, start):
    array = [{**RECORD, "src_uid": "a1"}, {**RECORD, "src_uid": "bad", "tags": 5}, {**RECORD, "src_uid": "a2"}]
    for name, value in (("array.json", array), ("object.json", {**RECORD, "src_uid": "o"})):
        (tmp_path / name).write_bytes((start + json.dumps(value, indent=1) + "\n").encode())
    (tmp_path / "spaced.json").write_bytes((start + '[\n\t{"src_uid": "s1"}\n,\r\n {"src_uid": "s2"}]').encode())
    found = records.scan_json_records(spark, str(tmp_path)).collect()
    assert sorted(r["src_uid"] for r in found) == ["a1", "a2", "o", "s1", "s2"]
    bad = records.quarantine_corrupt(spark, str(tmp_path)).collect()
    assert [(r["file_name"], json.loads(r["record"])["src_uid"]) for r in bad] == [("array.json", "bad")]


AWKWARD = [
    {**RECORD, "src_uid": "quotes", "source_code": 'a "}],[{" \\\\ \\" \\\\\\" }'},
    {**RECORD, "src_uid": "nested", "extra": [{"a": [1, {"b": "}"}]}, [[]], "]"]},
    {**RECORD, "src_uid": "letters", "prob_desc_notes": "é{ü}\u2028 漢[字], \t"},
    {**RECORD, "src_uid": "bad", "tags": 5},
    7, None, "text, with } and ]", [1, 2, {"c": "d"}], {}, "", [],
    {**RECORD, "src_uid": "long", "source_code": "if (a) { b[1] = {2, 3}; } // \\" * 400},
    *[{**RECORD, "src_uid": f"u{i}", "source_code": "x" * (i * 37 % 900)} for i in range(60)],
]
LARGE_FILES = {
    "array.json": json.dumps(AWKWARD),
    "lines.json": json.dumps(AWKWARD[::-1], indent=2, ensure_ascii=False) + "\n \n",
    "marked.json": "\ufeff\n" + json.dumps(AWKWARD[3:20], ensure_ascii=False),
    "object.json": json.dumps({**RECORD, "src_uid": "object", "source_code": "{}" * 900}),
    "spaced.json": json.dumps({**RECORD, "src_uid": "spaced", "source_code": "{ " * 900}) + "\n",
    "hollow.json": "[" + " \n" * 900 + "]",
    "a + b%20.json": json.dumps(AWKWARD[:4] + [{"source_code": "}" * 3000}]),
    "more.json": json.dumps(AWKWARD) + " {}",
    "brace.json": json.dumps(AWKWARD) + "}",
    "twice.json": json.dumps(AWKWARD) + json.dumps(AWKWARD[:3]),
}
BROKEN_FILES = {
    "cut.json": json.dumps(AWKWARD)[:-300],
    "comma.json": json.dumps(AWKWARD)[:-1] + ",]",
    "hole.json": json.dumps(AWKWARD).replace("}, {", "},, {", 1),
    "open.json": json.dumps(AWKWARD)[:-1],
    "quote.json": json.dumps(AWKWARD).replace('"src_uid"', 'src_uid"', 1),
    "word.json": json.dumps(AWKWARD).replace("7, null", "7, nul", 1),
    "text.json": "no JSON } at all { " * 200,
}


@pytest.mark.parametrize("block", ["5000b", "128m"])
def test_large_array_files_give_the_same_records(spark, tmp_path, block):
    for name, text in (LARGE_FILES | BROKEN_FILES).items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "small.json").write_text(json.dumps({"src_uid": "small"}))
    folder = str(tmp_path)
    whole = records.scan_json_records(spark, folder).collect()
    bad = [(r["file_name"], r["record"]) for r in records.quarantine_corrupt(spark, folder).collect()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        cut = records.scan_json_records(spark, folder, whole_file_bytes=100)
        assert sorted(cut.collect(), key=repr) == sorted(whole, key=repr)
        bad_cut = [(r["file_name"], r["record"]) for r in records.quarantine_corrupt(spark, folder, whole_file_bytes=100).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(whole) > 150 and {n for n, _ in bad} >= set(BROKEN_FILES)
    assert sorted(n for n, _ in bad_cut) == sorted(n for n, _ in bad)

    assert {x for x in bad_cut if x[0] not in BROKEN_FILES} == {x for x in bad if x[0] not in BROKEN_FILES}


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path):
    from labelloom.sources import array_files

    (tmp_path / "one.json").write_text(json.dumps([{"src_uid": f"u{i}", "source_code": "{x}" * 50} for i in range(2000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000b")
    written = []

    def watched(df, name):
        written.append((name, df.rdd.getNumPartitions()))
        return staged(df, name)

    staged, array_files.staged = array_files.staged, watched
    try:
        found = records.scan_json_records(spark, str(tmp_path), whole_file_bytes=100_000)
        assert found.select("src_uid").distinct().count() == found.count() == 2000
    finally:
        array_files.staged = staged
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert dict(written)["pieces"] >= 8


def test_missing_directory_and_no_files(spark, tmp_path):
    with pytest.raises(AnalysisException):
        records.scan_json_records(spark, str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError):
        records.scan_json_records(spark, str(tmp_path))


def test_cleaning_a_directory(spark, directory, tmp_path):
    path, missing, distribution, parsed, bad = clean_directory(spark, directory, str(tmp_path / "out"), "clean")
    assert {r["column"]: (r["n_parsed"], r["n_malformed"]) for r in parsed.collect()}["time_limit"] == (3, 0)
    assert sorted(r["file_name"] for r in bad.collect()) == ["broken.json", "mistyped.json"]
    clean = spark.read.parquet(path).collect()
    # All three records are equal once their ids are gone.
    assert len(clean) == 1
    row = clean[0]
    assert (row["problem_id"], row["creation_order"], row["math"], row["graphs"]) == (0, 1, 1, 0)
    assert (row["time_limit"], row["memory_limit"], row["tags"]) == (1.0, None, "['greedy', 'math']")
    assert (row["problem_description"], row["problem_notes"]) == ("some text", "none")
    assert row["output"].startswith('<output>{"math": 1, "graphs": 0,')
    assert "\nProblem notes: none\nSolution code: print(1)\n\nRespond" in row["prompt"]
    assert {r["column"]: r["n_missing"] for r in missing.collect()}["memory_limit"] == 1
    assert {r["label"]: r["percent"] for r in distribution.collect()}["math"] == 100.0


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b"\n, c', 1.5), (2, None, None)], "i int, t string, x double")
    tables.sink_csv(rows.select("t", "x", "i"), str(tmp_path / "csv"), first="i")
    inferred = tables.scan_csv(spark, str(tmp_path / "csv"))
    assert inferred.columns == ["i", "t", "x"] and inferred.dtypes[0][1] == "int"
    typed = tables.scan_csv(spark, str(tmp_path / "csv"), T.StructType(rows.select("i", "t", "x").schema.fields))
    assert sorted(tuple(r) for r in typed.collect()) == sorted(tuple(r) for r in rows.collect())


def test_csv_keeps_outer_white_space(spark, tmp_path):
    texts = ["  int x;\n", "\ttab ", " ", 'a "q" ', "line\nbreak\t", "plain"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    tables.sink_csv(rows, str(tmp_path / "csv"))
    typed = tables.scan_csv(spark, str(tmp_path / "csv"), rows.schema)
    assert [r["t"] for r in sorted(typed.collect())] == texts


def test_snapshots_are_never_overwritten(spark, tmp_path):
    rows, root, day = spark.range(3), str(tmp_path), date(2025, 4, 17)
    names = [tables.write_snapshot(rows, root, "clean", day).split("/")[-1] for _ in range(3)]
    assert names == ["clean_2025-04-17", "clean_2025-04-17_1", "clean_2025-04-17_2"]
    time.sleep(0.05)
    newest = tables.write_snapshot(spark.range(9), root, "another", day)
    assert tables.latest_snapshot(spark, root).count() == 9
    assert tables.latest_snapshot(spark, root, names[1]).count() == 3
    assert newest.endswith("another_2025-04-17")
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        tables.latest_snapshot(spark, str(tmp_path / "empty"))


def names(spark, items):
    return spark.createDataFrame([(x,) for x in items], "path string")


def test_latest_run(spark):
    listed = ["a_20250417_002", "a_20250417_010", "b_20250418_001", "bad_dir", "x_20251341_001", "t20250419_001", "20250419"]
    found = runs.latest_run(names(spark, listed)).collect()
    assert [tuple(r) for r in found] == [("b_20250418_001", date(2025, 4, 18), 1)]
    found = runs.latest_run(names(spark, ["m/a_20250417_002", "m/a_20250417_010"])).first()
    assert found["path"] == "m/a_20250417_010"
    assert runs.latest_run(names(spark, ["bad_dir", "t20250417_001"])).count() == 0


def test_next_run_index(spark):
    listed = names(spark, ["a_20250417_002", "a_20250417_x", "a_20250416_009", "ba_20250417_050", "a_20250417_-4"])
    day = date(2025, 4, 17)
    assert tuple(runs.next_run_index(listed, "a_", day).first()) == (3, "a_20250417_003")
    assert tuple(runs.next_run_index(listed, "c_", day).first()) == (1, "c_20250417_001")
    many = names(spark, ["a_20250417_999"])
    assert runs.next_run_index(many, "a_", day).first()["run_name"] == "a_20250417_1000"


def test_ledger(spark, tmp_path):
    ledger = str(tmp_path / "runs")
    for i in (1, 2):
        row = runs.run_manifest(spark, "a_", date(2025, 4, 17), i, f"m/a_20250417_00{i}", "train", "in", 7, {"x": i}, datetime(2025, 1, 1))
        runs.append_run(row, ledger)
    found = runs.read_runs(spark, ledger)
    assert found.count() == 2
    assert runs.latest_run(found).first()["run_idx"] == 2
    text = runs.manifest_json(found).filter("path like '%2'").first()["json"]
    assert json.loads(json.loads(text)["params_json"]) == {"x": 2}


def test_evaluation_file(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1)], "a int, pred_a int")
    path = str(tmp_path / "evaluation")
    runs.sink_eval_json(evaluation_bundle(rows, ["a"]), path)
    found = json.loads(spark.read.text(path).first()[0])
    assert found["custom_stats"]["perfect_match_percent"] == 100.0


def test_writers_that_start_together_get_a_name_each(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    day = date(2025, 4, 17)
    with ThreadPoolExecutor(5) as pool:
        paths = list(pool.map(lambda i: tables.write_snapshot(spark.range(i, i + 1), str(tmp_path), "t", day), range(5)))
    assert sorted(p.rsplit("/", 1)[1] for p in paths) == ["t_2025-04-17", *[f"t_2025-04-17_{i}" for i in range(1, 5)]]
    assert sorted(spark.read.parquet(p).first()[0] for p in paths) == list(range(5))
    assert tables.latest_snapshot(spark, str(tmp_path)).count() == 1
    assert not list((tmp_path / "_claims").iterdir())


def test_a_name_given_up_takes_no_other_claim_with_it(spark, tmp_path):
    from labelloom.sources.claims import claimed

    folder = tmp_path / "_claims"
    with claimed(spark, str(tmp_path), "t") as first, claimed(spark, str(tmp_path), "t_1") as second:
        assert first and second
        with claimed(spark, str(tmp_path), "t") as again:
            assert not again
        held = {p for p in folder.rglob("*") if p.is_file() and p.suffix != ".crc"}
        # A job that begins to claim while the first one ends: what it writes must stay.
        late = next(p for p in held if "t_1" not in str(p))
        late = late.with_name(late.name[:-32] + "0" * 32)
        late.write_text("")
    assert late.exists()
    with claimed(spark, str(tmp_path), "t") as taken, claimed(spark, str(tmp_path), "t_1") as free:
        assert (taken, free) == (False, True)
    late.unlink()
    with claimed(spark, str(tmp_path), "t") as mine:
        assert mine
    assert not list(folder.iterdir())


def test_runs_at_work_hold_their_index(spark, tmp_path):
    ledger, day = str(tmp_path / "runs"), date(2025, 4, 17)

    def enter(index, name):
        runs.append_run(runs.run_manifest(spark, "m_", day, index, name, "train", "in", 1, {}), ledger)

    with runs.reserved_run(spark, ledger, "m_", day) as first:
        with runs.reserved_run(spark, ledger, "m_", day) as second:
            with runs.reserved_run(spark, ledger, "m_", date(2025, 4, 18)) as other:
                assert (first, second, other) == ((1, "m_20250417_001"), (2, "m_20250417_002"), (1, "m_20250418_001"))
            enter(*second)
        enter(*first)
    with pytest.raises(ZeroDivisionError), runs.reserved_run(spark, ledger, "m_", day) as failed:
        assert failed == (3, "m_20250417_003")
        1 / 0
    with runs.reserved_run(spark, ledger, "m_", day) as again:
        assert again == failed
    assert runs.read_runs(spark, ledger).count() == 2


def test_trainings_that_overlap_get_two_paths(spark, tmp_path, monkeypatch):
    from labelloom.plans import forest
    from labelloom.sources.models import LabelModels

    paths = []

    def train(rows, config, **options):
        if not paths:
            paths.append("")  # the second training starts and ends within the first
            paths[0] = forest.train_run(rows, str(tmp_path / "models"), str(tmp_path / "runs"), "in", day=date(2025, 4, 17))
        return LabelModels(None, {}, "text", [], {"seed": 1})

    saved = []
    monkeypatch.setattr(forest, "train_forests", train)
    monkeypatch.setattr(forest, "save_model", lambda spark, models, path: saved.append(path))
    outer = forest.train_run(spark.range(3), str(tmp_path / "models"), str(tmp_path / "runs"), "in", day=date(2025, 4, 17))
    assert [p.rsplit("_", 1)[1] for p in (outer, paths[0])] == ["001", "002"] and sorted(saved) == sorted([outer, paths[0]])
    ledger = runs.read_runs(spark, str(tmp_path / "runs")).collect()
    assert sorted((r["run_idx"], r["path"]) for r in ledger) == [(1, outer), (2, paths[0])]
