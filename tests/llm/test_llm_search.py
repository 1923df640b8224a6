"""Exact top-k and the WARC archive."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import top_k, warc


def best_by_hand(rows, is_query, k):
    points = {}
    longest = max(len(v) for _, v in rows)
    for i, v in rows:
        whole = tuple(np.floor(64.0 * np.array(v + [0.0] * (longest - len(v)))).astype(int))
        points.setdefault(i, whole)
    found = []
    for q in sorted(filter(is_query, points)):
        scored = sorted((-int(np.dot(points[q], p)), i) for i, p in points.items() if i != q)
        found += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return found


@pytest.mark.parametrize(("k", "seed"), [(3, 1), (20, 2), (500, 3)])
def test_search_equals_brute_force(spark, monkeypatch, k, seed):
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 7)
    monkeypatch.setattr(top_k, "DATA_BLOCK", 15)
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + rnd.normal(size=8) * 0.2).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(80)] + [(2000, [1.0, 2.0]), (2001, [])]
    bad = [(3000, None), (3005, [float("nan")] * 8), (3010, [1.0, None]), (None, [1.0] * 8), (3015, [float("inf")])]
    table = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = top_k.search(table.repartition(3), F.col("id") % 5 == 0, k=k).collect()
    want = best_by_hand(rows, lambda i: i % 5 == 0, k)
    assert sorted(map(tuple, got)) == want


def test_bounds_prune_and_lose_nothing():
    rnd = np.random.default_rng(4)
    centres = top_k.farthest_first(np.concatenate([rnd.normal(size=(60, 4)) + 8 * c for c in np.eye(4)]), 16)
    radii = np.full(len(centres), 0.5)
    tree = top_k.Tree.over(centres, radii)
    limits = top_k.bounds(centres, radii, centres, radii)
    worst = np.full(len(centres), float(np.median(limits)))
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(limits >= worst[0]), strict=True)}
    assert set(top_k.surviving_pairs(tree, tree, worst)) == want and len(want) < limits.size


def test_search_without_queries(spark):
    table = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert top_k.search(table, F.col("id") == 2).count() == 0
    assert top_k.search(table.limit(0), F.col("id") == 2).count() == 0
    assert top_k.search(table, F.col("id") == 1).count() == 0


def page_rows():
    rnd = random.Random(1)
    long = ["<p>" + "é" * rnd.randint(60, 90) + str(i) + "\r\n\r\nWARC/1.1\r\n</p>" for i in range(4)]
    rows = [(i, f"http://x/{i}", rnd.choice([*long, "short", "", None])) for i in range(80)]
    rows += [(200, None, long[0]), (201, "http://a\r\nb", long[1]), (None, "u", long[2]), (202, "u", "x" * 99), (203, "u", "x" * 99)]
    return rows + [(204, "u", "y" * 100), (205, "u", "y" * 100), (205, "u", "y" * 100)]


def test_archive_round_trip(spark, tmp_path):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    folder = str(tmp_path / "archive")
    got = warc.archive_pages(pages.repartition(4), folder=folder).collect()
    assert len(got) == len(rows)
    firsts = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if i is not None and len(raw) >= 100:
            firsts[raw] = min(firsts.get(raw, i), i)
    want = []
    for i, url, html in rows:
        raw = (html or "").encode()
        first = firsts.get(raw) if i is not None else None
        later = first is not None and i > first
        want.append(
            (i, url and url.replace("\r\n", "%0D%0A"), len(raw), hashlib.sha256(raw).hexdigest(),
             "revisit" if later else "response", first if later else None)
        )
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(want, key=repr)
    stored = warc.read_payloads(spark, folder)
    assert stored.count() == len({(h or "").encode() for _, _, h in rows})
    by_id = {r["page_id"]: r for r in warc.rebuild_records(spark, folder).collect()}
    for i, _, html in rows:
        raw = (html or "").encode()
        record = bytes(by_id[i]["record"])
        head, body = record.split(b"\r\n\r\n", 1)
        own = raw if by_id[i]["record_type"] == "response" else b""
        assert body == own + b"\r\n\r\n" and bytes(by_id[i]["payload"]) == raw
        assert f"Content-Length: {len(own)}".encode() in head and head.startswith(b"WARC/1.1\r\n")
    exported = str(tmp_path / "files")
    warc.export_warc(spark, folder, exported)
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "files").glob("part-*")))
    assert len(whole) == sum(len(bytes(r["record"])) for r in warc.rebuild_records(spark, folder).collect())


def test_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a" * 200)], "page_id long, url string, html string")
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.encode(F.lit("b" * 200), "UTF-8")).write.parquet(f"{folder}/other")
    damaged = spark.read.parquet(f"{folder}/other")
    damaged.write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_pages(spark, folder).collect()


@pytest.mark.parametrize("read", [warc.read_pages, warc.rebuild_records])
@pytest.mark.parametrize("kind", ["response", "revisit"])
def test_records_without_a_stored_payload_are_found(spark, tmp_path, read, kind):
    rows = [(1, "u", "a" * 200), (2, "v", "a" * 200), (3, "w", "b")]
    folder = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    assert read(spark, folder).count() == 3
    records = spark.read.parquet(f"{folder}/records").collect()
    left = [tuple(r) for r in records if f"WARC-Type: {kind}" in r["header"]]
    spark.createDataFrame(left, "header string").write.mode("overwrite").parquet(f"{folder}/records")
    spark.createDataFrame([], "payload_digest string, payload binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="record without its payload"):
        read(spark, folder).collect()


def test_a_page_is_read_from_its_rebuilt_record(spark, tmp_path, monkeypatch):
    # A record put together wrongly shows in what the pages are read as.
    folder = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame([(1, "u", "a" * 200)], "page_id long, url string, html string"), folder)
    monkeypatch.setattr(warc, "_record", lambda own: F.concat(F.encode("header", "UTF-8"), F.reverse(F.lit("x" * 204)).cast("binary")))
    with pytest.raises(Exception, match="record without its payload"):
        warc.read_pages(spark, folder).collect()


def test_empty_archive(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages).count() == 0
