"""The queries of this package over the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import bpe, lexical, lines, main_text, near_duplicates, ngram_join, packing, periodic, quality, substrings, token_counts, top_k, warc
from labelloom.llm.quality import let

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


OP1_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT row_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS digest
  FROM (SELECT row_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM texts WHERE len(w) >= 35)
), repeated AS (
  SELECT row_id, i FROM windows WHERE digest IN (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1)
), removed AS (
  SELECT DISTINCT row_id, p FROM (SELECT row_id, unnest(generate_series(i, i + 34)) AS p FROM repeated)
), tokens AS (
  SELECT row_id, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM texts
), kept AS (
  SELECT row_id, string_agg(t.w, ' ' ORDER BY t.p) AS kept, count(*) AS n
  FROM tokens t ANTI JOIN removed r USING (row_id, p) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row_id)
"""


@query("op1_substring_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    words = quality.words_of(F.coalesce("text", F.lit("")))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line,
         list_distinct(regexp_extract_all(string_split(coalesce(text, ''), chr(10))[i], '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)
), sets AS (
  SELECT min({'doc_id': doc_id, 'line': line}) AS id, list_sort(w) AS w, len(w) AS n
  FROM lines WHERE len(w) > 0 GROUP BY list_sort(w), len(w)
), frequency AS (
  SELECT w, count(*) AS f FROM (SELECT unnest(w) AS w FROM sets) GROUP BY w
), tokens AS (
  SELECT id, n, w, row_number() OVER (PARTITION BY id ORDER BY f, w) AS place
  FROM (SELECT id, n, unnest(w) AS w FROM sets) JOIN frequency USING (w)
), prefixes AS (
  SELECT * FROM tokens WHERE place <= n - ceil(n * 8 / 10) + 1
), pairs AS (
  SELECT DISTINCT x.id AS a, y.id AS b FROM prefixes x JOIN prefixes y ON x.w = y.w AND y.id < x.id
  WHERE 10 * least(x.n, y.n) >= 8 * greatest(x.n, y.n)
), later AS (
  SELECT DISTINCT a FROM (
    SELECT a, x.n AS n, y.n AS m, len(list_intersect(x.w, y.w)) AS shared
    FROM pairs JOIN sets x ON x.id = a JOIN sets y ON y.id = b
  ) WHERE 10 * shared >= 8 * (n + m - shared)
)
SELECT id.doc_id AS doc_id, id.line AS line, CAST(n AS INTEGER) AS n_distinct_words
FROM sets WHERE id NOT IN (SELECT a FROM later)
"""


@query("op2_line_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.kept_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select(F.col("doc").alias("doc_id"), "line", F.col("n").alias("n_distinct_words"))


@query("op3_html_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return main_text.extract(pages).drop("html")


@query("op4_harmonic_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)
    return packed.drop("piece_ids")


OP5_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM texts WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  JOIN sizes n ON n.doc_id = x.doc_id JOIN sizes m ON m.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, n.n, m.n HAVING 100 * count(*) >= 85 * (n.n + m.n - count(*))
), arcs AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM texts
  UNION
  SELECT r.doc_id, arcs.b FROM reached r JOIN arcs ON arcs.a = r.other
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""


@query("op5_minhash_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    linked = near_duplicates.components(docs, percent=85, collections=16)
    return linked.select("doc_id", "n_shingles", "component_id", "kept")


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)


@query("op7_bpe_trie")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.encode_and_decode(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


OP8_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts
), tokens AS (
  SELECT row_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM words
), windows AS (
  SELECT row_id, i, w AS a, lead(w) OVER ordered AS b, lead(w, 2) OVER ordered AS c
  FROM tokens WINDOW ordered AS (PARTITION BY row_id ORDER BY i)
), counted AS (
  SELECT row_id, i, count(*) OVER (PARTITION BY row_id, a, b, c) AS found FROM windows WHERE c IS NOT NULL
), covered AS (
  SELECT row_id, count(DISTINCT p) AS n
  FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE found >= 2) GROUP BY row_id
), lines AS (
  SELECT row_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id
), measured AS (
  SELECT t.doc_id, t.source, CAST(len(w.w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts t JOIN words w USING (row_id) LEFT JOIN covered c USING (row_id) LEFT JOIN lines l USING (row_id)
), judged AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM measured
), hosts AS (
  SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS f FROM judged
  WHERE source IS NOT NULL GROUP BY source
), sums AS (
  SELECT count(*) AS k, sum(n) AS d, sum(f) AS t, sum(f) / sum(n) AS m,
         sum(n * n) AS squares, sum(f * f / n) AS spread FROM hosts
), prior AS (
  SELECT m, CASE WHEN m * (1 - m) > 0 AND d - squares / d - (k - 1) > 0
              THEN least(greatest(((spread - t * m) / (m * (1 - m)) - (k - 1)) / (d - squares / d - (k - 1)), 0), 1)
              ELSE 0 END AS overlap FROM sums
), verdicts AS (
  SELECT source, CASE WHEN overlap > 0 THEN (f + m * (1 / overlap - 1)) / (n + (1 / overlap - 1)) ELSE m END AS share
  FROM hosts, prior
)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(v.share > 0.5, false) AS kept
FROM judged j LEFT JOIN verdicts v ON j.source = v.source
"""


@query("op8_host_quality", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents", "doc_id", "text", "source"), keep_text=False)
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


OP9_SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM sound q JOIN sound d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op9_cover_tree_top_k", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k.search(vectors, F.col("id") % 20 == 0)


OP10_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM firsts
"""


@query("op10_warc_archive", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

OP11_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (
  SELECT row_id, doc_id, len(w) AS n FROM texts WHERE len(w) > 0
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), postings AS (
  SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(w) AS term FROM texts) GROUP BY row_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(docs AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM postings, totals GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, row_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (row_id), totals
  GROUP BY item_id, row_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op11_pair_bound_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), k=10)


OP12_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM texts WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  JOIN sizes n ON n.doc_id = x.doc_id JOIN sizes m ON m.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, n.n, m.n HAVING 100 * count(*) >= 80 * (n.n + m.n - count(*))
), arcs AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), linked AS (
  SELECT a AS doc_id, count(*) AS n_links FROM arcs GROUP BY a
), reached AS (
  SELECT doc_id, doc_id AS other FROM texts
  UNION
  SELECT r.doc_id, arcs.b FROM reached r JOIN arcs ON arcs.a = r.other
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM reached LEFT JOIN sizes USING (doc_id) LEFT JOIN linked USING (doc_id) GROUP BY doc_id, n, n_links
"""


@query("op12_ngram_jaccard", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join_components(table(spark, sf_dir, "documents", "doc_id", "text"), percent=80)
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


OP13_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])) AS bits
  FROM documents
), hashed AS (
  SELECT row_id, doc_id, w, len(w) AS n, xor(4294967295, list_reduce(list_prepend(4294967295, bits),
           lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)))) AS h
  FROM texts
), planted AS (
  SELECT row_id, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
           list_transform(range(n), lambda i: w[1 + CASE WHEN i < (h // 10) % n THEN i
             ELSE (h // 10) % n + (i - (h // 10) % n) % (1 + (n - (h // 10) % n) // (3 + (h // 10) % 8)) END])
           ELSE w END AS w
  FROM hashed
), tokens AS (
  SELECT row_id, n, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM planted
), matched AS (
  SELECT x.row_id, x.i, y.i - x.i AS q FROM tokens x JOIN tokens y
  ON x.row_id = y.row_id AND x.w = y.w AND x.i < y.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT row_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row_id, q ORDER BY i) AS island FROM matched)
  GROUP BY row_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT row_id, start, length, min(q) AS period FROM stretches GROUP BY row_id, start, length
), listed AS (
  SELECT row_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing,
         first({'start': start, 'length': length, 'period': period}
               ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS best
  FROM runs GROUP BY row_id
), dropped AS (
  SELECT DISTINCT row_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT row_id, string_agg(t.w, ' ' ORDER BY t.i) AS kept FROM tokens t ANTI JOIN dropped d USING (row_id, i) GROUP BY row_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start,
       CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
       CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (row_id) LEFT JOIN kept USING (row_id)
"""


def planted(doc_id: Column, text: Column) -> Column:
    """The texts op13 is asked about: in one of ten documents the words from a place on repeat."""

    def repeat(x: Column) -> Column:
        n, g = F.size(x["w"]), F.call_function("div", x["h"], F.lit(10))
        a = (g % n).cast("int")
        p = (F.lit(1) + F.call_function("div", n - a, F.lit(3) + g % 8)).cast("int")
        again = let(
            F.struct(x["w"].alias("w"), a.alias("a"), p.alias("p"), n.alias("n")),
            lambda y: F.transform(
                F.sequence(F.lit(0), y["n"] - 1),
                lambda i: F.get(y["w"], F.when(i < y["a"], i).otherwise(y["a"] + (i - y["a"]) % y["p"])),
            ),
        )
        return F.when(n > 0, F.array_join(again, " ")).otherwise("")

    h = F.crc32(doc_id.cast("string"))
    made = let(F.struct(h.alias("h"), quality.words_of(F.coalesce(text, F.lit(""))).alias("w")), repeat)
    return F.when(h % 10 == 0, made).otherwise(text)


@query("op13_periodic_runs", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = periodic.collapse_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    listing = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = {c: F.col(f"strongest.{c}") for c in periodic.RUN.names}
    return found.select(
        "doc_id",
        "n_runs",
        *[value.alias(c) for c, value in best.items()],
        F.call_function("div", 1000 * best["length"], best["period"]).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listing, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
