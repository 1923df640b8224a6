"""Ranked lexical search of many queries at once, by MaxScore with bounds of term pairs.

The index is cut into segments of documents. A segment holds, for every term, the documents it is
in and how often; its row of the empty term holds the documents' ids and lengths. The queries,
in blocks, go to every segment with the weights that follow from counts over all documents, and
each segment gives its best documents for each query; the best of those are the result.

In a segment every term of a query has a largest impact. Taken alone these bounds are loose: two
terms seldom have their largest impact in one document, and many never meet. So before any query
is run the documents that hold both of two frequent terms of a query are listed once for all
queries of the block, and the largest joint impact of each list is kept. A query then takes
disjoint pairs, those first that tighten most: of two terms no document gets more than the
larger of their joint impact and either one alone.

Terms are worked off from the largest impact down. As soon as the sum of what the remaining
terms can give, by pairs, is less than the k-th best score so far, no document without one of
the terms done can be among the best; only those that can still reach it are looked up in the
remaining lists, and dropped as the bound falls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.llm.columns import quoted, slices, written

# Terms of a segment's documents; a longer document is a segment by itself.
SEGMENT_TERMS = 1_000_000

# Queries in a block, or so.
BLOCK = 256

# Terms of a query that are paired, those of most documents first, and the fewest documents.
PAIRED = 12
LEAST_LIST = 8

# Terms are what stands between these bytes, A-Z in lower case; fixed values of the contract.
_TERMS = bytes(
    32 if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text: letters and digits, and whatever is not ASCII."""
    return (text or "").encode().translate(_TERMS).split()


INDEX = T.StructType(
    [
        T.StructField("segment", T.LongType()),
        T.StructField("term", T.StringType()),
        T.StructField("docs", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.IntegerType())),
        T.StructField("ids", T.ArrayType(T.LongType())),
    ]
)


def _segment(number: int, ids: list, split: list[list[bytes]]) -> pa.RecordBatch:
    """The rows of a segment: its documents first, then each term's list in order."""
    lengths = np.array([len(own) for own in split], np.int32)
    words = [w for own in split for w in own]
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    keys, counts = np.unique(codes * len(split) + np.repeat(np.arange(len(split)), lengths), return_counts=True)
    term, doc = np.divmod(keys, len(split))
    ends = np.searchsorted(term, np.arange(len(place)), "right")
    offsets = np.concatenate([[0, len(split)], len(split) + ends]).astype(np.int32)
    docs = np.concatenate([np.arange(len(split)), doc]).astype(np.int32)
    counts = np.concatenate([lengths, counts]).astype(np.int32)
    rows = len(place) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(rows, number)),
            pa.array([b"", *place], pa.binary()).cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(docs)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts)),
            pa.array([ids, *[None] * (rows - 1)], pa.list_(pa.int64())),
        ],
        INDEX.names,
    )


def build_index(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(segment, term, docs, counts, ids) of all documents that have a term; no shuffle.

    docs are places in the segment's ids, counts how often the term occurs in each. The row of
    the empty term has all places, the documents' lengths, and their ids (null elsewhere).
    """
    source = df.select(df[quoted(id_column)].cast("long").alias("id"), df[quoted(text)].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, split, size = [], [], 0
        for part in slices(batches):
            for own, value in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                terms = terms_of(value)
                if not terms:
                    continue
                if size and size + len(terms) > SEGMENT_TERMS:
                    yield _segment(number, ids, split)
                    ids, split, size, number = [], [], 0, number + 1
                ids.append(own)
                split.append(terms)
                size += len(terms)
        if size:
            yield _segment(number, ids, split)

    return source.mapInArrow(run, INDEX)


def _query_terms(queries: DataFrame, id_column: str, text: str) -> DataFrame:
    """Distinct (item, term)."""
    source = queries.select(queries[quoted(id_column)].cast("long").alias("item"), queries[quoted(text)].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [
                (item, term.decode())
                for item, value in zip(part.column("item").to_pylist(), part.column("text").to_pylist(), strict=True)
                for term in dict.fromkeys(terms_of(value))
            ]
            columns = zip(*found, strict=True) if found else [[]] * 2
            kinds = (pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item", "term"])

    return source.mapInArrow(run, "item long, term string").distinct()


def impacts(weight: int, counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to the scores of documents: whole numbers, division rounds down."""
    counts = counts.astype(np.int64)
    norm = 10 + (90 * lengths.astype(np.int64) * documents) // total
    return weight * ((1_000_000_000 * counts) // (1000 * counts + 8 * norm))


class Segment:
    """The lists of one segment for one block of queries."""

    def __init__(self, docs: list[np.ndarray], scores: list[np.ndarray], size: int) -> None:
        self.docs, self.scores, self.size = docs, scores, size
        self.most = [int(s.max()) for s in scores]
        self.joint: dict[tuple[int, int], int] = {}
        # Entries of lists added or looked up so far.
        self.work = 0

    def _frequent(self, terms: list[int]) -> list[int]:
        long = [t for t in terms if len(self.docs[t]) >= LEAST_LIST]
        return sorted(sorted(long, key=lambda t: (-len(self.docs[t]), t))[:PAIRED])

    def list_pairs(self, queries: list[list[int]]) -> None:
        """The largest joint impact of every pair of frequent terms of a query; 0 if they never meet."""
        frequent = {t: i for i, t in enumerate(sorted({t for q in queries for t in self._frequent(q)}))}
        table = np.zeros((len(frequent), self.size), np.int64)
        held = np.zeros((len(frequent), self.size), bool)
        for t, i in frequent.items():
            table[i, self.docs[t]], held[i, self.docs[t]] = self.scores[t], True
        for query in queries:
            own = self._frequent(query)
            for k, a in enumerate(own):
                for b in own[k + 1 :]:
                    if (a, b) not in self.joint:
                        i, j = frequent[a], frequent[b]
                        both = np.flatnonzero(held[i] & held[j])
                        self.joint[a, b] = int((table[i, both] + table[j, both]).max()) if len(both) else 0

    def bounds(self, order: list[int]) -> list[int]:
        """What the first 0, 1, 2, ... terms of an order can give together at most."""
        own, place = self._frequent(order), {t: i for i, t in enumerate(order)}
        saved = []
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                alone = self.most[a] + self.most[b]
                less = alone - max(self.most[a], self.most[b], self.joint[a, b])
                if less > 0:
                    saved.append((-less, a, b))
        cut, taken = [0] * len(order), set()
        for less, a, b in sorted(saved):
            if a not in taken and b not in taken:
                taken |= {a, b}
                cut[max(place[a], place[b])] = less
        bounds = [0]
        for t, less in zip(order, cut, strict=True):
            bounds.append(bounds[-1] + self.most[t] + less)
        return bounds

    def best(self, terms: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of documents, among them the k best and all equal to the last of these."""
        order = sorted(terms, key=lambda t: (self.most[t], t))
        bounds = self.bounds(order)
        score = np.zeros(self.size, np.int64)
        left, limit = len(order), 1
        while left:
            left -= 1
            score[self.docs[order[left]]] += self.scores[order[left]]
            self.work += len(self.docs[order[left]])
            limit = self._kth(score, k)
            if bounds[left] < limit:
                break
        found = np.flatnonzero(score + bounds[left] >= limit) if left else np.flatnonzero(score >= limit)
        while left:
            left -= 1
            docs = self.docs[order[left]]
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            self.work += len(found)
            score[found] += np.where(docs[at] == found, self.scores[order[left]][at], 0)
            limit = max(limit, self._kth(score[found], k))
            found = found[score[found] + bounds[left] >= limit]
        return found, score[found]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> int:
        """The k-th best score; 1 while there are fewer, which any document found reaches."""
        return max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k])) if len(scores) >= k else 1


def _best(table: pa.Table, documents: int, total: int, k: int) -> pa.Table:
    """The best documents of a segment for every query of a block."""
    terms = table.column("term").to_pylist()
    whole = terms.index("")
    ids = table.column("ids")[whole].as_py()
    counts, docs = (table.column(c).combine_chunks() for c in ("counts", "docs"))
    lengths = counts[whole].values.to_numpy()
    weights = table.column("weight").to_pylist()
    rows = [i for i, t in enumerate(terms) if t]
    lists = [docs[i].values.to_numpy() for i in rows]
    scores = [
        impacts(weights[i], counts[i].values.to_numpy(), lengths[own], documents, total) for i, own in zip(rows, lists, strict=True)
    ]
    queries: dict[int | None, list[int]] = {}
    for number, i in enumerate(rows):
        for item in table.column("items")[i].as_py():
            queries.setdefault(item, []).append(number)
    segment = Segment(lists, scores, len(lengths))
    segment.list_pairs(list(queries.values()))
    made = []
    for item, own in queries.items():
        found, score = segment.best(own, k)
        ranked = sorted(
            zip(score.tolist(), [ids[d] for d in found.tolist()], strict=True), key=lambda r: (-r[0], r[1] is None, r[1] or 0)
        )
        made += [(item, doc, value) for value, doc in ranked[:k]]
    columns = zip(*made, strict=True) if made else [[]] * 3
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["item", "doc", "score"])


def _weight(found: Column, documents: int) -> Column:
    return F.floor(1000 * F.log((2.0 * documents + 2) / (2 * found + 1).cast("double"))).cast("long")


def search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents for every query, from rank 1.

    Terms are the maximal pieces of letters a-z, digits and characters outside ASCII, A-Z lowered.
    With N documents that have a term, L terms in all of them, n in one document and df documents
    with a term: its weight is floor(1000 * ln((2N + 2) / (2 df + 1))), the rest is whole numbers,
    division rounding down: m = 10 + 90 n N / L, and a document's score is the sum of
    weight * (10^9 tf / (1000 tf + 8 m)) over the query's terms, once each. Equal scores go by
    id, a null id last. Only scores above 0 are listed.

    Null and empty texts, as documents or queries, have no terms and are in no result. Repeated
    rows, or rows of one id, are documents of their own; queries of one id are one query. Empty
    tables give no rows. Other columns of both tables are not read. Ids must be whole numbers.
    """
    for frame, column in ((df, id_column), (queries, query_id)):
        if not isinstance(frame.schema[column].dataType, T.IntegralType):
            raise ValueError("ids must be whole numbers")
    index = written(build_index(df, id_column, text), "index")
    documents, total = index.filter("term = ''").agg(
        F.coalesce(F.sum(F.size("docs")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)), F.lit(0)),
    ).first()
    asked = written(_query_terms(queries, query_id, query_text), "asked")
    blocks = max(1, -(-asked.select("item").distinct().count() // BLOCK))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    # Every block needs the row of a segment's documents too.
    wanted = asked.select("term").distinct().union(asked.sparkSession.range(1).select(F.lit("").alias("term")))
    lists = written(index.join(wanted, "term"), "lists")
    found = lists.filter("term <> ''").groupBy("term").agg(F.sum(F.size("docs")).alias("found"))
    weights = found.select("term", _weight(F.col("found"), documents).alias("weight")).filter("weight > 0")
    parts = (
        asked.select("term", block.alias("block"), "item")
        .groupBy("term", "block")
        .agg(F.collect_list(F.struct("item")).alias("items"))
        .select("term", "block", F.col("items.item").alias("items"))
        .join(weights, "term")
    )
    every = asked.sparkSession.range(blocks).select(
        F.lit("").alias("term"), F.col("id").cast("int").alias("block"), F.array().cast("array<long>").alias("items"), F.lit(0).cast("long").alias("weight")
    )
    dealt = lists.join(written(parts.select(*every.columns).union(every), "weights"), "term")

    def run(table: pa.Table) -> pa.Table:
        return _best(table, documents, total, k)

    best = dealt.groupBy("segment", "block").applyInArrow(run, "item long, doc long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = best.select("item", F.row_number().over(order).alias("rank"), "doc", "score").filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
