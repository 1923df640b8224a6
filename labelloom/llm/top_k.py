"""Exact top-k by inner product with a dual tree of covering balls.

Queries and data are indexed by one tree. Its centres come from a farthest-first walk over a
bounded sample: the first points of the walk cover the space coarsely, more of them finely,
so every prefix is a level of a cover tree and a finer centre's parent is the nearest coarser
one. Every row goes to its nearest centre of a level; a node's covering radius is measured over all of
its rows. Two nodes with centres p, q and radii r, s hold no pair of an inner product above
<p, q> + r |q| + s |p| + r s.

First each query group is scored against the nodes most promising for it. The worst kth score
of a group then prunes node pairs from the top of the tree down. What is left is scored in
blocks, and only scores that reach the query's own kth are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.columns import quoted
from labelloom.session import staged

# Rows of a block that are scored together, on either side.
QUERY_BLOCK = 1024
DATA_BLOCK = 4096

# Most centres on either side, and the sample they are chosen from. Every row is indexed.
MOST_QUERY_NODES = 128
MOST_DATA_NODES = 512
SAMPLE = 4096

# Room for rounding in bounds, which are sums of products of doubles.
SLACK = 1e-9


def farthest_first(points: np.ndarray, count: int) -> np.ndarray:
    """Points chosen one after the other, each the farthest from those before."""
    chosen = [0]
    distance = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < count and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's nearest centre and the distance to it."""
    best, where = np.full(len(points), np.inf), np.zeros(len(points), np.int64)
    for i, centre in enumerate(centres):
        distance = np.linalg.norm(points - centre, axis=1)
        closer = distance < best
        best[closer], where[closer] = distance[closer], i
    return where, best


@dataclass
class Tree:
    """One side's nodes: levels of prefixes of the centres, coarse to fine, with their radii."""

    levels: list[np.ndarray]  # centres of each level
    parents: list[np.ndarray]  # parent of each node in the level above
    radii: list[np.ndarray]  # -1 for a node without rows

    @staticmethod
    def over(centres: np.ndarray, radii: np.ndarray) -> Tree:
        levels, parents, covered = [centres], [], [radii]
        while len(levels[0]) > 1:
            upper = levels[0][: -(-len(levels[0]) // 4)]
            parent, distance = nearest(levels[0], upper)
            reach = np.full(len(upper), -1.0)
            filled = covered[0] >= 0
            np.maximum.at(reach, parent[filled], distance[filled] + covered[0][filled])
            levels, parents, covered = [upper, *levels], [parent, *parents], [reach, *covered]
        return Tree(levels, parents, covered)

    def children(self, level: int, node: int) -> np.ndarray:
        return np.flatnonzero(self.parents[level] == node) if level < len(self.parents) else np.array([node])


def bounds(p: np.ndarray, r: np.ndarray, q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The largest inner product any two rows of the nodes can have, for each pair of nodes."""
    lengths_p, lengths_q = np.linalg.norm(p, axis=1), np.linalg.norm(q, axis=1)
    size = np.outer(lengths_p + r, lengths_q + s)
    return p @ q.T + np.outer(r, lengths_q) + np.outer(lengths_p, s) + np.outer(r, s) + SLACK * size


def surviving_pairs(queries: Tree, data: Tree, worst: np.ndarray) -> list[tuple[int, int]]:
    """Leaf pairs that may hold a score of at least the query leaf's worst kth score."""
    lowest = [worst]
    for parent, upper in zip(reversed(queries.parents), reversed(queries.levels[:-1]), strict=True):
        low = np.full(len(upper), np.inf)
        np.minimum.at(low, parent, lowest[0])
        lowest.insert(0, low)
    found: list[tuple[int, int]] = []
    pairs = [(0, 0, 0, 0)]
    while pairs:
        a, i, b, j = pairs.pop()
        r, s = queries.radii[a][i], data.radii[b][j]
        if r < 0 or s < 0:
            continue
        p, q = queries.levels[a][[i]], data.levels[b][[j]]
        if bounds(p, np.array([r]), q, np.array([s]))[0, 0] < lowest[a][i]:
            continue
        last_a, last_b = a + 1 == len(queries.levels), b + 1 == len(data.levels)
        if last_a and last_b:
            found.append((i, j))
            continue
        down_a = [(a, i)] if last_a else [(a + 1, c) for c in queries.children(a, i)]
        down_b = [(b, j)] if last_b else [(b + 1, c) for c in data.children(b, j)]
        pairs += [(*x, *y) for x in down_a for y in down_b]
    return found


def _vectors(df: DataFrame, id_column: str, vector: str, scale: float) -> DataFrame:
    """(id, point): whole numbers floor(scale * x) as packed doubles, of the sound vectors.

    Rows that share an id keep the smallest packed point, so results do not depend on order.
    """
    source = df.select(df[quoted(id_column)].cast("long").alias("id"), df[quoted(vector)].alias("vector"))
    source = source.filter("id IS NOT NULL AND vector IS NOT NULL")
    longest = source.agg(F.max(F.size("vector"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, points = [], []
            for key, values in zip(batch.column("id").to_pylist(), batch.column("vector"), strict=True):
                row = np.zeros(longest)
                own = values.values.cast(pa.float64()) if values.values is not None else pa.array([], pa.float64())
                if own.null_count:
                    continue
                row[: len(own)] = own.to_numpy(zero_copy_only=False)
                if np.isfinite(row).all():
                    ids.append(key)
                    points.append((np.floor(scale * row) + 0.0).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(points, pa.binary())], ["id", "point"])

    return source.mapInArrow(run, "id long, point binary").groupBy("id").agg(F.min("point").alias("point"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def _indexed(points: DataFrame, queries: np.ndarray, data: np.ndarray) -> DataFrame:
    """Adds each row's leaf among the query centres and among the data centres, with distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column("point"))
                made = [*nearest(matrix, queries), *nearest(matrix, data)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("point"), *map(pa.array, made)],
                    ["id", "point", "query_leaf", "query_distance", "data_leaf", "data_distance"],
                )

    schema = "id long, point binary, query_leaf long, query_distance double, data_leaf long, data_distance double"
    return points.mapInArrow(run, schema)


def _leaves(rows: DataFrame, leaf: str, distance: str, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and covering radius of every leaf; one row per leaf comes to the driver."""
    sizes, radii = np.zeros(count, np.int64), np.full(count, -1.0)
    for node, n, radius in rows.groupBy(leaf).agg(F.count("*"), F.max(distance)).collect():
        sizes[node], radii[node] = n, radius * (1 + SLACK)
    return sizes, radii


def _scored(
    queries: DataFrame, data: DataFrame, pairs: list[tuple[int, int]], sizes: tuple[np.ndarray, np.ndarray], k: int
) -> DataFrame:
    """The k best (query, id, score) of each query in each block of the leaf pairs' data.

    Leaves are dealt into blocks by a hash of the id, so a leaf with a third of all rows is
    many blocks. The pairs are at most MOST_QUERY_NODES * MOST_DATA_NODES, so they are sent.
    """
    spark = queries.sparkSession
    query_blocks, data_blocks = (
        np.maximum(-(-own // block), 1) for own, block in zip(sizes, (QUERY_BLOCK, DATA_BLOCK), strict=True)
    )
    listed = [(q, d, int(query_blocks[q]), int(data_blocks[d])) for q, d in pairs]
    table = F.broadcast(spark.createDataFrame(listed, "query_leaf long, data_leaf long, query_blocks int, data_blocks int"))

    def block(blocks: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    keys = ["query_leaf", "query_block", "data_leaf", "data_block"]
    left = (
        queries.select("id", "point", "floor", "query_leaf")
        .join(table, "query_leaf")
        .select("*", block("query_blocks").alias("query_block"), every("data_blocks").alias("data_block"))
        .select(F.col("id").alias("query_id"), F.col("point").alias("query_point"), "floor", *keys)
    )
    right = (
        data.select("id", "point", "data_leaf")
        .join(table, "data_leaf")
        .select("*", block("data_blocks").alias("data_block"), every("query_blocks").alias("query_block"))
        .select(F.col("id").alias("vec_id"), F.col("point").alias("data_point"), *keys)
    )

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not one.num_rows or not other.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        other = other.sort_by("vec_id")
        ids, floors = one.column("query_id").to_numpy(), one.column("floor").to_numpy()
        found = other.column("vec_id").to_numpy()
        scores = _matrix(one.column("query_point")) @ _matrix(other.column("data_point")).T
        made: list[tuple[np.ndarray, ...]] = []
        for row, (key, floor) in enumerate(zip(ids, floors, strict=True)):
            own = scores[row]
            good = np.flatnonzero((own >= floor) & (found != key))
            if len(good) > k:
                # The kth best score here; ids are in order, so equal scores stay so.
                edge = np.partition(own[good], len(good) - k)[len(good) - k]
                good = good[own[good] >= edge]
                good = good[np.lexsort((found[good], -own[good]))][:k]
            made.append((np.full(len(good), key), found[good], own[good].astype(np.int64)))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*made, strict=True)], names=names)

    grouped = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return grouped.applyInArrow(run, "query_id long, vec_id long, score long")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query, exactly.

    Components count as floor(scale * x). Queries are the rows with is_query (a condition on
    ``id``); candidates are all rows but the query's own. Equal scores go to the smaller id. A
    query with fewer than k candidates gets all. Rows without an id, null vectors and vectors
    with a null or non-finite component take no part. Shorter vectors are filled up with zeros.
    Of rows that share an id one counts, the one with the smallest packed vector. An empty
    table gives no rows. Other columns are not looked at.

    Only the sample of SAMPLE rows, the leaves and the leaf pairs come to the driver, all of
    a fixed size.
    """
    spark = df.sparkSession
    points = staged(_vectors(df, id_column, vector, scale), "points")
    total, asked = points.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("point").collect()
    matrix = np.frombuffer(b"".join(bytes(r[0]) for r in sample), "<f8").reshape(len(sample), -1)
    centres = farthest_first(matrix, max(MOST_QUERY_NODES, MOST_DATA_NODES))
    query_centres = centres[: min(MOST_QUERY_NODES, -(-asked // QUERY_BLOCK))]
    data_centres = centres[: min(MOST_DATA_NODES, -(-total // DATA_BLOCK))]
    index = staged(_indexed(points, query_centres, data_centres), "index")
    queries = index.filter(is_query)
    query_sizes, query_radii = _leaves(queries, "query_leaf", "query_distance", len(query_centres))
    data_sizes, data_radii = _leaves(index, "data_leaf", "data_distance", len(data_centres))
    sizes = (query_sizes, data_sizes)
    promise = bounds(query_centres, np.maximum(query_radii, 0), data_centres, np.maximum(data_radii, 0))
    first: list[tuple[int, int]] = []
    for q in np.flatnonzero(query_sizes):
        held = 0
        for d in np.argsort(-promise[q], kind="stable"):
            if held <= k and data_sizes[d]:
                first.append((int(q), int(d)))
                held += data_sizes[d]
    floorless = queries.withColumn("floor", F.lit(float("-inf")))
    begun = staged(_best(_scored(floorless, index, first, sizes, k), k).drop("rank"), "begun")
    # A query's kth score so far; one without k candidates yet takes any score.
    floors = begun.groupBy("query_id").agg(F.min("score").cast("double").alias("floor"), F.count("*").alias("n"))
    with_floor = staged(
        queries.join(floors.filter(F.col("n") >= k).drop("n"), F.col("id") == F.col("query_id"), "left")
        .drop("query_id")
        .fillna(float("-inf"), ["floor"]),
        "queries",
    )
    worst = np.full(len(query_centres), np.inf)
    for leaf, floor in with_floor.groupBy("query_leaf").agg(F.min("floor")).collect():
        worst[leaf] = floor
    pairs = surviving_pairs(Tree.over(query_centres, query_radii), Tree.over(data_centres, data_radii), worst)
    rest = sorted({(int(q), int(d)) for q, d in pairs} - set(first))
    scored = begun
    if rest:
        scored = begun.unionByName(_scored(with_floor, index, rest, sizes, k))
    return _best(scored, k).select("query_id", "rank", "vec_id", "score")
