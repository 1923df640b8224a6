"""Near-duplicate documents by MinHash with tensored bands, links confirmed on full sets.

A band table needs a key that hardly ever agrees by chance, so many minhashes. Tensoring makes
keys of pairs of short collections: from m collections come m (m - 1) / 2 tables, while only
m short collections of minhashes are computed, about the square root of what separate tables
take. Two documents meet if at least two of their collections agree.

Documents with equal sets are one class from the start, so copies never meet each other. In a
table's bucket every class is first held against the bucket's smallest and largest class;
classes that are linked by then need not be compared again. Buckets whose other classes are
still apart, mostly texts of one pattern that are less alike than asked for, are verified
together by an exact join that compares blocks of them and never makes their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.llm.columns import quoted, without, written
from labelloom.llm.components import smallest_reachable
from labelloom.llm.ngram_join import join_components
from labelloom.llm.shingles import batched, set_digests, shingle_sets
from labelloom.llm.words import joined

# Pairs compared together, and classes whose keys are made together.
PAIRS_TOGETHER = 2_000
KEYS_TOGETHER = 1_000

# Pairs at the limit that may be missed, where the number of collections is not given, and the
# most collections taken by themselves (their tables are half as many as their square).
MISS = 1e-6
MOST_COLLECTIONS = 64

# Smallest members of a set that are kept to estimate how alike two sets are.
LOWEST = 128

def _minhashes(sets: list[np.ndarray], factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """One row of minhashes for every set; the sets must not be empty."""
    whole = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    return np.stack([np.minimum.reduceat((whole ^ s) * f, starts) for f, s in zip(factors, shifts, strict=True)], axis=1)


def _cut(values: np.ndarray) -> np.ndarray:
    """The upper 32 bits, as signed numbers in the same order."""
    return ((values >> np.uint64(32)).astype(np.int64) - (1 << 31)).astype(np.int32)


def least_agreement(hashes: int, percent: int) -> int:
    """Minhashes a pair at the limit agrees in at least, but for one pair in a million."""
    p, tail = percent / 100, 0.0
    for n in range(hashes + 1):
        tail += comb(hashes, n) * p**n * (1 - p) ** (hashes - n)
        if tail > 1e-6:
            return n
    return hashes


def miss_rate(collections: int, each: int, percent: int) -> float:
    """The probability that a pair at the limit meets in no table."""
    p = (percent / 100) ** each
    return (1 - p) ** collections + collections * p * (1 - p) ** (collections - 1)


def enough_collections(percent: int, each: int) -> int:
    """The fewest collections that miss no more than MISS of the pairs at the limit."""
    for collections in range(2, MOST_COLLECTIONS + 1):
        if miss_rate(collections, each, percent) <= MISS:
            return collections
    raise ValueError(f"{percent} percent needs more than {MOST_COLLECTIONS} collections of {each}: give collections and each")


def _apart(text: Column) -> Column:
    """128 bits that tell apart the texts of rows with one id."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))


SIGNATURES = [
    ("__llm_size", T.LongType()),
    ("__llm_low", T.LongType()),
    ("__llm_high", T.LongType()),
    ("__llm_parts", T.ArrayType(T.LongType())),
    ("__llm_hashes", T.ArrayType(T.IntegerType())),
    ("__llm_lowest", T.ArrayType(T.IntegerType())),
]


def _signatures(df: DataFrame, words: int, collections: int, each: int) -> DataFrame:
    """Size of each row's set, a 128-bit digest of it, its collections, its minhashes cut to 32
    bits, and the LOWEST smallest members, cut likewise and in order."""
    random = np.random.default_rng(20240501)
    factors, shifts = random.integers(1, 2**63, (2, collections * each), np.uint64) | np.uint64(1)
    names = ["__llm_row", "__llm_hash"]
    schema = T.StructType([df.schema[n] for n in names] + [T.StructField(n, t) for n, t in SIGNATURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__llm_text").to_pylist()
            for rows in batched(texts):
                sets = shingle_sets([texts[r] for r in rows], words)
                filled = [i for i, own in enumerate(sets) if len(own)]
                sizes = np.array([len(own) for own in sets], np.int64)
                low, high = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                parts: list = [[]] * len(sets)
                hashes: list = [[]] * len(sets)
                if filled:
                    found = [sets[i] for i in filled]
                    low[filled], high[filled] = set_digests(found)
                    minhashes = _minhashes(found, factors, shifts)
                    made = minhashes[:, ::each]
                    for k in range(1, each):
                        made = joined(made, minhashes[:, k::each])
                    for i, own, short in zip(
                        filled, made.view(np.int64), _cut(minhashes), strict=True
                    ):
                        parts[i], hashes[i] = own, short
                where = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n).take(where) for n in names],
                        pa.array(sizes),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.array(parts, pa.list_(pa.int64())),
                        pa.array(hashes, pa.list_(pa.int32())),
                        pa.array([_cut(own[:LOWEST]) for own in sets], pa.list_(pa.int32())),
                    ],
                    schema.names,
                )

    return df.select(*names, "__llm_text").mapInArrow(run, schema)


def _keyed(classes: DataFrame, collections: int) -> DataFrame:
    """A row (key, head) for each pair of a class's collections, keys of different pairs apart."""
    tables = np.array(list(combinations(range(collections), 2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.arange(1, len(tables) + 1, dtype=np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, KEYS_TOGETHER):
                part = batch.slice(at, KEYS_TOGETHER)
                parts = part.column("parts").flatten().to_numpy().view(np.uint64).reshape(-1, collections)
                keys = joined(joined(parts[:, tables[:, 0]], parts[:, tables[:, 1]]), names[None, :])
                heads = np.repeat(part.column("head").to_numpy(), len(tables))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(heads)], ["key", "head"])

    return classes.select("parts", F.col("head.__llm_row").alias("head")).mapInArrow(run, "key long, head long")


def _agreement(one: str, other: str) -> Column:
    """In how many places two arrays of one length agree."""
    same = F.zip_with(one, other, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, agrees: total + agrees)


def _estimate(least: int) -> Column:
    """Whether the sets' lowest members rule a pair out: of the LOWEST members of the union,
    how many are in both sets. Smaller unions are left to the full comparison."""
    union = F.slice(F.sort_array(F.array_union("lowest_a", "lowest_b")), F.lit(1), F.lit(LOWEST))
    both = F.array_intersect(F.array_intersect("lowest_a", "lowest_b"), union)
    return (F.size(union) < LOWEST) | (F.size(both) >= least)


def _alike(collections: int, each: int, percent: int) -> Column:
    """Filters on size, minhashes and lowest members of two classes, cheapest first."""
    return (
        _near_sizes("size_a", "size_b", percent)
        & (_agreement("hashes_a", "hashes_b") >= least_agreement(collections * each, percent))
        & _estimate(least_agreement(LOWEST, percent))
    )


def _side(classes: DataFrame, name: str) -> DataFrame:
    """The classes as one side of a pair."""
    return classes.select(F.col("head").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in SIDE])


def _likely(pairs: DataFrame, classes: DataFrame, alike: Column) -> DataFrame:
    """The pairs (a, b) of rows, given by id, as classes, where they can be alike."""
    left, right = _side(classes, "a"), _side(classes, "b")
    one = pairs.join(left, pairs["a"] == left["a.__llm_row"]).select("b", left["a"].alias("one"), *[f"{c}_a" for c in SIDE])
    both = one.join(right.withColumnRenamed("b", "other"), F.col("b") == F.col("other.__llm_row"))
    return both.filter(alike).select(F.col("one").alias("a"), F.col("other").alias("b"))


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between the ids of those pairs whose full sets agree in percent of their union."""
    left = texts.select(F.struct("__llm_row", "__llm_hash").alias("a"), F.col("__llm_text").alias("__llm_one"))
    right = texts.select(F.struct("__llm_row", "__llm_hash").alias("b"), F.col("__llm_text").alias("__llm_other"))
    both = pairs.join(left, "a").join(right, "b").select(
        F.col("a.__llm_row").alias("a"), F.col("b.__llm_row").alias("b"), "__llm_one", "__llm_other"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS_TOGETHER):
                part = batch.slice(at, PAIRS_TOGETHER)
                one, other = (part.column(c).to_pylist() for c in ("__llm_one", "__llm_other"))
                # A text is in many pairs, one after the other: its set is made once here.
                texts = list(dict.fromkeys([*one, *other]))
                sets: dict[str, np.ndarray] = {}
                for rows in batched(texts):
                    own = [texts[r] for r in rows]
                    sets.update(zip(own, shingle_sets(own, words), strict=True))
                good = []
                for x, y in zip(map(sets.__getitem__, one), map(sets.__getitem__, other), strict=True):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
                kept = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(c).filter(kept) for c in "ab"], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


# What a class brings to a pair.
SIDE = ["size", "hashes", "lowest"]


def _near_sizes(one: str, other: str, percent: int) -> Column:
    """Sets whose sizes differ more cannot agree in percent of their union."""
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def components(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    collections: int | None = None,
    each: int = 3,
) -> DataFrame:
    """Adds n_shingles, component_id and kept to every document.

    Documents are linked if 100 * intersection >= percent * union of their sets of distinct
    shingles (``words`` words, A-Z lowered; a shorter text is one shingle). component_id is the
    smallest id reachable over links, the own one included; kept tells the document with that
    id. A null text, or one without words, has an empty set and is linked with nothing, not
    even its like. A document without an id is in no component: its component_id is null and
    it is kept. Repeated rows share one fate. Rows that share an id but not their text are
    judged each by its text. An empty table stays empty. Columns named like a result are
    replaced, others stay. Ids must be whole numbers; percent must be over 50.

    A pair at the limit itself meets in no table with probability p = P(fewer than two of
    ``collections`` agree), where each agrees with (percent / 100) ** each. If not given they
    are so many that p is 1e-6 at most: 24 at 80 (8.7e-7). For 16 collections of 3 it is 1.8e-4
    at 80, 6.4e-6 at 85 and 1e-8 at 90. Of the pairs that meet, those are compared in full whose minhashes, and whose lowest members, agree as often as
    with all but one pair in a million at the limit. No link is made without the full comparison.
    """
    if not isinstance(df.schema[id_column].dataType, T.IntegralType):
        raise ValueError("ids must be whole numbers")
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50, and 100 at most")
    if collections is None:
        collections = enough_collections(percent, each)
    row = [df[quoted(id_column)].cast("long").alias("__llm_row"), _apart(df[quoted(text)]).alias("__llm_hash")]
    rows = df.select(*row, df[quoted(text)].alias("__llm_text"))
    signed = written(_signatures(rows, words, collections, each), "signatures")
    # Classes of equal sets, named by their smallest row. A class stands for all its rows.
    same = ["__llm_low", "__llm_high", "__llm_size"]
    classes = written(
        signed.filter("__llm_size > 0 AND __llm_row IS NOT NULL")
        .groupBy(*same)
        .agg(
            F.min(F.struct("__llm_row", "__llm_hash")).alias("head"),
            F.first("__llm_parts").alias("parts"),
            F.first("__llm_hashes").alias("hashes"),
            F.first("__llm_lowest").alias("lowest"),
        )
        .withColumn("size", F.col("__llm_size")),
        "classes",
    )
    keyed = _keyed(classes, collections)
    # The ends of each bucket; only buckets of two classes or more go on.
    ends = written(
        keyed.groupBy("key").agg(F.min("head").alias("low"), F.max("head").alias("high")).filter("low < high"), "buckets"
    )
    met = written(keyed.join(ends, "key"), "met")
    alike = _alike(collections, each, percent)
    stars = (
        met.select(F.explode(F.array("low", "high")).alias("end"), "head")
        .filter(F.col("head") != F.col("end"))
        .select(F.least("end", "head").alias("a"), F.greatest("end", "head").alias("b"))
        .distinct()
    )
    first = written(_likely(stars, classes, alike), "pairs")
    wanted = met.select(F.col("head").alias("__llm_row")).distinct()
    texts = rows.join(wanted, "__llm_row", "left_semi")
    texts = written(texts.dropDuplicates(["__llm_row", "__llm_hash"]), "texts")
    links = written(_confirmed(first, texts, words, percent), "links")
    labels = written(smallest_reachable(links), "labels")
    # The ends of a bucket have met all of it. Buckets whose other classes are of more than one
    # component still are compared by an exact join of these classes.
    inner = met.filter((F.col("head") != F.col("low")) & (F.col("head") != F.col("high")))
    labelled = inner.join(labels, F.col("head") == F.col("node"), "left").select(
        "key", "head", F.coalesce("component", "head").alias("component")
    )
    unsettled = (
        labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    )
    left = labelled.join(unsettled.select("key"), "key", "left_semi").select(F.col("head").alias("__llm_row")).distinct()
    left = texts.join(written(left, "unsettled"), "__llm_row", "left_semi")
    left = written(left.select(F.col("__llm_row").alias("id"), F.col("__llm_text").alias("text")), "unsettled")
    more = join_components(left, "id", "text", words, percent)
    more = written(more.select(F.col("component_id").alias("a"), F.col("id").alias("b")).filter("a < b"), "links")
    labels = written(smallest_reachable(links.union(more)), "labels")
    of_class = written(
        classes.join(labels, F.col("head.__llm_row") == F.col("node"), "left").select(
            *same, F.coalesce("component", "head.__llm_row").alias("__llm_component")
        ),
        "components",
    )
    # A class may hold a third of all rows: both sides are read afresh, so Spark can split it.
    verdicts = (
        signed.select("__llm_row", "__llm_hash", *same)
        .join(of_class, same, "left")
        .groupBy("__llm_row", "__llm_hash")
        .agg(F.max("__llm_size").alias("n_shingles"), F.min("__llm_component").alias("__llm_component"))
    )
    results = ["n_shingles", "component_id", "kept"]
    own = without(df, results)
    keyed_rows = df.select(*[df[quoted(c)] for c in own], *[c.alias(f"__llm_{i}") for i, c in enumerate(row)])
    joined_rows = keyed_rows.join(
        verdicts,
        F.col("__llm_0").eqNullSafe(F.col("__llm_row")) & (F.col("__llm_1") == F.col("__llm_hash")),
        "left",
    )
    component = F.when(F.col("__llm_0").isNotNull(), F.coalesce("__llm_component", "__llm_0"))
    return joined_rows.select(
        *[F.col(quoted(c)) for c in own],
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("__llm_0") == component, F.lit(True)).alias("kept"),
    )
