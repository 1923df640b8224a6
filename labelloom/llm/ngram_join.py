"""Exact join of documents on the Jaccard similarity of their word n-grams, by adaptive
multi-match prefixes.

The members of a set stand in one fixed order, that of their digests. Of n members a similar set
must share o = ceil(percent * n / 100) at least, so two similar sets share l members among the
first n - o + l of each (the l-prefix), for every l up to o. Documents are looked up by the members
of their prefixes, and a pair goes on to the full comparison only if it shares as many as its
prefix length promises.

How long a prefix is follows from what it costs. A member that more than LONG documents hold is
not paired. A document with h such members in its prefix takes the smallest l with h < l: of the l
shared members one at least is paired then, and the pair must share l - h paired ones. So a passage
that thousands of documents share costs each of them a few members of prefix, not thousands of
candidates. l goes from LEAST, where costs are low, up to MOST. Whatever l is, a pair must also
share as many of the longest prefixes as MOST and the two sizes ask for.

Candidates that hang together, few documents as a rule, are compared in one task, so that each
text is sent once and not with every pair it is in. Documents for which MOST is not enough, mostly
large groups of near copies, are gathered by their frequent members, so that near copies stand
together, and cut into blocks. Blocks whose documents share members enough are compared as one
product of their member tables. Both give back, for each document, the number of its links and
a tree of them, never the pairs. Documents with equal sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.llm.columns import discard, quoted, without, written
from labelloom.llm.components import smallest_reachable
from labelloom.llm.shingles import batched, set_digests, shingle_sets
from labelloom.operators.ranking import number_rows

# Shared members a pair needs: at low cost, and at most.
LEAST = 8
MOST = 32

# Documents of one member that are paired with each other.
LONG = 64

# Frequent members that gather a document to the first one that holds them.
GATHER = 16

# Documents in a block, members in a block's sets (more only for a single set), and members that
# two blocks are compared by at a time.
BLOCK = 128
BLOCK_MEMBERS = 1 << 20
COLUMNS = 4096

# Documents that candidate pairs hold together and that are compared in one task, and their members.
GROUP = 256
GROUP_MEMBERS = 1 << 21

RESULTS = ["n_shingles", "component_id", "n_links"]


def overlap(n, percent: int):
    """Members a set of n shares with every similar one at least. Works on numbers and arrays."""
    return (percent * n + 99) // 100


def _overlap(n: Column, percent: int) -> Column:
    return F.floor((percent * n + 99) / 100).cast("int")


def _signed(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Size and 128-bit digest of each row's set, and its longest prefix."""
    fields = [
        ("__llm_size", T.LongType()),
        ("__llm_low", T.LongType()),
        ("__llm_high", T.LongType()),
        ("__llm_prefix", T.ArrayType(T.LongType())),
    ]
    kept = [c for c in rows.columns if c != "__llm_text"]
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__llm_text").to_pylist()
            for part in batched(texts):
                sets = shingle_sets([texts[r] for r in part], words)
                filled = [i for i, own in enumerate(sets) if len(own)]
                low, high = np.zeros((2, len(sets)), np.uint64)
                if filled:
                    low[filled], high[filled] = set_digests([sets[i] for i in filled])
                prefixes = [own[: len(own) - overlap(len(own), percent) + MOST].view(np.int64) for own in sets]
                where = pa.array(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(where) for c in kept],
                        pa.array([len(own) for own in sets], pa.int64()),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.array(prefixes, pa.list_(pa.int64())),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(run, schema)


def _heads(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups of equal neighbours begin, and their sizes."""
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return first, np.diff(first, append=len(keys))


LISTED = pa.schema([("token", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("excess", pa.int32()), ("n", pa.int32()), ("m", pa.int32())])


def _list_rows(token, cls, n, excess, percent: int, long: int) -> Iterator[pa.RecordBatch]:
    """Pairs of the documents of each member (token null), or the rows of a member of many."""
    first, sizes = _heads(token)
    heavy = np.repeat(sizes > long, sizes)
    if heavy.any():
        nothing = pa.nulls(int(heavy.sum()), pa.int64())
        own, rest = (pa.array(c[heavy]) for c in (token, cls)), (pa.array(c[heavy]) for c in (excess, n, n))
        yield pa.RecordBatch.from_arrays([*own, nothing, *rest], schema=LISTED)
    for size in np.unique(sizes[(sizes > 1) & (sizes <= long)]).tolist():
        at = first[sizes == size]
        left, right = np.triu_indices(size, 1)
        step = max(1, 500_000 // len(left))
        for k in range(0, len(at), step):
            rows = at[k : k + step, None] + np.arange(size)
            x, y = rows[:, left].ravel(), rows[:, right].ravel()
            small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
            near = 100 * small.astype(np.int64) >= percent * large.astype(np.int64)
            x, y, small, large = x[near], y[near], small[near], large[near]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(x), pa.int64()),
                    pa.array(np.minimum(cls[x], cls[y])),
                    pa.array(np.maximum(cls[x], cls[y])),
                    pa.array(np.maximum(excess[x], excess[y])),
                    pa.array(small),
                    pa.array(large),
                ],
                schema=LISTED,
            )


def _listed(classes: DataFrame, percent: int, long: int) -> DataFrame:
    """What the documents of each member make; one shuffle, sorted by member, in pieces.

    Of a long list no more than one batch is held at a time.
    """
    exploded = classes.select("cls", F.col("size").cast("int").alias("n"), F.posexplode("prefix").alias("at", "token"))
    spare = F.col("n") - _overlap(F.col("n"), percent)
    rows = exploded.select("token", "cls", "n", F.greatest(F.lit(0), F.col("at") - spare).cast("int").alias("excess"))
    dealt = rows.repartition("token").sortWithinPartitions("token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, frequent = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(c).to_numpy() for c in ("token", "cls", "n", "excess")]
            if frequent is not None:
                # The rest of a list that was too long already.
                rest = int(np.argmax(own[0] != frequent)) if (own[0] != frequent).any() else len(own[0])
                if rest:
                    yield from _list_rows(*[c[:rest] for c in own], percent, 0)
                    own = [c[rest:] for c in own]
                if not len(own[0]):
                    continue
                frequent = None
            if held is not None:
                own = [np.concatenate(both) for both in zip(held, own, strict=True)]
            first, sizes = _heads(own[0])
            cut = first[-1]
            if sizes[-1] > long:
                frequent, cut = own[0][-1], len(own[0])
            yield from _list_rows(*[c[:cut] for c in own], percent, long)
            held = [c[cut:] for c in own] if cut < len(own[0]) else None
        if held is not None:
            yield from _list_rows(*held, percent, long)

    return dealt.mapInArrow(run, "token long, a long, b long, excess int, n int, m int")


def _shared(limit: Column, excesses: str = "excesses") -> Column:
    """How many of the members are in prefixes of that many matches."""
    return F.size(F.filter(excesses, lambda e: e < limit))


def _least_shared(percent: int) -> Column:
    """Members that similar sets of n and m (the larger) share of their longest prefixes.

    They are MOST, if the sets are not smaller, by the l-prefix for l = MOST. They are also what
    the sets must share in all, less what stands behind the prefix that ends first.
    """
    n, m = F.col("n"), F.col("m")
    in_all = F.floor((percent * (n + m) + (99 + percent)) / (100 + percent)).cast("int")
    behind = F.greatest(_overlap(m, percent) - MOST, F.lit(0))
    return F.greatest(F.least(F.lit(MOST), _overlap(n, percent)), in_all - behind)


def _costly(listed: DataFrame, percent: int) -> DataFrame:
    """Documents with members of many, and the matches their prefixes are lengthened to.

    matches is null where MOST is not enough; excused is the number of such members then,
    frequent that in the longest prefix.
    """
    most = _overlap(F.col("n"), percent)
    found = (
        listed.filter("token IS NOT NULL")
        .groupBy(F.col("a").alias("cls"))
        .agg(F.collect_list("excess").alias("excesses"), F.first("n").alias("n"))
        .withColumn("tries", F.sequence(F.least(F.lit(LEAST), most), F.least(F.lit(MOST), most)))
        .withColumn("matches", F.get(F.filter("tries", lambda m: _shared(m) < m), F.lit(0)))
    )
    return found.select("cls", "n", "matches", _shared(F.col("matches")).alias("excused"), F.size("excesses").alias("frequent"))


def _texts(df: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, copies, text) of the wanted classes, with the text of one row of each."""
    heads = wanted.join(classes.select("cls", "copies", "head"), "cls")
    same = (F.col("__llm_row") == F.col("head.__llm_row")) & (F.col("__llm_hash") == F.col("head.__llm_hash"))
    # Rows may be repeated, a third of all perhaps: one is left of each before they are sent on.
    return df.join(heads, same).groupBy("cls", "copies").agg(F.first("__llm_text").alias("text"))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(cls, copies, members) from (cls, copies, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in batched(texts):
                made = [own.view(np.int64) for own in shingle_sets([texts[r] for r in part], words)]
                where = pa.array(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cls").take(where), batch.column("copies").take(where), pa.array(made, pa.list_(pa.int64()))],
                    ["cls", "copies", "members"],
                )

    return texts.mapInArrow(run, "cls long, copies long, members array<long>")


Linked = list[tuple[int, int | None, int]]


def _linked(cls, copies, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, skip: np.ndarray) -> Linked:
    """Links between documents on the left and right: each one's number (a, null, n), and a tree (a, b, 0).

    The sides are the same documents or have none in common; pairs marked in skip are left out.
    """
    shared = overlaps([sets[i] for i in left], [sets[i] for i in right])
    sizes = np.array([len(s) for s in sets])
    links = (shared > 0) & (100 * shared >= percent * (sizes[left][:, None] + sizes[right][None, :] - shared)) & ~skip
    alone = left is right
    if alone:
        np.fill_diagonal(links, False)
    counts = [(int(c), None, int(n)) for c, n in zip(cls[left], links @ copies[right], strict=True) if n]
    if not alone:
        counts += [(int(c), None, int(n)) for c, n in zip(cls[right], links.T @ copies[left], strict=True) if n]
    return counts + [(a, b, 0) for a, b in _tree(links, cls[left], cls[right])]


LINKED = ["a", "b", "n"]


def _columns(made: Linked) -> list[pa.Array]:
    return [pa.array(c, pa.int64()) for c in (zip(*made, strict=True) if made else [[]] * 3)]


def _grouped(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The links inside each group of (grp, cls, copies, hot, text), as numbers and trees.

    Pairs of two hot documents are left to their blocks.
    """
    dealt = rows.repartition("grp").sortWithinPartitions("grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets = None, []
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in batched(texts):
                sets += shingle_sets([texts[i] for i in part], words)
                own = np.stack([batch.column(c).to_numpy(zero_copy_only=False)[part].astype(np.int64) for c in ("grp", "cls", "copies", "hot")])
                held = own if held is None else np.concatenate([held, own], axis=1)
                first, sizes = _heads(held[0])
                made: Linked = []
                for at, size in zip(first[:-1].tolist(), sizes[:-1].tolist(), strict=True):
                    made += compared(held[:, at : at + size], sets[at : at + size])
                yield pa.RecordBatch.from_arrays(_columns(made), LINKED)
                held, sets = held[:, first[-1] :], sets[first[-1] :]
        if held is not None:
            yield pa.RecordBatch.from_arrays(_columns(compared(held, sets)), LINKED)

    def compared(own: np.ndarray, sets: list[np.ndarray]) -> Linked:
        everyone = np.arange(len(sets))
        return _linked(own[1], own[2], sets, everyone, everyone, percent, (own[3][:, None] & own[3][None, :]) == 1)

    return dealt.mapInArrow(run, "a long, b long, n long")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar, with the copies of both.

    The set of a comes once, before those of its partners.
    """
    own = pairs.select(F.col("a").alias("cls")).distinct().join(sets, "cls")
    anchors = own.select(F.col("cls").alias("a"), F.lit(None).cast("long").alias("b"), "copies", "members")
    partners = pairs.join(sets, F.col("b") == F.col("cls")).select("a", "b", "copies", "members")
    rows = anchors.unionByName(partners).repartition("a").sortWithinPartitions("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, anchor_copies = np.zeros(0, np.int64), 0
        for batch in batches:
            members = batch.column("members")
            values, bounds = members.values.to_numpy(), members.offsets.to_numpy()
            copies = batch.column("copies").to_pylist()
            found = []
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                set_ = values[bounds[i] : bounds[i + 1]]
                if b is None:
                    anchor, anchor_copies = set_.copy(), copies[i]
                    continue
                shared = len(np.intersect1d(anchor, set_, assume_unique=True))
                if 100 * shared >= percent * (len(anchor) + len(set_) - shared):
                    found.append((a, b, anchor_copies, copies[i]))
            columns = zip(*found, strict=True) if found else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "copies_a", "copies_b"])

    return rows.mapInArrow(run, "a long, b long, copies_a long, copies_b long")


def _member_table(of: np.ndarray, column: np.ndarray, rows: int, low: int, high: int) -> np.ndarray:
    inside = (column >= low) & (column < high)
    made = np.zeros((rows, high - low), np.float32)
    made[of[inside], column[inside] - low] = 1
    return made


def overlaps(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Members that each of some sets shares with each of the others."""
    shared = np.zeros((len(sets), len(others)), np.float64)
    if not sets or not others:
        return shared
    values, values_other = np.concatenate(sets), np.concatenate(others)
    common = np.intersect1d(values, values_other)
    sides = []
    for own, all_ in ((sets, values), (others, values_other)):
        of = np.repeat(np.arange(len(own)), [len(s) for s in own])
        at = np.minimum(np.searchsorted(common, all_), max(len(common) - 1, 0))
        known = common[at] == all_ if len(common) else np.zeros(len(all_), bool)
        sides.append((of[known], at[known]))
    for low in range(0, len(common), COLUMNS):
        high = min(low + COLUMNS, len(common))
        one, other = (_member_table(*side, len(own), low, high) for side, own in zip(sides, (sets, others), strict=True))
        shared += one @ other.T
    return shared


def _tree(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links enough to hold together what the links do."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    kept = []
    for i, j in np.argwhere(links).tolist():
        a, b = int(left[i]), int(right[j])
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            kept.append((a, b))
    return kept


def _cells(cells: DataFrame, blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For each pair of blocks: a tree of the links (a, b), and each document's links (a, null, n)."""
    members = written(blocks.select("cls", "block").join(sets, "cls"), "blocks")
    sides = cells.select("block_a", "block_b", F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"))
    rows = sides.join(members, "block")

    def compare(table: pa.Table) -> pa.Table:
        first, block = table.column("block_a")[0].as_py(), table.column("block").to_numpy()
        cls, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
        sets = [np.asarray(v) for v in table.column("members").combine_chunks().to_numpy(zero_copy_only=False)]
        left = np.flatnonzero(block == first)
        right = left if table.column("block_b")[0].as_py() == first else np.flatnonzero(block != first)
        return pa.table(_columns(_linked(cls, copies, sets, left, right, percent, np.zeros((1, 1), bool))), LINKED)

    return rows.groupBy("block_a", "block_b").applyInArrow(compare, "a long, b long, n long")


def _blocks(costly: DataFrame, listed: DataFrame, percent: int) -> DataFrame:
    """Blocks of the documents without a prefix of bounded cost; need is the least of their matches.

    Documents that share GATHER frequent members with the first document of each get its label.
    Labels only say who stands together: any would do.
    """
    bits = F.floor(F.log2("n")).cast("int")
    hot = costly.filter("matches IS NULL").select("cls", "n", bits.alias("bits"))
    held = listed.filter("token IS NOT NULL").select("token", F.col("a").alias("cls")).join(hot.select("cls"), "cls", "left_semi")
    held = written(held, "held")
    firsts = written(held.groupBy("token").agg(F.min("cls").alias("first")), "firsts")
    near = held.join(firsts, "token").filter("first < cls").groupBy("first", "cls").agg(F.count("*").alias("shared"))
    labels = smallest_reachable(near.filter(F.col("shared") >= GATHER).select(F.col("first").alias("a"), F.col("cls").alias("b")))
    labelled = hot.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "n", "bits", F.coalesce("component", "cls").alias("label")
    )
    ranked = number_rows(labelled, ["bits", "label", "cls"], "rank", start=0)
    each = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(BLOCK_MEMBERS / F.pow(F.lit(2), "bits")))).cast("long")
    block = F.shiftleft(F.col("bits").cast("long"), 48) + F.call_function("div", F.col("rank"), each)
    need = F.least(F.lit(MOST), _overlap(F.col("n"), percent))
    return ranked.select("cls", "bits", "label", block.alias("block"), need.alias("need"))


def _meeting(listed: DataFrame, both_hot: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs of blocks with documents of one label, or of two that share members enough."""
    of = blocks.select(F.col("cls").alias("a"), "label")
    lists = (
        listed.filter("token IS NOT NULL")
        .join(of, "a")
        .groupBy("token")
        .agg(F.sort_array(F.collect_set("label")).alias("labels"))
        # Members of one group of documents have the same labels: their pairs are made once.
        .groupBy("labels")
        .agg(F.count("*").alias("shared"))
        .filter("size(labels) > 1")
    )
    ends = lists.select("labels", "shared", F.posexplode("labels").alias("at", "label_a"))
    by_member = ends.select("label_a", F.explode(F.slice("labels", F.col("at") + 2, F.size("labels"))).alias("label_b"), "shared")
    other = blocks.select(F.col("cls").alias("b"), F.col("label").alias("other"))
    by_pair = both_hot.join(of, "a").join(other, "b").filter("label <> other").select(
        F.least("label", "other").alias("label_a"), F.greatest("label", "other").alias("label_b"), "shared"
    )
    needs = blocks.groupBy("label").agg(F.min("need").alias("need"))
    a, b = (needs.select(F.col("label").alias(f"label_{n}"), F.col("need").alias(f"need_{n}")) for n in "ab")
    met = by_member.unionByName(by_pair).groupBy("label_a", "label_b").agg(F.sum("shared").alias("shared"))
    apart = met.join(a, "label_a").join(b, "label_b").filter(F.col("shared") >= F.least("need_a", "need_b"))
    pairs = apart.select("label_a", "label_b").union(needs.select("label", F.col("label").alias("other")))
    placed = written(blocks.select("label", "block", "bits").distinct(), "placed")
    left, right = (placed.select(*[F.col(c).alias(f"{c}_{n}") for c in placed.columns]) for n in "ab")
    return (
        pairs.join(left, "label_a")
        .join(right, "label_b")
        .filter(F.abs(F.col("bits_a") - F.col("bits_b")) <= 1)
        .select(F.least("block_a", "block_b").alias("block_a"), F.greatest("block_a", "block_b").alias("block_b"))
        .distinct()
    )


def join_components(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    long: int = LONG,
) -> DataFrame:
    """Every row of df without its text, with n_shingles, component_id and n_links.

    Two documents are linked if 100 * intersection >= percent * union of their sets of distinct
    n-grams (``words`` words ``[^\\x20\\x09-\\x0D]+``, A-Z lowered; a shorter text is one n-gram).
    component_id is the smallest id reachable over links, the own one included; n_links is the
    number of other rows linked with this one, copies among them. All links are found.

    A null text, or one without words, has an empty set and is linked with nothing, not even its
    like. A row without an id is linked with nothing: its component_id is null, n_links 0. Repeated
    rows are copies of each other and count as links. Rows that share an id but not their set are
    each judged by it. An empty table stays empty. Columns named like a result are replaced, others
    but the text stay. Ids must be whole numbers; percent must be over 50.

    Members are 64-bit digests of n-grams, classes of equal sets 128-bit ones.
    """
    if not isinstance(df.schema[id_column].dataType, T.IntegralType):
        raise ValueError("ids must be whole numbers")
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50, and 100 at most")
    own = [c for c in without(df, RESULTS) if c.lower() != text.lower()]
    keys = [
        df[quoted(id_column)].cast("long").alias("__llm_row"),
        F.xxhash64(df[quoted(text)]).alias("__llm_hash"),
        df[quoted(text)].alias("__llm_text"),
    ]
    signed = written(_signed(df.select(*[df[quoted(c)] for c in own], *keys), words, percent), "signed")
    same = ["__llm_low", "__llm_high", "__llm_size"]
    classes = (
        signed.filter("__llm_size > 0 AND __llm_row IS NOT NULL")
        .groupBy(*same)
        .agg(
            F.min(F.struct("__llm_row", "__llm_hash")).alias("head"),
            F.count("*").alias("copies"),
            F.first("__llm_prefix").alias("prefix"),
        )
    )
    classes = written(
        classes.select(F.monotonically_increasing_id().alias("cls"), *same, F.col("__llm_size").alias("size"), "head", "copies", "prefix"),
        "classes",
    )
    # Only the classes need the prefixes, and only their lists need those; both go as early as can be.
    rows = written(signed.drop("__llm_prefix", "__llm_hash"), "rows")
    discard(signed)
    listed = written(_listed(classes, percent, long), "listed")
    prefixed, classes = classes, written(classes.drop("prefix"), "classes")
    discard(prefixed)
    costly = written(_costly(listed, percent), "costly")
    pairs = (
        listed.filter("token IS NULL")
        .groupBy("a", "b")
        .agg(F.collect_list("excess").alias("excesses"), F.first("n").alias("n"), F.first("m").alias("m"))
    )
    for side in "ab":
        lengthened = costly.select(
            F.col("cls").alias(side), F.struct("matches", "excused").alias(f"cost_{side}"), F.col("frequent").alias(f"frequent_{side}")
        )
        pairs = pairs.join(lengthened, side, "left")
    hot = F.coalesce(F.col("cost_a").isNotNull() & F.col("cost_a.matches").isNull(), F.lit(False)) & F.coalesce(
        F.col("cost_b").isNotNull() & F.col("cost_b.matches").isNull(), F.lit(False)
    )
    usual = F.struct(F.least(F.lit(LEAST), _overlap(F.col("n"), percent)).alias("matches"), F.lit(0).alias("excused"))
    either = F.array_min(F.filter(F.array("cost_a", "cost_b"), lambda c: c["matches"].isNotNull()))
    cost = F.when(F.col("cost_a").isNull() | F.col("cost_b").isNull(), usual).otherwise(either)
    hidden = F.least(F.coalesce("frequent_a", F.lit(0)), F.coalesce("frequent_b", F.lit(0)))
    likely = F.size("excesses") + hidden >= _least_shared(percent)
    pairs = pairs.filter(likely).select("a", "b", "excesses", hot.alias("hot"), cost.alias("cost"))
    enough = _shared(F.col("cost.matches")) >= F.greatest(F.lit(1), F.col("cost.matches") - F.col("cost.excused"))
    pairs = written(
        pairs.filter(F.col("hot") | enough).select("a", "b", "hot", F.size("excesses").cast("long").alias("shared")), "pairs"
    )
    blocks = written(_blocks(costly, listed, percent), "numbered")
    cells = written(_meeting(listed, pairs.filter("hot"), blocks), "meeting")
    discard(listed, costly)
    plain = pairs.filter("NOT hot").select("a", "b")
    groups = written(smallest_reachable(plain).withColumnsRenamed({"node": "cls", "component": "grp"}), "groups")
    sizes = groups.join(classes.select("cls", "size"), "cls").groupBy("grp").agg(
        F.count("*").alias("documents"), F.sum("size").alias("members")
    )
    sizes = written(sizes.select("grp", ((F.col("documents") <= GROUP) & (F.col("members") <= GROUP_MEMBERS)).alias("small")), "sizes")
    hot = blocks.select("cls", F.lit(True).alias("hot"))
    together = groups.join(sizes.filter("small"), "grp").join(hot, "cls", "left").select("grp", "cls", F.coalesce("hot", F.lit(False)).alias("hot"))
    # Larger groups are compared pair by pair, or by blocks.
    apart = groups.join(sizes.filter("NOT small"), "grp").select(F.col("cls").alias("a"))
    plain = written(plain.join(apart, "a", "left_semi"), "apart")
    wanted = plain.select(F.explode(F.array("a", "b")).alias("cls")).union(blocks.select("cls")).distinct()
    texts = written(_texts(df.select(*keys), classes, groups.select("cls").union(wanted).distinct()), "texts")
    near = written(_grouped(together.join(texts, "cls"), words, percent), "near")
    sets = written(_sets(texts.join(wanted, "cls", "left_semi"), words), "sets")
    discard(texts)
    links = written(_compared(plain, sets, percent), "links")
    trees = near.union(written(_cells(cells, blocks, sets, percent), "cells"))
    counts = (
        links.select(F.explode(F.array(F.struct("a", F.col("copies_b").alias("n")), F.struct(F.col("b").alias("a"), F.col("copies_a").alias("n")))).alias("x"))
        .select("x.*")
        .union(trees.filter("b IS NULL").select("a", "n"))
        .groupBy(F.col("a").alias("cls"))
        .agg(F.sum("n").alias("linked"))
    )
    labels = written(smallest_reachable(links.select("a", "b").union(trees.filter("b IS NOT NULL").select("a", "b"))), "labels")
    named = written(
        labels.join(classes.select(F.col("cls").alias("node"), F.col("head.__llm_row").alias("row")), "node"), "named"
    )
    smallest = named.groupBy("component").agg(F.min("row").alias("smallest"))
    reached = named.join(smallest, "component").select(F.col("node").alias("cls"), "smallest")
    verdicts = written(
        classes.join(reached, "cls", "left")
        .join(counts, "cls", "left")
        .select(
            *same,
            F.coalesce("smallest", "head.__llm_row").alias("__llm_component"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("__llm_links"),
        ),
        "verdicts",
    )
    # A class may hold a third of all rows: both sides are read afresh, so Spark can split it.
    judged = rows.join(verdicts, same, "left")
    known = F.col("__llm_row").isNotNull()
    return judged.select(
        *[F.col(quoted(c)) for c in own],
        F.col("__llm_size").alias("n_shingles"),
        F.when(known, F.coalesce("__llm_component", "__llm_row")).alias("component_id"),
        F.when(known, F.coalesce("__llm_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
    )
