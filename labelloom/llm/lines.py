"""Removal of lines that are near copies of earlier lines, by an exact set-similarity join.

A line is the set of its words. The words of a line are put in order of rarity. Two sets that
agree in percent of their union share some words early in that order (the prefix filter): one
of the first words, and one more for every word the prefixes are lengthened by. All words are
dealt into m parts. Prefixes that share m + 1 words share two of one part, so a line is looked
up by the pairs of words of its prefix that fall into one part. With m near the length of the
shortest prefix that is two pairs for each of its words, and pairs stay rare where the
words of a large table do not. m is a power of two and goes by the larger line of a pair.

All pairs of words are dealt in one shuffle, with the size and a mask of the line. Lines of a
pair of words few lines have are held against each other. If more lines have it, they are first
held against the earliest of them, which settles most of a large group of near copies; only
lines without a match go on, against all others while they are few, else by three words.
Candidates must fit in length and in the mask, then share as many words of their prefixes as
similar lines must, and are at last compared in full: first each line's likeliest pair, then
the rest of the lines that this has not settled.

Everything is built from Spark's own functions. Words stand in the join as 63-bit numbers that
sort by rarity: 16 bits of the word's hash choose a counter, the counter's rank comes first,
47 more bits of the hash follow. Any fixed order gives right results; ranks are counted over
all words of the input and are as many as there are counters. The final comparison is of the
words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.columns import discard, quoted, without, written
from labelloom.llm.quality import WHITE, let, words_of

COUNTERS = 1 << 16
HASH_BITS = 47

# Words two prefixes must share, at least, before their lines are compared in full.
SHARED = 4

# Lines that two words may bring together in pairs; if more have them, they go by three words.
FEW = 256

# Bits of a set's parity mask; the other bits of its number hold its size, or SIZED if it has more words.
MASK = 55
SIZED = (1 << (63 - MASK)) - 1

# Found in lines that have a word.
WORDED = r"[^\x20\x09-\x0D]"


# Columns of the other line of a pair.
OTHER = {"num": "other", "n": "other_n", "mask": "other_mask"}


def _counter(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 48).cast("int")


def _ranks(texts: DataFrame) -> Column:
    """The rank of every counter, rarest first, above HASH_BITS zeros, as a constant array.

    The counts are over all words of all texts; COUNTERS numbers come to the driver.
    """
    # Other white space stays in words here: it can only make the order a little worse.
    words = texts.select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word")).filter("word != ''")
    hashed = words.select(_counter(F.xxhash64("word")).alias("c"))
    counted = dict(hashed.groupBy("c").agg(F.count("*")).collect())
    order = sorted(range(COUNTERS), key=lambda c: (counted.get(c, 0), c))
    ranks = [0] * COUNTERS
    for rank, counter in enumerate(order):
        ranks[counter] = rank << HASH_BITS
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<bigint>")


def _codes(words: Column, ranks: Column) -> Column:
    """The distinct words as numbers, rarest first."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    low = F.lit((1 << HASH_BITS) - 1)
    # Arrays that cannot hold nulls are sorted as plain numbers.
    coded = F.transform(
        hashed, lambda h: F.coalesce(F.get(ranks, _counter(h)), F.lit(0).cast("long")).bitwiseOR(h.bitwiseAND(low))
    )
    return F.array_distinct(F.sort_array(coded))


def _least_overlap(one: Column, other: Column, percent: int) -> Column:
    """Words two sets of these sizes must share to agree in percent of their union."""
    return F.floor((percent * (one + other) + (99 + percent)) / (100 + percent)).cast("int")


def _first(n: Column, percent: int) -> Column:
    """Length of the prefixes of which similar sets share a word, if sets have words enough."""
    return n - F.floor((percent * n + 99) / 100).cast("int") + 1


def _parts(n: Column, percent: int) -> Column:
    """Parts that words are dealt into for pairs of lines of which the larger has n words.

    Such lines share more words than there are parts, or one word only and there is one part.
    """
    first = _first(n, percent)
    most = F.greatest(F.lit(1.0), F.least((n - first).cast("double"), first * F.lit(1.41)))
    return F.call_function("shiftleft", F.lit(1), F.floor(F.log2(most)).cast("int"))


def _largest(n: Column, percent: int) -> Column:
    """Words of the largest set that a set of n words can agree with."""
    return F.floor(100 * n / percent).cast("int")


def _prefix(n: Column, percent: int) -> Column:
    """Length of the prefixes that are written: enough for lines of any size to meet."""
    more = F.greatest(F.lit(SHARED - 1), _parts(_largest(n, percent), percent))
    return F.least(n, _first(n, percent) + more)


def _mask(codes: Column) -> Column:
    """A bit per remainder of the codes, set if an odd number of them has it.

    Where two masks differ, one set has a word the other has not. So two sets of n and m words
    share (n + m - differing bits) / 2 words at most.
    """
    one = F.lit(1).cast("long")
    place = lambda code: (code.bitwiseAND(F.lit((1 << 31) - 1)) % MASK).cast("int")
    bit = lambda code: F.call_function("shiftleft", one, place(code))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda mask, code: mask.bitwiseXOR(bit(code)))


def _keyed(df: DataFrame, id_column: str, text: str) -> DataFrame:
    return df.select(df[quoted(id_column)].alias("doc"), F.coalesce(df[quoted(text)], F.lit("")).alias("text"))


def _sets(texts: DataFrame, percent: int) -> DataFrame:
    """Every distinct set of words: its first line, its size, its mask, its prefix and a number.

    A line that many documents share becomes one row, most of it before the shuffle. The numbers
    hold for the table once it is written; they stand for the lines where rows are many.
    """
    ranks = _ranks(texts)
    # Lines without words go by their text: by their numbers, these would be made twice.
    lines = texts.select("doc", F.posexplode(F.split("text", "\n")).alias("line", "body")).filter(F.rlike("body", F.lit(WORDED)))
    # The numbers are used several times, so Spark makes them in a projection of their own.
    coded = lines.select(F.struct("doc", "line").alias("id"), _codes(words_of(F.col("body")), ranks).alias("codes"))
    codes = F.col("codes")
    made = coded.select(
        "id",
        F.xxhash64(codes).alias("low"),
        F.xxhash64(F.lit(1), codes).alias("high"),
        F.size(codes).alias("n"),
        _mask(codes).alias("mask"),
        # 31 bits will do here: words that agree in them by chance only add candidates.
        F.transform(
            F.slice(codes, F.lit(1), _prefix(F.size(codes), percent)),
            lambda code: code.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"),
        ).alias("prefix"),
    )
    grouped = made.groupBy("low", "high").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("mask").alias("mask"), F.first("prefix").alias("prefix")
    )
    return grouped.select("id", "n", "mask", "prefix", F.monotonically_increasing_id().alias("num"))


def _fits(n: Column, mask: Column, other: Column, other_mask: Column, percent: int) -> Column:
    """Length and mask filters on the sizes and masks of two sets."""
    differing = F.bit_count(mask.bitwiseXOR(other_mask))
    return (100 * F.least(n, other) >= percent * F.greatest(n, other)) & (
        n + other - differing >= 2 * _least_overlap(n, other, percent)
    )


def _fitting(percent: int) -> Column:
    return _fits(F.col("n"), F.col("mask"), F.col("other_n"), F.col("other_mask"), percent)


def _packed(n: Column, mask: Column) -> Column:
    """A set's size and mask as one number, which is what most rows hold of it."""
    return F.shiftleft(F.least(n, F.lit(SIZED)).cast("long"), MASK).bitwiseOR(mask)


def _packed_fit(one: Column, other: Column, percent: int) -> Column:
    """The filters on two of those numbers; sets of SIZED words or more pass."""
    low = F.lit((1 << MASK) - 1)
    n, m = F.shiftright(one, MASK).cast("int"), F.shiftright(other, MASK).cast("int")
    fits = _fits(n, one.bitwiseAND(low), m, other.bitwiseAND(low), percent)
    return (n == SIZED) | (m == SIZED) | fits


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(num, id, other, differ): of the pairs (num, other) those with enough words of their prefixes in common.

    id is the later line of the two and num its number, other the earlier; differ counts bits of their masks.
    """
    # Both joins read one and the same shuffle of the sets.
    own = sets.select("num", "id", "n", "mask", "prefix")
    either = pairs.select(F.least("num", "other").alias("one"), F.greatest("num", "other").alias("two")).distinct()
    a, b = own.alias("a"), own.alias("b")
    both = either.join(a, F.col("one") == F.col("a.num")).join(b, F.col("two") == F.col("b.num"))
    n, m = F.col("a.n"), F.col("b.n")
    enough = F.least(F.greatest(F.lit(SHARED), _parts(F.greatest(n, m), percent) + 1), _least_overlap(n, m, percent))
    return written(
        both.filter(F.size(F.array_intersect("a.prefix", "b.prefix")) >= enough).select(
            F.when(F.col("a.id") > F.col("b.id"), F.col("one")).otherwise(F.col("two")).alias("num"),
            F.greatest("a.id", "b.id").alias("id"),
            F.least("a.id", "b.id").alias("other"),
            F.bit_count(F.col("a.mask").bitwiseXOR(F.col("b.mask"))).alias("differ"),
        ),
        "pairs",
    )


def _confirmed(likely: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(num): the sets in the pairs that agree with the other one, by the words themselves."""
    wanted = likely.select(F.explode(F.array("id", "other")).alias("line")).select("line.*")
    listed = wanted.groupBy(F.col("doc").alias("__llm_doc")).agg(F.collect_set("line").alias("wanted"))
    fetched = (
        texts.join(listed, F.col("doc").eqNullSafe(F.col("__llm_doc")))
        .select("doc", "wanted", F.posexplode(F.split("text", "\n")).alias("line", "body"))
        .filter(F.array_contains("wanted", F.col("line")))
        .select(F.struct("doc", "line").alias("line"), F.array_distinct(words_of(F.col("body"))).alias("words"))
    )
    fetched = written(fetched, "lines")
    a, b = fetched.alias("a"), fetched.alias("b")
    both = likely.join(a, F.col("id") == F.col("a.line")).join(b, F.col("other") == F.col("b.line"))
    shared = F.size(F.array_intersect("a.words", "b.words"))
    union = F.size("a.words") + F.size("b.words") - shared
    settled = written(both.filter(100 * shared >= percent * union).select("num").distinct(), "settled")
    discard(fetched)
    return settled


def _others(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows as the earlier line of a pair."""
    return rows.select(*keys, *[F.col(c).alias(a) for c, a in OTHER.items() if c in rows.columns])


def _rows(sets: DataFrame, percent: int) -> DataFrame:
    """(words, id, num, n, mask): a row for every two words of a prefix in one part, as one number.

    A line goes with the parts for lines of its own size and of all larger ones it can agree
    with. More parts halve those of fewer, so two words that share the lowest bits of their
    numbers meet once, in the most parts that keep them together.
    """
    n = F.col("n")
    # Lines that can agree with lines of just their words are in the table of sets once.
    others = (_largest(n, percent) > n) | ((100 - percent) * n >= 100 + percent)
    own = ["id", "num", "n", "mask"]
    sized = sets.filter(others).select(
        *own,
        "prefix",
        _first(n, percent).alias("first"),
        (n - _least_overlap(n, n + 1, percent) + 1).alias("short"),
        _parts(n, percent).alias("fewest"),
        _parts(_largest(n, percent), percent).alias("most"),
    )
    ones = sized.select("*", F.posexplode("prefix").alias("at", "one"))
    rest = F.slice("prefix", F.col("at") + 2, F.size("prefix"))
    twos = ones.select(*own, "first", "short", "fewest", "most", "at", "one", F.posexplode(rest).alias("next", "two"))
    one, two = F.col("one"), F.col("two")
    differ = one.bitwiseXOR(two)
    parts = F.when(differ == 0, F.col("most")).otherwise(F.least("most", differ.bitwiseAND(-differ)))
    # Larger lines of more parts share more words with this one, so its prefix for them is shorter.
    length = F.greatest(F.col("first") + F.col("fewest"), F.col("short") + parts)
    met = twos.filter((parts >= F.col("fewest")) & (F.col("at") + 1 + F.col("next") < length))
    word = lambda c: c.cast("long")
    rows = met.select(F.shiftleft(word(F.least(one, two)), 31).bitwiseOR(word(F.greatest(one, two))).alias("words"), *own)
    if percent <= 50:
        # Small sets, such as {a} and {a, b} at 50, may share one word only.
        small = sets.filter(percent * n <= 100).select(F.explode("prefix").alias("word"), *own)
        rows = rows.union(small.select(word(F.col("word")).alias("words"), *own))
    return rows


def _later_lines(sets: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The numbers of the sets that are near copies of an earlier line's set."""
    # A job on the written table also makes Spark let go of the last plan, and so of the sets' shuffle.
    if sets.isEmpty():
        return sets.select("num")
    # In this order the parts of a row that do not repeat lie together, which Spark's compression likes.
    rows = _rows(sets, percent).select("words", _packed(F.col("n"), F.col("mask")).alias("own"), "num")
    counted = rows.withColumn("lines", F.count("*").over(Window.partitionBy("words")))
    met = written(counted.filter("lines > 1").select(F.col("words").alias("key"), "own", "num", "lines"), "met")
    few = met.filter(F.col("lines") <= FEW).drop("lines")
    # Columns of the same names let both sides read one shuffle.
    a, b = few.alias("a"), few.alias("b")
    few = a.join(b, F.col("a.key") == F.col("b.key")).filter(F.col("b.num") < F.col("a.num"))
    few = few.filter(_packed_fit(F.col("a.own"), F.col("b.own"), percent))
    few = written(few.select("a.num", F.col("b.num").alias("other")), "few")
    frequent = met.filter(F.col("lines") > FEW).select("key", "num").join(sets, "num")
    frequent = written(frequent.select("key", "num", "id", "n", "mask", "prefix"), "frequent")
    discard(met)
    earliest = F.min(F.struct("id", "num", "n", "mask")).over(Window.partitionBy("key")).alias("first")
    star = frequent.select("num", "n", "mask", earliest)
    star = star.select("num", "n", "mask", *[F.col(f"first.{c}").alias(a) for c, a in OTHER.items()])
    star = star.filter("other != num").filter(_fitting(percent)).select("num", "other")
    likely = _likely(few.union(star), sets, percent)
    # A line's likeliest pair settles most lines, so few of the others are looked at.
    best = likely.groupBy("num").agg(F.min(F.struct("differ", "other", "id")).alias("best")).select("num", "best.*")
    best = written(best, "best")
    settled = _confirmed(best, texts, percent)
    rest = likely.join(settled, "num", "left_anti").join(best, ["num", "other"], "left_anti")
    if not frequent.isEmpty():
        more = _likely(_of_open(frequent, settled, percent), sets, percent)
        rest = rest.unionByName(more.join(best, ["num", "other"], "left_anti")).dropDuplicates(["num", "other"])
    return settled.union(_confirmed(written(rest, "rest"), texts, percent))


def _of_open(frequent: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """Pairs (num, other) of the open lines of words that more than FEW lines have, with all earlier ones.

    Words of not too many open lines bring these together with their other lines, the rest go by three.
    """
    flagged = frequent.join(settled.withColumn("settled", F.lit(True)), "num", "left")
    opened = flagged.withColumn("open", F.col("settled").isNull()).drop("settled")
    opened = opened.withColumn("opened", F.count_if("open").over(Window.partitionBy("key"))).filter("opened > 0")
    flagged = written(opened, "flagged")
    alone = flagged.filter(F.col("opened") <= 4 * FEW)
    crowded = flagged.filter(F.col("opened") > 4 * FEW)
    pairs = _open_pairs(alone, percent)
    return pairs if crowded.isEmpty() else pairs.union(_by_three(crowded, percent))


def _open_pairs(lines: DataFrame, percent: int) -> DataFrame:
    """Pairs (num, other) of the open lines of a key and its earlier lines, if they fit."""
    others = _others(lines.withColumnRenamed("id", "other_id"), "key", "other_id")
    met = lines.filter("open").select("key", "num", "id", "n", "mask").join(others, "key")
    return met.filter("other_id < id").filter(_fitting(percent)).select("num", "other")


def _by_three(lines: DataFrame, percent: int) -> DataFrame:
    """Pairs (num, other) of the lines (key, num, id, n, mask, prefix, open).

    Lines that share two words and must share three or more share a third one of slightly
    longer prefixes than the shortest. Those that may share fewer meet by what they have.
    """
    key, n = F.col("key"), F.col("n")
    thirds = F.array_except(
        F.slice("prefix", F.lit(1), _first(n, percent) + 2),
        F.array(F.shiftright(key, 31).cast("int"), key.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")),
    )
    # No word's number is below 0.
    thirds = F.when(percent * n <= 200, F.array_append(thirds, F.lit(-1))).otherwise(thirds)
    own = ["num", "id", "n", "mask", "open"]
    threes = lines.select("key", *own, F.explode(thirds).alias("third"))
    return _open_pairs(written(threes.select(F.xxhash64("key", "third").alias("key"), *own), "threes"), percent)


def kept_lines(df: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """(doc, line, n): the lines that stay, counted from 0, with their number of distinct words.

    A line stays if no earlier line, of the same document or of one with a smaller id, agrees
    with it in percent of the union of their words [^\\x20\\x09-\\x0D]+. Every line is judged
    against all earlier ones, whether those stay or not. Lines without words are not judged and
    not listed. A null text has no words.
    """
    texts = _keyed(df, id_column, text)
    sets = written(_sets(texts, percent), "sets")
    return _left(sets, _later_lines(sets, texts, percent))


def _left(sets: DataFrame, later: DataFrame) -> DataFrame:
    return sets.join(later, "num", "left_anti").select("id.doc", "id.line", "n")


def remove_near_lines(df: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The documents without lines that are near copies of earlier lines.

    All columns stay, n_lines and n_removed are added (given ones replaced); both count lines
    with words. Lines are put together again with line feeds; a text that loses none is
    unchanged, and a document that loses all its lines keeps an empty text. Lines without
    words stay as they are. A null text stays null. Repeated rows share one fate, as do rows
    that share an id: their lines count as one document's, a line of either that stays keeps
    that line's number in both. A null id comes before all others. An empty table stays empty.
    """
    texts = _keyed(df, id_column, text)
    sets = written(_sets(texts, percent), "sets")
    later = _later_lines(sets, texts, percent)
    # Only the lines' numbers are read from here on, so nothing else stays in the shared folder.
    kept = written(_left(sets, later), "kept")
    discard(sets, later)
    listed = kept.groupBy(F.col("doc").alias("__llm_doc")).agg(F.collect_set("line").alias("__llm_kept"))
    own = without(df, ["n_lines", "n_removed"])
    joined = df.select(*[df[quoted(c)] for c in own]).join(
        listed, df[quoted(id_column)].eqNullSafe(F.col("__llm_doc")), "left"
    )
    numbers = F.coalesce("__llm_kept", F.array().cast("array<int>"))
    lines = F.split(F.col(quoted(text)), "\n")
    flagged = F.zip_with(
        lines,
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda line, at: F.struct(line.alias("line"), F.rlike(line, F.lit(WORDED)).alias("worded"), at.alias("at")),
    )
    judged = joined.select(
        *[F.col(quoted(c)) for c in own],
        let(
            F.struct(flagged.alias("lines"), numbers.alias("kept")),
            lambda x: F.transform(
                x["lines"],
                lambda s: F.struct(
                    s["line"].alias("line"),
                    s["worded"].alias("worded"),
                    (s["worded"] & ~F.array_contains(x["kept"], s["at"])).alias("gone"),
                ),
            ),
        ).alias("__llm_lines"),
    )
    parts = F.col("__llm_lines")
    gone = F.size(F.filter(parts, lambda s: s["gone"]))
    left = F.array_join(F.transform(F.filter(parts, lambda s: ~s["gone"]), lambda s: s["line"]), "\n")
    value = F.when(gone > 0, left).otherwise(F.col(quoted(text)))
    return judged.select(
        *[(value.alias(c) if c.lower() == text.lower() else F.col(quoted(c))) for c in own],
        F.coalesce(F.size(F.filter(parts, lambda s: s["worded"])), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_removed"),
    )
