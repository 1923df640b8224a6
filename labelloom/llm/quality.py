"""Quality rules per document and per host.

Each document is measured and judged by fixed rules. The share of documents a host fails is
then shrunk towards the share of all hosts by a beta prior fitted to the hosts themselves, so
that a host with few documents is not condemned by one of them. A host whose shrunk share is
too high is rejected, and its verdict is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.columns import quoted, without
from labelloom.session import staged

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Documents of one host are dealt to so many tasks when they are joined with its verdict.
SALTS = 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once; a name used in a lambda is computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text."""
    return F.array_remove(F.split(text, WHITE), "")


def _rest(array: Column, start: int) -> Column:
    return F.slice(array, F.lit(start), F.size(array))


def _repeated(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    The windows are sorted with their places, so equal ones are neighbours. The places found,
    in order, each cover three words less what the next one covers too.
    """
    size = F.size(words)
    zipped = F.arrays_zip(
        words, _rest(words, 2), _rest(words, 3), F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)))
    ).cast("array<struct<a:string,b:string,c:string,i:int>>")
    windows = F.sort_array(F.slice(zipped, F.lit(1), F.greatest(size - 2, F.lit(0))))

    def pair(x: Column, y: Column) -> Column:
        same = (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        return F.when(same, F.array(x["i"], y["i"]))

    def places(ordered: Column) -> Column:
        found = F.zip_with(ordered, _rest(ordered, 2), pair)
        return F.sort_array(F.flatten(F.array_compact(found)))

    def covered(places: Column) -> Column:
        steps = F.zip_with(places, _rest(places, 2), lambda x, y: F.least(F.lit(3), F.coalesce(y - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return F.when(size < 4, F.lit(0)).otherwise(let(let(windows, places), covered))


def _counts(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return F.struct(
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
        let(
            words_of(text),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n"),
                F.length(F.array_join(words, "")).cast("long").alias("chars"),
                _repeated(words).cast("long").alias("repeated"),
            ),
        ).alias("words"),
    )


def measure(df: DataFrame, text: str = "text", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Adds the measures and base_failed to every document, without a shuffle.

    n_words; word_chars: code points in words; n_symbols: characters of #*$%&|<>; n_dup_lines:
    lines with a word that equal an earlier line; n_repeat_words: words in 3-word windows
    found twice or more in the text. base_failed: fewer than min_words words, or more than
    max_repeat_percent per cent of the words repeated. A null text is an empty one: all
    measures are 0 and it fails.
    """
    names = [*MEASURES, "base_failed"]
    kept = [df[quoted(c)] for c in without(df, [*names, "__llm_counts"])]
    counted = df.select(*kept, _counts(F.coalesce(df[quoted(text)], F.lit(""))).alias("__llm_counts"))
    counts = F.col("__llm_counts")
    words, repeated = counts["words"]["n"], counts["words"]["repeated"]
    return counted.select(
        *[F.col(quoted(c)) for c in counted.columns[:-1]],
        words.alias("n_words"),
        counts["words"]["chars"].alias("word_chars"),
        *[counts[n].alias(n) for n in MEASURES[2:4]],
        repeated.alias("n_repeat_words"),
        ((words < min_words) | (100 * repeated > max_repeat_percent * words)).alias("base_failed"),
    )


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """The beta prior of the hosts' failure shares, by moments, as (mean, weight in documents).

    hosts has a row per host with its documents and failed. The mean is the share over all
    documents. The weight follows from how much the hosts' shares differ beyond chance; where
    they do not (or there is one host) it is infinite, and every host gets the mean. The sums
    are one row, whatever the number of hosts.
    """
    sums = hosts.agg(
        F.count("*"),
        F.sum("documents"),
        F.sum("failed"),
        F.sum(F.col("documents").cast("decimal(38,0)") * F.col("documents")).cast("double"),
        F.sum((F.col("failed") * F.col("failed")).cast("double") / F.col("documents")),
    ).first()
    number, documents, failed, squares, spread = (x or 0 for x in sums)
    if not documents:
        return 0.0, float("inf")
    mean = failed / documents
    chance = mean * (1 - mean)
    room = documents - squares / documents - (number - 1)
    if chance <= 0 or room <= 0:
        return mean, float("inf")
    beyond = (spread - failed * mean) / chance - (number - 1)
    overlap = min(max(beyond / room, 0.0), 1.0)
    return mean, (1 / overlap - 1 if overlap > 0 else float("inf"))


def host_verdicts(measured: DataFrame, host: str = "source", max_share: float = 0.5) -> DataFrame:
    """Documents, failed, shrunk failure share and verdict of every host.

    Counts are added up before the shuffle, so a host with a third of all documents costs no
    more than others. Documents without a host belong to none.
    """
    hosts = (
        measured.filter(measured[quoted(host)].isNotNull())
        .groupBy(measured[quoted(host)].alias("__llm_host"))
        .agg(F.count("*").alias("documents"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    )
    hosts = staged(hosts, "hosts")
    mean, weight = beta_prior(hosts)
    if weight == float("inf"):
        share = F.lit(mean)
    else:
        share = (F.col("failed") + F.lit(mean * weight)) / (F.col("documents") + F.lit(weight))
    return hosts.withColumn("host_share", share).withColumn("host_rejected", F.col("host_share") > max_share)


def judge(
    df: DataFrame,
    text: str = "text",
    host: str = "source",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_share: float = 0.5,
    keep_text: bool = True,
) -> DataFrame:
    """Every document with its measures, base_failed, host_share and kept.

    kept is false for a document that fails the base rules and for every document of a
    rejected host. A document without a host is judged by the base rules alone, its
    host_share is null. Repeated rows count each. An empty table gives an empty one. Given
    columns named like a result are replaced; all others stay, the text too unless
    keep_text is false.

    Measuring is what costs, so the measured documents are written to the shared folder once and
    read for the hosts and for the result. They are not shuffled: only the verdicts of rejected hosts are needed,
    and each document asks for its host's. That list is joined as Spark sees fit; where both
    sides are shuffled, each host's documents go to many tasks.
    """
    measured = measure(df, text, min_words, max_repeat_percent)
    measured = staged(measured if keep_text else measured.drop(text), "measured")
    names = without(measured, ["host_share", "kept"])
    verdicts = host_verdicts(measured, host, max_share).select("__llm_host", "host_share", "host_rejected")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__llm_salt")
    dealt = verdicts.select("*", salts)
    salt = F.pmod(F.xxhash64(*[F.col(n) for n in MEASURES]), F.lit(SALTS)).cast("int")
    asked = measured.select(*[F.col(quoted(c)) for c in names], salt.alias("__llm_salt"))
    joined = asked.join(
        dealt.withColumnRenamed("__llm_salt", "__llm_dealt"),
        (F.col(quoted(host)) == F.col("__llm_host")) & (F.col("__llm_salt") == F.col("__llm_dealt")),
        "left",
    )
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.select(*[F.col(quoted(c)) for c in names], F.col("host_share"), kept.alias("kept"))
