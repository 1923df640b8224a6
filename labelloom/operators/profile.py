"""Profiles of a labelled table. Each is one scan; profile_report is one scan for all."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.tokens import sql_text
from labelloom.functions.values import finite_number, label_flag, leading_number, named
from labelloom.operators.columns import resolve_label_columns
from labelloom.operators.onepass import Statistic, one_pass, totals

_ROWS = "n_rows"


def _percent(part: str, whole: str = _ROWS) -> str:
    return f"coalesce(try_divide({part} * 100D, {whole}), 0D)"


def _flags(df: DataFrame, labels: Sequence[str]) -> dict[str, Column]:
    return {c: label_flag(named(c), df.schema[c].dataType) for c in labels if c in df.columns}


# ---- missing and parsed values ---------------------------------------------------


def _missing(columns: Sequence[str]) -> Statistic:
    stat = Statistic(aggregates={_ROWS: "count(*)"})
    for i, c in enumerate(columns):
        there = stat.value(f"there{i}", named(c).isNotNull())
        stat.aggregates[f"null{i}"] = f"count_if(NOT {there})"
        stat.add(column=sql_text(c), n_missing=f"null{i}", n_rows=_ROWS)
    return stat


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column and the number of rows."""
    return one_pass(df, _missing(columns or df.columns))


def parsed_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raw texts with a number, and texts that are there but hold none."""
    stat = Statistic()
    for i, c in enumerate(columns):
        there = stat.value(f"there{i}", named(c).isNotNull())
        parsed = stat.value(f"number{i}", leading_number(named(c).cast("string")))
        stat.aggregates[f"ok{i}"] = f"count({parsed})"
        stat.aggregates[f"bad{i}"] = f"count_if({there} AND {parsed} IS NULL)"
        stat.add(column=sql_text(c), n_parsed=f"ok{i}", n_malformed=f"bad{i}")
    return one_pass(df, stat)


# ---- labels ----------------------------------------------------------------------


def label_distribution(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows and percent of rows per label, 0 on an empty table."""
    stat = Statistic(
        aggregates={_ROWS: "count(*)"}, columns="label string, n_rows long, percent double"
    )
    for i, (label, flag) in enumerate(_flags(df, labels).items()):
        stat.aggregates[f"sum{i}"] = f"coalesce(sum({stat.value(f'flag{i}', flag)}), 0L)"
        stat.add(label=sql_text(label), n_rows=f"sum{i}", percent=_percent(f"sum{i}"))
    return one_pass(df, stat)


def class_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows per class and label, before and after undersampling."""
    stat = Statistic(
        aggregates={_ROWS: "count(*)"},
        columns="label string, class_value int, n_before long, n_after long",
    )
    for i, (label, flag) in enumerate(_flags(df, labels).items()):
        stat.aggregates[f"ones{i}"] = f"count_if({stat.value(f'flag{i}', flag)} = 1)"
        ones, zeros = f"ones{i}", f"({_ROWS} - ones{i})"
        smaller = f"least({ones}, {zeros})"
        for value, before in ((0, zeros), (1, ones)):
            stat.add(
                shown=f"{before} > 0",
                label=sql_text(label),
                class_value=str(value),
                n_before=before,
                n_after=f"CASE WHEN {smaller} > 0 THEN {smaller} ELSE {before} END",
            )
    return one_pass(df, stat)


def _together(flags: dict[str, Column]) -> Statistic:
    """Sums of the products of every two labels, each made once."""
    stat = Statistic(columns="label_a string, label_b string, n_rows long")
    names = list(flags)
    for i, name in enumerate(names):
        stat.value(f"flag{i}", flags[name])
    for i, j in combinations_with_replacement(range(len(names)), 2):
        stat.aggregates[f"both{i}_{j}"] = f"coalesce(sum(flag{i} * flag{j}), 0L)"
        for a, b in {(i, j), (j, i)}:
            stat.add(label_a=sql_text(names[a]), label_b=sql_text(names[b]), n_rows=f"both{i}_{j}")
    return stat


# Labels up to which every pair is a sum of its own; more would not compile.
FEW_LABELS = 40


def _together_of_many(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """The same from the labels that are set in each row.

    A row makes the pairs of its own labels only. They add up in each task before the shuffle,
    where a task sends one row a pair at most, so a frequent pair costs no more than others.
    """
    names = list(flags)
    # Hundreds of labels are named in SQL text, since each Column operation is a call into the JVM.
    listed = ", ".join(f"struct({i} AS i, CAST(flag{i} AS BIGINT) AS v)" for i in range(len(names)))
    read = df.select(*[flag.alias(f"flag{i}") for i, flag in enumerate(flags.values())])
    rows = read.selectExpr(f"filter(array({listed}), s -> s.v != 0) AS set")
    # The outer forms are used since for the plain ones Spark would make the arrays twice.
    ones = rows.select("set", F.posexplode_outer("set").alias("at", "one"))
    pairs = ones.select("one", F.explode_outer(F.slice("set", F.col("at") + 1, F.size("set"))).alias("other"))
    sums = (
        pairs.groupBy(F.col("one.i").alias("low"), F.col("other.i").alias("high"))
        .agg(F.sum(F.col("one.v") * F.col("other.v")).alias("n_rows"))
        .filter("low IS NOT NULL")
    )
    both = F.array_distinct(F.array(F.struct(F.col("low").alias("a"), F.col("high").alias("b")), F.struct(F.col("high").alias("a"), F.col("low").alias("b"))))
    made = sums.select(F.explode(both).alias("p"), "n_rows").select("p.a", "p.b", "n_rows")
    k = len(names)
    grid = df.sparkSession.range(k * k).select(
        F.call_function("div", F.col("id"), F.lit(k)).cast("int").alias("a"), (F.col("id") % k).cast("int").alias("b")
    )
    name = F.expr(f"array({', '.join(map(sql_text, names))})")
    return grid.join(made, ["a", "b"], "left").select(
        F.get(name, F.col("a")).alias("label_a"), F.get(name, F.col("b")).alias("label_b"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")
    )


def label_cooccurrence(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows that have both labels, for every pair; a label with itself is its support.

    For labels that are not 0 and 1 it is the sum of the products, so the table is symmetric.
    """
    flags = _flags(df, labels)
    return _together_of_many(df, flags) if len(flags) > FEW_LABELS else one_pass(df, _together(flags))


def _active(stat: Statistic, flags: dict[str, Column]) -> str:
    """Number of labels set in a row, read by stat."""
    names = [stat.value(f"flag{i}", flag) for i, flag in enumerate(flags.values())]
    return f"({' + '.join(names) or '0'})"


def _per_row(flags: dict[str, Column]) -> Statistic:
    """Rows per sum of 0/1 labels; rows with any other sum are counted together."""
    stat = Statistic(aggregates={_ROWS: "count(*)"})
    active = _active(stat, flags)
    found = {str(n): f"{active} = {n}" for n in range(len(flags) + 1)}
    found["other"] = f"{active} NOT BETWEEN 0 AND {len(flags)}"
    for i, (n, condition) in enumerate(found.items()):
        stat.aggregates[f"active{i}"] = f"count_if({condition})"
        stat.add(
            shown=f"active{i} > 0",
            n_labels=sql_text(n),
            n_rows=f"active{i}",
            percent=_percent(f"active{i}"),
        )
    return stat


def labels_per_row(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows and percent of rows per sum of labels, for sums that occur, whatever they are.

    The rows of a sum are counted before the shuffle; there are few sums.
    """
    active = sum(_flags(df, labels).values(), F.lit(0))
    counted = df.select(active.cast("int").alias("n_labels")).groupBy("n_labels").agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return counted.select("n_labels", "n_rows", (F.col("n_rows") * 100.0 / total).alias("percent"))


def _average(flags: dict[str, Column]) -> Statistic:
    stat = Statistic()
    stat.aggregates["avg_active"] = f"avg({_active(stat, flags)})"
    stat.add(avg_labels="avg_active")
    return stat


def avg_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Mean number of labels set per row."""
    return one_pass(df, _average(_flags(df, labels)))


# ---- splits ----------------------------------------------------------------------


def _sizes(split: str) -> Statistic:
    stat = Statistic(aggregates={_ROWS: "count(*)"})
    side = stat.value("side", named(split))
    for part in ("train", "test"):
        stat.aggregates[part] = f"count_if({side} = '{part}')"
        stat.add(split=f"'{part}'", n_rows=part, percent=_percent(part))
    return stat


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and percent of rows of train and test."""
    return one_pass(df, _sizes(split))


def _drift(df: DataFrame, labels: Sequence[str], split: str) -> Statistic:
    stat = Statistic(
        columns="position int, label string, train_percent double, test_percent double, drift double"
    )
    side = stat.value("side", named(split))
    for i, (label, column) in enumerate(resolve_label_columns(df, labels).items()):
        flag = stat.value(f"flag{i}", named(column).cast("double"))
        for part in ("train", "test"):
            stat.aggregates[f"{part}{i}"] = f"avg(CASE WHEN {side} = '{part}' THEN {flag} END) * 100"
        stat.add(
            position=str(i),
            label=sql_text(label),
            train_percent=f"train{i}",
            test_percent=f"test{i}",
            drift=f"2 * (test{i} - train{i})",
        )
    return stat


def split_drift(df: DataFrame, labels: Sequence[str], split: str = "split") -> DataFrame:
    """Percent of train and of test rows per label, and twice their difference."""
    return one_pass(df, _drift(df, labels, split)).drop("position")


def drift_summary(df: DataFrame, labels: Sequence[str], split: str = "split") -> DataFrame:
    """Mean and greatest absolute drift, with the first label that has it."""
    drift = one_pass(df, _drift(df, labels, split)).withColumn("size", F.abs("drift"))
    worst = F.max_by(
        F.struct("label", "train_percent", "test_percent"), F.struct("size", -F.col("position"))
    )
    return drift.agg(
        F.avg("size").alias("avg_abs_drift"), F.max("size").alias("max_abs_drift"), worst.alias("w")
    ).select("avg_abs_drift", "max_abs_drift", "w.*")


def split_overview(df: DataFrame, labels: Sequence[str], split: str = "split") -> DataFrame:
    """split_sizes, split_drift and drift_summary as (section, key, metric, value), from one scan."""
    sizes, drift = _sizes(split), _drift(df, labels, split)
    found = ", ".join(
        f"struct(abs({r['drift']}) AS size, -{r['position']} AS place, {r['label']} AS label, "
        f"{r['train_percent']} AS train, {r['test_percent']} AS test)"
        for r in drift.rows
    )
    row = totals(df, [sizes, drift])
    if drift.rows:
        row = row.selectExpr("*", f"filter(array({found}), d -> d.size IS NOT NULL) AS drifts")
        row = row.selectExpr("*", "array_max(drifts) AS worst")
    average = "aggregate(drifts, 0D, (a, d) -> a + d.size) / size(drifts)"
    cells = [("size", r["split"], m, r[m]) for r in sizes.rows for m in ("n_rows", "percent")]
    cells += [("drift", r["label"], m, r[m]) for r in drift.rows for m in ("train_percent", "test_percent", "drift")]
    summary = {
        "avg_abs_drift": average, "max_abs_drift": "worst.size", "train_percent": "worst.train", "test_percent": "worst.test"
    }
    if drift.rows:
        cells += [("worst", "worst.label", m, sql) for m, sql in summary.items()]
    structs = ", ".join(
        f"struct('{s}' AS section, {k} AS key, '{m}' AS metric, double({v}) AS value)" for s, k, m, v in cells
    )
    return row.selectExpr(f"inline(array({structs}))")


# ---- correlations ----------------------------------------------------------------


def _with_gaps(df: DataFrame, values: dict[str, Column]) -> set[str]:
    """The columns that hold no number in some row, from one count of each."""
    counted = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    row = counted.selectExpr("count(*)", *[f"count(v{i})" for i in range(len(values))]).first()
    return {name for name, n in zip(values, row[1:], strict=True) if n < row[0]}


def _correlations(
    df: DataFrame,
    values: dict[str, Column],
    pairs: Sequence[tuple[str, str]],
    mirrored: bool,
    prefix: str,
) -> Statistic:
    """Pearson over the rows where both values are there; null for a constant column.

    Columns without gaps share their spread and bounds among all pairs, and a pair adds its
    covariance only. For a pair with gaps spread and bounds are of the rows where both are
    there: regr_r2 has the squared correlation in one aggregate and, other than corr, does not
    divide by a zero spread; the covariance has the sign. Whether a column is constant is told
    by its bounds: partial means merge with rounding, so its spread need not be 0.
    """
    stat = Statistic()
    place = {name: i for i, name in enumerate(values)}
    gaps = _with_gaps(df, values) if values else set()
    for name, i in place.items():
        value = stat.value(f"{prefix}_v{i}", values[name])
        stat.aggregates[f"{prefix}_n{i}"] = f"count({value})"
        if name not in gaps:
            stat.aggregates[f"{prefix}_dev{i}"] = f"stddev_samp({value})"
            stat.aggregates[f"{prefix}_low{i}"] = f"min({value})"
            stat.aggregates[f"{prefix}_high{i}"] = f"max({value})"
    for k, (a, b) in enumerate(pairs):
        i, j = place[a], place[b]
        x, y = f"{prefix}_v{i}", f"{prefix}_v{j}"
        together = f"{prefix}_c{k}"
        stat.aggregates[together] = f"covar_samp({x}, {y})"
        if gaps.isdisjoint((a, b)):
            varied = [f"{prefix}_low{c} < {prefix}_high{c}" for c in (i, j)]
            found = f"greatest(-1D, least(1D, {together} / ({prefix}_dev{i} * {prefix}_dev{j})))"
        else:
            squared = f"{prefix}_r{k}"
            stat.aggregates[squared] = f"regr_r2({x}, {y})"
            varied = []
            for side, one, other in (("x", x, y), ("y", y, x)):
                both = one if one == other else f"CASE WHEN {other} IS NOT NULL THEN {one} END"
                for bound in ("min", "max"):
                    stat.aggregates[f"{prefix}_{bound}_{side}{k}"] = f"{bound}({both})"
                varied.append(f"{prefix}_min_{side}{k} < {prefix}_max_{side}{k}")
            found = f"signum({together}) * sqrt({squared})"
        value = f"CASE WHEN {' AND '.join(varied)} THEN {found} END"
        there = f"{prefix}_n{i} > 0 AND {prefix}_n{j} > 0"
        for first, second in ((a, b), (b, a)) if mirrored and a != b else ((a, b),):
            stat.add(there, column_a=sql_text(first), column_b=sql_text(second), correlation=value)
    return stat


def _numbers(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {c: finite_number(named(c), df.schema[c].dataType) for c in columns if c in df.columns}


def _numeric_correlations(df: DataFrame, numbers: dict[str, Column]) -> Statistic | None:
    if len(numbers) < 2:
        return None
    return _correlations(df, numbers, list(combinations_with_replacement(numbers, 2)), True, "num")


def _label_correlations(
    df: DataFrame, numbers: dict[str, Column], flags: dict[str, Column]
) -> Statistic | None:
    if not numbers or not flags:
        return None
    values = {**numbers, **{c: f.cast("double") for c, f in flags.items()}}
    return _correlations(df, values, [(a, b) for a in numbers for b in flags], False, "lab")


def _or_empty(df: DataFrame, stat: Statistic | None) -> DataFrame:
    if stat is None:
        return df.sparkSession.createDataFrame(
            [], "column_a string, column_b string, correlation double"
        )
    return one_pass(df, stat)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, all-null columns left out."""
    return _or_empty(df, _numeric_correlations(df, _numbers(df, columns)))


def numeric_label_correlation(
    df: DataFrame, columns: Sequence[str], labels: Sequence[str]
) -> DataFrame:
    """Pearson correlation of every numeric column with every label."""
    return _or_empty(df, _label_correlations(df, _numbers(df, columns), _flags(df, labels)))


# ---- texts -----------------------------------------------------------------------


def _texts(df: DataFrame, columns: Sequence[str]) -> Statistic:
    stat = Statistic(aggregates={_ROWS: "count(*)"})
    for i, c in enumerate(c for c in columns if c in df.columns):
        # 0 for null and for empty texts; the text itself goes no further.
        length = F.coalesce(F.char_length(named(c).cast("string")), F.lit(0))
        size = stat.value(f"size{i}", length)
        stat.aggregates[f"empty{i}"] = f"count_if({size} = 0)"
        stat.aggregates[f"length{i}"] = f"avg(CASE WHEN {size} > 0 THEN {size} END)"
        stat.add(
            shown=f"{_ROWS} > 0",
            column=sql_text(c),
            missing_percent=f"round({_percent(f'empty{i}')}, 2)",
            avg_length=f"round(coalesce(length{i}, 0D), 2)",
        )
    return stat


def text_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percent of null or empty texts and mean length of the others, per column."""
    return one_pass(df, _texts(df, columns))


# ---- everything ------------------------------------------------------------------


def profile_report(
    df: DataFrame,
    labels: Sequence[str],
    numeric: Sequence[str],
    texts: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """All of the above as (section, key, metric, value), from one scan after a count of gaps.

    Sums of labels beyond the number of labels, which only labels other than 0 and 1 can
    have, are one key "other" here; labels_per_row tells them apart.
    """
    flags, numbers = _flags(df, labels), _numbers(df, numeric)
    parts: list[tuple[str, Statistic, list[str], list[str]]] = [
        ("missing", _missing(columns or df.columns), ["column"], ["n_missing"]),
        ("labels_per_row", _per_row(flags), ["n_labels"], ["n_rows", "percent"]),
        ("cooccurrence", _together(flags), ["label_a", "label_b"], ["n_rows"]),
        ("avg_labels", _average(flags), [], ["avg_labels"]),
        ("text", _texts(df, texts), ["column"], ["missing_percent", "avg_length"]),
    ]
    for section, stat in (
        ("correlation", _numeric_correlations(df, numbers)),
        ("label_correlation", _label_correlations(df, numbers, flags)),
    ):
        if stat is not None:
            parts.append((section, stat, ["column_a", "column_b"], ["correlation"]))

    report = Statistic(aggregates={_ROWS: "count(*)"})
    report.add(section="'table'", key="''", metric="'n_rows'", value=f"double({_ROWS})")
    for section, stat, keys, metrics in parts:
        report.values.update(stat.values)
        report.aggregates.update(stat.aggregates)
        for made, shown in zip(stat.rows, stat.shown, strict=True):
            key = f"concat_ws('|', {', '.join(made[k] for k in keys)})" if keys else "''"
            for metric in metrics:
                report.add(
                    shown=shown,
                    section=f"'{section}'",
                    key=key,
                    metric=f"'{metric}'",
                    value=f"double({made[metric]})",
                )
    return one_pass(df, report)
