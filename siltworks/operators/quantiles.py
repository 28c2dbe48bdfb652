"""Exact quantiles of many columns over any number of rows.

One way for every size, which reads each column three times. First come size and range of every
column, then, apart from these so that they are compiled, mergeable sketches, which bracket each
wanted rank between two values that few rows lie between. The last job counts, column by column, the
values below, between and above the brackets and writes those within them, each different value once
with its count: a small table, in which the ranks are found.

There each pass counts, per column, how many values fall into each of a fixed number of buckets, Spark
adds the counts up, and only the buckets that hold a wanted rank come back, as ranges for the next
pass. A pass shuffles at most ``ranges x buckets`` rows per task, however often one value repeats, and
returns at most one row for each wanted rank. It cuts a range into buckets of equal width, then at
powers of two if it still spans many magnitudes, and what is left, with at most 2 ** 52 different
values, into equal widths again, so that seven passes are the most for any values.

The counts of the last job are exact. A rank that they show outside of its bracket, as it may lie
in a column with infinite values, is found by such passes over the table itself. Results equal the
built-in ``percentile`` to the last bit.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from siltworks.functions import sql
from siltworks.session import stage

BUCKETS = 4096
#: ranks that the sketch gives are off by this part of all values at most
SKETCH = 4096

# columns whose counts and ranges, or sketches, are found in one job
SUMMARY_COLUMNS = 64

EVEN, BINADES = "even", "binades"


@dataclass(frozen=True)
class NumericSummary:
    """What the fits need to know about one column."""

    n: int
    mean: float | None = None
    stddev_pop: float | None = None
    quantiles: Mapping[float, float | None] = field(default_factory=dict)


@dataclass
class _Range:
    """Values ``low <= v <= high`` of one column; ``below`` values lie under it."""

    low: float
    high: float
    below: int
    n: int
    ranks: set[int]
    cut: str = EVEN


def summarize(
    df: DataFrame,
    quantile_columns: Mapping[str, str],
    moment_columns: Mapping[str, str] | None = None,
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    buckets: int = BUCKETS,
) -> dict[str, NumericSummary]:
    """Count, mean and population deviation of some columns and exact quantiles of others.

    Columns are SQL expressions of type double; a bounded number of them is looked at in each job
    that finds ranges or sketches.
    """
    moment_columns = dict(moment_columns or {})
    plain: list[list[str]] = []
    sketched: list[list[str]] = []
    for i, c in enumerate(quantile_columns.values()):
        finite = f"CASE WHEN abs({c}) < double('inf') THEN {c} END"
        plain.append(
            [
                f"count({c}) AS q{i}_n",
                f"count_if({c} = double('-inf')) AS q{i}_minus",
                f"count({finite}) AS q{i}_finite",
                f"min({finite}) AS q{i}_low",
                f"max({finite}) AS q{i}_high",
            ]
        )
        sketched.append([f"percentile_approx({finite}, array({sql.numbers(_around(probabilities))}), {SKETCH}) AS q{i}_sketch"])
    for i, c in enumerate(moment_columns.values()):
        plain.append([f"count({c}) AS m{i}_n", f"avg({c}) AS m{i}_mean", f"stddev_pop({c}) AS m{i}_std"])
    first: dict[str, float | int | None] = {}
    for aggregates in (plain, sketched):  # beside a sketch, which is an object, nothing would be compiled
        for at in range(0, len(aggregates), SUMMARY_COLUMNS):
            first.update(df.selectExpr(*sum(aggregates[at : at + SUMMARY_COLUMNS], [])).first().asDict())

    columns = [(i, name, c) for i, (name, c) in enumerate(quantile_columns.items())]
    summary = _by_histogram(df, columns, first, probabilities, buckets)
    for i, name in enumerate(moment_columns):
        earlier = summary.get(name)
        summary[name] = NumericSummary(
            n=first[f"m{i}_n"],
            mean=first[f"m{i}_mean"],
            stddev_pop=first[f"m{i}_std"],
            quantiles=earlier.quantiles if earlier else {},
        )
    return summary


def approximate_quantiles(
    df: DataFrame,
    columns: Mapping[str, str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int = 10_000,
) -> dict[str, NumericSummary]:
    """One pass with a sketch; the rank of a result is off by at most ``n / accuracy``."""
    if not columns:
        return {}
    wanted = f"array({sql.numbers(probabilities)})"
    exprs = []
    for i, c in enumerate(columns.values()):
        exprs += [f"count({c}) AS n{i}", f"percentile_approx({c}, {wanted}, {accuracy}) AS q{i}"]
    row = df.selectExpr(*exprs).first()
    none = [None] * len(probabilities)
    return {
        name: NumericSummary(row[f"n{i}"], quantiles=dict(zip(probabilities, row[f"q{i}"] or none)))
        for i, name in enumerate(columns)
    }


def _around(probabilities: Sequence[float]) -> list[float]:
    """For each quantile a smaller and a larger one that enclose it, whatever the sketch is off by."""
    return [min(1.0, max(0.0, p + off / SKETCH)) for p in probabilities for off in (-2, 2)]


def _brackets(spans: list[_Range], sketch: Sequence[float]) -> list[tuple[float, float]]:
    """The ranges between each two values of the sketch; those that touch are one."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted(zip(sketch[::2], sketch[1::2])) if spans else ():
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _bracketed(
    df: DataFrame, values: Mapping[str, str], open_ranges: dict[str, list[_Range]], sketches: Mapping[str, Sequence[float]]
) -> tuple[DataFrame, dict[str, list[_Range]]]:
    """The last job over the table: values within the brackets with their counts, and the ranges of ``open_ranges`` in them.

    What is found in a bracket leaves ``open_ranges``. The table has c, the number of the column, v and n.
    """
    names = list(values)
    parts_of = []
    for i, name in enumerate(names):
        cases = []
        for k, (low, high) in enumerate(brackets := _brackets(open_ranges[name], sketches[name])):
            cases.append(f"WHEN x < {sql.number(low)} THEN {2 * k} WHEN x <= {sql.number(high)} THEN {2 * k + 1}")
        if cases:  # a scan of this column alone: one of all columns would be too long to be compiled
            finite = df.selectExpr(f"{values[name]} AS x").filter("abs(x) < double('inf')")
            placed = finite.selectExpr("x", f"CASE {' '.join(cases)} ELSE {2 * len(brackets)} END AS s")
            parts_of.append(placed.selectExpr(f"{i} AS c", "s", "CASE WHEN s % 2 = 1 THEN x END AS v", "x"))
    counted = (
        reduce(DataFrame.unionAll, parts_of).groupBy("c", "s", "v")
        .agg(F.expr("count(1) AS n"), F.expr("min(x) AS low"), F.expr("max(x) AS high"))
    )
    inner = stage(counted, "brackets")
    # a few rows for each column
    parts = inner.groupBy("c", "s").agg(F.expr("sum(n) AS n"), F.expr("min(low) AS low"), F.expr("max(high) AS high")).collect()
    found: dict[str, list[_Range]] = {name: [] for name in names}
    for i, name in enumerate(names):
        left: list[_Range] = []
        for span in open_ranges[name]:
            below, missing = span.below, set(span.ranks)
            for part in sorted((p for p in parts if p["c"] == i), key=lambda p: p["s"]):
                inside = {r for r in span.ranks if below <= r < below + part["n"]}
                if inside:
                    own = _Range(part["low"], part["high"], below, part["n"], inside)
                    (found[name] if part["s"] % 2 else left).append(own)
                    missing -= inside
                below += part["n"]
            assert not missing, "the counts of the scans differ: the table has changed"
        open_ranges[name] = left
    return inner.filter("s % 2 = 1").select("c", F.col("low").alias("v"), "n"), found


def _by_histogram(
    df: DataFrame,
    columns: Sequence[tuple[int, str, str]],
    first: Mapping[str, float | int | None],
    probabilities: Sequence[float],
    buckets: int,
) -> dict[str, NumericSummary]:
    known: dict[str, dict[int, float]] = {}
    open_ranges: dict[str, list[_Range]] = {}
    for i, name, _ in columns:
        n, minus, finite = first[f"q{i}_n"], first[f"q{i}_minus"], first[f"q{i}_finite"]
        known[name], open_ranges[name] = {}, []
        inside = set()
        for rank in {r for p in probabilities for r in _ranks(n, p)[:2]}:
            if rank < minus:
                known[name][rank] = float("-inf")
            elif rank >= minus + finite:
                known[name][rank] = float("inf")
            else:
                inside.add(rank)
        if inside:
            span = _Range(first[f"q{i}_low"], first[f"q{i}_high"], minus, finite, inside)
            _settle(span, known[name], open_ranges[name])
    values = {name: c for _, name, c in columns if open_ranges[name]}
    if values:
        sketches = {name: first[f"q{i}_sketch"] for i, name, _ in columns}
        inner, inside = _bracketed(df, values, open_ranges, sketches)
        of_inner = {name: f"CASE WHEN c = {i} THEN v END" for i, name in enumerate(values)}
        for table, exprs, ranges, counted in ((inner, of_inner, inside, "sum(n)"), (df, values, open_ranges, "count(1)")):
            for name in exprs:
                spans, ranges[name] = ranges[name], []
                for span in spans:
                    _settle(span, known[name], ranges[name])
            while any(ranges[name] for name in exprs):
                _narrow(table, exprs, ranges, known, buckets, counted)
    return {
        name: NumericSummary(
            n=first[f"q{i}_n"],
            quantiles={p: _interpolate(known[name], first[f"q{i}_n"], p) for p in probabilities},
        )
        for i, name, _ in columns
    }


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """The two order statistics (from 0) around quantile ``p`` and the place between them."""
    if n == 0:
        return (0, 0, 0.0)
    at = (n - 1) * p
    return (math.floor(at), math.ceil(at), at)


def _interpolate(known: Mapping[int, float], n: int, p: float) -> float | None:
    """As ``percentile`` does it, so that no last bit differs."""
    if n == 0:
        return None
    low, high, at = _ranks(n, p)
    if low == high or known[low] == known[high]:
        return known[low]
    return (high - at) * known[low] + (at - low) * known[high]


def _settle(span: _Range, known: dict[int, float], still_open: list[_Range]) -> None:
    """A range of one value answers its ranks; the smallest and largest rank are its ends."""
    if span.low == span.high:
        known.update(dict.fromkeys(span.ranks, span.low))
        return
    if span.below in span.ranks:
        known[span.below] = span.low
    last = span.below + span.n - 1
    if last in span.ranks:
        known[last] = span.high
    span.ranks -= {span.below, last}
    if span.ranks:
        still_open.append(span)


def _is_wide(low: float, high: float) -> bool:
    """Does the range span more than two powers of two?"""
    return not (0 < low and high <= 4 * low or high < 0 and low >= 4 * high)


def _slot(v: str, span: _Range, buckets: int) -> str:
    """The number of the bucket of ``v``, as SQL; larger values have no smaller numbers."""
    if span.n <= buckets:  # few values: one bucket for each ends the search
        return v
    if span.cut == BINADES:
        return f"CASE WHEN {v} = 0D THEN 0D ELSE signum({v}) * (floor(log2(abs({v}))) + 1100D) END"
    # halved so that the width of a range of huge values does not overflow
    width = span.high / 2 - span.low / 2
    place = f"floor(({v} / 2D - {sql.number(span.low / 2)}) / {sql.number(width)} * {buckets}D)"
    return f"CAST(least({place}, {buckets - 1}L) AS DOUBLE)"


def _narrow(
    df: DataFrame,
    values: Mapping[str, str],
    open_ranges: dict[str, list[_Range]],
    known: dict[str, dict[int, float]],
    buckets: int,
    counted: str = "count(1)",
) -> None:
    """One pass: count the buckets of every open range and keep those that hold a rank."""
    spans = [(name, span) for name in values for span in open_ranges[name]]
    entries = []
    weight = "n" if counted == "sum(n)" else "1L"
    for name in values:
        branches = [
            f"WHEN {values[name]} BETWEEN {sql.number(span.low)} AND {sql.number(span.high)} THEN "
            f"named_struct('span', {i}, 'slot', {_slot(values[name], span, buckets)}, 'v', {values[name]}, 'n', {weight})"
            for i, (owner, span) in enumerate(spans)
            if owner == name  # the ranges of a column do not overlap
        ]
        if branches:
            entries.append(f"CASE {' '.join(branches)} END")
    below = f"array({', '.join(f'{span.below}L' for _, span in spans)})[span]"
    ranks = ", ".join(f"array({', '.join(f'{r}L' for r in sorted(span.ranks))})" for _, span in spans)
    earlier = "sum(n) OVER (PARTITION BY span ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    # at most one row for each wanted rank
    found = (
        df.selectExpr(f"inline(array({', '.join(entries)}))")
        .filter("span IS NOT NULL")
        .groupBy("span", "slot")
        .agg(F.expr(f"{counted} AS n"), F.expr("min(v) AS low"), F.expr("max(v) AS high"))
        .selectExpr("span", "n", "low", "high", f"{below} + coalesce({earlier}, 0L) AS below")
        .filter(f"exists(array({ranks})[span], r -> r >= below AND r < below + n)")
        .collect()
    )
    for name in values:
        open_ranges[name] = []
    for row in found:
        name, span = spans[row["span"]]
        inside = {r for r in span.ranks if row["below"] <= r < row["below"] + row["n"]}
        next_cut = BINADES if span.cut == EVEN and _is_wide(row["low"], row["high"]) else EVEN
        rest = _Range(row["low"], row["high"], row["below"], row["n"], inside, next_cut)
        _settle(rest, known[name], open_ranges[name])
