"""One-pass column profile: every structural check and quality figure reads it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltworks.functions import sql

#: columns of one aggregate
PROFILE_COLUMNS = 200


def numeric_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}


def sparse_columns(df: DataFrame) -> set[str]:
    """Sparse one-hot vectors, which are as good as numbers."""
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType) and f.dataType.names == ["size", "place"]}


def profile_entries(df: DataFrame, columns: Sequence[str]) -> Column:
    """Aggregate: array of one struct per column with its counts, spread and constancy.

    A numeric column is constant, that is without variance, if two or more values are all
    the same. Comparing the ends is exact and cheap, while a computed variance of a
    constant may come out as a tiny number.
    """
    numeric, sparse = numeric_columns(df), sparse_columns(df)
    entries = []
    for column in columns:
        c, is_numeric = sql.name(column), column in numeric
        constant = f"coalesce(count({c}) > 1 AND min({c}) = max({c}), false)" if is_numeric else "false"
        entries.append(
            f"named_struct('column_name', {sql.text(column)}, 'is_numeric', {str(is_numeric or column in sparse).lower()}, "
            f"'n_values', count({c}), 'n_null', count(1) - count({c}), 'is_constant', {constant}, "
            f"'spread', {f'CAST(max({c}) - min({c}) AS DOUBLE)' if is_numeric else 'CAST(NULL AS DOUBLE)'})"
        )
    return F.expr(f"array({', '.join(entries)})")


def column_profile(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), each: int = PROFILE_COLUMNS, more: Mapping[str, Column] = MappingProxyType({})
) -> DataFrame:
    """One row per group: ``n_rows`` and the array ``profile``, and ``more`` aggregates by name.

    Wide tables are profiled ``each`` columns at a time: every aggregate reads its own columns
    alone and stays small enough to be compiled; their arrays are put together by position.
    """
    chunks = [columns[at : at + each] for at in range(0, len(columns), each)] or [columns]
    parts = [
        df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n_rows"),
            profile_entries(df, chunk).alias("profile"),
            F.lit(at).alias("at"),
            *[c.alias(name) for name, c in more.items() if at == 0],
        )
        for at, chunk in enumerate(chunks)
    ]
    if len(parts) == 1:
        return parts[0].drop("at")
    in_order = F.array_sort(F.collect_list(F.struct("at", "profile")))
    whole = F.flatten(F.transform(in_order, lambda x: x["profile"]))
    carried = [F.any_value(name, ignoreNulls=True).alias(name) for name in more]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.groupBy(*by).agg(F.max("n_rows").alias("n_rows"), whole.alias("profile"), *carried)


def total_nulls(profile: Column) -> Column:
    return F.aggregate(profile, F.lit(0).cast("bigint"), lambda total, c: total + c["n_null"])


def invalid_columns(profile: Column) -> Column:
    """Names of the columns with a null or without variance."""
    bad = F.filter(profile, lambda c: (c["n_null"] > 0) | c["is_constant"])
    return F.transform(bad, lambda c: c["column_name"])
