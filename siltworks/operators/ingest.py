"""From a table of text to a typed table: headers, null tokens, casts, first checks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from siltworks.config import PrepConfig
from siltworks.functions import sql
from siltworks.functions.scalars import NUMBER_PATTERN, null_if_token, percent, to_number


def header_map(names: Sequence[str]) -> dict[str, str]:
    """Old name -> normalised name, for the names that change.

    Raises before anything is read if two headers would become the same column.
    """
    normalised = [name.strip().lower() for name in names]
    collisions = sorted(name for name, n in Counter(normalised).items() if n > 1)
    if collisions:
        raise ValueError(f"headers that become the same column: {collisions}")
    return {old: new for old, new in zip(names, normalised) if old != new}


def normalize_header(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name."""
    renamed = header_map(df.columns)
    return df.withColumnsRenamed(renamed) if renamed else df


def apply_null_tokens(df: DataFrame, tokens: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the listed tokens into nulls in every text column (or in ``columns``)."""
    if columns is None:
        columns = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: null_if_token(c, tokens) for c in columns})


def cast_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the columns that are present to double; what is not a number becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(c) for c in present})


def ingest(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Header, null tokens and numeric casts in one projection over the source.

    A token that is no number is null after the cast anyway, so numeric columns are
    compared with the tokens only if one of these is a number.
    """
    named = normalize_header(df)
    tokens_are_text = not any(re.match(NUMBER_PATTERN, token) for token in cfg.null_tokens)
    skipped = {*cfg.key, *(cfg.numeric if tokens_are_text else ())}
    text = [name for name, kind in named.dtypes if kind == "string" and name not in skipped]
    return cast_numeric(apply_null_tokens(named, cfg.null_tokens, text), cfg.numeric)


def schema_check(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """One row per expected column: is it there, and how many values does it hold.

    A missing column is a finding, not a failure; one scan counts all columns.
    """
    kinds = {"numeric": cfg.numeric, "categorical": cfg.categorical, "binary": cfg.binary}
    rows = [
        f"named_struct('column_name', {sql.text(c)}, 'logical_type', '{kind}', 'present', {str(c in df.columns).lower()}, "
        f"'n_values', {f'count({sql.name(c)})' if c in df.columns else '0L'})"
        for kind, columns in kinds.items()
        for c in columns
    ]
    return df.agg(F.expr(f"array({', '.join(rows)})").alias("found")).select(F.inline("found"))


def null_census(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null cells per column and, as column ``*``, of the whole table. One scan."""
    rows = [
        f"named_struct('column_name', {sql.text(c)}, 'n_null', count(1) - count({sql.name(c)}), 'n_cells', count(1))"
        for c in columns
    ]
    counted = " + ".join(["0L", *[f"count({sql.name(c)})" for c in columns]])
    cells = f"count(1) * {len(columns)}"
    rows.append(f"named_struct('column_name', '*', 'n_null', {cells} - ({counted}), 'n_cells', {cells})")
    return (
        df.agg(F.expr(f"array({', '.join(rows)})").alias("census"))
        .select(F.inline("census"))
        .withColumn("null_pct", percent(F.col("n_null"), F.col("n_cells"), 4))
    )


class Trace:
    """Row counts at named points of a plan, collected while its main job runs."""

    def __init__(self) -> None:
        self._points: list[tuple[str, list[str], Observation]] = []

    def point(self, label: str):
        """A step for ``df.transform``: note the columns now and count the rows later."""

        def mark(df: DataFrame) -> DataFrame:
            seen = Observation(label)
            self._points.append((label, list(df.columns), seen))
            return df.observe(seen, F.count(F.lit(1)).alias("n_rows"))

        return mark

    def rows(self) -> list[tuple[str, int, int, str]]:
        """(label, rows, columns, column list); waits for the job that ran the plan."""
        return [
            (label, int(seen.get["n_rows"]), len(columns), ",".join(columns))
            for label, columns, seen in self._points
        ]
