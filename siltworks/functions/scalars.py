"""Text, number and cyclic expressions over a named column, all native."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from siltworks.functions import sql

# The characters stripped from both ends of a text (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A decimal number or an infinity, in spaces. Java also parses '1.0d', '1f', 'NaN' and
# hexadecimal floats; those are text here.
NUMBER_PATTERN = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def strip_sql(column: str) -> str:
    """Without white space at both ends.

    Looking for each of many characters is slow, so it is left to texts that start or end
    with one of them once their spaces are gone. Each end is looked at once: a table has
    many such columns, and their code must stay short enough to be compiled.
    """
    bare, white = f"trim({sql.name(column)})", sql.text(WHITESPACE)
    plain = f"(instr({white}, left({bare}, 1)) | instr({white}, right({bare}, 1))) = 0"
    return f"CASE WHEN {plain} THEN {bare} ELSE btrim({sql.name(column)}, {white}) END"


def null_if_token(column: str, tokens: Sequence[str]) -> Column:
    """Null where the whole text equals one of ``tokens``; anything else is kept as it is."""
    c = sql.name(column)
    return F.expr(f"CASE WHEN NOT array_contains(array({sql.texts(tokens)}), {c}) THEN {c} END")


def to_number(column: str) -> Column:
    """The text as a double, null where it is not a number. Never NaN.

    A text that ends with a digit and is not hexadecimal is read by Java as it should
    be; only the others are compared with the pattern.
    """
    c = sql.name(column)
    plain = f"instr('0123456789', right({c}, 1)) > 0 AND (instr({c}, 'x') | instr({c}, 'X')) = 0"
    return F.expr(
        f"CASE WHEN {plain} OR {c} RLIKE {sql.text(NUMBER_PATTERN)} THEN try_cast({c} AS DOUBLE) END"
    )


def without_nan_sql(column: str) -> str:
    return f"nullif({sql.name(column)}, double('NaN'))"


def canonical_text(column: str, missing: str) -> Column:
    """Stripped lower-case text; null becomes the ``missing`` level."""
    return F.expr(f"coalesce(lower({strip_sql(column)}), {sql.text(missing)})")


def yes_no(column: str, yes: Sequence[str], no: Sequence[str]) -> Column:
    """1.0 for a yes token, 0.0 for a no token, null for anything else."""
    pairs = [f"{sql.text(t)}, 1.0D" for t in yes] + [f"{sql.text(t)}, 0.0D" for t in no]
    return F.expr(f"try_element_at(map({', '.join(pairs)}), lower({strip_sql(column)}))")


def place_sql(text: str, levels: Sequence[str], start: int) -> str:
    """Index of a text in ``levels``, counted from ``start``; null if it is not there."""
    pairs = [f"{sql.text(level)}, {sql.number(i)}" for i, level in enumerate(levels, start)]
    return f"try_element_at(map({', '.join(pairs)}), {text})"


def cyclic(value: str, period: int) -> tuple[Column, Column]:
    """The sine and cosine of a value on a circle of ``period`` steps."""
    angle = f"({value}) * {sql.number(2 * math.pi)} / {sql.number(period)}"
    return F.expr(f"sin({angle})"), F.expr(f"cos({angle})")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole * 100`` rounded half up; null when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)
