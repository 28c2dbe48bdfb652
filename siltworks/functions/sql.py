"""Names and literals inside SQL expressions.

Wide tables need hundreds of expressions. As one SQL text each, they cost the driver one
call per column instead of one per function, and Catalyst sees the same tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterable


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values: Iterable[str]) -> str:
    return ", ".join(text(v) for v in values)


def number(value: float | None) -> str:
    """A double, so that no literal becomes a decimal."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    if not math.isfinite(value):
        return f"double('{value}')"
    return f"{value!r}D" if value >= 0 else f"(-{-value!r}D)"


def numbers(values: Iterable[float]) -> str:
    return ", ".join(number(v) for v in values)
