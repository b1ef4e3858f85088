"""Ranges of one column that hold about equally many rows, for parallel reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    return str(value)


def equal_depth_ranges(sample: DataFrame, column: str, n: int, *, accuracy: int = 10_000) -> list[str]:
    """Up to ``n`` SQL conditions on ``column`` that exclude each other and cover every row, NULLs included.

    Bounds come from a quantile sketch of ``sample`` (the table itself, an extract of it, or its state at the last load), so that a
    skewed key gives ranges of about the same number of rows, where equal steps between two guessed bounds give one
    overfull range. They stay right for rows outside the sample: the outer ranges are open. NULLs have a range of their own.
    One value is never split, so a value with more than its share of the rows has a range larger than the others.
    Numbers, dates and timestamps can be cut.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    steps = [i / n for i in range(1, n)]
    found = sample.agg(F.percentile_approx(column, F.array(*map(F.lit, steps)), accuracy)).first()[0] if steps else []
    bounds = sorted(set(found or []))
    name = f"`{column}`" if not column.isidentifier() else column
    marks = [_literal(b) for b in bounds]
    if not marks:
        return [f"{name} IS NOT NULL", f"{name} IS NULL"]
    inner = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(marks, marks[1:])]
    return [f"{name} <= {marks[0]}", *inner, f"{name} > {marks[-1]}", f"{name} IS NULL"]
