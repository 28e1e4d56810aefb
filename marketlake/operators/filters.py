"""Selections with the two meanings an empty choice can have."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_optional(df: DataFrame, column: str, chosen: Sequence[str]) -> DataFrame:
    """Rows whose value was chosen; no choice keeps everything."""
    return df.where(F.col(column).isin(list(chosen))) if chosen else df


def filter_strict(df: DataFrame, column: str, chosen: Sequence[str]) -> DataFrame:
    """Rows whose value was chosen; no choice keeps nothing."""
    return df.where(F.col(column).isin(list(chosen)))


def filter_by_frame(df: DataFrame, column: str, chosen: DataFrame) -> DataFrame:
    """Rows whose value occurs in ``chosen``, for selections too long for a literal list."""
    return df.join(chosen.select(column).distinct(), column, "left_semi").select(*df.columns)


def between_dates(column: Column, start: date, end: date) -> Column:
    """Closed date range."""
    return column.between(F.lit(start), F.lit(end))


def trailing_days(column: Column, as_of: date, days: int) -> Column:
    """The last ``days`` calendar days up to ``as_of``."""
    return (column > F.date_sub(F.lit(as_of), days)) & (column <= F.lit(as_of))
