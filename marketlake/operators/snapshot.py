"""Latest-date snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, date_col: str = "date", dates: DataFrame | None = None) -> DataFrame:
    """All rows at the largest date.

    The date is a scalar subquery: a small aggregate whose result is then an ordinary
    filter on the scan, where a window over everything would need a single partition.
    ``dates`` may hand in a cheaper frame with the same largest date.
    """
    newest = (df if dates is None else dates).agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == newest)
