"""Daily price series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.dates import iso_date
from marketlake.operators.filters import trailing_days


def shape_close_series(df: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Raw (Date, Close) rows as landing rows of the last ``days`` calendar days.

    The close is rounded to two places; ``loaded_at`` is the run date. Days without
    trading simply have no row.
    """
    day = F.col("Date").cast("date")
    return df.where(trailing_days(day, as_of, days)).select(
        iso_date(day).alias("date"),
        F.round("Close", 2).alias("close"),
        iso_date(F.lit(as_of)).alias("loaded_at"),
    )
