"""Literal dimension rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from marketlake.schemas import DISTRICTS, REFERENCE, TOTAL_AREA, TOTAL_DISTRICT


def area_dim(
    spark: SparkSession,
    districts: Mapping[str, str] = DISTRICTS,
    total: tuple[str, str] | None = (TOTAL_AREA, TOTAL_DISTRICT),
) -> DataFrame:
    """Area code and district name, plus the synthetic total."""
    rows = [*districts.items(), *([total] if total else [])]
    return spark.createDataFrame(rows, REFERENCE["gold_area_dim"])
