"""Finding, batching and filling records that lack a postcode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def needs_enrichment(incoming: DataFrame, target: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Incoming rows whose key has no known ``column`` in the target yet."""
    known = target.where(F.col(column).isNotNull()).select(*keys)
    return incoming.join(known, list(keys), "left_anti").select(*incoming.columns)


def batch_rows(df: DataFrame, size: int, key: str, buckets: int, bucket: Column | None = None) -> DataFrame:
    """Number the rows into request batches of at most ``size``: adds ``bucket`` and ``batch_no``.

    Rows are numbered inside hash buckets of the unique ``key``, so no task orders all rows.
    Choose ``buckets`` with the data, for instance one per million rows. ``bucket`` may give a
    row's bucket itself, such as the region that a request must stay in.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int") if bucket is None else bucket
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(key))
    return (
        df.withColumn("bucket", bucket)
        .withColumn("_place", place)
        .withColumn("batch_no", F.floor((F.col("_place") - 1) / size).cast("int"))
        .drop("_place")
    )


def fill_from(df: DataFrame, found: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``column`` filled from ``found`` (one row per key) where it is NULL or empty."""
    extra = found.select(*keys, F.col(column).alias("_found"))
    have = F.nullif(F.col(column), F.lit(""))
    return (
        df.join(extra, list(keys), "left")
        .withColumn(column, F.coalesce(have, "_found"))
        .select(*df.columns)
    )
