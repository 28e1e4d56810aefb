"""Small frames for a dashboard, computed from the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.filters import filter_optional, filter_strict
from marketlake.operators.medians import grouped_stats, value_counts
from marketlake.operators.snapshot import latest_snapshot
from marketlake.schemas import TOTAL_AREA


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def load(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {table}")


def load_area_dim(spark: SparkSession, table: str = "gold_area_dim") -> DataFrame:
    return spark.sql(f"SELECT * FROM {table} WHERE area_code != '{TOTAL_AREA}'")


def load_index(spark: SparkSession, table: str = "silver_spy_prices") -> DataFrame:
    return spark.sql(f"SELECT * FROM {table} ORDER BY date")


def last_updated(current: DataFrame) -> DataFrame:
    return current.agg(F.max("date").alias("last_updated"))


def area_summary(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Area rows of the newest date with their district, highest median first.

    The newest date is a scalar subquery, which a stored fact pushes down to its scan.
    """
    measures = ["avg_price", "median_price", "num_properties"]
    newest = latest_snapshot(fact.where(F.col("area_code") != TOTAL_AREA))
    return dim.join(newest, "area_code").select("area_code", "district", *measures).orderBy(
        F.desc("median_price"), "area_code"
    )


def area_options(fact: DataFrame) -> DataFrame:
    """The areas that occur, in text order."""
    return fact.where(F.col("area_code") != TOTAL_AREA).select("area_code").distinct().orderBy("area_code")


def default_areas(fact: DataFrame, n: int = 5) -> DataFrame:
    return area_options(fact).limit(n)


def price_lines(fact: DataFrame, chosen: Sequence[str]) -> DataFrame:
    """Mean price by date for the chosen areas; none chosen, none shown."""
    return filter_strict(fact, "area_code", chosen).select("date", "area_code", "avg_price").orderBy(
        "date", "area_code"
    )


def trend(fact: DataFrame, chosen: Sequence[str] | DataFrame) -> DataFrame:
    """Per date the median of the chosen areas' medians and the sum of their counts."""
    if isinstance(chosen, DataFrame):
        rows = fact.join(chosen.select("area_code"), "area_code", "left_semi")
    else:
        rows = filter_strict(fact, "area_code", chosen)
    return rows.groupBy("date").agg(
        F.median("median_price").alias("median_price"), F.sum("num_properties").alias("num_properties")
    ).orderBy("date")


def headline(current: DataFrame, chosen: Sequence[str] = ()) -> DataFrame:
    """One row: number of listings and their exact, interpolated median price; none chosen means all."""
    rows = filter_optional(current, "area_code", chosen)
    stats = grouped_stats(value_counts(rows, [], "price"), [])
    # A grouping without keys has no row for empty input; the outer aggregate restores it.
    return stats.agg(
        F.coalesce(F.max("num_rows"), F.lit(0)).alias("properties"), F.max("median").alias("median_price")
    )


def headline_text(row: DataFrame) -> DataFrame:
    """The headline as display text."""
    return row.select(
        F.format_number("properties", 0).alias("properties"),
        F.concat(F.lit("£"), F.format_number("median_price", 0), F.lit(" pcm")).alias("median_price"),
    )


def histogram(df: DataFrame, column: str = "price", bins: int = 40) -> DataFrame:
    """Rows per equal-width bin between the smallest and the largest value; empty bins have no row.

    The largest value belongs to the last bin. If all values are equal there is one bin.
    """
    low = df.agg(F.min(column).cast("double")).scalar()
    high = df.agg(F.max(column).cast("double")).scalar()
    value = F.col(column)
    position = F.floor((value - F.col("_low")) * bins / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0)))
    placed = df.where(value.isNotNull()).select(column, low.alias("_low"), high.alias("_high")).withColumn(
        "bin", F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    return placed.groupBy("bin").agg(
        F.min(F.col("_low") + F.col("bin") * width).alias("bin_start"),
        F.count(F.lit(1)).alias("num_properties"),
    ).orderBy("bin")


_EXACT = "decimal(28,10)"


def round_step(df: DataFrame, column: str = "price", max_bins: int = 40) -> DataFrame:
    """One row: ``step``, the width of bins with round edges over the column's extent, as an exact decimal.

    It is 1, 2 or 5 times a power of ten, the smallest with which at most ``max_bins`` bins that begin at its multiples
    hold all values; 1 if all values are equal. No row without any value. Values have up to 18 digits before the point
    and 10 after it.
    """
    value = F.col(column).cast(_EXACT)
    extent = df.agg(F.min(value).alias("_low"), F.max(value).alias("_high")).where("_low IS NOT NULL")
    steps = ", ".join(f"cast('{m}e{e}' AS {_EXACT})" for e in range(-10, 18) for m in (1, 2, 5))
    # From the begin of the lowest bin to the begin of the highest one.
    span = "(_high - pmod(_high, s)) - (_low - pmod(_low, s))"
    fitting = f"filter(array({steps}), s -> {span} <= s * cast({int(max_bins) - 1} AS decimal(8,0)))"
    return extent.selectExpr(f"IF(_low = _high, cast(1 AS {_EXACT}), get({fitting}, 0)) AS step")


def round_histogram(df: DataFrame, column: str = "price", max_bins: int = 40) -> DataFrame:
    """Rows per bin with round edges: ``bin_start`` and ``bin_end`` as exact decimals; empty bins have no row."""
    value = F.col(column).cast(_EXACT)
    step = round_step(df, column, max_bins).scalar()
    placed = df.where(value.isNotNull()).select(value.alias("_v"), step.alias("_s"))
    placed = placed.selectExpr("_s", f"cast(_v - pmod(_v, _s) AS {_EXACT}) AS bin_start")
    return placed.groupBy("bin_start").agg(
        F.max(F.expr(f"cast(bin_start + _s AS {_EXACT})")).alias("bin_end"), F.count(F.lit(1)).alias("num_rows")
    ).orderBy("bin_start")


def map_points(current: DataFrame, chosen: Sequence[str] = ()) -> DataFrame:
    return filter_optional(current, "area_code", chosen).select(
        "latitude", "longitude", "price", "address", "area_code"
    )
