"""Silver rows to gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.areas import listed_or_null
from marketlake.functions.dates import month_name, year_text
from marketlake.operators.medians import grouped_stats, value_counts
from marketlake.operators.snapshot import latest_snapshot
from marketlake.schemas import AREA_CODES, TOTAL_AREA


def price_fact(
    prices: DataFrame,
    props: DataFrame,
    areas: Sequence[str] = AREA_CODES,
    date_col: str = "date",
    total_label: str = TOTAL_AREA,
    accuracy: int | None = None,
) -> DataFrame:
    """Mean, median and number of prices by date and listed area, plus a total row per date.

    The total counts every price, also those of unlisted, unknown or missing properties, so
    it is no rollup of the area rows. Means are truncated to whole numbers. ``props`` holds
    one row per property.

    The median is exact by default: rows are first counted per (date, area, price), which
    shrinks them in the scanning tasks and spreads a hot date or area over its prices. Each
    count then serves its area and the total, so prices are read and joined once. With
    ``accuracy`` the median is ``percentile_approx`` of that accuracy instead.
    """
    facts = prices.select("prop_id", F.col(date_col).alias("date"), "price")
    located = props.where(F.col("area_code").isin(list(areas))).select("prop_id", "area_code")
    keys = ["date", "area_code"]
    total = F.lit(total_label)
    groups = F.when(F.col("area_code").isNull(), F.array(total)).otherwise(F.array(F.col("area_code"), total))
    placed = facts.join(located, "prop_id", "left")
    if accuracy is None:
        counts = value_counts(placed, keys, "price").withColumn("area_code", F.explode(groups))
        found = grouped_stats(counts, keys).withColumnRenamed("median_low", "middle")
    else:
        found = placed.withColumn("area_code", F.explode(groups)).groupBy(*keys).agg(
            F.mean("price").alias("mean"), F.approx_percentile("price", 0.5, accuracy).alias("middle"),
            F.count("*").alias("num_rows"),
        )
    kind = prices.schema["price"].dataType
    stats = found.select(
        *keys, F.col("mean").cast(kind).alias("avg_price"), F.col("middle").cast(kind).alias("median_price"),
        F.col("num_rows").alias("num_properties"),
    )
    return stats.withColumns({"month": month_name(F.col("date")), "year": year_text(F.col("date"))})


def moved_properties(before: DataFrame, after: DataFrame, areas: Sequence[str] = AREA_CODES) -> DataFrame:
    """(prop_id) of properties whose listed area differs between two states of the property table, new ones included."""
    def placed(props: DataFrame, name: str) -> DataFrame:
        return props.select("prop_id", listed_or_null(F.col("area_code"), areas).alias(name))

    both = placed(before, "_old").join(placed(after, "_new"), "prop_id", "full_outer")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("prop_id")


def affected_dates(prices: DataFrame, new_dates: DataFrame, moved: DataFrame) -> DataFrame:
    """(date) of the fact's dates that a delivery changes: those with new prices, and all of a moved property's."""
    touched = prices.join(moved.select("prop_id").distinct(), "prop_id", "left_semi").select("date")
    return new_dates.select("date").union(touched).where(F.col("date").isNotNull()).distinct()


def refresh_fact(prices: DataFrame, props: DataFrame, dates: Sequence, path: str, areas: Sequence[str] = AREA_CODES) -> None:
    """Recompute the fact of some dates and replace their folders of the stored fact; other folders keep their files.

    ``dates`` are at most as many values as there are calendar days; as literals they prune the folders of the prices.
    """
    if not dates:
        return
    fact = price_fact(prices.where(F.col("date").isin(list(dates))), props, areas)
    fact.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date"
    ).parquet(path)


def current_listings(
    prices: DataFrame,
    props: DataFrame,
    areas: Sequence[str] = AREA_CODES,
    date_col: str = "date",
    unlisted: str = "drop",
    dates: DataFrame | None = None,
) -> DataFrame:
    """Listings at the newest price date; those outside the listed areas are dropped or get a NULL area.

    If ``prices`` is not stored but worked out, ``dates`` may hand in a cheaper frame with the
    same newest date, such as the rows before deduplication.
    """
    if unlisted not in ("drop", "null"):
        raise ValueError("unlisted is 'drop' or 'null'")
    newest = latest_snapshot(prices.select("prop_id", "price", date_col), date_col, dates)
    columns = ["prop_id", "address", "postcode", "latitude", "longitude", "area_code"]
    places = props.select(*columns)
    if unlisted == "drop":
        places = places.where(F.col("area_code").isin(list(areas)))
    else:
        places = places.withColumn("area_code", listed_or_null(F.col("area_code"), areas))
    return newest.join(places, "prop_id").select(*columns, "price", date_col)
