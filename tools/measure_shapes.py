"""Seconds of plan shapes that give the same rows: the plain, pipeline-like one and this library's.

usage: measure_shapes.py [sf_dir]
"""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from marketlake.catalog import inputs  # noqa: E402
from marketlake.operators.snapshot import latest_snapshot  # noqa: E402
from marketlake.plans import gold, silver  # noqa: E402
from marketlake.session import build_session  # noqa: E402


def window_properties(spark: SparkSession, sf: str) -> DataFrame:
    key = Window.partitionBy("prop_id")
    return (
        inputs.raw_properties(spark, sf)
        .withColumn("rn", F.row_number().over(key.orderBy(F.desc("scraped_at"), F.desc("address"))))
        .withColumn("first_seen", F.min("scraped_at").over(key))
        .where("rn = 1")
    )


def window_prices(spark: SparkSession, sf: str) -> DataFrame:
    key = Window.partitionBy("prop_id", "date").orderBy(F.desc("scraped_at"), F.desc("price"))
    return inputs.raw_prices(spark, sf).withColumn("rn", F.row_number().over(key)).where("rn = 1")


def window_snapshot(prices: DataFrame) -> DataFrame:
    newest = F.max("date").over(Window.partitionBy(F.lit(1)))
    return prices.withColumn("newest", newest).where("date = newest").drop("newest")


def shapes(spark: SparkSession, sf: str) -> dict:
    def large():
        return inputs.large_facts(spark, sf)

    def silver_pair():
        return silver.incoming_prices(inputs.raw_prices(spark, sf)), silver.incoming_properties(
            inputs.raw_properties(spark, sf)
        )

    return {
        "latest property: two windows": lambda: window_properties(spark, sf),
        "latest property: one aggregate": lambda: silver.incoming_properties(inputs.raw_properties(spark, sf)),
        "latest price per day: window": lambda: window_prices(spark, sf),
        "latest price per day: one aggregate": lambda: silver.incoming_prices(inputs.raw_prices(spark, sf)),
        "newest date of line items: constant window": lambda: window_snapshot(large()[0]),
        "newest date of line items: subquery": lambda: latest_snapshot(large()[0]),
        "fact of events: approximate median 10,000": lambda: gold.price_fact(*silver_pair(), accuracy=10_000),
        "fact of events: approximate median 1,000,000": lambda: gold.price_fact(*silver_pair(), accuracy=1_000_000),
        "fact of events: exact median": lambda: gold.price_fact(*silver_pair()),
        "fact of line items: approximate median 10,000": lambda: gold.price_fact(*large(), accuracy=10_000),
        "fact of line items: approximate median 1,000,000": lambda: gold.price_fact(*large(), accuracy=1_000_000),
        "fact of line items: exact median": lambda: gold.price_fact(*large()),
    }


def main(sf: str) -> None:
    spark = build_session("shapes", cpus=8, **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name, build in shapes(spark, sf).items():
        seconds = []
        for _ in range(4):
            start = time.monotonic()
            build().write.format("noop").mode("overwrite").save()
            seconds.append(time.monotonic() - start)
        print(f"{name:52s} {statistics.median(seconds[1:]):7.3f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
