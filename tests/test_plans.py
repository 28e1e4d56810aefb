"""Shapes of physical plans that matter at scale."""

from pyspark.sql import functions as F

from marketlake.operators.dedupe import dedupe_latest
from marketlake.operators.merge import merge_upsert
from marketlake.operators.snapshot import latest_snapshot
from marketlake.plans import gold, silver
from marketlake.schemas import SILVER
from marketlake.session import scratch_path
from marketlake.streaming.state import AppendTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    text = plan_of(df)
    return text[: text.index("Initial Plan")] if "Initial Plan" in text else text


def stored(spark):
    path = scratch_path(spark, "plans")
    spark.range(2000).selectExpr(
        "id % 100 AS prop_id", "cast(id AS int) AS price", "date_add(date'2024-01-01', cast(id % 5 AS int)) AS date"
    ).write.partitionBy("date").parquet(f"{path}/prices")
    spark.range(100).selectExpr(
        "id AS prop_id", "concat('SW', id % 25 + 1) AS area_code", "'a' AS address", "'p' AS postcode",
        "1D AS latitude", "1D AS longitude",
    ).write.parquet(f"{path}/props")
    return spark.read.parquet(f"{path}/prices"), spark.read.parquet(f"{path}/props")


def test_dedupe_aggregates_before_its_only_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS t", "id AS v")
    text = plan_of(dedupe_latest(df, ["k"], ["t"], first_seen=("t", "first")))
    assert text.count("Exchange") == 1 and "partial_max" in text and "Window" not in text


def test_snapshot_uses_a_subquery_on_the_partition_column(spark):
    prices, _ = stored(spark)
    text = plan_of(latest_snapshot(prices))
    assert "Window" not in text
    assert "PartitionFilters: [isnotnull(date" in text and "Subquery" in text


def test_fact_reads_prices_once_and_only_needed_columns(spark):
    prices, props = stored(spark)
    text = final_plan_of(gold.price_fact(prices, props))
    assert text.count("FileScan") == 2 and "ReusedExchange" in text
    assert "ReadSchema: struct<prop_id:bigint,price:int>" in text
    assert "ReadSchema: struct<prop_id:bigint,area_code:string>" in text
    assert "partial_count" in text


def test_upsert_checks_uniqueness_without_a_shuffle_of_its_own(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path = scratch_path(spark, "upsert")
        spark.range(10).selectExpr("if(id = 3, NULL, id) AS k", "id AS v").write.parquet(path)
        target, source = (spark.read.parquet(path) for _ in range(2))  # keys may be NULL by their type
        text = plan_of(merge_upsert(target, source, ["k"], lambda s, t: s("v") > t("v")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" in text and "Union" not in text
    assert text.count("Exchange hashpartitioning") == 2 and text.count("FileScan") == 2


def test_insert_only_merge_bounds_the_stored_dates(spark):
    prices, _ = stored(spark)
    table = AppendTable(scratch_path(spark, "prices"), SILVER["silver_prices"], "date")
    table.append(prices.dropDuplicates(["prop_id", "date"]))
    batch = spark.createDataFrame([(1, 5, None)], SILVER["silver_prices"]).withColumn(
        "date", F.lit("2024-01-05").cast("date"))
    text = plan_of(silver.new_prices(table.read(spark), batch))
    scan = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scan) >= 1 and any("PartitionFilters: [isnotnull(date" in s and "Subquery" in s for s in scan)
