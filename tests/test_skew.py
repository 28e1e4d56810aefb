"""One key with a third of all rows: right results, and little of it in any one task."""

import duckdb
import pytest
from pyspark.sql import functions as F

from marketlake.operators.dedupe import dedupe_latest
from marketlake.operators.quality import is_unique, run_rules
from marketlake.plans import gold, serving, silver
from marketlake.session import scratch_path

N = 300_000


@pytest.fixture(scope="module")
def hot(spark):
    """Prices of which a third belongs to property 7, all of them on ten dates."""
    path = scratch_path(spark, "hot")
    spark.range(0, N, 1, 16).selectExpr(
        "if(id % 3 = 0, 7, id % 500) AS prop_id",
        "cast(if(id % 3 = 1, 1000, id * 7919 % 200000) AS int) AS price",
        "date_add(date'2024-01-01', cast(if(id % 2 = 0, 0, id % 10) AS int)) AS date",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 31 % 5000) AS scraped_at",
    ).write.parquet(path)
    return path


def sql(path, text):
    return {tuple(r) for r in duckdb.sql(text.format(t=f"'{path}/*.parquet'")).fetchall()}


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_latest_row_per_key(spark, hot):
    df = spark.read.parquet(hot).select("prop_id", "scraped_at", "price")
    got = rows(dedupe_latest(df, ["prop_id"], ["scraped_at"], ["price"]))
    assert got == sql(hot, """
        SELECT prop_id, scraped_at, price FROM (SELECT *, row_number() OVER (
          PARTITION BY prop_id ORDER BY scraped_at DESC, price DESC) AS rn FROM {t}) WHERE rn = 1""")


def test_dedupe_shuffles_one_row_per_key_and_task(spark, hot):
    df = dedupe_latest(spark.read.parquet(hot), ["prop_id"], ["scraped_at"], ["price"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    moved = []

    def visit(node):
        if node.nodeName() == "Exchange":
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        if "QueryStage" in node.nodeName():
            visit(node.plan())
        kids = node.children()
        for i in range(kids.size()):
            visit(kids.apply(i))

    visit(plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan)
    assert moved and max(moved) <= 16 * 500


def test_fact_and_median(spark, hot):
    prices = spark.read.parquet(hot).select("prop_id", "price", "date")
    props = spark.range(500).selectExpr("id AS prop_id", "concat('SW', id % 25 + 1) AS area_code")
    got = rows(gold.price_fact(prices, props).select("date", "area_code", "avg_price", "median_price", "num_properties"))
    assert got == sql(hot, """
        SELECT date, area, CAST(trunc(avg(price)) AS INT), quantile_disc(price, 0.5), count(*)
        FROM (SELECT date, price, 'SW' || (prop_id % 25 + 1) AS area FROM {t} WHERE prop_id % 25 < 20
              UNION ALL SELECT date, price, 'all' FROM {t}) GROUP BY date, area""")
    assert rows(serving.headline(prices)) == sql(hot, "SELECT count(*), median(price) FROM {t}")


def test_prices_merge_and_uniqueness(spark, hot):
    raw = spark.read.parquet(hot)
    first = silver.incoming_prices(raw.where(F.col("scraped_at") < "2024-01-01 00:30:00"))
    added = silver.new_prices(first, silver.incoming_prices(raw), raw)
    both = first.unionByName(added)
    assert both.count() == len(sql(hot, "SELECT DISTINCT prop_id, date FROM {t}"))
    verdict = run_rules(raw, "t", [is_unique("prop_id")]).first()
    assert (verdict["metric"], verdict["passed"]) == (500.0, False)
