"""Gold tables and the frames served from them."""

import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from marketlake.functions import area_code
from marketlake.operators import filters
from marketlake.operators.medians import grouped_stats, value_counts
from marketlake.operators.snapshot import latest_snapshot
from marketlake.plans import gold, serving
from marketlake.schemas import reference_schema
from marketlake.sources.series import shape_close_series
from marketlake.sources.static import area_dim

D1, D2 = date(2024, 1, 1), date(2024, 2, 5)


@pytest.fixture(scope="module")
def prices(spark):
    rows = [
        (1, 1000, D1), (2, 2001, D1), (3, 500, D1), (4, 700, D1), (9, 50, D1),
        (1, 1100, D2), (2, 2000, D2), (3, 400, D2), (5, 900, D2), (6, None, D2),
    ]
    return spark.createDataFrame(rows, "prop_id bigint, price int, date date")


@pytest.fixture(scope="module")
def props(spark):
    rows = [(1, "SW1"), (2, "SW1"), (3, "SW21"), (4, None), (5, "SW2"), (6, "SW2")]
    return spark.createDataFrame(rows, "prop_id bigint, area_code string").select(
        "prop_id", F.concat(F.lit("home "), "prop_id").alias("address"), F.lit("p").alias("postcode"),
        F.lit(51.45678912).alias("latitude"), F.lit(-0.1).alias("longitude"), "area_code",
    )


def fact_rows(df):
    return {(r["date"], r["area_code"]): (r["avg_price"], r["median_price"], r["num_properties"]) for r in df.collect()}


@pytest.mark.parametrize("accuracy", [None, 10000])
def test_fact(prices, props, accuracy):
    fact = gold.price_fact(prices, props, accuracy=accuracy)
    assert fact_rows(fact) == {
        (D1, "SW1"): (1500, 1000, 2),
        # Total: also the unlisted, the area-less and the unknown property.
        (D1, "all"): (850, 700, 5),
        (D2, "SW1"): (1550, 1100, 2),
        (D2, "SW2"): (900, 900, 2),
        (D2, "all"): (1100, 900, 5),
    }
    row = fact.where(F.col("date") == F.lit(D2)).first()
    assert (row["month"], row["year"]) == ("February", "2024")


def test_mean_is_truncated_towards_zero(spark, props):
    prices = spark.createDataFrame([(1, -1, D1), (2, -2, D1)], "prop_id bigint, price int, date date")
    assert fact_rows(gold.price_fact(prices, props))[(D1, "SW1")] == (-1, -2, 2)


def test_grouped_stats_equal_the_exact_aggregates(spark):
    rng = random.Random(3)
    rows = []
    for g in ("a", "b", None):
        for _ in range(rng.choice([1, 2, 40, 41])):
            rows.append((g, rng.choice([None, rng.randint(-(2**31), 2**31 - 1), rng.randint(1000, 1030)])))
    rows += [("nulls", None)] * 3 + [("hot", 7)] * 500 + [("hot", 8)] * 500
    df = spark.createDataFrame(rows, "g string, v int")
    got = {r["g"]: r.asDict() for r in grouped_stats(value_counts(df, ["g"], "v"), ["g"]).collect()}
    for g in {r[0] for r in rows}:
        values = sorted(v for k, v in rows if k == g and v is not None)
        assert got[g]["num_rows"] == sum(k == g for k, _ in rows)
        if not values:
            assert got[g]["median"] is None and got[g]["median_low"] is None and got[g]["mean"] is None
            continue
        assert got[g]["median"] == statistics.median(values)
        assert got[g]["median_low"] == statistics.median_low(values)
        assert got[g]["mean"] == pytest.approx(statistics.fmean(values))


def test_current_listings(prices, props):
    listed = gold.current_listings(prices, props)
    assert {(r["prop_id"], r["area_code"], r["price"]) for r in listed.collect()} == {
        (1, "SW1", 1100), (2, "SW1", 2000), (5, "SW2", 900), (6, "SW2", None),
    }
    everyone = gold.current_listings(prices, props, unlisted="null")
    assert {(r["prop_id"], r["area_code"]) for r in everyone.collect()} == {
        (1, "SW1"), (2, "SW1"), (3, None), (5, "SW2"), (6, "SW2"),
    }
    narrow = reference_schema(listed, "gold_current_properties")
    assert narrow.schema.simpleString().startswith("struct<prop_id:int,address:string,postcode:string,latitude:float")
    assert abs(narrow.first()["latitude"] - 51.45679092) < 1e-8


def test_snapshot_of_nothing_and_of_unlisted_only(spark, prices, props):
    assert latest_snapshot(prices.limit(0)).count() == 0
    late = spark.createDataFrame([(3, 1, date(2025, 1, 1))], "prop_id bigint, price int, date date")
    assert gold.current_listings(prices.unionByName(late), props).count() == 0


def test_area_codes(spark):
    df = spark.createDataFrame([("SW1A 1AA",), ("SW9",), ("EC1A 1BB",), (None,), ("",), (" SW1 1AA",), ("lower",)],
                               "p string")
    got = df.select(area_code(F.col("p")), area_code(F.col("p"), normalise=True)).collect()
    assert [tuple(r) for r in got] == [
        ("SW1A", "SW1"), ("SW9", "SW9"), ("EC1A", "EC1"), (None, None), ("", None), ("", None), ("lower", None),
    ]


def test_dimension(spark):
    rows = {r["area_code"]: r["district"] for r in area_dim(spark).collect()}
    assert len(rows) == 21 and rows["all"] == "All districts" and rows["SW5"] == "Earl's Court"


def test_served_frames(spark, prices, props):
    fact, current = gold.price_fact(prices, props), gold.current_listings(prices, props)
    summary = serving.area_summary(fact, area_dim(spark))
    assert [tuple(r) for r in summary.collect()] == [
        ("SW1", "Westminster", 1550, 1100, 2), ("SW2", "Brixton", 900, 900, 2),
    ]
    assert [r[0] for r in serving.area_options(fact).collect()] == ["SW1", "SW2"]
    trend = serving.trend(fact, ["SW1", "SW2"]).collect()
    assert [tuple(r) for r in trend] == [(D1, 1000.0, 2), (D2, 1000.0, 4)]
    assert serving.trend(fact, []).count() == 0
    assert [tuple(r) for r in serving.trend(fact, serving.default_areas(fact, 1)).collect()] == [
        (D1, 1000.0, 2), (D2, 1100.0, 2)]
    assert [r["avg_price"] for r in serving.price_lines(fact, ["SW1"]).collect()] == [1500, 1550]
    assert tuple(serving.headline(current).first()) == (4, 1100.0)
    assert tuple(serving.headline(current, ["SW1"]).first()) == (2, 1550.0)
    assert tuple(serving.headline(current, ["SW20"]).first()) == (0, None)
    assert serving.headline_text(serving.headline(current, ["SW1"])).first()["median_price"] == "£1,550 pcm"
    assert serving.last_updated(current).first()[0] == D2
    assert serving.map_points(current, ["SW2"]).columns == ["latitude", "longitude", "price", "address", "area_code"]


def test_default_areas_are_first_in_text_order(spark):
    fact = spark.createDataFrame([(f"SW{i}",) for i in range(1, 21)] + [("all",)], "area_code string")
    assert [r[0] for r in serving.default_areas(fact).collect()] == ["SW1", "SW10", "SW11", "SW12", "SW13"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 39, 40, 40)], "price int")
    assert {r["bin"]: r["num_properties"] for r in serving.histogram(df).collect()} == {0: 1, 1: 1, 39: 3}
    same = spark.createDataFrame([(5,), (5,)], "price int")
    assert [tuple(r) for r in serving.histogram(same).collect()] == [(0, 5.0, 2)]
    assert serving.histogram(same.limit(0)).count() == 0


def test_selections(spark, props):
    assert filters.filter_optional(props, "area_code", []).count() == 6
    assert filters.filter_strict(props, "area_code", []).count() == 0
    assert filters.filter_strict(props, "area_code", ["SW1"]).count() == 2
    chosen = spark.createDataFrame([("SW2",), ("SW2",)], "area_code string")
    assert filters.filter_by_frame(props, "area_code", chosen).count() == 2


def test_close_series(spark):
    raw = spark.createDataFrame(
        [(date(2024, 1, 5), 470.126), (date(2024, 1, 10), 471.0), (date(2024, 1, 3), 1.0)], "Date date, Close double"
    )
    out = shape_close_series(raw, date(2024, 1, 10), days=7)
    assert {tuple(r) for r in out.collect()} == {
        ("2024-01-05", 470.13, "2024-01-10"), ("2024-01-10", 471.0, "2024-01-10"),
    }
