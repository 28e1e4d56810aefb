"""Latest row per key and keyed merges."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake.operators.dedupe import dedupe_latest
from marketlake.operators.merge import merge_insert_only, merge_upsert
from marketlake.plans import silver
from marketlake.schemas import LANDING, SILVER

RAW = LANDING["properties"]


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


def state(spark, *rows):
    return spark.createDataFrame(rows, SILVER["silver_properties"])


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_latest_scrape_wins_and_first_seen_is_the_earliest(spark):
    out = silver.incoming_properties(raw(
        spark,
        (1, "old", 51.1, -0.1, "2024-01-01T12:00:00", "SW1 1AA"),
        (1, "new", 51.2, -0.2, "2024-01-08T12:00:00.5", "SW2 1AA"),
        (1, "newest", 51.3, -0.3, "2024-01-08T12:00:00.500001", None),
        (2, "other", 51.0, 0.0, "2024-01-03T00:00:00", "SW1A 1AA"),
    ))
    assert as_set(out) == {
        (1, "newest", 51.3, -0.3, None, date(2024, 1, 8), date(2024, 1, 1), None),
        (2, "other", 51.0, 0.0, "SW1A 1AA", date(2024, 1, 3), date(2024, 1, 3), "SW1A"),
    }


def test_ties_and_null_times_do_not_depend_on_row_order(spark):
    rows = [(1, t, a) for t in (None, "b", "a") for a in ("x", "y", None)]
    seen = set()
    for seed in range(5):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, t string, a string").repartition(3)
        seen |= as_set(dedupe_latest(df, ["k"], ["t"]))
    assert seen == {(1, "b", "y")}


def test_null_time_loses_against_any_time_and_empty_input_stays_empty(spark):
    schema = "k int, t timestamp_ntz, a string"
    df = spark.createDataFrame([(1, None, "z"), (1, datetime(2000, 1, 1), "a")], schema)
    assert dedupe_latest(df, ["k"], ["t"]).first()["a"] == "a"
    assert dedupe_latest(spark.createDataFrame([], schema), ["k"], ["t"]).count() == 0


def test_one_price_per_property_and_date(spark):
    df = spark.createDataFrame(
        [
            (1, "2024-01-01", 100, "2024-01-01T10:00:00"), (1, "2024-01-01", 200, "2024-01-01T11:00:00"),
            (1, "2024-01-02", 50, "2024-01-02T10:00:00"), (1, "2024-01-01", 300, "2024-01-01T11:00:00"),
        ],
        LANDING["prices"],
    )
    assert as_set(silver.incoming_prices(df)) == {(1, 300, date(2024, 1, 1)), (1, 50, date(2024, 1, 2))}


def test_overlapping_index_files_give_one_row_per_date(spark):
    df = spark.createDataFrame(
        [("2024-01-02", 470.0, "2024-01-03"), ("2024-01-02", 471.5, "2024-01-10"), ("2024-01-03", 1.0, "2024-01-03")],
        LANDING["spy_prices"],
    )
    assert as_set(silver.incoming_index(df)) == {(date(2024, 1, 2), 471.5), (date(2024, 1, 3), 1.0)}


def test_legacy_tables(spark):
    prices = spark.createDataFrame(
        [
            (1, "2024-01-01", 0, "2024-01-01T12:00:00"), (1, "2024-01-01", 5, "2024-01-01T10:00:00"),
            (2, "2024-01-01", None, "2024-01-01T10:00:00"), (1, "2024-01-02", 7, "2024-01-02T10:00:00"),
        ],
        LANDING["prices"],
    )
    assert as_set(silver.legacy_prices(prices)) == {(1, 5, date(2024, 1, 1)), (1, 7, date(2024, 1, 2))}


OLD, NEW, LATER = date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 15)


def test_upsert_rules(spark):
    target = state(
        spark,
        (1, "a", 1.0, 1.0, "SW1 1AA", NEW, NEW, "SW1"),
        (2, "a", 1.0, 1.0, "SW2 1AA", NEW, NEW, "SW2"),
        (3, "a", 1.0, 1.0, "SW3 1AA", NEW, NEW, "SW3"),
    )
    source = state(
        spark,
        (1, "b", 2.0, 2.0, None, LATER, OLD, None),  # newer, keeps the postcode
        (2, "b", 2.0, 2.0, "SW9 1AA", NEW, OLD, "SW9"),  # same date: no change
        (3, "b", 2.0, 2.0, "SW9 1AA", OLD, OLD, "SW9"),  # older: no change
        (4, "b", 2.0, 2.0, None, OLD, OLD, None),  # unknown: inserted
    )
    assert as_set(silver.merge_properties(target, source)) == {
        (1, "b", 2.0, 2.0, "SW1 1AA", LATER, OLD, "SW1"),
        (2, "a", 1.0, 1.0, "SW2 1AA", NEW, NEW, "SW2"),
        (3, "a", 1.0, 1.0, "SW3 1AA", NEW, NEW, "SW3"),
        (4, "b", 2.0, 2.0, None, OLD, OLD, None),
    }
    late = {r["prop_id"]: r["first_seen"] for r in silver.merge_properties(target, source, late_first_seen=True).collect()}
    assert late == {1: OLD, 2: OLD, 3: OLD, 4: OLD}


def test_upsert_refuses_a_source_with_a_key_twice(spark):
    row = (1, "a", 1.0, 1.0, None, NEW, NEW, None)
    with pytest.raises(Exception, match="duplicate merge key"):
        silver.merge_properties(state(spark), state(spark, row, row)).collect()


def test_upsert_on_composite_keys_without_rules(spark):
    schema = "a int, b string, v int"
    target = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], schema)
    source = spark.createDataFrame([(1, "x", 5), (2, "x", None)], schema)
    out = merge_upsert(target, source, ["a", "b"], lambda s, t: F.lit(True))
    assert as_set(out) == {(1, "x", 5), (1, "y", 2), (2, "x", None)}


def test_upsert_refuses_a_source_key_with_a_null(spark):
    schema = "a int, b string, v int"
    with pytest.raises(Exception, match="merge key with a NULL"):
        merge_upsert(
            spark.createDataFrame([], schema), spark.createDataFrame([(1, None, 6)], schema), ["a", "b"], lambda s, t: F.lit(True)
        ).collect()


def test_rows_that_cannot_be_stored_are_set_aside(spark):
    rows = [
        (1, "2024-01-01", 100, "2024-01-01T10:00:00"), (None, "2024-01-01", 1, "2024-01-01T10:00:00"),
        (2, "08/01/2024", 1, "2024-01-01T10:00:00"), (3, None, 1, None), (4, "2024-01-01", 3_000_000_000, None),
        (5, "2024-01-01", None, None), (6, "2024-01-01", 1, "at noon"),
    ]
    df = spark.createDataFrame(rows, LANDING["prices"])
    assert as_set(silver.incoming_prices(df)) == {(1, 100, date(2024, 1, 1)), (5, None, date(2024, 1, 1))}
    reasons = sorted(r["reason"] for r in silver.rejected(df, "prices").collect())
    assert reasons == ["bad date", "bad price", "bad scraped_at", "no date", "no prop_id"]


def random_state(spark, rng, n):
    keys = rng.sample(range(12), n)
    rows = []
    for k in keys:
        last = date(2024, 1, rng.randint(1, 28))
        rows.append((k, rng.choice("abc"), 1.0, 1.0, rng.choice([None, "SW1 1AA"]), last,
                     date(2024, 1, rng.randint(1, last.day)), None))
    return state(spark, *rows)


def test_merge_laws(spark):
    rng = random.Random(7)
    for _ in range(4):
        t, s = random_state(spark, rng, 8), random_state(spark, rng, 8)
        once = spark.createDataFrame(silver.merge_properties(t, s).collect(), SILVER["silver_properties"])
        assert as_set(silver.merge_properties(once, s)) == as_set(once)
        before = {r["prop_id"]: r for r in t.collect()}
        after = {r["prop_id"]: r for r in once.collect()}
        assert set(after) == set(before) | {r["prop_id"] for r in s.collect()}
        assert all(after[k]["last_seen"] >= r["last_seen"] for k, r in before.items())
        assert all(after[k]["first_seen"] <= r["first_seen"] for k, r in before.items())


def test_insert_only_keeps_stored_rows_and_adds_late_dates(spark):
    schema = SILVER["silver_prices"]
    target = spark.createDataFrame([(1, 100, NEW), (2, 100, NEW)], schema)
    source = spark.createDataFrame([(1, 999, NEW), (1, 90, OLD), (3, 300, LATER), (None, 5, NEW)], schema)
    added = silver.new_prices(target, source)
    assert as_set(added) == {(1, 90, OLD), (3, 300, LATER)}
    assert silver.new_prices(target.unionByName(added), source).count() == 0
    assert merge_insert_only(target, spark.createDataFrame([], schema), ["prop_id", "date"], "date").count() == 0
