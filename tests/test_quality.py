"""Rules, expectations and gates."""

import pytest
from pyspark.sql import functions as F

from marketlake.operators import quality as q


def verdicts(df, *rules):
    return {r["rule"]: (r["metric"], r["passed"]) for r in q.run_rules(df, "t", list(rules)).collect()}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, 100, "SW1"), (2, 50000, "SW2"), (2, None, None), (None, 500, "N1")], "id int, price int, area_code string"
    )


def test_rules(table):
    got = verdicts(
        table,
        q.row_count(">", 3), q.row_count(">", 4), q.is_complete("id"), q.is_unique("id"), q.is_unique("price"),
        q.completeness("price", ">=", 0.75), q.completeness("price", ">=", 0.76),
        q.values_between("price", 100, 50000), q.values_compare("price", ">", 99),
        q.custom_sql("free", "SELECT count_if(area_code LIKE 'SW%') / count(*) FROM {primary}", "<", 0.6),
    )
    assert got == {
        "RowCount > 3": (4.0, True), "RowCount > 4": (4.0, False), "IsComplete id": (1.0, False),
        "IsUnique id": (1.0, False), "IsUnique price": (0.0, True),
        "Completeness price >= 0.75": (0.75, True), "Completeness price >= 0.76": (0.75, False),
        # Open range: both ends and the NULL violate.
        "ColumnValues price between 100 and 50000": (3.0, False), "ColumnValues price > 99": (1.0, False),
        "free": (0.5, True),
    }
    closed = q.values_between("price", 100, 50000, inclusive=True)
    assert verdicts(table.where("price is not null"), closed)[closed.name] == (0.0, True)


def test_empty_table_fails_on_null_metrics(spark):
    empty = spark.createDataFrame([], "id int, area_code string")
    got = verdicts(
        empty, q.row_count(">", 0), q.completeness("id", ">=", 0.0), q.is_complete("id"), q.is_unique("id"),
        q.custom_sql("free", "SELECT try_divide(count_if(id > 0), count(*)) FROM {primary}", "<", 2),
    )
    assert got == {
        "RowCount > 0": (0.0, False), "Completeness id >= 0": (None, False), "IsComplete id": (0.0, True),
        "IsUnique id": (0.0, True), "free": (None, False),
    }


@pytest.mark.parametrize("outside,passed", [(1, False), (0, True)])
def test_share_outside_south_west_is_strict(spark, outside, passed):
    codes = ["N1"] * outside + ["SW1"] * (10 - outside)
    df = spark.createDataFrame([(c,) for c in codes], "area_code string")
    rule = [r for r in q.rulesets()["silver_properties"] if r.name.startswith("share")]
    assert verdicts(df, *rule)["share outside SW < 0.1"][1] is passed


def test_rulesets_cover_every_table(spark):
    sizes = {t: len(r) for t, r in q.rulesets().items()}
    assert sizes == {
        "silver_properties": 8, "silver_prices": 5, "silver_spy_prices": 5, "gold_current_properties": 5,
        "gold_property_fact": 5,
    }


def test_plain_rules_share_one_aggregate(spark, table):
    plan = q.run_rules(table, "t", [q.row_count(">", 0), q.is_complete("id"), q.completeness("price", ">=", 0.1)])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 1


def test_check_rules(table):
    q.check_rules(q.run_rules(table, "t", [q.row_count(">", 0)]))
    with pytest.raises(q.QualityFailure, match="RowCount > 9"):
        q.check_rules(q.run_rules(table, "t", [q.row_count(">", 9)]))


def test_expect_keeps_and_expect_or_drop_drops(table):
    kept, seen = q.expect(table, {"has_id": F.col("id").isNotNull(), "cheap": F.col("price") < 1000}, "watch")
    assert kept.count() == 4 and seen.get == {"has_id": 1, "cheap": 2}
    left, dropped = q.expect_or_drop(table, "positive", F.col("price") > 100)
    assert left.count() == 2 and dropped.get == {"positive": 2}
    rows = q.expectation_counts(table, {"has_id": F.col("id").isNotNull()}).collect()
    assert [tuple(r) for r in rows] == [("has_id", 1, 4)]


def test_gate_reports_all_groups_but_names_few(spark):
    rates = spark.range(100).selectExpr("id", "10L AS total", "id AS failures", "id / 100 AS rate")
    with pytest.raises(q.QualityFailure, match=r"in 89 group\(s\)"):
        q.fail_if_rate(rates, "bad", 0.1)
    assert q.fail_if_rate(rates, "bad", 0.99) == 99


def test_gate_on_empty_groups(spark):
    rates = spark.createDataFrame([(1, 0, 0, None)], "id int, total bigint, failures bigint, rate double")
    assert q.fail_if_rate(rates, "bad", 0.1) == 0
    with pytest.raises(q.QualityFailure):
        q.fail_if_rate(rates, "bad", 0.1, empty_message="nothing")
