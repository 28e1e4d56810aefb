"""Nearest by great circle, quality states of batches, and tables of broken pages."""

import math
import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators import quality
from marketlake.operators.greatcircle import EARTH_RADIUS_KM, nearest_great_circle
from marketlake.operators.quality_state import QualityState
from marketlake.sources.broken_tables import extract_any_table, first_table, irregular_share, is_irregular

PLACE = "prop_id int, latitude double, longitude double"


def haversine(a, b):
    (la, lo), (lb, lp) = ((math.radians(x) for x in p) for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("leaf_size,count", [(32, 40), (4, 300)])
def test_great_circle_equals_brute_force(spark, leaf_size, count):
    rng = random.Random(count)
    spot = lambda: (math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180))
    sites = [(i, *spot()) for i in range(count)] + [(1000, 90.0, 0.0), (1001, -90.0, 50.0), (1002, 0.0, 180.0), (1003, None, 1.0)]
    points = [(i, *spot()) for i in range(200)] + [
        (500, 89.9, 170.0), (501, 89.9, -10.0), (502, 0.1, -179.9), (503, 0.1, 539.9), (504, None, 1.0), (505, 95.0, 1.0),
        (506, 1.0, float("nan")), (507, -90.0, 12.0),
    ]
    got = nearest_great_circle(
        spark.createDataFrame(points, PLACE), spark.createDataFrame(sites, PLACE).withColumnRenamed("prop_id", "site_id"),
        "site_id", leaf_size=leaf_size,
    )
    found = {r.prop_id: (r.site_id, r.distance) for r in got.collect()}
    assert len(found) == len(points) and all(found[i] == (None, None) for i in (504, 505, 506))
    for i, lat, lon in points:
        if i not in (504, 505, 506):
            best = min(haversine((lat, lon), s[1:]) for s in sites if s[1] is not None)
            site = next(s for s in sites if s[0] == found[i][0])
            assert found[i][1] == pytest.approx(best, abs=1e-5) and haversine((lat, lon), site[1:]) == pytest.approx(best, abs=1e-5)
    assert found[502][0] == 1002 == found[503][0] and found[507][0] == 1001


def test_great_circle_without_sites_and_with_one_place(spark):
    points = spark.createDataFrame([(1, 10.0, 20.0)], PLACE)
    none = spark.createDataFrame([], PLACE).withColumnRenamed("prop_id", "site_id")
    assert nearest_great_circle(points, none, "site_id").first().site_id is None
    same = spark.createDataFrame([(i, 10.0, 20.0) for i in range(50)], PLACE).withColumnRenamed("prop_id", "site_id")
    row = nearest_great_circle(points, same, "site_id").first()
    assert row.site_id == 0 and row.distance == 0


def rules():
    return [
        quality.row_count(">", 5), quality.is_complete("v"), quality.completeness("v", ">=", 0.5), quality.is_unique("k"),
        quality.values_between("v", 0, 10), quality.values_compare("v", ">", 3),
        quality.share_of("odd", F.col("k") % 2 == 1, "<", 0.6),
    ]


def test_states_of_batches_equal_full_passes(spark, tmp_path):
    rows = [(k, None if k is None or k % 5 == 0 else float(k)) for k in (1, 2, 3, 4, 5, 9, 12, 3, 15, None)]
    batches = [rows[:4], rows[4:7], rows[7:]]
    state, seen = QualityState(str(tmp_path), rules(), buckets=3), []
    for number, batch in enumerate(batches):
        seen += batch
        part = spark.createDataFrame(batch, "k int, v double")
        state.add(part, number)
        if number == 1:
            state.add(part, number)  # a replay counts once
        whole = quality.run_rules(spark.createDataFrame(seen, "k int, v double"), "t", rules())
        assert sorted(map(tuple, state.verdicts(spark, "t").collect())) == sorted(map(tuple, whole.collect()))
    assert state.verdicts(spark, "t").where("rule = 'IsUnique k'").first().metric == 1


def test_rules_without_states_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="mergeable"):
        QualityState(str(tmp_path), [quality.custom_sql("x", "SELECT 1 FROM {primary}", ">", 0)])


ROW = "<tr><td>02 Jan 24</td><td>5.25</td></tr>"
PAGES = {
    "good": (f"<p><table>{ROW}</table>", [["02 Jan 24", "5.25"]], False),
    "open cells": ("<table><tr><td>02 Jan 24<td>5.25</tr></table>", [["02 Jan 24", "5.25"]], True),
    "open rows": ("<TABLE><TR><TD>02 Jan 24</TD><TD>5.25</TD><TR><TD>03 Jan 24</TD><TD>5</TD></TABLE>",
                  [["02 Jan 24", "5.25"], ["03 Jan 24", "5"]], True),
    "open table": (f"<table>{ROW}", [["02 Jan 24", "5.25"]], True),
    "nested": ("<table><tr><td>02 Jan 24</td><td>5.25</td><td><table><tr><td>x</td></tr></table></td></tr></table>",
               [["02 Jan 24", "5.25", "x"]], True),
    "entities": ("<table><tr><td>02&nbsp;Jan&#160;24<td>&nbsp;<b>5.25</b></table>", [["02 Jan 24", "5.25"]], True),
    "none": ("<p>no table", [], False),
    "empty": ("", [], False),
    "only open": ("<table", [], True),
}


def test_first_table_of_broken_pages(spark):
    assert first_table(None) == []
    for name, (html, rows, _) in PAGES.items():
        assert first_table(html) == rows, name
    df = spark.createDataFrame([(n, h) for n, (h, *_) in PAGES.items()] + [("null", None)], "page string, html string")
    odd = {r.page: r.odd for r in df.select("page", is_irregular(F.col("html")).alias("odd")).collect()}
    assert odd == {**{n: o for n, (*_, o) in PAGES.items()}, "null": False}
    share = irregular_share(df).first()
    assert share.num_irregular == sum(odd.values()) and share.share == pytest.approx(share.num_irregular / len(odd))
    got = extract_any_table(df, ["page"], F.lit("2024-01-01").cast("date")).collect()
    want = {(n, i, rows[i][0]) for n, (_, rows, _) in PAGES.items() for i in range(len(rows))}
    assert {(r.page, r.position) for r in got} == {(n, i) for n, i, _ in want}
    assert {r.date for r in got} == {"2024-01-02", "2024-01-03"}


def test_a_very_long_broken_page(spark):
    html = "<table>" + "<tr><td>02 Jan 24<td>5.25" * 20000
    df = spark.createDataFrame([(1, html)], "page int, html string")
    assert extract_any_table(df, ["page"], F.lit("2024-01-01").cast("date")).count() == 20000
