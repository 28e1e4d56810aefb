"""Enrichment and the nearest-neighbour join against brute force."""

import random

import pytest

from marketlake.operators.enrich import batch_rows, fill_from, needs_enrichment
from marketlake.operators.nearest import nearest_join


def test_needs_enrichment(spark):
    target = spark.createDataFrame([(1, "SW1"), (2, None)], "prop_id int, postcode string")
    incoming = spark.createDataFrame([("x", 1), ("x", 2), ("x", 3), ("x", None)], "address string, prop_id int")
    out = needs_enrichment(incoming, target, ["prop_id"], "postcode")
    assert out.columns == ["address", "prop_id"]
    assert {r["prop_id"] for r in out.collect()} == {2, 3, None}


@pytest.mark.parametrize("key", ["id", "cast(id AS string)"])
def test_batches_hold_every_row_once_and_at_most_the_size(spark, key):
    out = batch_rows(spark.range(1037).selectExpr(f"{key} AS id"), 100, "id", buckets=3)
    sizes = [r["count"] for r in out.groupBy("bucket", "batch_no").count().collect()]
    assert sum(sizes) == 1037 and max(sizes) <= 100 and len(sizes) <= 14


def test_fill_from(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, ""), (4, None)], "id int, postcode string")
    found = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, postcode string")
    assert {tuple(r) for r in fill_from(df, found, ["id"], "postcode").collect()} == {
        (1, "x"), (2, "a"), (3, "z"), (4, None)}


def brute_force(points, sites, scale):
    out = {}
    for pid, lat, lng in points:
        if lat is None or lng is None:
            out[pid] = None
        else:
            out[pid] = min(((lat - y) ** 2 + (lng * scale - x * scale) ** 2, i) for i, y, x in sites)[1]
    return out


def scattered(rng):
    return 51 + rng.random(), -1 + 2 * rng.random()


def clustered(rng):
    """A third on one spot, a third in a crowd of a few metres, the rest anywhere."""
    kind = rng.randrange(3)
    if kind == 0:
        return 51.5, -0.1
    if kind == 1:
        return 51.5 + rng.gauss(0, 1e-5), -0.1 + rng.gauss(0, 1e-5)
    return scattered(rng)


def gridded(rng):
    """Exact ties are frequent."""
    return 51 + rng.randrange(12) / 8, rng.randrange(12) / 8


@pytest.mark.parametrize("spread", [scattered, clustered, gridded])
@pytest.mark.parametrize("n", [1, 300])
def test_nearest_equals_brute_force(spark, spread, n):
    rng = random.Random(n)
    sites = [(i, *spread(rng)) for i in range(n)]
    points = [(i, *spread(rng)) for i in range(150)] + [(900, None, 0.0), (901, 60.0, None), (902, -80.0, 170.0)]
    schema = "{} int, latitude double, longitude double"
    out = nearest_join(
        spark.createDataFrame(points, schema.format("pid")), spark.createDataFrame(sites, schema.format("site")),
        "site", x_scale=0.5, leaf_size=8,
    )
    assert {r["pid"]: r["site"] for r in out.collect()} == brute_force(points, sites, 0.5)


def test_nearest_of_nothing(spark):
    schema = "{} int, latitude double, longitude double"
    points = spark.createDataFrame([(1, 51.0, 0.0)], schema.format("pid"))
    out = nearest_join(points, spark.createDataFrame([], schema.format("site")), "site")
    assert [tuple(r) for r in out.collect()] == [(1, 51.0, 0.0, None, None)]


def test_a_crowded_city_is_walked_in_many_tasks(spark):
    """Nine tenths of points and sites lie within a few metres of each other."""
    rng = random.Random(4)

    def somewhere(i):
        if i % 10:
            return 51.5 + rng.random() * 1e-4, -0.1 + rng.random() * 1e-4
        return 50 + 3 * rng.random(), -2 + 4 * rng.random()

    sites = [(i, *somewhere(i)) for i in range(1500)]
    points = [(i, *somewhere(i)) for i in range(400)]
    schema = "{} int, latitude double, longitude double"
    out = nearest_join(
        spark.createDataFrame(points, schema.format("pid")), spark.createDataFrame(sites, schema.format("site")), "site"
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r["pid"]: r["site"] for r in out.collect()} == brute_force(points, sites, 1.0)
