"""Nearest neighbours against brute force; the curve and the blocks by their rules."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import ann, queries


def slow(rows, every=20, keep=20):
    rows = {i: np.array(v, dtype=np.float64) for i, v in rows}
    out = {}
    for q in sorted(i for i in rows if i % every == 0):
        scores = sorted((-(rows[q] * v).sum(), i) for i, v in rows.items() if i != q)[:keep]
        out[q] = [(i, -s) for s, i in scores]
    return out


def fast(df):
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")
    ]
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (6, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = ann.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_blocks_are_neighbours_of_one_ordering(spark, partitions):
    rng = np.random.default_rng(6)
    values = rng.normal(size=(333, 5))
    entries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "entry long, v array<double>")
    orderings = ann.Orderings(values, count=3)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.ordering, r.entry): r.number for r in ann.numbered(entries.repartition(4), orderings, 10).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for ordering, keys in enumerate(orderings.keys(values)):
        for place, entry in enumerate(np.lexsort((np.arange(333), keys)).tolist()):
            assert got[(ordering, entry)] == place // 10
    assert len(got) == 3 * 333


def test_no_vector_is_stored_by_ordering(spark, monkeypatch):
    """What the orderings store has a few numbers for each entry; its vector comes to the strips alone."""
    seen, stored = {}, ann.stored
    monkeypatch.setattr(ann, "stored", lambda df, name: seen.setdefault(name, df.columns) and stored(df, name))
    rows = [(i, np.random.default_rng(i).normal(size=4).tolist()) for i in range(200)]
    ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count()
    assert [name for name, columns in seen.items() if "v" in columns] == ["vectors", "entries"]


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = fast(queries.op9_nearest_neighbours(spark, sf)), slow(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        vectors = dict(rows)
        for i, score in found:
            assert abs(score - np.dot(np.array(vectors[q], dtype=np.float64), np.array(vectors[i], dtype=np.float64))) < 1e-12


def test_narrow_windows_suffice_for_clusters(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(25, 16)) * 3
    rows = [(i, (centres[i % 25] + rng.normal(size=16) * 0.05).tolist()) for i in range(2500)]
    chosen = []
    fit = ann.fit_window
    monkeypatch.setattr(ann, "fit_window", lambda *a: chosen.append(fit(*a)) or chosen[-1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(fast(ann.search(df, block=32)), slow(rows)) >= 0.9
    orderings, window = chosen[0]
    assert orderings * (2 * window + 1) * 32 < 2500  # fewer products than brute force


def test_equal_vectors_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    same = [1.0, 2.0, 0.5]
    rows = [(i, same) for i in range(0, 300)] + [(i, rng.normal(size=3).tolist()) for i in range(300, 500)]
    odd = [(1000, None), (1020, [0.0, 0.0, 0.0]), (1040, [1.0, None, 1.0]), (1060, [1.0, float("nan"), 1.0]),
           (1080, [float("inf"), 1.0, 1.0]), (1100, []), (1120, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), rows[400], rows[400]]
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame(rows + odd, schema).withColumn("entry", F.lit("clash")).withColumn("v", F.lit(0))
    rows = [(i, np.array(v, dtype=np.float32)) for i, v in rows]
    got, want = fast(ann.search(df, target=1.0, block=16)), slow(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    got = fast(ann.search(spark.createDataFrame([(0, [1.0]), (3, [2.0]), (4, [-1.0])], schema)))
    assert got == {0: [(3, 2.0), (4, -1.0)]}
    assert fast(ann.search(spark.createDataFrame([], schema))) == {}
    assert fast(ann.search(spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema))) == {}
    assert fast(ann.search(spark.createDataFrame([(20, [1.0])], schema))) == {}


def sampled(monkeypatch):
    seen, brute = [], ann.brute_force
    monkeypatch.setattr(ann, "brute_force", lambda entries, ids, *a: seen.append(ids.tolist()) or brute(entries, ids, *a))
    return seen


def test_the_window_is_fitted_on_about_200_queries(spark, monkeypatch):
    rng = np.random.default_rng(4)
    seen = sampled(monkeypatch)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(10_000, 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert ann.search(df).count() == 500 * 20
    assert 100 < len(seen[0]) <= 400 and all(i % 20 == 0 for i in seen[0])


def test_rare_queries_are_all_sampled_and_found(spark, monkeypatch):
    rng = np.random.default_rng(5)
    seen = sampled(monkeypatch)
    rows = [(7 * i + 1 if (7 * i + 1) % 20 else 1, v) for i, v in enumerate(rng.normal(size=(3000, 24)).tolist())]
    rows = [(i, v) for i, v in rows if i != 1] + [(40, rng.normal(size=24).tolist()), (80, rng.normal(size=24).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = fast(ann.search(df, block=16)), slow(rows)
    assert sorted(seen[0]) == [40, 80] and recall(got, want) >= 0.9


def test_own_entry_is_no_neighbour_that_counts(spark):
    # Each query is best itself; its only other neighbour lies three blocks off in the one ordering.
    entries = spark.createDataFrame(
        [(0, [1.0, 0.0], True), (1, [0.9, 0.0], False), (2, [0.0, 1.0], False), (3, [0.0, 0.5], False)],
        "entry long, v array<double>, asks boolean",
    )
    one = [(0, 0, 1), (2, 0, 2), (3, 0, 3), (1, 0, 4)]
    places = spark.createDataFrame(one, "entry long, ordering int, number int")
    assert ann.fit_window(entries, places, 1, 1, target=0.5) == (1, 3)
    # A second ordering that has them together is worth its blocks; a third one that does, too, is not.
    more = [(e, o, n) for o in (1, 2) for e, n in ((0, 5), (1, 5), (2, 1), (3, 9))]
    places = spark.createDataFrame(one + more, "entry long, ordering int, number int")
    assert ann.fit_window(entries, places, 1, 1, target=0.5) == (2, 0)
