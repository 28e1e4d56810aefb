"""Hard negatives against brute force; bounds and pruning by their rules."""

import math
import random

import numpy as np
import pytest

from marketlake.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, every=50, positives=5, keep=3):
    usable = {}
    for vec_id, v, label in rows:
        if vec_id is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        usable[vec_id] = min(usable.get(vec_id, (label, q)), (label, q))
    out = []
    for a, (label, q) in usable.items():
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, p)), i, other) for i, (other, p) in usable.items() if i != a)
        for s, i, _ in [x for x in scores if x[2] == label][:positives]:
            near = [x for x in scores if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:keep]
            out += [(a, i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(near)]
    return sorted(out)


def vectors(seed=1, n=900, dims=8, clusters=12, labels=4):
    """Clustered vectors, a third of them equal, ids in any order."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    rows = []
    for i in range(n):
        c = int(rng.integers(clusters))
        v = centres[c] + 0.15 * rng.normal(size=dims)
        if rng.random() < 0.33:
            v = centres[0]
        rows.append((int(i), [float(np.float32(x)) for x in v], int(rng.integers(labels))))
    random.Random(seed).shuffle(rows)
    return rows


def fast(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, hardneg.mine(docs, **options).collect()))


@pytest.mark.parametrize("active,block", [(50_000, 1024), (4, 16)])
def test_equals_brute_force(spark, active, block):
    rows = vectors()
    got = fast(spark, rows, active=active, block=block)
    assert got == slow(rows) and len({r[0] for r in got}) > 10


def test_odd_rows_take_no_part(spark):
    rows = vectors(2, n=200)
    odd = [
        (1000, None, 1), (1050, [1.0] * 8, None), (None, [1.0] * 8, 1), (1100, [1.0, None] * 4, 1), (1150, [], 1),
        (1200, [float("nan")] * 8, 1), (1250, [float("inf")] * 8, 2), (1300, [0.0] * 8, 1), (1350, [0.0] * 8, 2),
        (50, [9.0] * 8, 0), (50, [9.0] * 8, 3),
    ]
    longer = [(1400, [1.0] * 9, 1)]
    assert fast(spark, rows + odd + longer) == slow(rows + odd)


def test_negative_scores_and_ties(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.5, 0.5], 0), (3, [0.4, 0.0], 1), (4, [0.4, 1.0], 1),
            (5, [0.4, -1.0], 1), (6, [0.4, 3.0], 1), (7, [-0.8, 0.0], 1), (8, [0.0, 1.0], 0), (9, [0.0, -1.0], 1)]
    got = fast(spark, rows, block=2)
    assert got == slow(rows)
    assert [r[3] for r in got if r[1] == 2] == [3, 4, 5]  # four equal scores, the smallest ids first
    assert [(r[1], r[3]) for r in got if r[4] == 0] == [(8, 9)]  # a score of zero admits a zero; negative ones nothing


def test_few_or_no_partners(spark):
    assert fast(spark, []) == []
    assert fast(spark, [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 1)]) == []  # no anchor
    assert fast(spark, [(50, [1.0, 0.0], 0)]) == []
    rows = [(50, [1.0, 0.0], 0), (51, [1.0, 0.1], 0), (52, [0.9, 0.1], 1)]
    assert fast(spark, rows) == slow(rows) != []


def test_clashing_columns(spark):
    rows = [(*r, 1, 2.0) for r in vectors(3, n=120)]
    docs = spark.createDataFrame(rows, SCHEMA + ", score int, rank double")
    assert sorted(map(tuple, hardneg.mine(docs).collect())) == slow([r[:3] for r in rows])


def test_bounds_hold_every_product():
    rng = np.random.default_rng(4)
    a, box = rng.integers(-300, 300, (20, 6)), rng.integers(-300, 300, (50, 6))
    least, most = hardneg.bounds(a, box.min(axis=0)[None], box.max(axis=0)[None])
    scores = hardneg.products(a, box)
    assert (scores >= least).all() and (scores <= most).all()
    corner = np.where(a[0] > 0, box.max(axis=0), box.min(axis=0))
    assert hardneg.products(a[:1], corner[None])[0, 0] == most[0, 0]


def test_products_are_exact_or_an_error():
    a, b = np.array([[(1 << 28) + 1, 1]]), np.array([[(1 << 28) + 3, 1]])
    assert int(hardneg.products(a, b)[0, 0]) == ((1 << 28) + 1) * ((1 << 28) + 3) + 1
    with pytest.raises(OverflowError):
        hardneg.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_zone_maps_spare_blocks_of_other_clusters(spark):
    """On separated clusters the anchors of one group must read a small part of the blocks."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(4000):
        v = np.full(16, 0.05)
        v[i % 16] = 4.0
        rows.append((i, (v + 0.01 * rng.normal(size=16)).tolist(), (i % 16) // 2))
    blocks = hardneg.curve_blocks(hardneg.quantised(spark.createDataFrame(rows, SCHEMA), 256), 50, 32)
    first = blocks.where("asks > 0").orderBy("part").limit(1).mapInArrow(
        hardneg._anchors(50, 5), "part int, anchor_id long, label long, q array<long>, low array<long>, high array<long>"
    ).selectExpr("0 AS group", "anchor_id", "label", "q", "low", "high")
    from marketlake.llm.common import stored

    needed = hardneg.needed_blocks(stored(first, "one"), blocks, 1, same=True).count()
    assert 0 < needed < blocks.count() / 4
