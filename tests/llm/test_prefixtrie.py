"""The conversation trie against brute force; sums over subtrees on forests of any shape."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import prefixtrie

SCHEMA = "conv_id long, turn int, role string, text string"


def conversations_of(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns, key=lambda t: t[:2])] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c - 20 * int(c / 20))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def slow(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, within in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(within) - 1) * words
    out = []
    for node, within in members.items():
        ends = ",".join(str(c) for c in sorted(within) if len(convs[c]) == len(node))
        out.append((min(within), len(node), min(members[node[:-1]]) if node else None, len(within), children.get(node, 0),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def fast(turns, members, **options):
    return sorted(map(tuple, prefixtrie.prefix_trie(turns, members, **options).collect()), key=repr)


def of_rows(spark, rows, again=False, **options):
    digests = prefixtrie.turn_digests(spark.createDataFrame(rows, SCHEMA).repartition(3))
    conv = F.col("conv_id")
    turns = digests if not again else prefixtrie.rebuilt(
        digests, F.crc32(conv.cast("string").cast("binary")) % 4, conv - conv % 20
    )
    return fast(turns, digests.select("conv_id"), **options)


def some(seed, n=150, spread=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 4 * n), n):
        for turn in range(rng.randrange(1, 7)):
            text = rng.choice(["", " a\tb", "c é d e", None, "f"][:spread])
            rows.append((c, None if turn == 0 and rng.random() < 0.3 else turn, rng.choice(["user", None, "tool"][:spread]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("again,local", [(False, 60), (True, prefixtrie.LOCAL)])
def test_equals_brute_force(spark, again, local):
    rows = some(1)
    convs = conversations_of(rows)
    assert of_rows(spark, rows, again=again, local=local) == slow(rebuilt(convs) if again else convs)


def test_conversations_over_many_partitions(spark):
    rows = some(2, n=40) + [(7000, i, "user", f"t{i % 50}") for i in range(700)] + [
        (7001 + k, i, "user", f"t{i % 50}") for k in range(3) for i in range(120)
    ]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = prefixtrie.placed(prefixtrie.turn_digests(spark.createDataFrame(rows, SCHEMA)))
        ranks = sorted(r[0] for r in placed.where("conv_id = 7000").select("rank").collect())
        assert ranks == list(range(1, 701))
        assert of_rows(spark, rows, local=100) == slow(conversations_of(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_empty_and_turnless(spark):
    assert of_rows(spark, []) == []
    assert of_rows(spark, [(None, 1, "user", "x")]) == []
    rows = [(1, 1, None, None), (2, 1, "", ""), (3, None, "user", "null comes first"), (3, 0, "user", "x"), (None, 1, "a", "b")]
    got = of_rows(spark, rows)
    assert got == slow(conversations_of(rows))
    # of a conversation whose base is absent nothing may be left
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = of_rows(spark, [(lone, 1, "user", "x")], again=True)
    assert got == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_role_and_text_are_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc")]
    assert of_rows(spark, rows) == slow(conversations_of(rows))


def test_repeated_rows_are_turns_of_their_own(spark):
    rows = [(1, 0, "user", "a b")] * 3 + [(2, 0, "user", "a b")]
    assert of_rows(spark, rows) == slow(conversations_of(rows))


def test_clashing_columns(spark):
    rows = [(*r, 5, "x") for r in some(3, n=20)]
    docs = spark.createDataFrame(rows, SCHEMA + ", node int, h1 string")
    digests = prefixtrie.turn_digests(docs)
    assert fast(digests, digests.select("conv_id")) == slow(conversations_of([r[:4] for r in rows]))


def forest(kind, n, rng):
    if kind == "chain":
        return [i - 1 for i in range(n)]
    if kind == "star":
        return [-1] + [0] * (n - 1)
    if kind == "brush":  # a long handle with many children at its end
        return [i - 1 if i < n // 2 else n // 2 - 1 for i in range(n)]
    return [rng.randrange(-1, i) if i and rng.random() < 0.97 else -1 for i in range(n)]


def sums_by_walking(up, values):
    sums = values.copy()
    for i in range(len(up) - 1, -1, -1):
        if up[i] >= 0:
            sums[up[i]] += sums[i]
    return sums


@pytest.mark.parametrize("kind", ["chain", "star", "brush", "any"])
def test_centroid_sums(kind):
    rng = random.Random(4)
    up = np.array(forest(kind, 500, rng), dtype=np.int64)
    values = np.array([[rng.randrange(100), rng.randrange(5)] for _ in up])
    added = np.ones_like(values)
    assert (prefixtrie.centroid_sums(up, values, added) == sums_by_walking(up, values) + 1).all()


@pytest.mark.parametrize("kind", ["chain", "any"])
def test_large_components_are_split_in_spark(spark, kind):
    rng = random.Random(5)
    up = forest(kind, 150, rng)
    values = np.array([[rng.randrange(100), rng.randrange(5)] for _ in up])
    name = lambda i: i.to_bytes(16, "big") if i >= 0 else None
    nodes = spark.createDataFrame(
        [(name(i), name(u), int(a), int(b)) for i, (u, (a, b)) in enumerate(zip(up, values))],
        "node binary, up binary, a long, b long",
    )
    got = {int.from_bytes(r.node, "big"): (r.a, r.b) for r in prefixtrie.subtree_sums(nodes, local=60).collect()}
    assert got == {i: tuple(map(int, s)) for i, s in enumerate(sums_by_walking(up, values))}


def test_digest_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "IDS", 7)
    ends = spark.createDataFrame([(b"n" if i % 3 else b"m", i) for i in range(-50, 400)], "node binary, conv_id long").repartition(5)
    got = {bytes(r.node): r.ends for r in prefixtrie.end_digests(ends).collect()}
    for node, kept in ((b"n", lambda i: i % 3), (b"m", lambda i: not i % 3)):
        ids = ",".join(str(i) for i in range(-50, 400) if kept(i))
        assert got[node] == hashlib.sha256(ids.encode()).hexdigest()
