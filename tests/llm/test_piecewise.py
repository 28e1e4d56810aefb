"""Piecewise fingerprints and successors against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marketlake.llm import piecewise, queries

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def slow_rolling(data):
    out = []
    for i in range(len(data)):
        h = sum((data[i - k] + 1) * pow(0x9E3779B1, k + 1) for k in range(min(7, i + 1))) % 2**32
        h = (h ^ h >> 15) * 0x85EBCA6B % 2**32
        out.append(h ^ h >> 13)
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def slow_likeness(a, b):
    if a == b:
        return 1.0
    prints = []
    for text in (a, b):
        block, *signatures = text.split(":")
        prints.append([(int(block) << i, s, i >= len(signatures) - 2) for i, s in enumerate(signatures)])
    like = lambda x, y: 1 - distance(x, y) / max(len(x), len(y)) if x or y else 1.0
    pairs = [(x, y, v and w) for n, x, v in prints[0] for m, y, w in prints[1] if n == m]
    whole = [p for p in pairs if p[2]]
    return max((like(x, y) for x, y, _ in whole or pairs), default=0.0)


def slow(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        k = len(text) // 4
        changed = text[: len(text) - k] + following[:k]
        own, other, nxt = (piecewise.fingerprint(t) for t in (text, changed, following))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other,
                    round(slow_likeness(own, other), 9), round(slow_likeness(own, nxt), 9)))
    return sorted(out, key=repr)


def fast(docs):
    out = piecewise.with_successors(docs)
    assert out.columns == COLUMNS
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in out.collect()), key=repr)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeföü日") for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 80, 900]))) for _ in range(n)]


def test_rolling_hash_across_slices(monkeypatch):
    monkeypatch.setattr(piecewise, "_SLICE", 11)
    data = texts(5)[-1].encode()[:200] + b"tail"
    assert piecewise.rolling(data).tolist() == slow_rolling(data)


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_equals_brute_force_however_it_is_cut(spark, partitions):
    rows = [(i * 7 - 40, t) for i, t in enumerate(texts(45))] + [(1000, None), (1001, ""), (None, "no id " * 30)]
    rows.append((1002, "long " * 100000))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit("clash"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert fast(docs) == slow(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_ids_and_a_single_row(spark):
    schema = "doc_id long, text string"
    rows = [(1, "b" * 50), (1, "b" * 50), (1, "other text"), (2, "x")]
    assert len(fast(spark.createDataFrame(rows, schema))) == 4
    assert fast(spark.createDataFrame([(5, "only one row here")], schema)) == slow([(5, "only one row here")])
    assert fast(spark.createDataFrame([], schema)) == []


def test_edits_stay_near_and_others_do_not():
    near, far = [], []
    long = [t for t in texts(120, seed=3) if len(t) > 1500]
    for a, b in zip(long, long[1:]):
        prints = [piecewise.fingerprint(t) for t in (a, piecewise.edited(a, b), b)]
        near.append(slow_likeness(prints[0], prints[1]))
        far.append(slow_likeness(prints[0], prints[2]))
        assert max(map(len, prints[0].split(":"))) <= 64
    assert sum(near) / len(near) > 0.65 and max(far) < 0.35 and min(near) > 0.4


def phrases(seed, repeats, rng=random):
    """A phrase repeated with small changes: triggers that the phrase holds come far more often than its length implies."""
    rng = random.Random(seed)
    phrase = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(9))
    return " ".join(phrase + rng.choice(["", "", f" {rng.randrange(10**6)}"]) for _ in range(repeats))


def test_the_end_of_a_repetitive_text_counts():
    """An edit of the last quarter shows, however many chunks come before it."""
    met = 0
    for seed in range(60):
        text, other = phrases(seed, 350), phrases(seed + 1000, 350)
        own = piecewise.fingerprint(text)
        met += own.count(":") > 2
        changed = piecewise.fingerprint(piecewise.edited(text, other))
        assert slow_likeness(own, changed) < 0.95
        block, *signatures = own.split(":")
        data = text.encode()
        hashes = piecewise.rolling(data)
        for i in (-2, -1):  # these have a digit for each chunk
            size = int(block) << (len(signatures) + i)
            triggers = int((hashes % size == size - 1).sum())
            assert len(signatures[i]) in (triggers, triggers + 1)
    assert met >= 5


def test_no_text_passes_a_single_partition(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts(30))], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = piecewise.with_successors(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = plan.split("Exchange SinglePartition")[1:]
    assert parts and all("text#" not in p.split("Scan parquet")[0] for p in parts)


def test_query_keeps_every_document(spark):
    rows = queries.op6_document_fingerprints(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(docs[r.doc_id], r.fingerprint) == r.fingerprint
