"""Line dedup against a brute-force version and its SQL."""

import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import linededup, queries
from marketlake.llm.common import TEXT_KEY

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def slow(rows):
    holders = defaultdict(set)
    order = lambda d: (d is not None, d or 0)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 20:
                holders[key_of(line)].add(order(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keep = [
            line for line in lines
            if not (len(holders[key_of(line)]) >= 3 and order(doc_id) != max(holders[key_of(line)]))
        ]
        digest = hashlib.sha256("\n".join(keep).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(keep), digest))
    return sorted(out, key=repr)


def fast(docs):
    out = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    return sorted(map(tuple, out.select(
        "doc_id", "__llm_n_lines", "__llm_n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    ).collect()), key=repr)


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    pool = ["shared line number %d of the pool" % i for i in range(25)] + ["Ünïcode line é %d ......" % i for i in range(5)]
    pool += ["short line", "", "nineteen characters", "exactly twenty chars", " \t Padded Shared Line Here \x0b"]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool) if rng.random() < 0.5 else "own %d %d and some more" % (i, rng.random() * 1e6)
                 for _ in range(rng.randrange(1, 12))]
        if rng.random() < 0.7:
            lines.insert(rng.randrange(len(lines) + 1), "ONE very common line that most documents hold")
        rows.append((i, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, rows[0][1]), (None, "one very common line that most documents hold\nx")]
    rows += [rows[3], rows[3], (rows[4][0], "another text of an id\nshared line number 1 of the pool")]
    rows.append((503, "one very common line that most documents hold\n" * 30000 + "end"))
    return rows


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_equals_brute_force_however_groups_are_cut(spark, partitions):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("high", F.lit("clash"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert fast(docs) == slow(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def decide(lines, cuts, sizes):
    """Drops of sorted (hash, doc, at) lines in partitions that begin at ``cuts`` and batches of ``sizes`` rows."""
    drops, pending, docs = set(), [], defaultdict(set)
    for a, b in zip([0, *cuts], [*cuts, len(lines)]):
        part = lines[a:b]
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([h for h, _, _ in c], pa.int64()), pa.array([0] * len(c), pa.int64()),
                 pa.array([d for _, d, _ in c], pa.int64()), pa.array([0] * len(c), pa.int64()),
                 pa.array([x for _, _, x in c], pa.int64())], names=["high", "low", "doc_id", TEXT_KEY, "at"])
            for c in (part[i : i + sizes] for i in range(0, len(part), sizes))
        ]
        for out in linededup._decide(3)(iter(batches)):
            for r in out.to_pylist():
                if r["kind"] == 0:
                    drops.add((r["high"], r["doc_id"], r["at"]))
                elif r["kind"] == 1:
                    pending.append((r["high"], r["doc_id"], r["at"]))
                else:
                    docs[r["high"]].add(r["doc_id"])
    return drops | {p for p in pending if len(docs[p[0]]) >= 3 and p[1] < max(docs[p[0]])}


def test_streamed_decisions_for_any_cuts_and_batches():
    for seed in range(150):
        rng = random.Random(seed)
        lines = sorted(
            {(rng.randrange(6), rng.randrange(6), rng.randrange(4)) for _ in range(rng.randrange(1, 60))},
            key=lambda x: (x[0], -x[1], x[2]),
        )
        cuts = sorted(rng.sample(range(len(lines) + 1), min(rng.randrange(5), len(lines))))
        want = {
            (h, d, x) for h, d, x in lines
            if len({b for a, b, _ in lines if a == h}) >= 3 and d < max(b for a, b, _ in lines if a == h)
        }
        assert decide(lines, cuts, rng.choice([1, 2, 3, 7, 100])) == want, seed


def test_bitmaps_hold_no_text(spark):
    docs = spark.createDataFrame([(i, "a line that three documents hold\nown %d" % i) for i in range(3)], "doc_id long, text string")
    maps = linededup.keep_bitmaps(docs)
    assert maps.columns == ["doc_id", TEXT_KEY, "n_lines", "n_dropped", "keep_bitmap"]
    assert {r.doc_id: r.n_dropped for r in maps.collect()} == {0: 1, 1: 1, 2: 0}


def test_stage_keeps_columns_and_follows_the_length(spark):
    rows = [(i, "the same long line in all\nown %d" % i, 30 + i, "x") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, at string")
    out = linededup.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(0, "own 0", 5, "x"), (1, "own 1", 5, "x"), (2, rows[2][1], 31, "x")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fast(docs) == []


def test_query_against_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = queries.op3_line_dedup(spark, sf).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    want = con.execute(
        f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({queries.ORACLE['op3_line_dedup']})"
    ).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
