"""Substring dedup against a brute-force version."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import substrings


def slow(rows, words=20):
    """(doc_id, n_words, n_removed, kept words) of every row; rows of a doc_id come in the order of the operator's hash."""
    seen, out = set(), []
    for doc_id, text in rows:
        split = (text or "").encode().split()
        gone = np.zeros(len(split), dtype=bool)
        for i in range(len(split) - words + 1):
            window = tuple(split[i : i + words])
            if window in seen:
                gone[i : i + words] = True
            seen.add(window)
        kept = b" ".join(w for w, g in zip(split, gone) if not g).decode()
        out.append((doc_id, len(split), int(gone.sum()), kept))
    return sorted(out, key=repr)


def fast(docs, **options):
    out = substrings.drop_repeats(docs, **options)
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return sorted(map(tuple, out.select("doc_id", "__llm_n_words", "__llm_n_removed", joined).collect()), key=repr)


def corpus(seed, n=120, vocabulary=40):
    """Passages of 15 to 70 words in several contexts, overlapping, repeated within a document, with odd white space."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "Ünï", "a b", "x y"]
    own = lambda k: [rng.choice(words) for _ in range(k)]
    passages = [own(k) for k in (15, 19, 20, 21, 27, 28, 35, 70)]
    hot = own(23)
    rows = []
    for i in range(n):
        text = own(rng.randrange(0, 30))
        for _ in range(rng.randrange(0, 4)):
            passage = rng.choice(passages)
            a = rng.randrange(0, max(1, len(passage) - 18))
            text += passage[a : a + rng.randrange(18, 71)] + own(rng.randrange(0, 6))
        if rng.random() < 0.4:
            text += hot + own(3)
        rows.append((i, rng.choice([" ", "\n", " \t\x0b"]).join(text)))
    return rows


ODD = [
    (900, None), (901, ""), (902, " \n\t "), (903, "word " * 19), (904, "word " * 20), (905, "word " * 21),
    (906, "p q " * 30000), (907, "p q " * 30), (908, "word " * 20),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed) + ODD
    shuffled = random.Random(seed).sample(rows, len(rows))
    docs = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5)
    assert fast(docs) == slow(rows)


def test_runs_at_the_ends_of_many_partitions(spark):
    rows = corpus(3, n=60, vocabulary=6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert fast(docs) == slow(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_other_lengths(spark):
    rows = corpus(4, n=50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for words, anchor in ((10, 3), (20, 20), (30, 1)):
        assert fast(docs, words=words, anchor=anchor) == slow(rows, words)
    with pytest.raises(ValueError):
        substrings.repeated_windows(docs, words=5, anchor=8)


def test_a_passage_in_every_document_makes_no_pairs(spark):
    """A phrase of 30 words in 3,000 documents: one of them keeps it, and the rows that go on are few a document."""
    rng = random.Random(5)
    phrase = " ".join(f"h{i}" for i in range(30))
    rows = [(i, " ".join(f"{i}x{rng.random()}" for _ in range(12)) + " " + phrase + f" {i} end of {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert fast(docs) == slow(rows)
    found = substrings.repeated_windows(docs)
    assert found.count() < 3000 * 30


def test_null_and_repeated_ids(spark):
    long = " ".join(f"v{i}" for i in range(40))
    rows = [(None, long), (1, long), (1, long), (2, "other " + long + " end"), (2, "short"), (None, None)]
    out = fast(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(d, n): r for d, n, r, _ in out}
    assert got[(None, 40)] == 0  # rows without an id come first
    assert [r for d, n, r, _ in out if d == 1] == [40, 40]  # equal rows are one document
    assert got[(2, 42)] == 40 and got[(2, 1)] == 0 and len(out) == 6


def test_equal_rows_keep_their_first_copy(spark):
    long = " ".join(f"v{i}" for i in range(40))
    docs = spark.createDataFrame([(1, long)] * 5 + [(2, long)], "doc_id long, text string").repartition(4)
    assert [r[2] for r in fast(docs)] == [0] * 5 + [40]


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fast(docs) == [] and substrings.maximal_repeats(docs).count() == 0
    long = " ".join(f"v{i}" for i in range(25))
    rows = [(1, long, 5, "a", 1, 2), (2, long + " x", 6, "b", 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans long, place string, runs int, anchor int")
    out = substrings.drop_repeats(docs)
    assert out.columns == [*docs.columns, "__llm_n_words", "__llm_n_removed"]
    assert sorted(map(tuple, out.collect())) == [(*rows[0], 25, 0), (2, "x", *rows[1][2:], 26, 25)]


def test_maximal_repeats_are_merged(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(22))
    docs = spark.createDataFrame([(1, a + " " + b), (2, f"{b} z {a} y {a}")], "doc_id long, text string")
    found = substrings.maximal_repeats(docs).select("doc_id", "spans").collect()
    assert [(r[0], [tuple(s) for s in r[1]]) for r in found] == [(2, [(0, 22), (23, 50), (74, 50)])]


def test_long_texts_are_split_in_slices(monkeypatch):
    text = " ".join(f"wörd{i}\t" for i in range(3000))
    whole = substrings.word_hashes(text)
    monkeypatch.setattr(substrings, "_SLICE", 100)
    assert len(whole) == 3000 and np.array_equal(whole, substrings.word_hashes(text))
