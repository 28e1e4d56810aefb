"""SimHash near-duplicate groups against a brute-force version."""

import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from marketlake.llm import simhash
from marketlake.llm.common import connected


def slow_print(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            tokens, word = tokens + [word] * bool(word), ""
        else:
            word += c
    if not tokens:
        return 0
    grams = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, max_bits=2):
    prints = [slow_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= max_bits and group[i] != group[j]:
            group = [group[i] if g == group[j] else g for g in group]
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [d for (d, _), g in zip(rows, group) if g == group[k] and d is not None]
        out.append((doc_id, prints[k], min(ids, default=None)))
    return sorted(out, key=repr)


def near_copies(seed=3):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    rows = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 400]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return rows


def as_rows(df):
    return sorted(
        ((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in df.collect()), key=repr
    )


def test_groups_equal_brute_force(spark):
    texts = near_copies() + ["", None, "  \n", "One", "one", "a B", "É é", "x\x0by\x1cz", "long " * 30000]
    rows = list(enumerate(texts)) + [(None, "alone without id"), (3, texts[3]), (3, "other text of id 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash"))
    assert as_rows(simhash.near_duplicate_groups(docs.repartition(5))) == slow_groups(rows)


def test_tables_find_every_pair_of_up_to_two_bits(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(30)} | {0, 2**64 - 1, 1 << 63}
    for v in list(values):
        values |= {v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(20)}
    values |= {7 ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a, 64, 5)}
    signed = [v - 2**64 if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long")).collect()
    pairs = [tuple(sorted(p)) for p in found]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {
        tuple(sorted((a, b))) for a, b in itertools.combinations(signed, 2)
        if ((a ^ b) % 2**64).bit_count() <= 2
    }


def test_more_bits_than_the_tables_serve_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fingerprint long"), max_bits=3)


def test_one_row_of_each_group_stays_with_its_columns(spark):
    text = " ".join("w%d" % i for i in range(200))
    rows = [(5, text, "a"), (2, text, "b"), (2, text, "b"), (9, "quite another text here", "c"), (11, None, "d"),
            (10, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [
        (2, text, "b"), (9, "quite another text here", "c"), (10, "", "e")
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicate_groups(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 200)]
    star = [(7, k) for k in range(1000, 3000)] + [(3, 2999)]
    edges = spark.createDataFrame(chain + star, "low long, high long")
    roots = {r.node: r.root for r in connected(edges).collect()}
    assert roots == {i: 100 for i in range(100, 201)} | {k: 3 for k in [3, 7, *range(1000, 3000)]}


def test_repeated_and_missing_ids_lose_no_document_of_another_group(spark):
    rng = random.Random(8)
    fresh = lambda: " ".join("v%d" % rng.randrange(10**6) for _ in range(400))
    one, two, three, four = (fresh() for _ in range(4))
    words, print_ = four.split(), slow_print(four)
    copies = (" ".join([*words[:i], "changed", *words[i + 1 :]]) for i in range(400))
    near = next(c for c in copies if 1 <= (print_ ^ slow_print(c)).bit_count() <= 2)
    rows = [(5, one), (5, two), (7, one), (9, two), (5, three), (None, four), (None, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in simhash.drop_near_duplicates(docs).collect()), key=repr)
    assert [d for d, _ in kept] == [5, 5, 5, None]
    assert {t for d, t in kept if d} == {one, two, three}
