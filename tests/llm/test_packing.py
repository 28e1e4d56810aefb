"""Pieces against the tokenizer file itself, placements by their rules."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from marketlake.llm import packing, queries

FILES = queries.tokenizer_files()


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens(**FILES)


def slow_ids(tokens, text):
    return tokens.whole.encode(text or "", add_special_tokens=False).ids + [2]


def odd_texts(seed=2):
    rng = random.Random(seed)
    parts = ["the", "word", "don't", " ", "  ", "\n", "\t", " ", " x", "Ünï", "日本語", "🙂", "123", "4,5", "...", "!?",
             "\x0b", "\x1c", "<|endoftext|>", "a'll", "'s", "‍", "é", "ß", "²", "_"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(30))) for _ in range(400)]
    return texts + ["", " ", "one", " lead", "trail ", "x" * 5000, "word " * 3000, "a <|endoftext|> b"]


def test_ids_equal_the_tokenizer_files(tokens):
    texts = odd_texts()
    got = tokens.many(pa.array(texts, pa.string()))
    for text, ids in zip(texts, got):
        assert ids.tolist() == slow_ids(tokens, text)[:-1], repr(text)
    assert tokens.many(pa.array([], pa.string())) == []


def test_every_letter_of_the_plane(tokens):
    texts = ["a" + chr(c) + "b " + chr(c) + " 1" + chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    got = tokens.many(pa.array(texts, pa.string()))
    assert [i.tolist() for i in got] == [slow_ids(tokens, t)[:-1] for t in texts]


def check_places(rows, n_sequences=None):
    taken = defaultdict(list)
    for r in rows:
        taken[r.sequence_id].append((r.offset, r.length))
    for places in taken.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(taken)


def test_pieces_and_places(spark, tokens):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gämma", "x1", "."]) for _ in range(rng.choice([1, 5, 300, 900, 4000]))))
            for i in range(60)]
    rows += [(100, None), (101, ""), (None, "no id"), rows[3], rows[3], (3, "same id"), (102, "y" * 20000)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, piece string").repartition(3)
    out = packing.pack(docs, **FILES).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = slow_ids(tokens, text)
        ends = list(range(len(ids), 0, -1024))[::-1]
        for piece, (a, b) in enumerate(zip([0, *ends], ends)):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            want[doc_id, piece, a, b - a, crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    n = check_places(out)
    assert n <= -(-sum(r.length for r in out) // 1024) + 2


def test_many_equal_lengths_are_ranked_in_salted_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 10)
    pieces = spark.createDataFrame(
        [(i, 0, 0, 300 if i % 3 else 424, 7) for i in range(300)], "doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    out = packing.place_pieces(pieces).collect()
    assert len(out) == 300 and check_places(out) == 100


def test_packed_sequences_hold_all_ids(spark, tokens):
    rows = [(i, "some text number %d " % i * (i * 20 + 1)) for i in range(20)] + [(3, "some text number 3 " * 61)]
    pieces = packing.token_pieces(spark.createDataFrame(rows, "doc_id long, text string"), **FILES, with_ids=True)
    placed = packing.place_pieces(pieces)
    ids = [i for r in packing.sequences(placed, pieces).collect() for i in r.ids]
    assert Counter(ids) == Counter(i for _, t in rows for i in slow_ids(tokens, t))


@pytest.mark.parametrize("seed", range(6))
def test_configurations_hold_each_piece_once_in_few_sequences(seed):
    rng = random.Random(seed)
    low, high = rng.choice([(1, 1024), (200, 700), (1, 60), (513, 1024)])
    counts = Counter(rng.randrange(low, high + 1) for _ in range(rng.choice([1, 50, 2000])))
    groups = packing.configurations(counts, 1024)
    held = Counter()
    for pattern, times in groups:
        assert sum(n * k for n, k in pattern) <= 1024
        for n, k in pattern:
            held[n] += k * times
    assert held == counts
    plain = sum(t for _, t in packing._best_fit(dict(counts), 1024))
    assert sum(t for _, t in groups) <= plain * 1.01 + 1


def test_multiplicative_weights_reach_the_known_optimum():
    uses = packing.solve_configurations({600: 100, 424: 100, 300: 60, 724: 60}, 1024)
    assert 160 <= sum(uses.values()) <= 160 * 1.15


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, **FILES).count() == 0


def test_most_sequences_come_from_the_program():
    rng = np.random.default_rng(8)
    for n in (1000, 10000):
        lengths = np.clip(rng.lognormal(5.8, 0.7, n).astype(int), 5, 1023)
        counts = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True))}
        total = sum(t for _, t in packing.configurations(counts))
        bound = -(-int(lengths.sum()) // 1024)
        assert bound <= total <= bound * 1.01 + 1 and packing.program_share(counts) > 0.4
    assert packing.program_share({}) == 0 == packing.program_share({1024: 7})
