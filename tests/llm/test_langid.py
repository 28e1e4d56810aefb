"""Language ID: n-grams and steps against plain versions, held-out accuracy, odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import langid, queries
from marketlake.llm.common import sampled

SF = "/root/testdata/sf0.01"


def slow_counts(text):
    chars = [ord(c) if "a" <= c <= "z" or ord(c) >= 128 else 32 for c in text.lower()]
    out = Counter()
    for order in (1, 2, 3):
        for i in range(len(chars) - order + 1):
            code = order
            for c in chars[i : i + order]:
                code = ((code << 21) ^ c) % 2**64
            out[(code * 0x9E3779B97F4A7C15 % 2**64) >> 48] += 1
    return out


@pytest.mark.parametrize("short", [0, 1 << 14])
def test_ngrams_of_whole_texts(monkeypatch, short):
    monkeypatch.setattr(langid, "_SLICE", 7)
    monkeypatch.setattr(langid, "_SORTED", short)
    for text in ("", "a", "Ab", "ÄÖü 12 straße, x", "日本 \x7f{}", "abc" * 40):
        found, counts = langid.ngram_counts(text)
        assert dict(zip(found.tolist(), counts.tolist())) == slow_counts(text)


def test_ftrl_steps_equal_a_plain_version():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(30, 5, replace=False)), rng.random(5), int(rng.integers(3))) for _ in range(12)]
    got, bias = langid.fit_ftrl(rows, 3, epochs=2, seed=9)
    z, n = Counter(), Counter()
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1

    def w(f, c):
        shrink = 0 if f == -1 else l1
        if abs(z[f, c]) <= shrink:
            return 0.0
        return -(z[f, c] - np.sign(z[f, c]) * shrink) / ((beta + np.sqrt(n[f, c])) / alpha + l2)

    order = np.random.default_rng(9)
    for _ in range(2):
        for i in order.permutation(len(rows)):
            found, values, lang = rows[i]
            items = [*zip(found.tolist(), values.tolist()), (-1, 1.0)]
            old = {(f, c): w(f, c) for f, _ in items for c in range(3)}
            p = langid.softmax(np.array([sum(old[f, c] * x for f, x in items) for c in range(3)]))
            for f, x in items:
                for c in range(3):
                    g = (p[c] - (c == lang)) * x
                    sigma = (np.sqrt(n[f, c] + g * g) - np.sqrt(n[f, c])) / alpha
                    z[f, c] += g - sigma * old[f, c]
                    n[f, c] += g * g
    want = np.array([[w(f, c) for c in range(3)] for f in range(30)])
    assert np.allclose(got[:30], want) and not got[30:].any()
    assert np.allclose(bias, [w(-1, c) for c in range(3)])
    assert (want == 0).any()


def test_temperature_softens_wrong_certainty():
    rng = np.random.default_rng(0)
    langs = rng.integers(3, size=500)
    right = np.where(rng.random(500) < 0.7, langs, (langs + 1) % 3)
    assert langid.fit_temperature(np.eye(3)[right] * 20, langs) > 5
    assert langid.fit_temperature(np.eye(3)[langs], langs) < 0.2
    assert langid.fit_temperature(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0


def test_held_out_accuracy(spark):
    got = queries.op7_language_id(spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = langid.held_out()
    other = docs.withColumn("source", F.lit(None).cast("string")).withColumn(
        "lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))
    ).withColumn("text", F.when(held, F.lit("zzz")).otherwise(F.col("text")))
    a, b = langid.train(docs), langid.train(other)
    assert a.langs == b.langs and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "and", "with"]) for _ in range(20)), "en") for i in range(40)]
    rows += [(100 + i, " ".join(rng.choice(["der", "und", "mit"]) for _ in range(20)), "de") for i in range(40)]
    rows += [(200, None, "en"), (201, "", None), (202, "12 ... 34", "en"), (None, "the and with", "en"),
             (203, "der und " * 60000, None), (0, rows[0][1], "en"), (0, "another the text", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    out = {(r.doc_id): r for r in langid.predict(docs, langid.train(docs)).collect()}
    assert out[200].lang_pred == out[201].lang_pred == out[202].lang_pred == "und"
    assert out[203].lang_pred == "de" and out[None].lang_pred == "en" and out[None].held_out
    assert langid.predict(docs, langid.train(docs)).count() == len(rows)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(empty)
    assert langid.predict(empty, model).count() == 0
    one = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.predict(one, langid.train(one)).collect()] == [("und", 0.0)]


def test_a_share_of_a_very_large_table_is_not_nothing(spark):
    """The share of a language with 800 million documents, and of one with a million million."""
    ids = spark.range(200_000)
    assert ids.where(sampled("id", 1.0)).count() == 200_000 and ids.where(sampled("id", 0.0)).count() == 0
    assert 60 < ids.where(sampled("id", 5e-4)).count() < 150
    first = ids.select(F.xxhash64("id").bitwiseAND(F.lit((1 << 63) - 1)).alias("h")).agg(F.min("h")).first()[0]
    share = (first + 2) / 2.0**63 * 1.001  # just enough for one of them
    assert share < 1e-4 and ids.where(sampled("id", share)).count() == 1
    for total in (8e8, 1e12):
        threshold = spark.range(1).select((F.lit(3000 / 4 / total) * F.lit(2.0**63)).cast("decimal(38,0)")).first()[0]
        assert abs(int(threshold) / 2**63 * total - 750) < 1


def test_every_language_of_an_uneven_table_is_learned(spark):
    words = {"a": "alpha beta gamma", "b": "ünü öçş ğış", "c": "キャ ラク ター"}
    rows = [(i, f"{words[l]} {i}", l) for i, l in enumerate("a" * 3000 + "b" * 60 + "c" * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample_docs=120)
    got = {r.lang for r in langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(
        "lang_pred = lang").select("lang").distinct().collect()}
    assert model.langs == ["a", "b", "c"] and got == {"a", "b", "c"}


def test_a_column_of_very_many_values_is_bounded(spark):
    rows = [(i, f"word {i}", f"value {i}") for i in range(500)] + [(1000 + i, "alpha beta", "a") for i in range(50)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_langs=5)
    assert len(model.langs) == 5 and model.langs[0] == "a" and model.weights.shape[1] == 5


def test_predictions_of_the_query_equal_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    for r in docs.collect()[:60]:
        counts = slow_counts(r.text or "")
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        x = {f: (1 + np.log(n)) * model.idf[f] for f, n in counts.items()}
        size = max(np.sqrt(sum(v * v for v in x.values())), 1e-12)
        logits = [sum(v / size * float(model.weights[f][k]) for f, v in x.items()) + model.bias[k] for k in range(len(model.langs))]
        powers = [np.exp((z - max(logits)) / model.temperature) for z in logits]
        best = int(np.argmax(powers))
        assert got[r.doc_id][0] == model.langs[best] and abs(got[r.doc_id][1] - powers[best] / sum(powers)) < 1e-4
