"""Quality classifier: gradients, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from marketlake.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(9, quality.N_FEATURES)).astype(np.float64)
    counts, labels = np.array([2, 1, 4, 2]), np.array([1.0, 0.0, 0.0, 1.0])
    model = quality.Model(hidden=5, gate=3)

    def loss():
        s = model.forward(x, counts)["score"]
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))

    grads = model.gradients(model.forward(x, counts), labels)
    for name, value in model.p.items():
        at = tuple(rng.integers(n) for n in value.shape)
        old = value[at]
        value[at] = old + 1e-6
        up = loss()
        value[at] = old - 1e-6
        slope = (up - loss()) / 2e-6
        value[at] = old
        assert abs(slope - grads[name][at]) < 1e-5, name


def test_passages_cover_whole_texts():
    x, counts = quality.encode_passages([b"", b"a" * 2500, b"b b c"])
    assert counts.tolist() == [1, 3, 1]
    assert x[:, -1].tolist() == pytest.approx([0.001, 1.0, 1.0, 0.5, 0.005])
    assert x[4, -3:-1].tolist() == pytest.approx([2 / 3, 1 / 3])
    assert (quality.encode_passages([b"a" * 2500])[0] == x[1:4]).all()


def test_held_out_accuracy(spark):
    scored = queries.op8_quality_classifier(spark, SF)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = scored.collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in out) >= 0.95 * len(out)
    assert sum(a == 0 for a, b in out if b == 1) <= 0.02 * len(out)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    model = quality.train(docs, labels)
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), flipped)
    assert all(np.array_equal(model.p[k], again.p[k]) for k in model.p)


def test_odd_rows(spark):
    rows = [(1, "Good text of many words, as one reads it. " * 3, "x"), (1, None, "x"), (None, "", "x"), (2, "é" * 200000, "x"),
            (3, "bad!! " * 50, "x"), (3, "bad!! " * 50, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (9, 0), (None, 1), (2, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    out = quality.classify(docs, model).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 3}) == 1
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("none", ["docs", "labels"])
def test_nothing_to_learn_from(spark, none):
    docs = spark.createDataFrame([] if none == "docs" else [(1, "text")], "doc_id long, text string")
    labels = spark.createDataFrame([] if none == "labels" else [(1, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model is None
    assert [r.score for r in quality.classify(docs, model).collect()] == ([] if none == "docs" else [0.5])


def plain_score(model, text):
    """A whole text by loops over its passages, as the formulas of gated attention say."""
    data = (text or "").encode()
    rows = [quality.encode_passages([data[at : at + quality.PASSAGE_BYTES]])[0][0].astype(float)
            for at in range(0, max(1, len(data)), quality.PASSAGE_BYTES)]
    p, hidden, raw = model.p, [], []
    for row in rows:
        x = [(row[i] - model.mean[i]) / model.scale[i] for i in range(len(row))]
        h = [np.tanh(sum(x[i] * p["encode"][i][j] for i in range(len(x))) + p["encode0"][j]) for j in range(len(p["encode0"]))]
        e = 0.0
        for k in range(len(p["attend"])):
            v = np.tanh(sum(h[j] * p["value"][j][k] for j in range(len(h))) + p["value0"][k])
            g = 1 / (1 + np.exp(-(sum(h[j] * p["gate"][j][k] for j in range(len(h))) + p["gate0"][k])))
            e += v * g * p["attend"][k]
        hidden.append(h)
        raw.append(e)
    total = sum(np.exp(e) for e in raw)
    z = [sum(np.exp(e) / total * h[j] for e, h in zip(raw, hidden)) for j in range(len(hidden[0]))]
    return 1 / (1 + np.exp(-(sum(z[j] * p["out"][j] for j in range(len(z))) + p["out0"][0])))


def test_scores_equal_a_plain_forward_pass(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    short = sorted(d for d, t in texts.items() if len((t or "").encode()) < 4000)[:60]
    scores = {r.doc_id: r.score for r in quality.classify(docs, model).collect()}
    for d in short:
        assert scores[d] == pytest.approx(plain_score(model, texts[d]), abs=1e-5)
    assert any(len((texts[d] or "").encode()) > 2 * quality.PASSAGE_BYTES for d in short)
