"""Language of whole texts by sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams are hashed; their document frequencies come from all documents that may be learned from. The
weights are fitted by follow-the-regularised-leader with an elastic net, so most of them are exactly zero, on a bounded
sample of labelled documents. A part of the sample that the fit never sees sets the temperature of the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import sampled

BITS = 16  # of a hashed n-gram
ORDERS = (1, 2, 3)
SAMPLE_DOCS = 3000  # bound of the training sample, over all languages
MAX_LANGS = 128  # bound of the languages that are learned
UNKNOWN = "und"
_SLICE = 1 << 20  # characters counted at once
_SORTED = 1 << 14  # characters of a text whose n-grams are sorted, not counted in an array
_MIX = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased text, other ASCII than letters as spaces, and how often each occurs."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    chars = np.where((chars < 97) | ((chars > 122) & (chars < 128)), np.uint64(32), chars)
    total = None if len(chars) <= _SORTED else np.zeros(1 << BITS, dtype=np.int64)
    hashes = []
    for at in range(0, len(chars), _SLICE):
        for order in ORDERS:
            part = chars[at : at + _SLICE + order - 1]
            if len(part) < order:
                continue
            code = np.full(len(part) - order + 1, order, dtype=np.uint64)
            for k in range(order):
                code = (code << np.uint64(21)) ^ part[k : len(part) - order + 1 + k]
            hashed = ((code * _MIX) >> np.uint64(64 - BITS)).astype(np.uint16)
            if total is None:
                hashes.append(hashed)
            else:
                total += np.bincount(hashed, minlength=1 << BITS)
    if total is None:  # sorting what a short text has is cheaper than a counter for every feature
        found, counts = np.unique(np.concatenate(hashes or [np.zeros(0, dtype=np.uint16)]), return_counts=True)
        return found.astype(np.int64), counts
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # by feature and language
    bias: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def logits(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return vector(self.idf, found, counts) @ self.weights[found] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*ngram_counts(text)) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def vector(idf: np.ndarray, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The document's TF-IDF values at its features, of length 1."""
    x = (1 + np.log(counts)) * idf[found]
    return x / max(np.sqrt(x @ x), 1e-12)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.1, epochs: int = 4, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal steps over (features, values, language) in a seeded order.

    The last feature is the bias; it is regularised like the others only by ``l2``.
    """
    z, n = np.zeros(((1 << BITS) + 1, n_langs)), np.zeros(((1 << BITS) + 1, n_langs))

    def weights(at):
        shrink = np.full((len(at), 1), l1)
        shrink[at == 1 << BITS] = 0
        w = -(z[at] - np.sign(z[at]) * shrink) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) > shrink, w, 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            found, values, lang = rows[i]
            at, x = np.append(found, 1 << BITS), np.append(values, 1.0)
            w = weights(at)
            wrong = softmax(x @ w)
            wrong[lang] -= 1
            g = x[:, None] * wrong
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    final = weights(np.arange((1 << BITS) + 1))
    return final[:-1], final[-1]


def fit_temperature(logits: np.ndarray, langs: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search between 1/20 and 20."""
    if not len(langs):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(langs)), langs]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: str | Column = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves ``fold``; rows without an id, too."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(True))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Of each feature over all rows of ``texts`` (text), and the number of rows; tasks add up before they shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << BITS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                total[ngram_counts(text.as_py() or "")[0]] += 1
                rows += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1).astype(np.int32)), pa.array(np.append(total[found], rows))], names=["f", "n"]
        )

    sums = texts.mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    counts, rows = np.zeros(1 << BITS), 0
    for f, n in sums:  # at most one row per feature
        if f < 0:
            rows = n
        else:
            counts[f] = n
    return counts, rows


def train(
    docs: DataFrame, folds: int = 4, fold: int = 2, sample_docs: int = SAMPLE_DOCS, max_langs: int = MAX_LANGS
) -> Model:
    """A model from the text and lang of documents outside the held-out fold.

    About ``sample_docs`` documents, as many of each language where there are so many, picked by a hash of the id, are
    fitted; every fifth of them by that hash is kept for the temperature. Of more than ``max_langs`` language values the
    most frequent ones are learned (ties by name), which bounds the weights; a column with so many holds no languages. Without labelled documents the model knows
    no language and everything is unknown.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & ~held_out(folds=folds, fold=fold))
    frequent = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(max_langs)
    sizes = {r["lang"]: r["n"] for r in frequent.collect()}
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), np.zeros(1 << BITS))
    counts, n_docs = document_frequencies(known.select("text"))
    idf = np.log((1 + n_docs) / (1 + counts))

    langs = sorted(sizes)
    shares = F.create_map(*[
        F.lit(x) for lang in langs for x in (lang, float(min(1, sample_docs / len(langs) / sizes[lang])))
    ])
    sample = known.where(sampled("doc_id", shares[F.col("lang")])).select("text", "lang", (F.pmod(F.hash("doc_id"), F.lit(5)) == 0).alias("apart"))

    def features(batches):
        for pdf in batches:
            for text, lang, apart in zip(pdf["text"], pdf["lang"], pdf["apart"]):
                found, n = ngram_counts(text or "")
                yield pd.DataFrame({
                    "lang": [lang], "apart": [apart], "found": [found.astype(np.int32).tobytes()],
                    "n": [n.astype(np.int32).tobytes()],
                })

    rows = sample.mapInPandas(features, "lang string, apart boolean, found binary, n binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["found"]), bytes(r["n"])))
    fit, apart = [], []
    for r in rows:
        found, n = (np.frombuffer(bytes(r[c]), dtype=np.int32) for c in ("found", "n"))
        (apart if r["apart"] else fit).append((found, vector(idf, found, n), langs.index(r["lang"])))
    weights, bias = fit_ftrl(fit, len(langs))
    model = Model(langs, weights.astype(np.float32), bias, idf)
    logits = np.array([x @ weights[found] + bias for found, x, _ in apart]).reshape(-1, len(langs))
    model.temperature = fit_temperature(logits, np.array([lang for *_, lang in apart], dtype=int))
    return model


def predict_column(model: Model, text: str | Column = "text") -> Column:
    """Struct of lang_pred and score for every text."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def predict(docs: DataFrame, model: Model, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; null texts and texts without a letter are ``und`` at 0."""
    rows = docs.select(
        F.col("doc_id").cast("long"), held_out(folds=folds, fold=fold).alias("held_out"),
        predict_column(model, F.col("text").cast("string")).alias("p"),
    )
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")
