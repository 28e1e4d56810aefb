"""Quality of whole documents by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded; gated attention weighs the
encodings against each other; a logistic output scores their weighted mean (Ilse et al. 2018). Encoder, attention and
output are trained together, by mini-batch gradient steps on a bounded sample of labelled documents, with whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import sampled

PASSAGE_BYTES = 1000
SAMPLE_DOCS = 4000  # bound of the training sample
THRESHOLD = 0.3
_SLICE_BYTES = 4 << 20

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Byte to fine class and byte to coarse class."""
    fine, coarse = np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64)
    for i, byte in enumerate(range(ord("a"), ord("z") + 1), 1):
        fine[byte], coarse[byte] = i, 1
    for i, byte in enumerate(_PUNCTUATION, 27):
        fine[byte], coarse[byte] = i, 10
    for byte in range(256):
        char = chr(byte)
        if "A" <= char <= "Z":
            fine[byte], coarse[byte] = 59, 2
        elif char in "0123456789":
            fine[byte], coarse[byte] = 60, 3
        elif char == " ":
            fine[byte], coarse[byte] = 61, 4
        elif char == "\n":
            fine[byte], coarse[byte] = 62, 5
        elif byte >= 0xC0:
            fine[byte], coarse[byte] = 63, 6
        elif byte >= 0x80:
            fine[byte], coarse[byte] = 64, 6
    for group, chars in ((7, b".,;:"), (8, b"!?"), (9, b"|<>{}[]")):
        coarse[list(chars)] = group
    return fine, coarse


_FINE, _COARSE = _classes()
_N_FINE, _N_COARSE = 65, 11
N_FEATURES = _N_FINE + _N_COARSE**2 + 3


def _word_shares(passage: bytes) -> tuple[float, float]:
    words = passage.split()
    n = max(1, len(words))
    return len(set(words)) / n, sum(map(eq, words, words[1:])) / n


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many each text has; a text without bytes is one passage of zeros.

    Features are square roots of the shares of byte classes and of pairs of coarse classes, the shares of words that
    differ from all others and that repeat the word before, and the passage's length.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    begin, first = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
    passage = first[owner] + (np.arange(len(data)) - begin[owner]) // PASSAGE_BYTES
    total = int(counts.sum())
    single = np.bincount(passage * _N_FINE + _FINE[data], minlength=total * _N_FINE).reshape(total, _N_FINE)
    coarse = _COARSE[data]
    same = passage[1:] == passage[:-1]
    pair = (passage[1:] * _N_COARSE**2 + coarse[:-1] * _N_COARSE + coarse[1:])[same]
    double = np.bincount(pair, minlength=total * _N_COARSE**2).reshape(total, _N_COARSE**2)
    length = np.maximum(1, np.bincount(passage, minlength=total))[:, None]
    words = np.array([
        _word_shares(text[at : at + PASSAGE_BYTES]) for text in texts for at in range(0, max(1, len(text)), PASSAGE_BYTES)
    ]).reshape(total, 2)
    out = np.concatenate([np.sqrt(single / length), np.sqrt(double / length), words, length / PASSAGE_BYTES], axis=1)
    return out.astype(np.float32), counts


class Model:
    """tanh encoder, gated attention, logistic output."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7):
        rng = np.random.default_rng(seed)
        glorot = lambda a, b: rng.normal(0, np.sqrt(2 / (a + b)), (a, b))
        self.p = {
            "encode": glorot(N_FEATURES, hidden), "encode0": np.zeros(hidden),
            "value": glorot(hidden, gate), "value0": np.zeros(gate),
            "gate": glorot(hidden, gate), "gate0": np.zeros(gate),
            "attend": glorot(gate, 1)[:, 0], "out": glorot(hidden, 1)[:, 0], "out0": np.zeros(1),
        }
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p, bag = self.p, np.repeat(np.arange(len(counts)), counts)
        starts = np.cumsum(counts) - counts
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["encode"] + p["encode0"])
        v = np.tanh(h @ p["value"] + p["value0"])
        g = 1 / (1 + np.exp(-(h @ p["gate"] + p["gate0"])))
        e = (v * g) @ p["attend"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["out"] + p["out0"], -30, 30)))
        return {"x": x, "bag": bag, "starts": starts, "h": h, "v": v, "g": g, "a": a, "z": z, "score": score}

    def gradients(self, f: dict[str, np.ndarray], label: np.ndarray) -> dict[str, np.ndarray]:
        p, bag = self.p, f["bag"]
        wrong = (f["score"] - label) / len(label)
        dz = wrong[:, None] * p["out"]
        da = (dz[bag] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["starts"])[bag])
        dvg = de[:, None] * p["attend"]
        dv, dg = dvg * f["g"] * (1 - f["v"] ** 2), dvg * f["v"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[bag] + dv @ p["value"].T + dg @ p["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "encode": f["x"].T @ dx, "encode0": dx.sum(axis=0), "value": f["h"].T @ dv, "value0": dv.sum(axis=0),
            "gate": f["h"].T @ dg, "gate0": dg.sum(axis=0), "attend": (f["v"] * f["g"]).T @ de,
            "out": f["z"].T @ wrong, "out0": np.array([wrong.sum()]),
        }

    def fit(self, x: np.ndarray, counts: np.ndarray, labels: np.ndarray, epochs: int = 25, rate: float = 0.01,
            decay: float = 1e-4, batch: int = 128, seed: int = 11) -> Model:
        """Adam on the log loss; the share of label 1 is the starting point."""
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.02
        share = (labels.sum() + 1) / (len(labels) + 2)
        self.p["out0"] = np.array([np.log(share / (1 - share))])
        begins = np.cumsum(counts) - counts
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, epochs * -(-len(labels) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                docs = order[at : at + batch]
                rows = np.concatenate([np.arange(begins[d], begins[d] + counts[d]) for d in docs])
                grads = self.gradients(self.forward(x[rows], counts[docs]), labels[docs])
                step += 1
                now = rate * (1 - step / (steps + 1))
                for k, g in grads.items():
                    g = g + decay * self.p[k] * (not k.endswith("0"))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - now * (first[k] / (1 - 0.9**step)) / (
                        np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                    )
        return self

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        """Scores of whole texts; a null text scores like an empty one."""
        out, part, size = [], [], 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            if part and size + len(data) > _SLICE_BYTES:
                out.append(self.forward(*encode_passages(part))["score"])
                part, size = [], 0
            part.append(data)
            size += len(data)
        if part:
            out.append(self.forward(*encode_passages(part))["score"])
        return np.concatenate(out) if out else np.zeros(0)


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 0. Rows without an id are held out, too."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from about ``sample_docs`` labelled documents outside the held-out fold, picked by a hash of the id.

    A label that comes several times counts by its mean, labels without id or quality not at all. None without any
    labelled document.
    """
    known = labels.where(F.col("quality").isNotNull() & ~held_out(folds=folds)).groupBy(
        F.col("doc_id").cast("long").alias("__llm_id")
    ).agg((F.avg("quality") >= 0.5).cast("double").alias("__llm_label"))
    share = min(1.0, sample_docs / max(1, known.count()))
    # At most about sample_docs rows, whatever the tables hold.
    sample = F.broadcast(known.where(sampled("__llm_id", share)))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        sample, F.col("doc_id") == F.col("__llm_id")
    )

    def features(batches):
        for pdf in batches:
            for label, text in zip(pdf["__llm_label"], pdf["text"]):
                x, counts = encode_passages([(text or "").encode("utf-8", "surrogatepass")])
                yield pd.DataFrame({"label": [label], "n": counts, "x": [x.tobytes()]})

    # Rows that repeat an id are all taken; the order makes the fit repeatable.
    bags = rows.mapInPandas(features, "label double, n long, x binary").collect()
    if not bags:
        return None
    bags.sort(key=lambda r: (r["label"], r["n"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in bags), dtype=np.float32).reshape(-1, N_FEATURES)
    return Model().fit(x, np.array([r["n"] for r in bags]), np.array([r["label"] for r in bags]))


def score_column(model: Model | None, text: str | Column = "text") -> Column:
    """The score of every text, empty and null ones too; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return score(text)


def classify(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; repeated rows are rows of their own."""
    scored = docs.select(
        F.col("doc_id").cast("long"), held_out(folds=folds).alias("held_out"),
        score_column(model, F.col("text").cast("string")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, with their columns."""
    return docs.withColumn("__llm_score", score_column(model, F.col("text").cast("string"))).where(
        F.col("__llm_score") >= threshold
    ).drop("__llm_score")
