"""Mixing against a brute-force version and its SQL."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from marketlake.llm import mixing, queries

SCHEMA = "doc_id long, text string, lang string, source string, kind string"


def deal(budget, caps, weights):
    """Budgets of children by name: fill who can't take their share, deal the rest anew."""
    out, open_ = {c: 0 for c in caps if not weights[c]}, {c: n for c, n in caps.items() if weights[c]}
    while open_:
        total = sum(weights[c] for c in open_)
        full = [c for c in open_ if open_[c] * total <= weights[c] * budget]
        if not full:
            return out | {c: weights[c] * budget // total for c in open_}
        least = min(full, key=lambda c: (open_[c] / weights[c], c))
        out[least] = open_.pop(least)
        budget -= out[least]
    return out


def slow(rows, mix):
    """(doc_id, leaf, epoch) of every use; ids are unique and texts plain."""
    tokens, members = Counter(), defaultdict(list)
    for doc_id, text, lang, source, kind in rows:
        leaf = (kind or "", lang or "", source or "")
        tokens[leaf] += len((text or "").split())
        members[leaf].append((doc_id, len((text or "").split())))

    def weight(path):
        return mix.weights.get("/".join(path), mix.default_weight)

    def cap(path):
        return mix.epochs * sum(
            t for leaf, t in tokens.items()
            if leaf[: len(path)] == path and all(weight(leaf[: d + 1]) for d in range(3))
        )

    def go(path, budget):
        if len(path) == 3:
            return {path: budget}
        names = {leaf[len(path)] for leaf in members if leaf[: len(path)] == path}
        caps, weights = {n: cap((*path, n)) for n in names}, {n: weight((*path, n)) for n in names}
        return {k: v for n, b in deal(budget, caps, weights).items() for k, v in go((*path, n), b).items()}

    out = []
    for leaf, budget in go((), int(sum(tokens.values()) * mix.share)).items():
        whole, rest = divmod(budget, tokens[leaf]) if tokens[leaf] else (0, 0)
        out += [(d, leaf, e) for e in range(whole) for d, _ in members[leaf]]
        begin = 0
        for d, n in sorted(members[leaf], key=lambda m: hashlib.md5(f"{mix.seed}:{whole}:{m[0]}".encode()).hexdigest()):
            if begin < rest:
                out.append((d, leaf, whole))
            begin += n
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None])
        kind = "web" if source == "a" else rng.choice(["book", "talk"])
        rows.append((i, "w " * rng.choice([0, 1, 7, 40]), lang, source, kind))
    return rows + [(900, None, "fr", "z", "lost"), (901, "long " * 5000, "en", "b", "book")]


@pytest.mark.parametrize("seed,share,epochs", [(1, 1.0, 3), (2, 0.3, 1), (3, 5.0, 2), (4, 0.9, 4)])
def test_equals_brute_force(spark, monkeypatch, seed, share, epochs):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 16)
    rows = corpus(seed)
    weights = {"web": 1, "book": 6, "talk": 3, "web/en": 2, "book/en/b": 5, "book/de": 1}
    mix = mixing.Mix(weights, 2, share, epochs, seed)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("budget", F.lit("clash"))
    got = mixing.mix_table(docs, F.col("kind"), mix).collect()
    assert sorted((r.doc_id, (r.domain, r.lang, r.source), r.epoch) for r in got) == slow(rows, mix)


@pytest.mark.parametrize("weights,default", [
    ({"web": 0, "book": 6, "talk": 3}, 2),  # a domain
    ({"web/en": 0, "web/de": 0, "web/": 0, "book/en/b": 0, "talk/de": 0}, 1),  # all below a domain, a source, a language
    ({"book/en": 3, "book": 1, "book/en/b": 2}, 0),  # only what is named
    ({}, 0),
])
def test_nodes_of_weight_zero_are_left_out(spark, weights, default):
    rows, mix = corpus(6), mixing.Mix(weights, default, 0.8, 3, 6)
    got = mixing.mix_table(spark.createDataFrame(rows, SCHEMA), F.col("kind"), mix).collect()
    assert sorted((r.doc_id, (r.domain, r.lang, r.source), r.epoch) for r in got) == slow(rows, mix)


def test_what_is_no_target_is_refused():
    for wrong in ({"weights": {"a": -1}}, {"weights": {"a": 0.5}}, {"default_weight": -2}, {"share": -0.1},
                  {"share": float("nan")}, {"epochs": 0}):
        with pytest.raises(ValueError):
            mixing.Mix(**wrong)


def test_shortage_goes_to_siblings_before_other_domains(spark):
    rows = [(0, "w " * 10, "en", "a", "x"), (1, "w " * 990, "de", "b", "x"), (2, "w " * 1000, "en", "c", "y")]
    sized = mixing.leaves(spark.createDataFrame(rows, SCHEMA), F.col("kind"))
    got = {r["__llm_source"]: r.budget for r in mixing.budgets(sized, mixing.Mix(share=0.5, epochs=1)).collect()}
    assert got == {"a": 10, "b": 490, "c": 500}


def test_stage_repeats_whole_rows_with_their_columns(spark):
    rows = [(1, "w w", "en", "a", "x"), (1, "w w", "en", "a", "x"), (None, "w", "en", "a", "x"), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("whole", F.lit("clash"))
    out = mixing.mixed(docs, F.col("kind"), mixing.Mix(share=2.0, epochs=2))
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == {1: 4, None: 2}


def test_empty_table(spark):
    assert mixing.mix_table(spark.createDataFrame([], SCHEMA), F.col("kind"), mixing.Mix()).count() == 0


def test_no_python_on_the_main_path(spark):
    docs = spark.createDataFrame(corpus(1), SCHEMA)
    plan = mixing.mixed(docs, F.col("kind"), mixing.Mix())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_against_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    columns = "doc_id, domain, lang, source, n_tokens, epoch"
    want = con.execute(f"SELECT {columns} FROM ({queries.ORACLE['op2_mixing_sources']})").fetchall()
    got = queries.op2_mixing_sources(spark, sf).select(*columns.split(", ")).collect()
    assert len(want) > 500 and sorted(map(tuple, got)) == sorted(want)
