"""The stages in a row against brute-force versions of each."""

from collections import Counter
from pathlib import Path

import corpus_pipeline
from marketlake.llm import queries
from marketlake.llm.common import stored
from marketlake.llm.packing import Tokens
from marketlake.session import shared_dir
from pyspark.sql import functions as F
from test_linededup import slow as slow_lines
from test_mixing import slow as slow_mix
from test_packing import check_places
from test_simhash import slow_groups

SF = "/root/testdata/sf0.001"


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_every_stage_works_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        frames.append(docs)
    good, lines, single, mixed, packed = frames
    assert all(f.columns == columns for f in frames[:-1])

    scores = {r.doc_id: r.predicted for r in queries.op8_quality_classifier(spark, SF).collect()}
    assert sorted(d for d, _ in rows_of(good)) == sorted(d for d, p in scores.items() if p)

    import hashlib

    want = {d: digest for d, _, _, digest in slow_lines(rows_of(good))}
    assert {d: hashlib.sha256((t or "").encode()).hexdigest() for d, t in rows_of(lines)} == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    assert sorted(d for d, _ in rows_of(single)) == sorted(d for d, _, c in slow_groups(rows_of(lines)) if c == d)

    leaf = [tuple(r) for r in single.select("doc_id", "text", "lang", "source", F.expr(queries.DOMAIN_SQL)).collect()]
    assert Counter(d for d, _ in rows_of(mixed)) == Counter(d for d, *_ in slow_mix(leaf, queries.MIX))

    tokens = Tokens(**queries.tokenizer_files())
    lengths = Counter()
    for r in packed.collect():
        lengths[r.doc_id] += r.length
    want = Counter()
    for d, t in rows_of(mixed):
        want[d] += len(tokens.whole.encode(t, add_special_tokens=False).ids) + 1
    assert lengths == want
    check_places(packed.collect())


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 100


def test_run_leaves_its_result_only(spark):
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    out = corpus_pipeline.run(spark, SF)
    left = [p.name for p in set(shared.iterdir()) - before]
    assert len(left) == 1 and left[0].startswith("stage-best-fit-packing") and out.count() > 100
