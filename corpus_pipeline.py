"""From raw documents to packed training sequences: every stage calls one operator of marketlake.llm.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet to the shared folder and reads
it again for the next one. All stages but the last return the documents' columns; the last one returns every piece of
the documents left, with its place in a sequence.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import linededup, mixing, packing, quality, queries, simhash
from marketlake.llm.common import drop_folder, find_library, finished

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        find_library(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5)
    return quality.keep_good(docs, model, threshold=0.3)


@stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least three documents share stay in one of them."""
    return linededup.drop_repeated_lines(docs, min_chars=20, min_docs=3)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs, words=3, max_bits=2)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the target weights of their source want them."""
    return mixing.mixed(docs, F.expr(queries.DOMAIN_SQL), queries.MIX)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, **queries.tokenizer_files(), capacity=1024, end_id=2)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: The classifier's fitted scores, the fingerprints' links and the tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. Each one's output goes when the next one has read it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES:
        docs, folder = finished(spark, partial(function, spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if before is not None:
            drop_folder(spark, before)
        before = folder
    return docs
