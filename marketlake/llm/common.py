"""What several of these operators share: stored intermediate tables, row identity, connected components."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_path

#: Names for helper columns; no input column is expected to start like this.
TEXT_KEY = "__llm_text_key"

_EDGE = "low long, high long"

# Folders that the calls of ``finished`` on their way have stored so far, the innermost one last.
_MADE: list[list[str]] = []


def find_library(spark: SparkSession) -> None:
    """Let Python workers on machines that have this library in the same place import it, wherever the driver was started.

    Other machines get it as any Python dependency, for instance with ``--py-files``.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in known:
        environment["PYTHONPATH"] = ":".join([*known, root])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Lost executors cost a re-read instead of the work before, and every later use sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    if _MADE:
        _MADE[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> tuple[DataFrame, str]:
    """What ``make`` gives, stored, and its folder; tables that were stored on the way are deleted then.

    They stay if the job fails, as its next attempt makes its own.
    """
    made: list[str] = []
    _MADE.append(made)
    try:
        out = stored(make(), name)
    finally:
        _MADE.pop()
    for path in made[:-1]:
        drop_folder(spark, path)
    if _MADE:
        _MADE[-1].append(made[-1])
    return out, made[-1]


def drop_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_key(text: str | Column = "text") -> Column:
    """64 bits of a text; with the document's id it tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def sampled(key: str, share: float | Column) -> Column:
    """Whether a row is in a sample of this share (0 to 1) by a hash of its key.

    The hash has 63 bits, so no share of a table of any size rounds to nothing. Rows without a key share one hash.
    """
    share = F.lit(share) if isinstance(share, (int, float)) else share
    return F.xxhash64(key).bitwiseAND(F.lit((1 << 63) - 1)) <= (share * F.lit(2.0**63)).cast("decimal(38,0)")


def same_row(left: DataFrame, right: DataFrame, names: tuple[str, ...] = ("doc_id", TEXT_KEY)) -> Column:
    """Null-safe equality of the columns that identify a row."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (low long, high long); the root is the smallest node reachable.

    Large-star and small-star rounds (Kiveris et al. 2014): each links neighbours to the smallest one they know of,
    until only stars are left. A node's minimum is a map-side aggregate joined back, so that a node with very many
    neighbours is a skewed join, which Spark splits, and never one group in one task. Every round is stored in the
    shared folder. An empty input gives an empty result.
    """
    edges = stored(
        edges.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
        .where("low < high").distinct(), "edges",
    )
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).union(
            edges.select(F.col("high").alias("u"), F.col("low").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.least("u", "m").alias("low"), F.col("v").alias("high"))
        large = large.distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").select(
            F.explode(F.array(
                F.struct(F.col("m").alias("low"), F.col("low").alias("high")),
                F.struct(F.col("m").alias("low"), F.col("high").alias("high")),
            )).alias("e")
        ).select("e.low", "e.high").where("low < high").distinct()
        edges = stored(small, "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
