"""Landing folders as streams of new files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake.schemas import LANDING


# Spark's default forgets files a week older than the newest and then never reads them. Names of all files seen stay
# in the checkpoint and in the driver, about 200 bytes each.
MAX_FILE_AGE = "36500d"


def landing_stream(spark: SparkSession, root: str, dataset: str, schema: T.StructType | None = None) -> DataFrame:
    """New files of a dataset, however old their modification times are.

    All files that are new form one batch: a batch's latest scrape wins, so cutting an
    increment into several ones would change what is stored.
    """
    reader = spark.readStream.schema(schema or LANDING[dataset]).option("recursiveFileLookup", "true")
    return reader.option("maxFileAge", MAX_FILE_AGE).parquet(f"{root}/{dataset}")


def stream_landing(
    spark: SparkSession,
    root: str,
    dataset: str,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None],
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Hand all files that arrived since the last run to ``on_batch``, then stop.

    Files count as consumed once their batch has finished; a batch that failed comes again
    with the same id and files. Without new files ``on_batch`` is not called.
    """
    return (
        landing_stream(spark, root, dataset, schema)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedupe(
    stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str, salts: int = 8
) -> DataFrame:
    """First row per key within ``lateness``, for streams that append facts without a merge.

    A key's rows are deduplicated in ``salts`` shares first, so that a very frequent key is
    spread over as many tasks and leaves only that many rows for the last step.
    """
    marked = stream.withWatermark(event_time, lateness)
    if salts > 1:
        salt = F.pmod(F.xxhash64(*stream.columns), F.lit(salts))
        marked = marked.withColumn("_salt", salt).dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def stream_latest(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str, tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per key and day of ``event_time``, for a query in update mode.

    Every trigger gives the rows that changed, each the newest so far of its key and day; ties go to the greatest ``tie``
    columns. The state keeps one row per key of the days that the watermark has not passed. A row that comes more than
    ``lateness`` after the newest event is dropped.
    """
    order = F.struct(event_time, *tie)
    whole = F.struct(*[c for c in stream.columns if c not in keys])
    day = F.window(event_time, "1 day").alias("_day")
    newest = stream.withWatermark(event_time, lateness).groupBy(day, *keys).agg(F.max_by(whole, order).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in stream.columns])


def stream_to_state(updates: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run an update-mode aggregate over what has arrived; ``on_batch`` must be idempotent, a failed batch comes again."""
    return (
        updates.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
