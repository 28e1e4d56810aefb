"""Landing and table writers on Parquet."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schemas import LANDING, PARTITION_COLUMNS, conform
from marketlake.sources.landing import counted


class EmptyWrite(RuntimeError):
    """A dataset that must not be empty was."""


def write_landing(
    df: DataFrame,
    root: str,
    dataset: str,
    run_date: date | str,
    on_empty: str = "skip",
    schema: T.StructType | None = None,
) -> int:
    """Write one run's records under ``year=/month=/day=`` and return how many there were.

    ``run_date`` is a date, or the name of a date column for a backfill of many days at
    once. A rerun replaces its days and no others; it writes new file names, which the
    streaming reader then notices. Rows are cast to the explicit schema, so a column that
    is all NULL keeps its type. With no rows nothing is written: ``on_empty="skip"``
    returns 0 and ``"fail"`` raises.
    """
    schema = schema or LANDING[dataset]
    day = F.col(run_date).cast("date") if isinstance(run_date, str) else F.lit(run_date)
    parts = {"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    rows = df.select(*typed, *[c.alias(name) for name, c in parts.items()])
    if isinstance(run_date, str):
        # Few files per day, while a day with much data still spreads over several tasks.
        rows = rows.hint("rebalance", *PARTITION_COLUMNS)
    rows, seen = counted(rows, f"landing_{dataset}")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(f"{root}/{dataset}")
    )
    written = seen.get["rows"]
    if written == 0 and on_empty == "fail":
        raise EmptyWrite(f"no {dataset} records to write")
    return written


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str,
                 partition_by: Sequence[str] = ()) -> None:
    """Create the database and an external Parquet table unless they exist."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioned} LOCATION '{path}'")


def replace_table(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Replace the whole table, also by an empty one."""
    out = df if schema is None else conform(df, schema)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Append in few, evenly filled files and return the row count.

    With ``partition_by`` there are few files per value, and large values are split.
    """
    columns = [partition_by] if partition_by else []
    rows, seen = counted(df.hint("rebalance", *columns), "append")
    rows.write.mode("append").partitionBy(*columns).parquet(path)
    return seen.get["rows"]


def preview(df: DataFrame) -> tuple[int, Row | None]:
    """Dry run: row count and one sample row (the smallest) from one pass, nothing written."""
    whole = F.struct(*df.columns)
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.min(whole).alias("sample")).first()
    return seen["n"], seen["sample"]


class RunLog:
    """Rows and seconds per dataset and stage of a run."""

    SCHEMA = "dataset string, stage string, rows bigint, seconds double"

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._entries: list[tuple[str, str, int | None, float]] = []

    def timed(self, dataset: str, stage: str, action, seen: Observation | None = None):
        """Run ``action`` and note how long it took and, if observed, how many rows it saw."""
        start = time.monotonic()
        result = action()
        seconds = time.monotonic() - start
        rows = seen.get["rows"] if seen is not None else None
        self._entries.append((dataset, stage, rows, seconds))
        return result

    def note(self, dataset: str, stage: str, rows: int | None, seconds: float) -> None:
        self._entries.append((dataset, stage, rows, seconds))

    def frame(self) -> DataFrame:
        return self._spark.createDataFrame(self._entries, self.SCHEMA)
