"""Landing datasets and tables on Parquet."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schemas import LANDING, conform


def read_landing(
    spark: SparkSession, root: str, dataset: str, schema: T.StructType | None = None
) -> DataFrame:
    """Every file of one landing dataset, without the folder columns."""
    schema = schema or LANDING[dataset]
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/{dataset}")


def read_landing_day(
    spark: SparkSession, root: str, dataset: str, day: date, schema: T.StructType | None = None
) -> DataFrame:
    """One run day; its folder is the only one listed."""
    schema = schema or LANDING[dataset]
    return spark.read.schema(schema).parquet(f"{root}/{dataset}/{day:year=%Y/month=%m/day=%d}")


def read_foreign_landing(
    spark: SparkSession, paths: Sequence[str], dataset: str, schema: T.StructType | None = None
) -> DataFrame:
    """Files of other writers whose column types drift between run days.

    A column that a day wrote as all NULL has another Parquet type there, which one common
    schema rejects. Paths whose files have the same columns and types are read together, cast
    to ours and unioned by name: the plan has one read for each set of types, not for each day.
    """
    schema = schema or LANDING[dataset]
    alike: dict[str, list[str]] = {}
    for path in paths:
        found = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
        alike.setdefault(found.json(), []).append(path)
    frames = []
    for found, group in alike.items():
        reader = spark.read.schema(T.StructType.fromJson(json.loads(found)))
        df = reader.option("recursiveFileLookup", "true").parquet(*group)
        missing = [f for f in schema.fields if f.name not in df.columns]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df
        frames.append(conform(df, schema))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame and an observation that holds its row count once an action has run.

    The count rides along with that action; the data is not read a second time.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def read_table(spark: SparkSession, name_or_path: str, format: str | None = None) -> DataFrame:
    """Files of a format at a path; without one a catalog table by name, or Parquet files if the name has a slash."""
    if format is not None:
        return spark.read.format(format).load(name_or_path)
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
