"""Tables that a stream's batches keep up to date on plain Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schemas import conform
from marketlake.sinks.writers import append_rows

BUCKETS = 32


def _fs_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs_path(spark, path)
    return fs.exists(where)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _drop(spark: SparkSession, path: str) -> None:
    fs, where = _fs_path(spark, path)
    fs.delete(where, True)


class MissingCommit(RuntimeError):
    """Data of an earlier batch is there, but not its commit."""


#: A commit: for each bucket the batch that wrote it last and its row count; bucket -1 stands for the commit itself.
_COMMIT = "buckets int, bucket int, written bigint, rows bigint, batch bigint"


class KeyedTable:
    """A keyed table in hash buckets of its keys; a batch rewrites the buckets it touches.

    Spark writes ``data/batch=<id>/bucket=<n>``, what a batch stored, and after it ``commits/batch=<id>``, a Parquet
    table of one file with a row per bucket. What a batch starts from is the newest commit before its own, so one that
    is replayed after a crash starts from the same input and replaces its own output only. Batch ids come from the
    stream's checkpoint: keep table and checkpoint together. The number of buckets is set by the first commit.
    """

    def __init__(self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.buckets = buckets

    def _data(self, batch: int) -> str:
        return f"{self.path}/data/batch={batch:012d}"

    def _commits(self, spark: SparkSession) -> DataFrame:
        """Rows of all commits; a commit whose only file is not there yet has none."""
        where = f"{self.path}/commits"
        if not path_exists(spark, where):
            return spark.createDataFrame([], _COMMIT)
        return spark.read.schema(_COMMIT).parquet(where)

    def batches(self, spark: SparkSession) -> list[int]:
        """Committed batches, oldest first."""
        return sorted(r["batch"] for r in self._commits(spark).select("batch").distinct().collect())

    def _newest(self, spark: SparkSession, before: int | None) -> list[Row]:
        """Rows of the newest commit before a batch, at most one per bucket. Data between the two must not be."""
        commits = self._commits(spark)
        usable = commits if before is None else commits.where(F.col("batch") < before)
        rows = usable.where(F.col("batch") == usable.agg(F.max("batch")).scalar()).collect()
        newest = rows[0]["batch"] if rows else -1
        written = [int(n[len("batch="):]) for n in _names(spark, f"{self.path}/data") if n.startswith("batch=")]
        lost = [b for b in written if newest < b and (b < before if before is not None else newest < 0)]
        if lost:
            raise MissingCommit(f"{self.path} holds data of batch {lost[-1]} without its commit")
        return rows

    def bucket_of(self, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets or self.buckets)).cast("int")

    def n_buckets(self, spark: SparkSession, before: int | None = None) -> int:
        commit = self._newest(spark, before)
        return commit[0]["buckets"] if commit else self.buckets

    def touched(self, df: DataFrame, before: int | None = None) -> list[int]:
        """Buckets that hold keys of ``df``: at most as many numbers as there are buckets."""
        bucket = self.bucket_of(self.n_buckets(df.sparkSession, before))
        return sorted(r[0] for r in df.select(bucket.alias("bucket")).distinct().collect())

    def read(
        self, spark: SparkSession, before: int | None = None, only: Sequence[int] | None = None
    ) -> DataFrame:
        """The table after the newest batch, or after the newest one earlier than ``before``; ``only`` some buckets."""
        folders = [
            f"{self._data(r['written'])}/bucket={r['bucket']}" for r in self._newest(spark, before)
            if r["rows"] and (only is None or r["bucket"] in only)
        ]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*sorted(folders))

    def write(self, df: DataFrame, batch: int, only: Sequence[int] | None = None) -> int:
        """Store the new content of the buckets (all, or ``only`` some), commit, and return the table's row count."""
        spark = df.sparkSession
        newer = [b for b in self.batches(spark) if b > batch]
        if newer:
            raise ValueError(
                f"{self.path} holds batch {newer[-1]}, which is ahead of batch {batch}: "
                "the stream's checkpoint does not belong to this table"
            )
        commit = self._newest(spark, batch)
        buckets = commit[0]["buckets"] if commit else self.buckets
        rewritten = set(range(buckets) if only is None else only)
        places = [(r["bucket"], r["written"], r["rows"]) for r in commit if r["bucket"] not in {*rewritten, -1}]
        if rewritten:
            rows = conform(df, self.schema).withColumn("bucket", self.bucket_of(buckets))
            rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
                "bucket"
            ).parquet(self._data(batch))
            if any(n.startswith("bucket=") for n in _names(spark, self._data(batch))):
                stored = spark.read.parquet(self._data(batch)).groupBy("bucket").count().collect()
                places += [(r["bucket"], batch, r["count"]) for r in stored]
        # One small file, which Spark's committer renames into its place as the last step.
        spark.createDataFrame(
            [(buckets, *place) for place in [(-1, batch, 0), *places]], _COMMIT.removesuffix(", batch bigint")
        ).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{self.path}/commits/batch={batch:012d}"
        )
        return sum(rows for *_, rows in places)

    def expire(self, spark: SparkSession, keep: int = 2) -> list[int]:
        """Drop all but the newest ``keep`` commits (two at least, for a replay) and the data none of them names."""
        committed = self.batches(spark)
        old, kept = committed[: -max(keep, 2)], committed[-max(keep, 2):]
        for batch in old:
            _drop(spark, f"{self.path}/commits/batch={batch:012d}")
        needed = {r["written"] for r in self._commits(spark).select("written").distinct().collect()}
        for name in _names(spark, f"{self.path}/data"):
            batch = int(name[len("batch="):]) if name.startswith("batch=") else None
            if batch is not None and batch not in needed and kept and batch < kept[-1]:
                _drop(spark, f"{self.path}/data/{name}")
        return old


class BatchTable:
    """Rows by the batch that brought them, one folder per batch, which a replay replaces."""

    def __init__(self, path: str, columns: str):
        self.path = path.rstrip("/")
        self.columns = columns

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows with their ``batch``."""
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], f"{self.columns}, batch bigint")
        return spark.read.schema(f"{self.columns}, batch bigint").parquet(self.path)

    def write(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/batch={batch:012d}")


class AppendTable:
    """A table that batches only add to, partitioned by date if it holds many rows per date.

    Batches append keys the table lacks, so a replayed batch adds what is still missing and
    nothing twice.
    """

    def __init__(self, path: str, schema: T.StructType, partition_by: str | None = None):
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by

    def read(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def append(self, df: DataFrame) -> int:
        """Add the rows and return how many there were."""
        return append_rows(conform(df, self.schema), self.path, self.partition_by)


class RejectTable:
    """Rows that a dataset's batches could not store, one folder per batch, which a replay replaces."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def read(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], "reason string, record string")
        return spark.read.schema("reason string, record string").option("recursiveFileLookup", "true").parquet(self.path)

    def write(self, df: DataFrame, batch: int) -> int:
        """Store the batch's rejects, if there are any, and return how many; counting reads the checked columns only."""
        rows = df.count()
        if rows:
            folder = f"{self.path}/batch={batch:012d}"
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
        return rows
