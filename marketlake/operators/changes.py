"""Change feeds with deletes: the newest change of every key by a sequence number.

A state keeps one row per key, also of deleted ones: its newest change's sequence number, whether that was a delete, and
the values. Taking the newest of two rows is associative and commutative, so changes may come in any order, twice, and
cut into any batches, and a late update never revives a key that a newer change deleted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQUENCE, DELETED = "_sequence", "_deleted"


def state_schema(schema: T.StructType) -> T.StructType:
    """A table's schema with the columns that its state needs besides."""
    return T.StructType([*schema.fields, T.StructField(SEQUENCE, T.LongType()), T.StructField(DELETED, T.BooleanType())])


def _values(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in (*keys, SEQUENCE, DELETED)]


def as_states(changes: DataFrame, keys: Sequence[str], sequence: str, is_delete: Column) -> DataFrame:
    """Changes as state rows. Deletes carry no values. Changes without a whole key or a sequence number are left out:
    they can't be put in order; :func:`unusable` gives them."""
    gone = F.coalesce(is_delete, F.lit(False))
    values = [F.when(~gone, F.col(c)).alias(c) for c in changes.columns if c not in (*keys, sequence)]
    usable = changes.where(~_unusable(keys, sequence))
    return usable.select(
        *keys, *values, F.col(sequence).cast("bigint").alias(SEQUENCE), gone.alias(DELETED)
    )


def _unusable(keys: Sequence[str], sequence: str) -> Column:
    missing = F.col(sequence).cast("bigint").isNull()
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def unusable(changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Changes that :func:`as_states` leaves out."""
    return changes.where(_unusable(keys, sequence))


def newest_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the greatest sequence number; of equal ones a delete, then the greatest values.

    One aggregate that reduces in each task first, so a key with very many changes costs a row per task.
    """
    columns = [F.col(SEQUENCE), F.col(DELETED), *[F.col(c) for c in _values(states.columns, keys)]]
    newest = states.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("_newest"))
    return newest.select(*[F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in states.columns])


def apply_states(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states after a batch of states."""
    return newest_states(target.unionByName(incoming.select(*target.columns)), keys)


def live(states: DataFrame) -> DataFrame:
    """The table: rows of keys whose newest change is no delete."""
    return states.where(~F.col(DELETED)).drop(SEQUENCE, DELETED)


def forget_deleted(states: DataFrame, before: int | Column) -> DataFrame:
    """Without the deleted keys whose delete came before a sequence number that no late change can be older than."""
    return states.where(~(F.col(DELETED) & (F.col(SEQUENCE) < before)))
