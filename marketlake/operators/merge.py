"""Keyed merges over plain DataFrames, with the semantics of SQL MERGE."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Row = Callable[[str], Column]


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pass the rows through; the job fails if a key occurs twice or holds a NULL.

    The window wants the same partitioning and order as a sort-merge join on the
    keys, so in front of such a join it adds no shuffle.
    """
    seen = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    shown = F.to_json(F.struct(*keys))
    twice = F.raise_error(F.concat(F.lit("duplicate merge key: "), shown)).cast("boolean")
    unset = F.raise_error(F.concat(F.lit("merge key with a NULL: "), shown)).cast("boolean")
    return (
        df.withColumn("_seen", seen)
        .where(F.when(~_all_set(keys), unset).when(F.col("_seen") > 1, twice).otherwise(F.lit(True)))
        .drop("_seen")
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    when_newer: Callable[[Row, Row], Column],
    set_exprs: Mapping[str, Callable[[Row, Row], Column]] | None = None,
    when_older: Mapping[str, Callable[[Row, Row], Column]] | None = None,
) -> DataFrame:
    """``target`` after merging ``source``: update matched rows that pass ``when_newer``, insert the rest.

    ``when_newer`` and the update rules get accessors ``s`` and ``t`` for the source's and the
    target's columns. A column without a rule takes the source's value. ``when_older`` holds
    rules for matched rows that fail ``when_newer`` (by default these stay as they are).
    Keys hold no NULL: a NULL matches nothing, so a replayed row would be inserted again. The
    job fails on such source rows; set them aside before.
    """
    set_exprs = dict(set_exprs or {})
    when_older = dict(when_older or {})
    columns = target.columns
    values = [c for c in columns if c not in keys]
    source = source.select(*columns)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*values).alias(name))

    joined = side(target, "_t").join(side(assert_unique(source, keys), "_s"), list(keys), "full_outer")

    def s(name: str) -> Column:
        return F.col(name) if name in keys else F.col("_s")[name]

    def t(name: str) -> Column:
        return F.col(name) if name in keys else F.col("_t")[name]

    newer = F.coalesce(when_newer(s, t), F.lit(False))

    def merged(name: str) -> Column:
        updated = set_exprs[name](s, t) if name in set_exprs else s(name)
        kept = when_older[name](s, t) if name in when_older else t(name)
        return (
            F.when(F.col("_t").isNull(), s(name))
            .when(F.col("_s").isNull(), t(name))
            .when(newer, updated)
            .otherwise(kept)
            .cast(target.schema[name].dataType)
            .alias(name)
        )

    return joined.select([F.col(c) if c in keys else merged(c) for c in columns])


def merge_insert_only(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    bound_by: str | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Source rows whose key the target does not hold, ready to append.

    ``source`` must hold one row per key; rows with a NULL in their key are left out, as they
    would come again with every replay. ``bound_by`` names a key column, usually the
    target's partition column: the target is then read only between the batch's smallest
    and largest value of it. ``bounds`` may hand in a frame that has the same column and
    range but costs less than ``source`` to work out, such as the batch before deduplication.
    """
    known = target.select(*keys)
    if bound_by is not None:
        span = source if bounds is None else bounds
        low = span.agg(F.min(bound_by)).scalar()
        high = span.agg(F.max(bound_by)).scalar()
        known = known.where(F.col(bound_by).between(low, high))
    return source.where(_all_set(keys)).join(known, list(keys), "left_anti").select(*source.columns)
