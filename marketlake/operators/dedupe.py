"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tiebreak: Sequence[str] = (),
    first_seen: tuple[str, str] | None = None,
) -> DataFrame:
    """The row with the greatest ``order_by`` (NULL lowest), then ``tiebreak``, for each key.

    Remaining columns settle any tie still left, so the answer never depends on row order.
    ``first_seen=(source, name)`` adds the key's smallest ``source``.

    One aggregate instead of windows: each task cuts its rows to one per key before the
    shuffle, so a key that owns a third of the input costs a reducer one row per task.
    """
    lead = [*order_by, *tiebreak]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    best = F.max(F.struct(*lead, *rest)).alias("_best")
    extra = [] if first_seen is None else [F.min(first_seen[0]).alias(first_seen[1])]
    picked = df.groupBy(*keys).agg(best, *extra)
    columns = [F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns]
    if first_seen is not None:
        columns.append(F.col(first_seen[1]))
    return picked.select(*columns)
