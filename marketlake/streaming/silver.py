"""Batch handlers that bring the silver tables up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from marketlake.operators import changes
from marketlake.plans import gold, silver
from marketlake.streaming.state import AppendTable, BatchTable, KeyedTable, RejectTable

Handler = Callable[[DataFrame, int], None]
Note = Callable[[int], None]
#: A batch's properties before they are merged, from those and the stored ones.
Enrich = Callable[[DataFrame, DataFrame], DataFrame]


def _ignore(rows: int) -> None:
    pass


def with_rejects(handle: Handler, dataset: str, table: RejectTable, noted: Note = _ignore) -> Handler:
    """Store and count the rows that can't be kept, then handle the batch."""

    def both(batch: DataFrame, batch_id: int) -> None:
        noted(table.write(silver.rejected(batch, dataset), batch_id))
        handle(batch, batch_id)

    return both


def upsert_properties(
    table: KeyedTable, normalise: bool = False, late_first_seen: bool = False, written: Note = _ignore,
    enrich: Enrich | None = None, keep: int | None = None, moved: BatchTable | None = None,
) -> Handler:
    """Merge each batch into the buckets of the property table that it touches.

    ``written`` gets the table's row count after each batch. ``enrich`` may add to the batch's
    properties; ``keep`` drops all but that many commits after each batch. ``moved`` keeps the
    properties whose area the batch changes, written before the table is.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        buckets = table.touched(silver.accepted(batch, "properties").select("prop_id"), before=batch_id)
        before = table.read(spark, before=batch_id, only=buckets)
        incoming = silver.incoming_properties(batch, normalise)
        if enrich is not None:
            incoming = enrich(incoming, before)
        merged = silver.merge_properties(before, incoming, late_first_seen)
        if moved is not None:
            moved.write(gold.moved_properties(before, merged), batch_id)
        written(table.write(merged, batch_id, buckets))
        if keep is not None:
            table.expire(spark, keep)

    return handle


def insert_prices(table: AppendTable, written: Note = _ignore, dates: BatchTable | None = None) -> Handler:
    """Append each batch's new (property, date) prices.

    ``dates`` keeps the dates of each batch, written before the prices are.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if dates is not None:
            dates.write(silver.incoming_prices(batch).select("date").distinct(), batch_id)
        stored = table.read(batch.sparkSession)
        written(table.append(silver.new_prices(stored, silver.incoming_prices(batch), batch)))

    return handle


def insert_index(table: AppendTable, written: Note = _ignore) -> Handler:
    """Append each batch's closes of new dates."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = table.read(batch.sparkSession)
        written(table.append(silver.new_index_rows(stored, silver.incoming_index(batch), batch)))

    return handle


def apply_changes(
    table: KeyedTable, sequence: str, is_delete: Callable[[], Column], written: Note = _ignore, keep: int | None = None
) -> Handler:
    """Apply each batch of a change feed to the buckets of a state table that it touches.

    The table's schema is :func:`changes.state_schema` of the data's. Batches may come in any order and more than once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        incoming = changes.newest_states(changes.as_states(batch, table.keys, sequence, is_delete()), table.keys)
        buckets = table.touched(incoming.select(*table.keys), before=batch_id)
        before = table.read(batch.sparkSession, before=batch_id, only=buckets)
        written(table.write(changes.apply_states(before, incoming, table.keys), batch_id, buckets))
        if keep is not None:
            table.expire(batch.sparkSession, keep)

    return handle
