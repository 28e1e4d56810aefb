"""Fingerprints by context-triggered piecewise hashing, and the likeness of documents to their successors.

A rolling hash over seven bytes ends a chunk where it meets a block size's trigger, so boundaries move with the text
around an edit. A signature has one base-64 digit per chunk, from a hash of the chunk; a fingerprint holds the block
size, the signature at that size and the one at twice the size. Signatures are compared by edit distance where block
sizes are equal or one step apart.

Successors come from one range partitioning by id: partitions are streamed in order, each row meets the next one, and
only the ends of partitions, of which there are two for each, meet in a small second step.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

WINDOW = 7
SMALLEST = 3  # block size
CHUNKS = 64  # wanted at most in a signature
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_FACTOR = 0x9E3779B1
_WEIGHTS = [pow(_FACTOR, k + 1, 1 << 32) for k in range(WINDOW)]
_SLICE = 1 << 20


def rolling(data: bytes) -> np.ndarray:
    """Hash of the last seven bytes at every position."""
    values = np.frombuffer(data, dtype=np.uint8)
    out = np.empty(len(values), dtype=np.uint32)
    for at in range(0, len(values), _SLICE):
        begin = max(0, at - WINDOW + 1)
        part = values[begin : at + _SLICE].astype(np.uint32) + np.uint32(1)
        total = part * np.uint32(_WEIGHTS[0])
        for k in range(1, WINDOW):
            total[k:] += part[:-k] * np.uint32(_WEIGHTS[k])
        total ^= total >> np.uint32(15)
        total *= np.uint32(0x85EBCA6B)
        total ^= total >> np.uint32(13)
        out[at : at + _SLICE] = total[at - begin :]
    return out


def _signature(data: bytes, hashes: np.ndarray, block: int) -> tuple[str, bool]:
    """The signature at a block size, and whether it has a digit for every chunk."""
    ends = (np.flatnonzero(hashes % np.uint32(block) == block - 1) + 1).tolist()
    if not ends or ends[-1] < len(data):
        ends.append(len(data))
    whole = len(ends) <= CHUNKS
    if not whole:
        ends = [*ends[: CHUNKS - 1], len(data)]  # the last chunk is the rest
    return "".join([_DIGITS[zlib.crc32(data[a:b]) & 63] for a, b in zip([0, *ends], ends)]) if data else "", whole


def fingerprint(text: str) -> str:
    """block size:signature:signature at twice the block size:..., of a whole text.

    The first block size (3 times a power of two) follows from the length, so that 32 to 64 chunks are to be expected, and
    is halved once if there are no more than 32. Texts of about the same length then have neighbouring sizes, whatever
    their chunks are. Sizes double until two signatures have a digit for every chunk; of ordinary texts these are the
    first two. A signature has at most 64 digits; where a text has more chunks its last digit stands for the rest.
    """
    data = text.encode("utf-8", "surrogatepass")
    hashes = rolling(data)
    block = SMALLEST
    while block * CHUNKS < len(data):
        block *= 2
    if block > SMALLEST and len(_signature(data, hashes, block)[0]) <= CHUNKS // 2:
        block //= 2
    parts, size, whole = [str(block)], block, 0
    while whole < 2:
        signature, complete = _signature(data, hashes, size)
        parts.append(signature)
        whole, size = whole + complete, 2 * size
    return ":".join(parts)


def likeness(a: str | Column, b: str | Column) -> Column:
    """0 to 1 of two fingerprints' columns; 1 if they are equal, 0 if no block size is in both.

    One minus the edit distance of signatures of the same block size over the longer one's length, the best of them.
    Signatures that stand for whole texts on both sides count, others only where there are none.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    parts = F.struct(F.split(a, ":", -1).alias("a"), F.split(b, ":", -1).alias("b"))

    def of(p: Column) -> Column:
        (x, n), (y, m) = ((p[side], F.size(p[side]) - 1) for side in ("a", "b"))
        # Place i of the one is place i - ahead of the other; place 0 holds the block size.
        ahead = F.round(F.log2(y[0].cast("double") / x[0].cast("double"))).cast("int")
        first, last = F.greatest(F.lit(1), 1 + ahead), F.least(n, m + ahead)
        whole = F.greatest(first, n - 1, m - 1 + ahead)

        def like(i: Column) -> Column:
            one, other = F.get(x, i), F.get(y, i - ahead)
            longer = F.greatest(F.length(one), F.length(other))
            return F.when(longer > 0, 1 - F.levenshtein(one, other) / longer).otherwise(F.lit(1.0))

        begin = F.when(whole <= last, whole).otherwise(first)
        return F.when(first > last, F.lit(0.0)).otherwise(F.array_max(F.transform(F.sequence(begin, last), like)))

    both = F.transform(F.array(parts), of)[0]
    return F.when(a == b, F.lit(1.0)).otherwise(both)


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many of what follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_ROW = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "next_fingerprint string, place string, text string, tie long, part int"
)


def _finished(doc_id, text: str, own: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own, fingerprint(changed) if changed != text else own, next_print


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their successors; of a partition's first and last row also the texts, to be joined to others."""
    columns = [field.split()[0] for field in _SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 4, pa.string(), pa.string(), pa.int64(), pa.int32()]
    part = TaskContext.get().partitionId()
    last = None  # id, tie, text, fingerprint

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns
        )

    for batch in batches:
        rows = []
        for doc_id, tie, text in zip(*(batch.column(i) for i in range(3))):
            text = text.as_py() or ""
            row = (doc_id.as_py(), tie.as_py(), text, fingerprint(text))
            if last is None:
                rows.append((row[0], None, None, row[3], None, None, "head", text, row[1], part))
            else:
                rows.append((*_finished(last[0], last[2], last[3], text, row[3]), None, None, None, None))
            last = row
        if rows:
            yield batch_of(rows)
    if last is not None:
        yield batch_of([(last[0], None, None, last[3], None, None, "tail", last[2], last[1], part)])


def _join_ends(ends: DataFrame) -> DataFrame:
    """The last rows of partitions with the first row of the next one, or of the first one after the last.

    There are two rows for each partition. Only their ids and partition numbers are put in order together; texts are
    joined to them by these numbers.
    """
    order = Window.orderBy("has_id", "doc_id", "tie", "turn", "part")
    names = ends.select(
        F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "tie",  # rows without an id come first
        F.when(F.col("place") == "head", 0).otherwise(1).alias("turn"), "part",
    )
    first = F.first(F.when(F.col("turn") == 0, F.col("part")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    next_part = F.coalesce(F.lead("part").over(order), first).alias("next_part")
    following = names.select("turn", "part", next_part).where("turn = 1").drop("turn")
    tails = ends.where("place = 'tail'").select("doc_id", "text", "fingerprint", "part")
    heads = ends.where("place = 'head'").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    return tails.join(following, "part").join(heads, "next_part").drop("part", "next_part")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_finished(*row.values()) for row in (
            {k: r[k] for k in ("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")}
            for r in batch.to_pylist()
        )]
        if rows:
            types = [pa.int64(), pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_ROW)


def with_successors(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next row by doc_id, then by a hash of the text; the first follows the last, so a
    single row follows itself. Rows without an id come first. A null text is empty; an empty text has the fingerprint
    "3::", and two of them are alike. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    walked = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_walk, _SCHEMA), "successors"
    )
    inner = walked.where("place is null").select(*_ROW)
    schema = ", ".join(_SCHEMA.split(", ")[: len(_ROW)])
    outer = _join_ends(walked.where("place is not null")).mapInArrow(_finish, schema)
    return inner.union(outer).select(
        *_ROW[:-1], likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
