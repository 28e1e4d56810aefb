"""Lines that many documents share, dropped from all but one of them.

Lines are hashed (128 bits) and range-partitioned by hash, then document, then position, so that a line which a third
of all documents hold spreads over as many partitions as its rows need. Each partition is streamed in that order. A
group of equal lines that begins and ends inside a partition is decided there, with the rows of at most one document
held back. Only the first and last group of a partition can reach into another one: their rows are marked pending, and
a summary of up to three documents of each settles them. The result is a compressed bitmap of kept lines for every
document, never its text; ``apply_bitmaps`` turns texts into kept texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import TEXT_KEY, stored, text_key

MIN_CHARS = 20
MIN_DOCS = 3
_SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_NO_ID = -(1 << 63)  # stands for a null doc_id while lines are compared

_LINES = f"high long, low long, doc_id long, {TEXT_KEY} long, at long"
_NAMES = ["high", "low", "doc_id", TEXT_KEY, "at"]
_DROP, _PENDING, _SUMMARY = 0, 1, 2


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least or len(key) >= 4 * least:
        return len(key) >= least
    return len(key.decode("utf-8", "surrogatepass")) >= least


def _hash_lines(least: int):
    """A header row per document (no hash, number of lines), and a row per line that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, ats = [], [], []
            counts = np.empty(batch.num_rows, dtype=np.int64)
            for row, text in enumerate(batch.column(2)):
                lines = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b"\n")
                counts[row] = len(lines)
                for at, line in enumerate(lines):
                    key = line.strip(_SPACE)
                    if _long_enough(key, least):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        ats.append(at)
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, batch.column(0), batch.column(1), pa.array(counts)], names=_NAMES
            )
            halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            rows = np.array(rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (halves[:, 0].copy(), halves[:, 1].copy(), ids[rows], keys[rows],
                                       np.array(ats, dtype=np.int64))],
                names=_NAMES,
            )

    return run


def _marked(kind: int, cols: list[np.ndarray]) -> pa.RecordBatch:
    kinds = pa.array(np.full(len(cols[0]), kind, dtype=np.int8))
    return pa.RecordBatch.from_arrays([kinds, *map(pa.array, cols)], names=["kind", *_NAMES])


def _changes(*cols: np.ndarray) -> np.ndarray:
    """Whether each row but the first differs from the one before; the first counts as different."""
    out = np.ones(len(cols[0]), dtype=bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return out


class _OpenGroup:
    """The group of equal lines that the rows read so far end with."""

    def __init__(self, least_docs: int, first: bool):
        self.least, self.first = least_docs, first
        self.key, self.count, self.last, self.docs = None, 0, None, []
        self.held: list[list[np.ndarray]] = []  # lines of later documents, while there are too few documents

    def add(self, cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        doc = cols[2]
        new = _changes(doc)
        new[0] = self.last is None or doc[0] != self.last
        rank = self.count + np.cumsum(new)
        self.key, self.count, self.last = (cols[0][0], cols[1][0]), int(rank[-1]), doc[-1]
        self.docs = (self.docs + doc[new][: self.least].tolist())[: self.least]
        if self.first:
            yield _marked(_PENDING, cols)
            return
        self.held.append([c[rank >= 2] for c in cols])
        if self.count >= self.least:
            yield from (_marked(_DROP, part) for part in self.held)
            self.held = []

    def reaching_out(self) -> Iterator[pa.RecordBatch]:
        """Of a group that other partitions may hold lines of."""
        yield from (_marked(_PENDING, part) for part in self.held)
        n = len(self.docs)
        nothing = np.zeros(n, dtype=np.int64)
        yield _marked(_SUMMARY, [np.full(n, self.key[0]), np.full(n, self.key[1]),
                                 np.array(self.docs, dtype=np.int64), nothing, nothing])


def _drops_inside(cols: list[np.ndarray], least_docs: int) -> np.ndarray:
    """Rows to drop from whole groups."""
    group, new = _changes(*cols[:2]), _changes(*cols[:3])
    begins, number, seen = np.flatnonzero(group), np.cumsum(group) - 1, np.cumsum(new)
    rank = seen - (seen[begins] - 1)[number]
    totals = rank[np.append(begins[1:], len(number)) - 1]
    return (totals >= least_docs)[number] & (rank >= 2)


def _decide(least_docs: int):
    """Decisions for lines that come sorted by hash, document (largest first) and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _OpenGroup(least_docs, first=True)
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            while len(cols[0]):
                begins = np.flatnonzero(_changes(*cols[:2]))
                if group.key in (None, (cols[0][0], cols[1][0])):  # the open group goes on
                    end = begins[1] if len(begins) > 1 else len(cols[0])
                    yield from group.add([c[:end] for c in cols])
                else:  # it ended; all groups here but the last are whole
                    if group.first:
                        yield from group.reaching_out()
                    end = begins[-1]
                    whole = [c[:end] for c in cols]
                    if end:
                        drop = _drops_inside(whole, least_docs)
                        yield _marked(_DROP, [c[drop] for c in whole])
                    group = _OpenGroup(least_docs, first=False)
                cols = [c[end:] for c in cols]
        if group.key is not None:
            yield from group.reaching_out()

    return run


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text key, number of lines) of every document, and (doc_id, text key, at) of every dropped line."""
    texts = docs.select(F.col("doc_id").cast("long"), text_key().alias(TEXT_KEY), F.col("text").cast("string"))
    lines = stored(
        texts.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), TEXT_KEY, "text")
        .mapInArrow(_hash_lines(min_chars), _LINES), "lines",
    )
    order = [F.col("high"), F.col("low"), F.col("doc_id").desc(), F.col(TEXT_KEY), F.col("at")]
    marks = stored(
        lines.where("high is not null").repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_decide(min_docs), f"kind byte, {_LINES}"), "line-marks",
    )
    # At most two groups of a partition, and min_docs rows of each.
    reaching = marks.where(F.col("kind") == _SUMMARY).groupBy("high", "low").agg(
        F.max("doc_id").alias("largest"), F.count_distinct("doc_id").alias("n_docs")
    ).where(F.col("n_docs") >= min_docs)
    pending = marks.where(F.col("kind") == _PENDING).join(F.broadcast(reaching), ["high", "low"])
    drops = marks.where(F.col("kind") == _DROP).select("doc_id", TEXT_KEY, "at").union(
        pending.where("doc_id < largest").select("doc_id", TEXT_KEY, "at")
    )
    headers = lines.where("high is null").groupBy("doc_id", TEXT_KEY).agg(F.max("at").alias("n_lines"))
    return headers, drops


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, text key, n_lines, n_dropped and keep_bitmap (zlib of one bit a line, 1 kept).

    A line's key is the line without white space at its ends, A-Z lower-cased. A key of ``min_chars`` code points or
    more that ``min_docs`` documents or more hold stays only in the document of the largest doc_id. A null or empty
    text is one empty line. Rows that share a doc_id count as one document, and so do all rows without one, which come
    before any id; equal rows share one bitmap. An empty table gives no rows.
    """
    headers, drops = dropped_lines(docs, min_chars, min_docs)
    ats = drops.groupBy("doc_id", TEXT_KEY).agg(F.collect_set("at").alias("ats"))

    @F.pandas_udf("binary")
    def bitmap(n_lines: pd.Series, ats: pd.Series) -> pd.Series:
        out = []
        for n, at in zip(n_lines, ats):
            keep = np.ones(n, dtype=bool)
            if at is not None:
                keep[np.asarray(at, dtype=np.int64)] = False
            out.append(zlib.compress(np.packbits(keep).tobytes()))
        return pd.Series(out, dtype=object)

    joined = headers.join(ats, ["doc_id", TEXT_KEY], "left")
    return joined.select(
        F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), TEXT_KEY, "n_lines",
        F.coalesce(F.size("ats"), F.lit(0)).cast("long").alias("n_dropped"),
        bitmap("n_lines", "ats").alias("keep_bitmap"),
    )


def kept_text(text: str | None, n_lines: int, bitmap: bytes) -> str | None:
    """The kept lines of a text, joined again."""
    if text is None:
        return None
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines)
    return text if keep.all() else "\n".join(line for line, k in zip(text.split("\n"), keep) if k)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents with their kept text; all other columns as they are, with n_lines and n_dropped after them."""

    @F.pandas_udf("string")
    def kept(text: pd.Series, n_lines: pd.Series, bitmap: pd.Series) -> pd.Series:
        return pd.Series([kept_text(t, n, b) for t, n, b in zip(text, n_lines, bitmap)], dtype=object)

    maps = bitmaps.select(
        F.col("doc_id").alias("__llm_id"), F.col(TEXT_KEY).alias("__llm_key"), F.col("n_lines").alias("__llm_lines"),
        F.col("n_dropped").alias("__llm_dropped"), "keep_bitmap",
    )
    rows = docs.withColumn(TEXT_KEY, text_key())
    match = rows["doc_id"].eqNullSafe(maps["__llm_id"]) & (rows[TEXT_KEY] == maps["__llm_key"])
    text = F.when(
        F.col("__llm_dropped") > 0, kept(rows["text"], F.col("__llm_lines"), maps["keep_bitmap"])
    ).otherwise(rows["text"])
    return rows.join(maps, match).select(
        *[text.alias(c) if c == "text" else rows[c] for c in docs.columns],
        F.col("__llm_lines").alias("__llm_n_lines"), F.col("__llm_dropped").alias("__llm_n_dropped"),
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with their kept text; n_chars, where there is one, follows the text."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs)).drop("__llm_n_lines", "__llm_n_dropped")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns
    ) else out
