"""Near-duplicate groups by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits in four segments of 16. Two fingerprints at two or fewer differing bits either differ within
one segment, so that the other three are equal, or in one bit each of two segments. Hence there is one table for each
segment q, keyed by the three other segments. It is probed with the fingerprint's own key, and with the keys in the
Hamming ball of radius 1 of one of the others. Each pair of segments is served by one table. A bit in which two
fingerprints differ is 0 in exactly one of them, so only zero bits are flipped. All matches are verified on all 64
bits.

Equal fingerprints are one entry, so exact copies cost nothing. A bucket holds only fingerprints that share 48 bits,
so its size has a bound (65,536) however large the corpus or a group of copies is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import TEXT_KEY, connected, same_row, stored, text_key

SEGMENT_BITS = 16
SEGMENTS = 4
#: (table, probed segment): each unordered pair of different segments once.
BALLS = ((0, 1), (1, 2), (2, 3), (3, 0), (0, 2), (1, 3))

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SEED = 42
_ROWS = 4096  # shingles whose bits are summed at once


def fingerprint(text: str | None, words: int = 3) -> int:
    """Signed 64-bit SimHash of a text's word shingles; 0 without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, _SEED)]
    else:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(tokens) - words + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], _SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    digests = np.array(hashes, dtype=np.uint64).astype(">u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(digests), _ROWS):
        bits = np.unpackbits(digests[i : i + _ROWS].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(digests)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, text key, fingerprint) of every row, whatever its text; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.int64())],
                names=["doc_id", TEXT_KEY, "fingerprint"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias(TEXT_KEY), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, {TEXT_KEY} long, fingerprint long")


def _mask(segment: int) -> int:
    """Signed mask of all bits but the segment's."""
    bits = ~(((1 << SEGMENT_BITS) - 1) << (segment * SEGMENT_BITS)) & ((1 << 64) - 1)
    return bits - (1 << 64) if bits >> 63 else bits


def _signed(bit: int) -> int:
    return -(1 << 63) if bit == 63 else 1 << bit


def _flips() -> Column:
    """Every flip of the balls: table, the mask of its key, the bit."""
    return F.array(*[
        F.struct(F.lit(table).cast("byte").alias("q"), F.lit(_mask(table)).alias("mask"), F.lit(_signed(bit)).alias("flip"))
        for table, segment in BALLS
        for bit in range(segment * SEGMENT_BITS, (segment + 1) * SEGMENT_BITS)
    ])


def _masks() -> Column:
    return F.array(*[
        F.struct(F.lit(q).cast("byte").alias("q"), F.lit(_mask(q)).alias("mask")) for q in range(SEGMENTS)
    ])


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(low, high): every pair of different fingerprints at ``max_bits`` (0 to 2) or fewer bits, once."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the tables find pairs of up to 2 differing bits")
    key = F.expr("b & k.mask").alias("key")
    table = prints.select(F.col("fingerprint").alias("b"), F.explode(_masks()).alias("k")).select("k.q", key, "b")
    probe = (
        prints.select(F.col("fingerprint").alias("a"), F.explode(_flips()).alias("k")).where("a & k.flip = 0")
        .select("k.q", F.expr("a & k.mask | k.flip").alias("key"), "a", F.lit(False).alias("own"))
    ).union(table.select("q", "key", F.col("b").alias("a"), F.lit(True)))
    match = probe.join(table, ["q", "key"]).where("not own or a < b")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    once = F.col("own") | (differing == 2)  # pairs at 1 bit are also met as members of a ball
    return match.where((differing > 0) & (differing <= max_bits) & once).select(
        F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    )


def _rooted_groups(docs: DataFrame, words: int, max_bits: int) -> DataFrame:
    """The rows of ``near_duplicate_groups`` with ``root``: the fingerprint that identifies the component, never null."""
    rows = stored(fingerprints(docs, words), "fingerprints")
    prints = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    roots = connected(links(prints, max_bits))
    entries = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    smallest = entries.groupBy("root").agg(F.min("first").alias("component_id"))
    found = stored(entries.join(smallest, "root").select("fingerprint", "component_id", "root"), "components")
    return rows.join(found, "fingerprint").select("doc_id", TEXT_KEY, "fingerprint", "component_id", "root")


def near_duplicate_groups(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document row: doc_id, text key, fingerprint (long) and component_id.

    Documents are linked when their fingerprints differ in ``max_bits`` or fewer bits; component_id is the smallest
    doc_id that links lead to. A null or empty text has fingerprint 0 and links like any other. Rows that repeat a
    doc_id are rows of their own. A null doc_id stays null and counts for no component_id unless a whole component has
    none (then component_id is null). An empty table gives no rows.
    """
    return _rooted_groups(docs, words, max_bits).drop("root")


def drop_near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents' columns, with one row of each group: that of the smallest doc_id, then the smallest text key.

    Groups are told apart by their fingerprints, since different ones may hold the same doc_id or none.
    """
    groups = stored(_rooted_groups(docs, words, max_bits), "groups")
    ordered = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", TEXT_KEY)
    first = groups.groupBy("root").agg(F.min(ordered).alias("keep")).select("keep.doc_id", f"keep.{TEXT_KEY}")
    rows = docs.withColumn(TEXT_KEY, text_key())
    kept = rows.join(first, same_row(rows, first), "left_semi")
    return kept.dropDuplicates(["doc_id", TEXT_KEY]).drop(TEXT_KEY)
