"""Passages of many words that repeat within or across documents, found by seed and extend.

Seeds: of all windows of ``words`` words a winnowed anchor stands for each, the ``ANCHOR``-word sequence of smallest hash
in it (the first of equal ones). Neighbouring windows mostly share their anchor, so an anchor with the run of windows it
stands for is one row, about one for seven words, and equal windows have equal anchors at the same place.

Join: runs are range-partitioned by anchor, then by a hash of all words of the run, then by document and place, and
streamed in that order. Runs of an anchor that occurs once are no repeats. Of runs that agree in all their words, the
first stays and the others are repeats as a whole, without pairs being made. Only where an anchor has runs with
different words (at the ends of a passage, or where a phrase has many contexts), their first occurrences go on; so do
runs at the ends of partitions, whose neighbours are elsewhere.

Extend: these are joined to their documents and extended from the anchor to the left and right, to every window of the
run. Windows are compared by anchor and words; all but the first of equal ones are repeats. Repeats that touch or overlap
merge to maximal ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import TEXT_KEY, finished, stored, text_key

WORDS = 20
ANCHOR = 8
_SLICE = 1 << 20  # bytes that are split into words at once
_SPACE = b" \t\n\x0b\x0c\r"
_NO_ID = -(1 << 63)  # stands for a null doc_id, so such rows come first
_SHIFT = 6  # bits of a place that hold the number of windows of a run

# Odd multipliers of three independent polynomial hashes modulo 2**64.
_ANCHOR_BASE, _RUN_BASE, _WINDOW_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93

_ROW = ["doc_id", TEXT_KEY, "place"]
_RUN = f"anchor long, run long, doc_id long, {TEXT_KEY} long, place long"
_REPEAT, _OPEN = 0, 1


def word_hashes(text: str) -> np.ndarray:
    """64 bits of every word, the words being cut at ASCII white space."""
    data = text.encode("utf-8", "surrogatepass")
    parts, begin = [], 0
    while begin < len(data):
        end = min(begin + _SLICE, len(data))
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        found = data[begin:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))
        begin = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Spans:
    """Hashes of any span of a sequence of word hashes."""

    def __init__(self, hashes: np.ndarray, base: int):
        def powers(of: int) -> np.ndarray:
            steps = np.full(len(hashes) + 1, of, dtype=np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        self.back = powers(pow(base, -1, 1 << 64))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(base)[:-1], dtype=np.uint64)])

    def of(self, begin: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mixed((self.sums[begin + length] - self.sums[begin]) * self.back[begin])


def runs_of(hashes: np.ndarray, words: int = WORDS, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Anchor hash, hash of all words, first window and number of windows of every run of windows."""
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < words:
        return none, none, none, none
    reach = words - anchor + 1
    grams = _Spans(hashes, _ANCHOR_BASE).of(np.arange(len(hashes) - anchor + 1), anchor)
    spans = _Spans(hashes, _RUN_BASE)
    chosen = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(len(grams) - reach + 1)
    begins = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    counts = np.diff(np.append(begins, len(chosen)))
    whole = _mixed(spans.of(begins, counts + (words - 1)) + counts.astype(np.uint64))
    return grams[chosen[begins]].view(np.int64), whole.view(np.int64), begins, counts


def _find_runs(words: int, anchor: int):
    """Runs of every document; equal rows of a task are read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            found, rows = [], []
            ids, keys = (batch.column(i).to_numpy() for i in (0, 1))
            for row, text in enumerate(batch.column(2)):
                if (same := (int(ids[row]), int(keys[row]))) in seen:
                    continue
                seen.add(same)
                anchors, wholes, begins, counts = runs_of(word_hashes(text.as_py() or ""), words, anchor)
                if len(begins):
                    found.append((anchors, wholes, (begins << _SHIFT) | counts))
                    rows.append(np.full(len(begins), row))
            if found:
                anchors, wholes, places = (np.concatenate(x) for x in zip(*found))
                row = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchors, wholes, ids[row], keys[row], places)],
                    names=["anchor", "run", *_ROW],
                )

    return run


def _differs(cols: list[np.ndarray], before: tuple | None) -> np.ndarray:
    """Whether each row differs from the one before, the first one from ``before``."""
    out = np.ones(len(cols[0]), dtype=bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    out[0] = before != tuple(int(c[0]) for c in cols)
    return out


def _marked(kind: int, cols: list[np.ndarray]) -> pa.RecordBatch:
    kinds = pa.array(np.full(len(cols[0]), kind, dtype=np.int8))
    return pa.RecordBatch.from_arrays([kinds, *map(pa.array, cols)], names=["kind", "anchor", *_ROW])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of runs sorted by anchor, words, document and place: repeats, and those that only their windows can settle.

    The first row of equal words is a repeat of nothing here. It is left out if its anchor has no other words, and goes
    on if it has, or if the anchor is the first or last one of the partition. One such row at most is held back.
    """
    before_row, before_run, anchor, held = None, None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy() for i in range(5)]
        new_row, new_run = _differs(cols, before_row), _differs(cols[:2], before_run)
        before_row, before_run = (tuple(int(c[-1]) for c in cols[:n]) for n in (5, 2))
        again = new_row & ~new_run
        yield _marked(_REPEAT, [cols[i][again] for i in (0, 2, 3, 4)])
        firsts = [cols[i][new_run] for i in (0, 2, 3, 4)]
        if not len(firsts[0]):
            continue
        begins = np.flatnonzero(_differs(firsts[:1], None))
        sizes = np.diff(np.append(begins, len(firsts[0])))
        several = sizes > 1
        if anchor is None:
            several[0] = True
        elif firsts[0][0] == anchor:
            several[0] = True
            if held is not None:
                yield _marked(_OPEN, held)
        goes_on = np.repeat(several, sizes)
        yield _marked(_OPEN, [c[goes_on] for c in firsts])
        anchor = firsts[0][-1]
        held = None if several[-1] else [c[begins[-1] :] for c in firsts]
    if held is not None:
        yield _marked(_OPEN, held)


def _extend(words: int):
    """Every window of a document's open runs: anchor, hash of the words, document and first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, text, runs in zip(*(batch.column(i) for i in range(4))):
                anchors = runs.values.field("anchor").to_numpy()
                places = runs.values.field("place").to_numpy()
                counts = places & ((1 << _SHIFT) - 1)
                total = int(counts.sum())
                first = np.repeat(np.cumsum(counts) - counts, counts)
                begins = np.repeat(places >> _SHIFT, counts) + np.arange(total) - first
                hashes = _Spans(word_hashes(text.as_py() or ""), _WINDOW_BASE).of(begins, words)
                fixed = [pa.array(np.full(total, x.as_py())) for x in (doc_id, key)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(anchors, counts)), pa.array(hashes.view(np.int64)), *fixed,
                     pa.array((begins << _SHIFT) | 1)],
                    names=["anchor", "window", *_ROW],
                )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text_key().alias(TEXT_KEY),
        F.col("text").cast("string").alias("text"),
    )


def repeated_windows(docs: DataFrame, words: int = WORDS, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, text key, place) of runs of windows whose words also start earlier; ``place`` is first window * 64 + number.

    Earlier is a smaller doc_id (null first), of rows that share one a smaller hash of the text, or an earlier start in
    the same row. Equal rows count as one.
    """
    if not 0 < anchor <= words < anchor + (1 << _SHIFT) - 1:
        raise ValueError("the anchor must be shorter than the window, by less than 63 words")
    texts = _texts(docs)
    order = ["anchor", "run", *_ROW]

    def settled() -> DataFrame:
        # Stored, since range partitioning reads its input twice; gone once the marks are there.
        runs = stored(texts.mapInArrow(_find_runs(words, anchor), _RUN), "runs")
        return runs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _settle, f"kind byte, anchor long, doc_id long, {TEXT_KEY} long, place long"
        )

    marks, _ = finished(docs.sparkSession, settled, "run-marks")
    held = marks.where(F.col("kind") == _OPEN).groupBy("doc_id", TEXT_KEY).agg(
        F.collect_list(F.struct("anchor", "place")).alias("runs")
    )
    windows = stored(
        texts.join(held, ["doc_id", TEXT_KEY]).select("doc_id", TEXT_KEY, "text", "runs")
        .mapInArrow(_extend(words), f"anchor long, window long, doc_id long, {TEXT_KEY} long, place long"), "windows",
    )
    place = F.struct(*_ROW)
    first = windows.groupBy("anchor", "window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where("first < last").drop("last")
    later = windows.join(first, ["anchor", "window"]).where(place > F.col("first")).select(*_ROW)
    return marks.where(F.col("kind") == _REPEAT).select(*_ROW).union(later)


def _merged(words: int) -> Column:
    @F.pandas_udf("array<struct<start:long,length:long>>")
    def merge(places: pd.Series) -> pd.Series:
        out = []
        for found in places:
            found = np.sort(np.asarray(found, dtype=np.int64))
            begin = found >> _SHIFT
            end = np.maximum.accumulate(begin + (found & ((1 << _SHIFT) - 1)) + words - 1)
            new = np.concatenate([[True], begin[1:] > end[:-1]])
            last = np.append(np.flatnonzero(new)[1:] - 1, len(found) - 1)
            out.append([{"start": int(a), "length": int(b - a)} for a, b in zip(begin[new], end[last])])
        return pd.Series(out, dtype=object)

    return merge


def maximal_repeats(docs: DataFrame, words: int = WORDS, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, text key, spans): of each document with repeats the maximal ones, as first word and number of words.

    A span is covered by windows of ``words`` words that also start earlier, and is at least that long. Rows without an
    id have the smallest 64-bit number as doc_id here. Texts of fewer words, empty and null ones have no repeats; an
    empty table gives no rows.
    """
    found = repeated_windows(docs, words, anchor)
    return found.groupBy("doc_id", TEXT_KEY).agg(F.collect_list("place").alias("places")).select(
        "doc_id", TEXT_KEY, _merged(words)("places").alias("spans")
    )


def _without(text: str, spans) -> str:
    begins = iter(sorted((s["start"], s["start"] + s["length"]) for s in spans))
    kept, at, split = [], 0, text.encode("utf-8", "surrogatepass").split()
    for begin, end in begins:
        kept += split[at:begin]
        at = end
    return b" ".join([*kept, *split[at:]]).decode("utf-8", "surrogatepass")


def drop_repeats(docs: DataFrame, words: int = WORDS, anchor: int = ANCHOR) -> DataFrame:
    """The documents without their repeats, all other columns as they are, with n_words and n_removed after them.

    A document that loses words keeps the others joined by one space; any other keeps its text. A null text has no words
    and stays null. The added columns are ``__llm_n_words`` and ``__llm_n_removed``, so none of the input's can clash.
    """

    @F.pandas_udf("string")
    def kept(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else _without(t, s) for t, s in zip(text, spans)], dtype=object)

    spans = maximal_repeats(docs, words, anchor).select(
        F.col("doc_id").alias("__llm_id"), F.col(TEXT_KEY).alias("__llm_key"), F.col("spans").alias("__llm_spans")
    )
    rows = docs.withColumn(TEXT_KEY, text_key())
    own = F.coalesce(rows["doc_id"].cast("long"), F.lit(_NO_ID))
    joined = rows.join(spans, (own == spans["__llm_id"]) & (rows[TEXT_KEY] == spans["__llm_key"]), "left")
    removed = F.aggregate("__llm_spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    text = F.when(F.col("__llm_spans").isNull(), rows["text"]).otherwise(kept(rows["text"], F.col("__llm_spans")))
    count = F.coalesce(F.regexp_count(rows["text"], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    return joined.select(
        *[text.alias(c) if c == "text" else rows[c] for c in docs.columns], count.cast("long").alias("__llm_n_words"),
        F.coalesce(removed, F.lit(0).cast("long")).alias("__llm_n_removed"),
    )
