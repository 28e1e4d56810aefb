"""Hard negatives of anchors: rows of another label that come close to an anchor's positives, but not too close.

All rows are sorted along a Hilbert curve of a few projected directions and written as Parquet blocks: one row holds the
ids, labels and vectors of up to ``BLOCK`` neighbours, with a zone map, the least and greatest component of every
dimension. For an anchor a and a block, interval arithmetic bounds every product from above and below: positive
components of a meet the greatest (least) ones of the block, negative components the least (greatest) ones.

An anchor asks for scores in windows. For its positives that is everything not below the best of its own block; then, for
each positive, the scores between two shares of the positive's. Anchors are put into groups in curve order, and a first
step over zone maps alone gives the blocks that any anchor of a group must read. Only these are joined to the group, and
there each anchor still meets only the blocks whose bounds reach its windows, which narrow as results come in. A skipped
block provably holds no result, so results are exact.

Groups are bounded by ``ACTIVE`` anchors and one partition's; a task holds one group and about ``BLOCKS`` blocks. Vectors
without structure need all blocks, and the work is anchors times rows, like any exact search; clustered ones need few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.ann import Orderings
from marketlake.llm.common import stored

BLOCK = 1024
BLOCKS = 128  # blocks that a task meets, about
ZONES = 4096  # zone maps that a task looks at, about
ACTIVE = 50_000  # anchors of a group
SAMPLE = 5000  # bound of the vectors that the curve's directions are fitted on
_CHUNK = 512  # anchors whose products are held at once
_NONE = -(1 << 62)  # below any score
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = "anchor_id long, slot int, id long, score long"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, q): one row per id, every component x as floor(scale * x).

    Rows without an id, label or vector take no part, nor do those with a null or non-finite component, an empty vector
    or one of another length than most. Of rows that share an id, the smallest by label, then vector, counts.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("v")
    ).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND size(v) > 0"
        " AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    )
    common = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"))
    common = common.orderBy(F.col("n").desc(), "dims").limit(1).collect()
    if common:
        rows = rows.where(F.size("v") == common[0]["dims"])
    q = F.transform("v", lambda x: F.floor(x * scale))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", q.alias("q"))).alias("r")).select("vec_id", "r.label", "r.q")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as a matrix of 64-bit whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if bound < 1 << 53:
        return a.astype(np.float64) @ b.T.astype(np.float64)
    if bound < 1 << 62:
        return a @ b.T
    raise OverflowError("inner products exceed 62 bits")


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product that a row of ``a`` can have with a vector in each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _keyed(ordering: Orderings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = ordering.keys(_matrix(batch.column(2)).astype(np.float64))[0]
                yield pa.RecordBatch.from_arrays([pa.array(keys), *batch.columns], names=["key", *batch.schema.names])

    return run


_BLOCK = (
    "block long, part int, asks long, ids binary, labels binary, width int, vectors binary, low array<long>, "
    "high array<long>, kinds array<long>"
)


def _narrow(values: np.ndarray) -> np.ndarray:
    top = int(np.abs(values).max(initial=0))
    return values.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)


def _cut(size: int, every: int):
    """Sorted rows as blocks with their zone maps; a block's name is its first id on the curve, its rows are by id."""

    def block(table: pa.Table, part: int) -> pa.RecordBatch:
        ids, labels, q = table["vec_id"].to_numpy(), table["label"].to_numpy(), _matrix(table["q"])
        name, order = int(ids[0]), np.argsort(ids)
        ids, labels, q = ids[order], labels[order], q[order]
        values = _narrow(q)
        row = (name, part, int((ids % every == 0).sum()), ids.tobytes(), labels.tobytes(), values.dtype.itemsize,
               values.tobytes(), q.min(axis=0).tolist(), q.max(axis=0).tolist(), np.unique(labels).tolist())
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(),
                 *[pa.list_(pa.int64())] * 3]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(row, types)], names=[c.split()[0] for c in _BLOCK.split(", ")]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rest, held = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            rest.append(batch)
            held += batch.num_rows
            if held >= size:
                table = pa.Table.from_batches(rest)
                for at in range(0, held - held % size, size):
                    yield block(table.slice(at, size), part)
                left = table.slice(held - held % size).combine_chunks()
                rest, held = left.to_batches(), len(left)
        if held:
            yield block(pa.Table.from_batches(rest), part)

    return run


class _Block:
    """A stored block's ids, labels, vectors and zone map."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], f"i{row['width']}").astype(np.int64).reshape(len(self.ids), -1)
        self.low, self.high = (np.array([row[c]], dtype=np.int64) for c in ("low", "high"))


class _Asking:
    """Anchors with their windows, and what was found for them so far.

    Every anchor has the same number of slots; a slot looks for the ``keep`` best scores from ``low`` to ``high``.
    ``same`` says whether for rows of the anchor's label or of other labels.
    """

    def __init__(self, ids, labels, vectors, low, high, keep: int, same: bool):
        self.ids, self.labels, self.vectors, self.low, self.high = ids, labels, vectors, low.copy(), high
        self.keep, self.same = keep, same
        self.found = np.zeros((*low.shape, keep), dtype=np.int64)
        self.scores = np.full((*low.shape, keep), _NONE, dtype=np.int64)

    def meet(self, block: _Block) -> None:
        least, most = bounds(self.vectors, block.low, block.high)
        reached = np.flatnonzero(((most >= self.low) & (least <= self.high)).any(axis=1))
        for at in range(0, len(reached), _CHUNK):
            rows = reached[at : at + _CHUNK]
            scores = products(self.vectors[rows], block.vectors)
            scores[(self.labels[rows, None] == block.labels) != self.same] = _NONE
            place = np.minimum(np.searchsorted(block.ids, self.ids[rows]), len(block.ids) - 1)
            own = block.ids[place] == self.ids[rows]
            scores[np.flatnonzero(own), place[own]] = _NONE
            for slot in range(self.low.shape[1]):
                self._take(rows, slot, scores, block.ids)

    def _take(self, rows: np.ndarray, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.low[rows, slot, None]) & (scores <= self.high[rows, slot, None]) & (scores > _NONE)
        some = np.flatnonzero(inside.any(axis=1))
        if not len(some):
            return
        rows, wanted = rows[some], np.where(inside[some], scores[some], _NONE)
        if wanted.shape[1] > self.keep:
            edge = np.partition(wanted, -self.keep, axis=1)[:, -self.keep]
            wanted[wanted < edge[:, None]] = _NONE
        row, column = np.nonzero(wanted > _NONE)
        row = np.concatenate([row, np.repeat(np.arange(len(rows)), self.keep)])
        score = np.concatenate([wanted[wanted > _NONE].astype(np.int64), self.scores[rows, slot].ravel()])
        found = np.concatenate([ids[column], self.found[rows, slot].ravel()])
        order = np.lexsort((found, -score, row))
        row, score, found = row[order], score[order], found[order]
        begins = np.searchsorted(row, np.arange(len(rows)))
        best = begins[:, None] + np.arange(self.keep)
        self.scores[rows, slot], self.found[rows, slot] = score[best], found[best]
        self.low[rows, slot] = np.maximum(self.low[rows, slot], self.scores[rows, slot, -1])

    def results(self) -> pa.Table:
        row, slot, place = np.nonzero(self.scores > _NONE)
        return pa.table({
            "anchor_id": self.ids[row], "slot": slot.astype(np.int32), "id": self.found[row, slot, place],
            "score": self.scores[row, slot, place],
        })


def _anchors(every: int, keep: int):
    """Anchors of each block, with the window for positives: from the ``keep``-th best of the block itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                pick = np.flatnonzero(block.ids % every == 0)
                low = np.full((len(pick), 1), _NONE + 1)
                asking = _Asking(block.ids[pick], block.labels[pick], block.vectors[pick], low, np.full_like(low, -_NONE),
                                 keep, same=True)
                asking.meet(block)
                lists = [pa.array(list(x), pa.list_(pa.int64())) for x in (asking.vectors, asking.low, asking.high)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pick), row["part"], dtype=np.int32)), pa.array(asking.ids),
                     pa.array(asking.labels), *lists], names=["part", "anchor_id", "label", "q", "low", "high"],
                )

    return run


def _asking(table: pa.Table, keep: int, same: bool) -> _Asking:
    ids, labels = (table[c].to_numpy() for c in ("anchor_id", "label"))
    return _Asking(ids, labels, *(_matrix(table[c]) for c in ("q", "low", "high")), keep, same)


def _choose(same: bool):
    """The blocks that an anchor of the group must read, from the zone maps alone."""

    def run(key: tuple, anchors: pa.Table, zones: pa.Table) -> pa.Table:
        needed = np.zeros(len(zones), dtype=bool)
        if len(anchors) and len(zones):
            asking, low, high = _asking(anchors, 1, same), _matrix(zones["low"]), _matrix(zones["high"])
            kinds = zones["kinds"].combine_chunks()
            sizes = np.diff(kinds.offsets.to_numpy())
            kind, zone = kinds.flatten().to_numpy(), np.repeat(np.arange(len(zones)), sizes)
            for label in np.unique(asking.labels).tolist():
                of_label = np.flatnonzero(asking.labels == label)
                holds = np.zeros(len(zones), dtype=bool)
                holds[zone[(kind == label) == same]] = True
                for at in range(0, len(of_label), _CHUNK):
                    rows, left = of_label[at : at + _CHUNK], np.flatnonzero(holds & ~needed)
                    least, most = bounds(asking.vectors[rows], low[left], high[left])
                    for slot in range(asking.low.shape[1]):
                        reach = (most >= asking.low[rows, slot, None]) & (least <= asking.high[rows, slot, None])
                        needed[left[reach.any(axis=0)]] = True
        block = zones["block"].filter(pa.array(needed))
        return pa.table({"group": pa.array([key[0].as_py()] * len(block), pa.int32()), "block": block})

    return run


def _meet(keep: int, same: bool):
    def run(key: tuple, anchors: pa.Table, blocks: pa.Table) -> pa.Table:
        asking = _asking(anchors, keep, same)
        for batch in blocks.to_batches(max_chunksize=1):
            for row in batch.to_pylist():
                asking.meet(_Block(row))
        return asking.results()

    return run


def needed_blocks(anchors: DataFrame, blocks: DataFrame, groups: int, same: bool) -> DataFrame:
    """(group, block) of every block that the bounds don't rule out for all anchors of the group."""
    parts = max(1, -(-blocks.count() // ZONES))
    zones = blocks.select("block", "low", "high", "kinds").withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)))
    zones = zones.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return asked.groupBy("group", "part").cogroup(zones.groupBy("group", "part")).applyInArrow(
        _choose(same), "group int, block long"
    )


def best_in_windows(anchors: DataFrame, blocks: DataFrame, groups: int, keep: int, same: bool) -> DataFrame:
    """(anchor_id, slot, id, score, rank): the best ``keep`` scores in every window of every anchor, ties to smaller ids.

    ``anchors``: group, anchor_id, label, q, low and high (a window per slot).
    """
    spark = blocks.sparkSession
    count = blocks.count()
    slices = max(1, -(-count // BLOCKS), min(count, spark.sparkContext.defaultParallelism))
    pairs = stored(
        needed_blocks(anchors, blocks, groups, same).withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices))),
        "needed-blocks",
    )
    asked = anchors.join(pairs.select("group", F.col("slice").alias("piece")).distinct(), "group")
    read = pairs.join(blocks.drop("part", "asks", "kinds"), "block")
    found = asked.groupBy("group", "piece").cogroup(read.groupBy("group", "slice")).applyInArrow(
        _meet(keep, same), _FOUND
    )
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def curve_blocks(rows: DataFrame, every: int, size: int = BLOCK) -> DataFrame:
    """The rows of :func:`quantised` as stored blocks along the curve, see the module's text. Needs at least one row."""
    wanted = min(1.0, SAMPLE / max(1, rows.count()))
    scale = 1_000_000
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(scale)) < int(scale * wanted) + 1).limit(2 * SAMPLE).collect()
    sample = sample or rows.limit(1).collect()
    ordering = Orderings(np.array([r["q"] for r in sample], dtype=np.float64), count=1)
    keyed = rows.mapInArrow(_keyed(ordering), "key long, vec_id long, label long, q array<long>")
    return stored(
        keyed.repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id").mapInArrow(_cut(size, every), _BLOCK),
        "blocks",
    )


def mine(
    vectors: DataFrame, every: int = 50, positives: int = 5, keep: int = 3, low_percent: int = 50, high_percent: int = 95,
    scale: int = 256, block: int = BLOCK, active: int = ACTIVE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of hard negatives.

    ``vectors``: vec_id, embedding, label; :func:`quantised` says which rows take part. Anchors are rows whose id divides
    by ``every``. The score is the integer inner product; higher scores come first, ties by smaller id. Positives are an
    anchor's first other rows of its label. For each, the first ``keep`` rows of other labels whose score is at least
    ``low_percent`` and at most ``high_percent`` of the positive's come back, ranked from 1. Fewer if there are fewer,
    and none for a negative positive score. Scores beyond 62 bits are an error. An empty table, or one without anchors
    or other labels, gives no rows.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, scale), "quantised")
    if rows.isEmpty():
        return spark.createDataFrame([], _RESULT)
    blocks = curve_blocks(rows, every, block)

    # Groups of neighbouring partitions; a row here stands for a partition.
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    parts = blocks.groupBy("part").agg(F.sum("asks").alias("n")).withColumn("group", F.floor(before / active).cast("int"))
    groups = parts.agg(F.max("group")).first()[0] + 1
    anchors = stored(
        blocks.where("asks > 0").mapInArrow(
            _anchors(every, positives),
            "part int, anchor_id long, label long, q array<long>, low array<long>, high array<long>",
        ).join(parts.select("part", "group"), "part").drop("part"), "anchors",
    )
    best = stored(best_in_windows(anchors, blocks, groups, positives, same=True), "positives")

    # A slot per positive; anchors with fewer get windows that hold nothing.
    low = f"({low_percent} * score + pmod(-{low_percent} * score, 100)) div 100 AS low"
    high = f"({high_percent} * score - pmod({high_percent} * score, 100)) div 100 AS high"
    windows = best.selectExpr("anchor_id", "rank", low, high).groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "low", "high"))).alias("w")
    )
    empty = F.struct(F.lit(0).alias("rank"), F.lit(0).cast("long").alias("low"), F.lit(-1).cast("long").alias("high"))
    filled = F.slice(F.concat("w", F.array_repeat(empty, positives)), 1, positives)
    asking = anchors.drop("low", "high").join(windows.select("anchor_id", filled.alias("w")), "anchor_id").select(
        "group", "anchor_id", "label", "q", F.col("w.low").alias("low"), F.col("w.high").alias("high")
    )
    found = best_in_windows(stored(asking, "windows"), blocks, groups, keep, same=False)
    named = best.select(
        "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(named, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
