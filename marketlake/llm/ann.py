"""Nearest neighbours by largest inner product, by several shifted Hilbert orderings of projected vectors.

Every ordering projects the vectors to a few random directions (drawn with the covariance of a bounded sample), shifts
and quantises them, and range-partitions their ids by their place on a Hilbert curve. Sorted partitions are cut into
blocks. A query goes to its own block and to the neighbouring ones within a window. Strips of blocks as long as a window
are swept in order, each block scoring the queries whose windows it lies in, and a query leaves a strip with its best
entries only. The windows of all orderings merge, and the best by the exact measure stay. Vectors are read when strips
are built; until then orderings hold ids and keys.

The number of orderings and the window are those that scan least and find ``TARGET`` of the true neighbours of a bounded
sample of queries, which are found by brute force over all vectors. Vectors without structure need wide windows, and the
work is then queries times rows like any exact search; clustered ones need narrow ones.

Equal vectors are one entry of the index. A result needs at most as many of them as it has ranks, and takes those of
the smallest ids, so that a vector which a third of all rows share costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import stored

ORDERINGS = 8  # at most; as many are used as scan the fewest blocks
LEAST_ORDERINGS = 2
DIRECTIONS = 6
CELL_BITS = 8
BLOCK = 1024  # entries of a block; of small tables fewer, so that a window can be a small part
SMALLEST_BLOCK, BLOCKS_OF_SMALL = 16, 64
ACTIVE_QUERIES = 50_000  # queries that a task holds at once
SAMPLE_VECTORS = 5000  # bound of the sample that directions and cells are fitted on
SAMPLE_QUERIES = 200  # bound of the queries that the window is fitted on
TARGET = 0.95
_RESULT = "query_id long, rank int, vec_id long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of every row of cells (whole numbers under 2**bits); after Skilling (2004)."""
    x = [c.copy() for c in cells.T.astype(np.int64)]
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:
        low = bit - 1
        for axis in range(len(x)):
            inside = (x[axis] & bit) != 0
            swap = np.where(inside, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[axis] ^= swap
        bit >>= 1
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    gray, bit = np.zeros_like(x[0]), top
    while bit > 1:
        gray ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    key = np.zeros_like(gray)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ gray) >> level) & 1)
    return key


class Orderings:
    """Directions, shifts and cells of all orderings."""

    def __init__(self, sample: np.ndarray, count: int = ORDERINGS, directions: int = DIRECTIONS,
                 bits: int = CELL_BITS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.bits, self.maps = bits, []
        centred = sample - sample.mean(axis=0)
        dims = sample.shape[1]
        directions = min(directions, dims)
        for _ in range(count):
            drawn = centred.T @ rng.normal(size=(len(sample), directions)) if len(sample) > directions else (
                rng.normal(size=(dims, directions))
            )
            drawn = drawn + 1e-9 * rng.normal(size=drawn.shape)
            axes = np.linalg.qr(drawn)[0]
            places = sample @ axes
            spread = np.maximum(places.std(axis=0), 1e-9)
            # Cells span 8 deviations; the shift moves the grid by up to half a deviation.
            shift = 4 + rng.uniform(-0.5, 0.5, directions)
            self.maps.append((axes, places.mean(axis=0), spread, shift))

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        out = []
        for axes, mean, spread, shift in self.maps:
            cells = ((vectors @ axes - mean) / spread + shift) / 8 * (1 << self.bits)
            out.append(hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.int64), self.bits))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    dims = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one row per id with a finite vector that is not zero, all of the most frequent length.

    Vectors keep their type (float, else double); sums are in double precision.

    Of rows that share an id, the one with the smallest vector counts. Rows without an id take no part.
    """
    kind = vectors.schema["embedding"].dataType.elementType
    stored_as = "array<float>" if isinstance(kind, T.FloatType) else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(stored_as).alias("v")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0"
        " AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x <> 0)"
    )
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.col("n").desc(), "dims").limit(1).collect()
    if not common:
        return rows
    return rows.where(F.size("v") == common[0]["dims"]).groupBy("vec_id").agg(F.min("v").alias("v"))


def _keyed(orderings: Orderings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for number, keys in enumerate(orderings.keys(_matrix(batch.column(1)))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), number, dtype=np.int32)), pa.array(keys), batch.column(0)],
                        names=["ordering", "key", "entry"],
                    )

    return run


def _seated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted along the orderings, with their place among those of their ordering in this partition."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        number = batch.column(0).to_numpy()
        begins = np.concatenate([[number[0] != last], number[1:] != number[:-1]])
        at = np.arange(len(number))
        origin = np.maximum.accumulate(np.where(begins, at, 0))
        seat = at - origin + np.where(np.cumsum(begins) == 0, count, 0)
        last, count = number[-1], int(seat[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(np.full(len(number), part, dtype=np.int32)), pa.array(seat)],
            names=["ordering", "entry", "part", "seat"],
        )


def numbered(entries: DataFrame, orderings: Orderings, block: int) -> DataFrame:
    """(entry, ordering, number): the block of ``block`` neighbours that each entry is in, along each ordering.

    Only keys are sorted and stored, no vectors. Blocks are numbered from 0 by the counts of the partitions, of which
    there is a row for each ordering in it.
    """
    keyed = entries.select("entry", "v").mapInArrow(_keyed(orderings), "ordering int, key long, entry long")
    seated = stored(
        keyed.repartitionByRange("ordering", "key", "entry").sortWithinPartitions("ordering", "key", "entry")
        .mapInArrow(_seated, "ordering int, entry long, part int, seat long"), "seats",
    )
    counts = seated.groupBy("ordering", "part").agg(F.count("*").alias("n"))
    before = counts.select("ordering", "part", (F.sum("n").over(Window.partitionBy("ordering").orderBy("part")) - F.col("n")).alias("before"))
    return seated.join(before, ["ordering", "part"]).select(
        "entry", "ordering", F.floor((F.col("before") + F.col("seat")) / block).cast("int").alias("number")
    )


def _best(entries: np.ndarray, vectors: np.ndarray, query: np.ndarray, scores: np.ndarray, keep: int):
    """Entries and exact scores of the best by (score, smaller entry)."""
    n = min(keep, len(scores))
    edge = np.partition(scores, len(scores) - n)[len(scores) - n]
    near = np.flatnonzero(scores >= edge - 1e-9 * abs(edge))
    exact = (vectors[near] * query).sum(axis=1)
    order = np.lexsort((entries[near], -exact))[:keep]
    return entries[near][order], exact[order]


class _Active:
    """Queries that the sweep is within the windows of, with the best entries found so far."""

    def __init__(self, keep: int, dims: int):
        self.keep = keep
        self.ids, self.till = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.vectors = np.zeros((0, dims))
        self.entries: list[np.ndarray] = []
        self.scores: list[np.ndarray] = []

    def add(self, ids: np.ndarray, till: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.till = np.concatenate([self.ids, ids]), np.concatenate([self.till, till])
        self.vectors = np.concatenate([self.vectors, vectors])
        self.entries += [np.zeros(0, dtype=np.int64)] * len(ids)
        self.scores += [np.zeros(0)] * len(ids)

    def meet(self, entries: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(self.ids), 512):
            products = self.vectors[at : at + 512] @ vectors.T
            floors = np.array([
                x[-1] - 1e-9 * abs(x[-1]) if len(x) == self.keep else -np.inf for x in self.scores[at : at + 512]
            ])
            for row in np.flatnonzero((products >= floors[:, None]).any(axis=1)):
                pick = np.flatnonzero(products[row] >= floors[row])
                i = at + row
                found, exact = _best(entries[pick], vectors[pick], self.vectors[i], products[row][pick], self.keep)
                found, exact = np.concatenate([self.entries[i], found]), np.concatenate([self.scores[i], exact])
                order = np.lexsort((found, -exact))[: self.keep]
                self.entries[i], self.scores[i] = found[order], exact[order]

    def retire(self, before: int | None = None) -> Iterator[pa.RecordBatch]:
        """Give what was found for queries whose window ends before a block, or for all."""
        over = np.ones(len(self.ids), dtype=bool) if before is None else self.till < before
        if not over.any():
            return
        gone, left = np.flatnonzero(over), np.flatnonzero(~over)
        sizes = [len(self.entries[i]) for i in gone]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids[gone], sizes)), pa.array(np.concatenate([self.entries[i] for i in gone])),
             pa.array(np.concatenate([self.scores[i] for i in gone]))], names=["query", "entry", "score"],
        )
        self.ids, self.till, self.vectors = self.ids[left], self.till[left], self.vectors[left]
        self.entries, self.scores = [self.entries[i] for i in left], [self.scores[i] for i in left]


_STRIP = "ordering int, strip int, part int, at int, kind int, id long, till int, v binary"
_STRIP_ORDER = ["ordering", "strip", "part", "at", "kind", "id"]


def _strips(window: int, parts: int, width: str):
    """Entries as rows of the strips that their blocks are in, and as queries of each strip that their window reaches.

    A strip is as long as a window. A query stands before the first block of its window; the parts of a strip share its
    queries.
    """
    length = 2 * window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, asks = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            values = pa.array([v.tobytes() for v in _matrix(batch.column(1)).astype(width)], pa.binary())
            places = batch.column(3)
            row = np.repeat(np.arange(len(ids)), np.diff(places.offsets.to_numpy()))
            seats = places.flatten()
            ordering, number = (seats.field(k).to_numpy().astype(np.int64) for k in ("ordering", "number"))
            out = [(row, ordering, number // length, np.full(len(row), part), number, 1, np.zeros(len(row))) for part in range(parts)]
            pick = np.flatnonzero(asks[row])
            low, high = np.maximum(number[pick] - window, 0), number[pick] + window
            for strip, take in ((low // length, slice(None)), (high // length, high // length != low // length)):
                begin = np.maximum(low, strip * length)
                end = np.minimum(high, (strip + 1) * length - 1)
                chosen = pick[take]
                out.append((row[chosen], ordering[chosen], strip[take], ids[row[chosen]] % parts, begin[take], 0, end[take]))
            for of, *columns, kind, till in out:
                numbers = [*columns, np.full(len(of), kind)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c.astype(np.int32)) for c in numbers), pa.array(ids[of]), pa.array(till.astype(np.int32)),
                     values.take(pa.array(of))], names=[*_STRIP_ORDER, "till", "v"],
                )

    return run


def _sweep(keep: int, width: str):
    """Sorted strips swept block by block: a query leaves with its best entries when its window ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, active = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(5)], axis=1)
            ids, till = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            vectors = np.frombuffer(b"".join(batch.column(7).to_pylist()), dtype=width).reshape(len(ids), -1).astype(np.float64)
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            for a, b in zip(bounds, bounds[1:]):
                *here, at, kind = keys[a].tolist()
                if here != strip:
                    if active is not None:
                        yield from active.retire()
                    strip, active = here, _Active(keep, vectors.shape[1])
                if kind == 0:
                    active.add(ids[a:b], till[a:b], vectors[a:b])
                else:
                    yield from active.retire(before=at)
                    active.meet(ids[a:b], vectors[a:b])
        if active is not None:
            yield from active.retire()

    return run


def _top(pairs: DataFrame, by: str, item: str, keep: int) -> DataFrame:
    """The best ``keep`` items of each ``by``, each once; Spark limits them before it shuffles."""
    order = Window.partitionBy(by).orderBy(F.col("score").desc(), item)
    return pairs.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= keep).drop("place").distinct()


def brute_force(entries: DataFrame, ids: np.ndarray, wanted: np.ndarray, keep: int) -> DataFrame:
    """(query, entry, score): the true best entries of a bounded set of queries, from every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            entry, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for query, vector, scores in zip(ids, wanted, wanted @ vectors.T):
                found, exact = _best(entry, vectors, vector, scores, keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), query)), pa.array(found), pa.array(exact)],
                    names=["query", "entry", "score"],
                )

    return _top(
        entries.select("entry", "v").mapInArrow(run, "query long, entry long, score double"), "query", "entry", keep
    )


def _sample(entries: DataFrame, bound: int, total: int) -> DataFrame:
    """About ``bound`` rows, picked by a hash of the entry."""
    scale = 1_000_000
    return entries.where(F.pmod(F.xxhash64("entry"), F.lit(scale)) < int(scale * min(1.0, bound / max(1, total))) + 1)


def fit_window(
    entries: DataFrame, places: DataFrame, keep: int, asked: int, target: float = TARGET, least: int = LEAST_ORDERINGS
) -> tuple[int, int]:
    """How many orderings, and how many neighbouring blocks on each side, find ``target`` of a sample's true neighbours.

    Of the pairs that do, the one that scans the fewest blocks. The sample is drawn from the ``asked`` entries that ask. A
    query's own entry, which is always found, doesn't count.
    """
    asks = entries.where("asks").select("entry", "v")
    asking = _sample(asks, SAMPLE_QUERIES, asked).limit(2 * SAMPLE_QUERIES).collect()
    if not asking:  # the hash may miss them all
        asking = asks.limit(SAMPLE_QUERIES).collect()
    if not asking:
        return least, 0
    ids = np.array([r["entry"] for r in asking], dtype=np.int64)
    found = brute_force(entries, ids, np.array([r["v"] for r in asking], dtype=np.float64), keep + 1).where("query <> entry")
    truth = _top(found, "query", "entry", keep).select("query", "entry").collect()
    if not truth:
        return least, 0
    # Bounded: the sample's queries and their neighbours.
    named = entries.sparkSession.createDataFrame(
        [(int(e),) for e in {x for pair in truth for x in pair}], "entry long"
    )
    at: dict[int, dict[int, int]] = {}
    for r in places.join(F.broadcast(named), "entry").collect():
        at.setdefault(r["entry"], {})[r["ordering"]] = r["number"]
    count = len(next(iter(at.values())))
    apart = np.array([[abs(at[q][o] - at[e][o]) for o in range(count)] for q, e in truth])
    best = []
    for orderings in range(min(least, count), count + 1):
        nearest = np.sort(apart[:, :orderings].min(axis=1))
        window = int(nearest[min(len(nearest) - 1, int(np.ceil(target * len(nearest))) - 1)])
        best.append((orderings * (2 * window + 1), orderings, window))
    return min(best)[1:]


def search(vectors: DataFrame, every: int = 20, keep: int = 20, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest ``keep`` rows found of each row whose vec_id divides by ``every``.

    Nearest by inner product in double precision, ties to the smaller vec_id; a query's own row is no candidate. With
    fewer candidates a query gets all that are found. ``usable`` says which rows take part. Without any, or without
    queries, there are no rows.
    """
    spark: SparkSession = vectors.sparkSession
    rows = stored(usable(vectors).withColumn("asks", F.col("vec_id") % every == 0), "vectors")
    entries = stored(
        rows.groupBy("v").agg(F.min("vec_id").alias("entry"), F.max("asks").alias("asks"), F.count("*").alias("n"))
        .select("entry", "v", "asks", "n"), "entries",
    )
    total = entries.count()
    if not total:
        return spark.createDataFrame([], _RESULT)
    sample = np.array([r["v"] for r in _sample(entries, SAMPLE_VECTORS, total).limit(2 * SAMPLE_VECTORS).collect()])
    if not len(sample):
        sample = np.array([r["v"] for r in entries.limit(1).collect()])
    orderings = Orderings(sample)

    size = max(SMALLEST_BLOCK, min(block, total // BLOCKS_OF_SMALL))
    places = stored(numbered(entries, orderings, size), "places")
    asked = entries.where("asks").count()
    used, window = fit_window(entries, places, keep, asked, target)

    # Queries that a window holds at once; parts of a strip bound them for a task.
    asked_at_once = asked * (2 * window + 1) // max(1, -(-total // size))
    parts = max(1, -(-asked_at_once // ACTIVE_QUERIES))
    seats = places.where(F.col("ordering") < used).groupBy("entry").agg(
        F.collect_list(F.struct("ordering", "number")).alias("places")
    )
    width = "<f4" if entries.schema["v"].dataType.elementType == T.FloatType() else "<f8"
    strips = entries.select("entry", "v", "asks").join(seats, "entry").select("entry", "v", "asks", "places").mapInArrow(
        _strips(window, parts, width), _STRIP
    )
    pairs = strips.repartition("ordering", "strip", "part").sortWithinPartitions(*_STRIP_ORDER).mapInArrow(
        _sweep(keep + 1, width), "query long, entry long, score double"
    )
    best = stored(_top(pairs, "query", "entry", keep + 1), "best")

    # Entries that stand for several rows give their smallest ids; one more than the ranks, for the query's own row.
    several = rows.join(entries.where("n > 1").select("v", "entry"), "v").select("entry", "vec_id")
    first = Window.partitionBy("entry").orderBy("vec_id")
    several = several.withColumn("place", F.row_number().over(first)).where(F.col("place") <= keep + 1)
    ids = several.select("entry", "vec_id").union(entries.where("n = 1").select("entry", F.col("entry").alias("vec_id")))
    near = _top(best.join(ids, "entry").select("query", "vec_id", "score"), "query", "vec_id", keep + 1)
    asked = rows.where("asks").join(entries.where("asks").select("v", F.col("entry").alias("query")), "v").select(
        "query", F.col("vec_id").alias("query_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return asked.join(near, "query").where("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= keep
    ).select("query_id", "rank", "vec_id", "score")
