"""The trie of conversation prefixes, with sums over subtrees by centroid decomposition.

Turns are reduced to hashes and word counts where they are read, sorted by range partitions and streamed: every turn gets
its place and the hash of all turns up to it, a sum of turn hashes times powers of a constant. A partition works out its
own part; what the partitions before it add to its first conversation is one row for each. So a conversation may be as
long as it likes. Hashes of prefixes name the nodes of the trie.

Sums over subtrees don't walk the trie level by level. Its parent edges are a forest; every round takes the centroid of
each component, the deepest node with at least half of the component below it (the nodes with at least half below them
are the path from the component's top to it). Cutting its edges leaves parts of at most half the size. The total below a
centroid is its own value and the totals of the parts under it; it is added to all nodes on the path from the centroid to
the component's top. Each node is a centroid once, and then its sum is complete. Components of more than ``LOCAL`` nodes
take a round in Spark, with sizes and tops by pointer doubling, so that depth costs a logarithm; smaller ones are packed
together and finished inside tasks by the same rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

LOCAL = 8192  # nodes of a component that one task may finish
IDS = 1000  # ids in a row of a digest's input
# Odd multipliers of two independent polynomial hashes modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD = r"[^\x20\x09-\x0D]+"
_ROOT = bytes(16)
_PLACED = "conv_id long, rank long, part int, first boolean, h1 long, h2 long, words long, p1 long, p2 long"
_VALUES = ["a", "b"]


# ---- places and prefixes -------------------------------------------------------------


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, words) of every turn; a null role or text is empty, rows without a conv_id take no part."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    )


def _power(base: int, exponent: int) -> np.uint64:
    return np.uint64(pow(base, exponent, 1 << 64))


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation, with place and prefix hashes as far as this partition knows.

    ``first`` marks turns of the partition's first conversation, which may have begun before.
    """
    names = [c.split()[0] for c in _PLACED.split(", ")]
    part = TaskContext.get().partitionId()
    conv, count, sums, first_conv = None, 0, [np.uint64(0)] * 2, None
    for batch in batches:
        if not batch.num_rows:
            continue
        convs, h1, h2, words = (batch.column(i).to_numpy() for i in range(4))
        if first_conv is None:
            first_conv = convs[0]
        place = np.arange(len(convs))
        begins = np.concatenate([[convs[0] != conv], convs[1:] != convs[:-1]])
        origin = np.maximum.accumulate(np.where(begins, place, 0))
        going_on = (convs == conv) if conv is not None else np.zeros(len(convs), dtype=bool)
        local = place - origin + 1
        prefixes = []
        for k, h in enumerate((h1, h2)):
            steps = np.full(len(convs) + 1, _BASES[k], dtype=np.uint64)
            steps[0] = 1
            powers = np.cumprod(steps, dtype=np.uint64)[local]
            powers = np.where(going_on, powers * _power(_BASES[k], count), powers)
            total = np.cumsum(h.view(np.uint64) * powers, dtype=np.uint64)
            before = np.where(origin > 0, total[origin - 1], np.uint64(0))
            prefixes.append(total - before + np.where(going_on, sums[k], np.uint64(0)))
        rank = local + np.where(going_on, count, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(convs), pa.array(rank), pa.array(np.full(len(convs), part, dtype=np.int32)),
             pa.array(convs == first_conv), pa.array(h1), pa.array(h2), pa.array(words),
             *(pa.array(p.view(np.int64)) for p in prefixes)], names=names,
        )
        conv, count, sums = convs[-1], int(rank[-1]), [p[-1] for p in prefixes]


def _carried(key: tuple, ends: pa.Table) -> pa.Table:
    """Of a conversation in several partitions: places and hashes that the partitions before each one add."""
    ends = ends.sort_by("part").to_pylist()
    out, count, sums = [], 0, [0, 0]
    for end in ends:
        out.append((end["conv_id"], end["part"], count, *(s - (1 << 64) if s >> 63 else s for s in sums)))
        sums = [(s + pow(b, count, 1 << 64) * end[p]) % (1 << 64) for s, b, p in zip(sums, _BASES, ("p1", "p2"))]
        count += end["rank"]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names=["conv_id", "part", "before", "c1", "c2"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = {name: batch.column(name).to_numpy() for name in ("rank", "p1", "p2", "before", "c1", "c2")}
        fixed = {"rank": cols["rank"] + cols["before"]}
        for base, p, c in zip(_BASES, ("p1", "p2"), ("c1", "c2")):
            power = {int(n): _power(base, int(n)) for n in np.unique(cols["before"])}
            scale = np.array([power[int(n)] for n in cols["before"]], dtype=np.uint64)
            fixed[p] = (cols[p].view(np.uint64) * scale + cols[c].view(np.uint64)).view(np.int64)
        names = [c.split()[0] for c in _PLACED.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(fixed[n]) if n in fixed else batch.column(n) for n in names], names=names
        )


def placed(digests: DataFrame) -> DataFrame:
    """Digests with ``rank`` (place in the conversation from 1) and p1, p2 (hash of all turns up to this one).

    Turns go by ``turn``, null first, ties by their hashes.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")]
    rows = stored(
        digests.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "h1", "h2", "words")
        .mapInArrow(_place, _PLACED), "placed",
    )
    # Per partition two rows: what it holds of its first conversation and of its last one.
    last = rows.groupBy("part").agg(F.max("conv_id").alias("conv_id"))
    ends = rows.where("first").groupBy("part", "conv_id").agg(F.max_by(F.struct("rank", "p1", "p2"), "rank").alias("e"))
    ends = ends.union(
        rows.where("NOT first").join(last, ["part", "conv_id"]).groupBy("part", "conv_id")
        .agg(F.max_by(F.struct("rank", "p1", "p2"), "rank").alias("e"))
    ).select("part", "conv_id", "e.*")
    carried = ends.groupBy("conv_id").applyInArrow(_carried, "conv_id long, part long, before long, c1 long, c2 long")
    carried = carried.select("conv_id", F.col("part").cast("int"), "before", "c1", "c2").where("before > 0")
    names = [c.split()[0] for c in _PLACED.split(", ")]
    begun = rows.where("first").join(carried, ["conv_id", "part"], "left")
    fixed = begun.where("before IS NOT NULL").mapInArrow(_added, _PLACED)
    return rows.where("NOT first").union(begun.where("before IS NULL").select(*names)).union(fixed).drop("part", "first")


# ---- sums over subtrees --------------------------------------------------------------


def _depths(up: np.ndarray) -> np.ndarray:
    depth, jump = (up >= 0).astype(np.int64), up.copy()
    while (going := np.flatnonzero(jump >= 0)).size:
        step, further = depth[jump[going]], jump[jump[going]]
        depth[going] += step
        jump[going] = further
    return depth


def centroid_sums(up: np.ndarray, values: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over every node's subtree, plus what was ``added`` to the node before.

    ``up`` is each node's parent or -1. All components take their rounds together.
    """
    n = len(up)
    depth = _depths(up)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))
    up, sums = up.copy(), added.astype(np.int64).copy()
    alive, hang = np.ones(n, dtype=bool), np.full(n, -1)
    centroid_of = np.full(n, -1)  # of nodes on a path: the centroid it leads to
    centroids = np.zeros(0, dtype=np.int64)
    while len(centroids) or alive.any():
        levels = [x[alive[x]] for x in levels]
        levels = [x for x in levels if len(x)]
        size, top = alive.astype(np.int64), np.arange(n)
        for nodes in levels:
            below = nodes[up[nodes] >= 0]
            top[below] = top[up[below]]
        for nodes in reversed(levels):
            below = nodes[up[nodes] >= 0]
            np.add.at(size, up[below], size[below])
        live = np.flatnonzero(alive)
        if len(centroids):  # the totals of the parts under them are known now
            totals = np.zeros_like(sums)
            np.add.at(totals, top[live], values[live])
            below = values[centroids].copy()
            place = np.full(n, -1)
            place[centroids] = np.arange(len(centroids))
            parts = live[hang[live] >= 0]
            np.add.at(below, place[hang[parts]], totals[parts])
            sums[centroids] += below
            on_path = live[centroid_of[live] >= 0]
            sums[on_path] += below[place[centroid_of[on_path]]]
            hang[:], centroid_of[:] = -1, -1
        path = live[2 * size[live] >= size[top[live]]]
        path = path[np.argsort(depth[path], kind="stable")]
        deepest = np.full(n, -1)
        for nodes in np.split(path, np.flatnonzero(np.diff(depth[path])) + 1):
            deepest[top[nodes]] = nodes  # a path has one node on a level
        centroids = deepest[deepest >= 0]
        centroid_of[path] = deepest[top[path]]
        is_centroid = np.zeros(n, dtype=bool)
        is_centroid[centroids] = True
        cut = live[(up[live] >= 0) & is_centroid[up[live]]]
        hang[cut], up[cut] = up[cut], -1
        alive[centroids] = False
    return sums


def _finish(local: int):
    """Components, sorted by their tops, packed to about ``local`` nodes and finished."""

    def sums_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        nodes = table["node"].to_pylist()
        index = {node: i for i, node in enumerate(nodes)}
        up = np.array([-1 if u is None else index[u] for u in table["up"].to_pylist()], dtype=np.int64)
        values, added = (np.stack([table[c].to_numpy() for c in cols], axis=1) for cols in (_VALUES, ["add_a", "add_b"]))
        sums = centroid_sums(up, values, added)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), *(pa.array(np.ascontiguousarray(sums[:, k])) for k in range(2))],
            names=["node", *_VALUES],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            tops = batch.column("top").to_pylist()
            begin = 0
            for i, top in enumerate(tops):
                if (i or held) and top != (tops[i - 1] if i else last) and count + i - begin >= local:
                    held.append(batch.slice(begin, i - begin))
                    yield sums_of([b for b in held if b.num_rows])
                    held, count, begin = [], 0, i
            if tops:
                held.append(batch.slice(begin))
                count, last = count + len(tops) - begin, tops[-1]
        if count:
            yield sums_of([b for b in held if b.num_rows])

    return run


def _tops_and_sizes(forest: DataFrame) -> DataFrame:
    """(node, top, size) of a forest (node, up) by pointer doubling; both joins' small side has a row per ancestor."""
    state = stored(forest.select(
        "node", F.col("up").alias("jump"), F.coalesce("up", "node").alias("top"), F.lit(1).cast("long").alias("size")
    ), "doubling")
    while not state.where("jump IS NOT NULL").isEmpty():
        more = state.where("jump IS NOT NULL").groupBy(F.col("jump").alias("node")).agg(F.sum("size").alias("more"))
        known = state.join(more, "node", "left").select(
            "node", "jump", "top", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")
        )
        far = state.select(F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("top").alias("far"))
        moved = known.where("jump IS NOT NULL").join(far, "jump").select(
            "node", F.col("next").alias("jump"), F.col("far").alias("top"), "size"
        )
        state = stored(known.where("jump IS NULL").union(moved), "doubling")
    return state.drop("jump")


def subtree_sums(nodes: DataFrame, local: int = LOCAL) -> DataFrame:
    """(node, a, b): sums of a and b (long) over every subtree of the forest (node binary, up binary or null, a, b).

    By centroid decomposition, see the module's text.
    """
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("binary")
    live = nodes.select("node", "up", *_VALUES, zero.alias("add_a"), zero.alias("add_b"), none.alias("hang"),
                        none.alias("centroid"))
    done = small = centroids = None
    while True:
        live = stored(live.join(_tops_and_sizes(live), "node"), "components")
        totals = live.groupBy("top").agg(
            F.count("*").alias("n"), F.sum("a").alias("t_a"), F.sum("b").alias("t_b"), F.max("hang").alias("hang")
        )
        if centroids is not None:
            parts = totals.where("hang IS NOT NULL").groupBy(F.col("hang").alias("node")).agg(
                F.sum("t_a").alias("t_a"), F.sum("t_b").alias("t_b")
            )
            below = stored(centroids.join(parts, "node", "left").select(
                "node", "add_a", "add_b", *[(F.col(c) + F.coalesce(f"t_{c}", zero)).alias(c) for c in _VALUES]
            ), "centroids")
            finished = below.select("node", (F.col("a") + F.col("add_a")).alias("a"), (F.col("b") + F.col("add_b")).alias("b"))
            done = finished if done is None else done.union(finished)
            paid = below.select(F.col("node").alias("centroid"), F.col("a").alias("t_a"), F.col("b").alias("t_b"))
            path = live.where("centroid IS NOT NULL").join(paid, "centroid").withColumns(
                {f"add_{c}": F.col(f"add_{c}") + F.col(f"t_{c}") for c in _VALUES}
            ).select(*live.columns)
            live = live.where("centroid IS NULL").union(path)
        sized = live.join(totals.select("top", "n"), "top").drop("hang", "centroid")
        little = sized.where(F.col("n") <= local).select("node", "up", "top", *_VALUES, "add_a", "add_b")
        small = little if small is None else small.union(little)
        big = sized.where(F.col("n") > local)
        if big.isEmpty():
            break
        path = big.where("2 * size >= n")
        found = stored(path.groupBy("top").agg(F.min_by("node", "size").alias("centroid")), "found")
        marked = stored(
            big.join(found, "top").select(
                "node", "up", *_VALUES, "add_a", "add_b", "centroid", F.expr("2 * size >= n").alias("on_path")
            ), "marked",
        )
        centroids = marked.where("node = centroid").select("node", *_VALUES, "add_a", "add_b")
        cut = F.col("up").eqNullSafe(F.col("centroid"))
        live = marked.where("node <> centroid").select(
            "node", F.when(~cut, F.col("up")).alias("up"), *_VALUES, "add_a", "add_b", F.when(cut, F.col("up")).alias("hang"),
            F.when(F.col("on_path"), F.col("centroid")).alias("centroid"),
        )
    # Stored first: above a join by "top" Spark would leave out this repartition, and splitting the join's skewed
    # partitions would then cut components.
    packed = stored(small, "small-components").repartition("top").sortWithinPartitions("top").mapInArrow(
        _finish(local), "node binary, a long, b long"
    )
    return packed if done is None else packed.union(done)


# ---- the trie ------------------------------------------------------------------------


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix hashes as names of nodes; the parent's is what the last turn added to."""

    def named(values: list[np.ndarray]) -> pa.Array:
        data = np.stack(values, axis=1).astype(">u8").tobytes()
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(values[0]), [None, pa.py_buffer(data)]).cast(
            pa.binary()
        )

    for batch in batches:
        rank, h, p = batch.column("rank").to_numpy(), [], []
        for base, name, prefix in zip(_BASES, ("h1", "h2"), ("p1", "p2")):
            powers = {int(r): _power(base, int(r)) for r in np.unique(rank)}
            scale = np.array([powers[int(r)] for r in rank], dtype=np.uint64)
            own = batch.column(prefix).to_numpy().view(np.uint64)
            p.append(own)
            h.append(own - batch.column(name).to_numpy().view(np.uint64) * scale)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("rank"), batch.column("words"), named(p), named(h)],
            names=["conv_id", "depth", "words", "node", "up"],
        )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) as rows of up to ``IDS`` ids."""
    for batch in batches:
        nodes, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows, begin = [], 0
        for i in range(1, len(nodes) + 1):
            if i == len(nodes) or nodes[i] != nodes[begin] or i - begin == IDS:
                rows.append((nodes[begin], ids[begin], ",".join(map(str, ids[begin:i]))))
                begin = i
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.string()))],
                names=["node", "first", "ids"],
            )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node = digest = None

    def one() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends"])

    for batch in batches:
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name == node:
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                yield one()
            node, digest = name, hashlib.sha256(ids.encode())
    if node is not None:
        yield one()


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends): SHA-256 of each node's conv_ids, ascending, joined by commas.

    Ids are packed where they lie after a range sort; only packed rows of a node meet in one task, which reads them one
    after the other.
    """
    packed = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _pack, "node binary, first long, ids string"
    )
    return packed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digest, "node binary, ends string")


def prefix_trie(turns: DataFrame, members: DataFrame, local: int = LOCAL) -> DataFrame:
    """All nodes of the trie over the conversations ``members`` (conv_id), whose turns are digests with ``turn`` as order.

    A node is a distinct sequence of first turns, the root the empty one. Per node: conv_id (smallest conversation that
    starts with it), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes in the
    subtree), saved_tokens (sum over the subtree of (n_convs - 1) * words of the last turn) and ends_sha256 (of the
    conversations that end there, see :func:`end_digests`; of the empty text if none does).

    Members without turns end at the root; turns of other conversations must not come. Without members there are no rows.
    """
    uses = stored(placed(turns).mapInArrow(_nodes, "conv_id long, depth long, words long, node binary, up binary"), "uses")
    members = stored(members.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), "members")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(_ROOT).alias("node"), F.lit(None).cast("binary").alias("up"), "conv_id", F.lit(0).cast("long").alias("depth"),
        "n_convs", F.lit(0).cast("long").alias("words"),
    )
    others = uses.groupBy("node").agg(
        F.min("up").alias("up"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"), F.min("words").alias("words"),
    )
    nodes = root.union(others)
    children = nodes.groupBy(F.col("up").alias("node")).agg(F.count("*").alias("n_children")).where("node IS NOT NULL")
    nodes = stored(
        nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "nodes",
    )
    values = nodes.select(
        "node", "up", (F.col("n_children") == 0).cast("long").alias("a"), ((F.col("n_convs") - 1) * F.col("words")).alias("b")
    )
    sums = subtree_sums(values, local).select("node", F.col("a").alias("n_leaves"), F.col("b").alias("saved_tokens"))

    last = uses.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node"))
    ends = members.join(last, "conv_id", "left").select(F.coalesce("node", F.lit(_ROOT)).alias("node"), "conv_id")
    digests = end_digests(ends)
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256().hexdigest()
    return nodes.join(sums, "node").join(digests, "node", "left").join(parents, "up", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
    )


def rebuilt(digests: DataFrame, shared: Column, base: Column) -> DataFrame:
    """Digests of conversations whose first ``shared`` turns come from conversation ``base``, then their own after these.

    Both are expressions of conv_id; ``shared`` is small. All of the base's turns come if it has fewer, none if there is
    no such conversation. ``turn`` of the result is the place that gives the order.
    """
    own = stored(placed(digests).select("conv_id", "rank", "h1", "h2", "words"), "own-turns")
    kept = own.where(F.col("rank") > shared)
    members = own.select("conv_id").distinct().select("conv_id", shared.alias("__shared"), base.alias("__base"))
    members = members.where("__shared > 0")
    taken = members.join(own.withColumnsRenamed({"conv_id": "__base"}), "__base").where(F.col("rank") <= F.col("__shared"))
    return kept.union(taken.select("conv_id", "rank", "h1", "h2", "words")).withColumnRenamed("rank", "turn")
