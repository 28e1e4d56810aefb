"""Packing of tokenised documents into sequences of a fixed length.

Only the histogram of piece lengths decides how pieces go together, and it has at most as many entries as a sequence
has tokens. Its configuration linear program (which combinations of lengths fill a sequence, and how many sequences use
each) is solved by multiplicative weights on the driver: lengths that are covered least weigh most, and a knapsack
dynamic program prices the best configurations. Its configurations of least waste are used as often as the solution says,
rounded, and what they leave is solved again while that places whole configurations; the last pieces go best-fit, with the
shortest tenth, which is held back to close gaps. Pieces then take the slots of their length by rank; ranks come from salted
groups, so that a length which a third of all pieces share is never one group.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

CAPACITY = 1024
END_ID = 2
HELD_BACK = 0.1  # of the pieces, the shortest ones
TOLERANCES = (0.02, 0.002)  # of configurations used in one round, below the best one's value
GROUP_ROWS = 500  # rows aimed at in a group that ranks pieces of one length
_SLICE_BYTES = 8 << 20  # text tokenised at once in a task

# White space beside a space: such texts are not cut at their spaces.
_SPACES = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_UNEVEN = f" [{_SPACES}]|[{_SPACES}] |^ | $"


# Tokens ------------------------------------------------------------------------------------------------------------


class Tokens:
    """Ids of many texts at once: every different word is encoded once.

    A byte-level BPE cuts text before the space of " word", so texts with single spaces between words are the ids of
    their first word and then of each " word". The vocabulary's ranks encode words; a text that holds a special token
    goes to the tokenizer file itself.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def one(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.encode(text)

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        for s in self.special:
            uneven = pc.or_(uneven, pc.match_substring(texts, s))
        uneven = uneven.to_numpy(zero_copy_only=False)
        even = np.flatnonzero(~uneven)
        words = pc.split_pattern(texts.take(pa.array(even)), " ")
        flat = words.flatten().dictionary_encode()
        index = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets -= offsets[0] if len(offsets) else 0

        # Ids of all " word"s in a row, cut where the words' bytes end.
        different = flat.dictionary
        ids = np.array(self.encode(" " + " ".join(different.to_pylist())) if len(different) else [], dtype=np.int64)
        ends = np.cumsum(pc.binary_length(different).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        cuts = np.concatenate([[0], np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1])

        # After them the ids of what stands alone: first words, and whole texts that are not even.
        alone: list[list[int]] = [self.encode(different[index[o]].as_py()) for o in offsets[:-1]]
        alone += [self.one(texts[int(i)].as_py()) for i in np.flatnonzero(uneven)]
        index[offsets[:-1]] = len(different) + np.arange(len(even))
        sizes = np.concatenate([np.diff(cuts), np.fromiter(map(len, alone), np.int64, len(alone))])
        ids = np.concatenate([ids.astype("<u4"), *[np.array(a, dtype="<u4") for a in alone]])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        lengths = sizes[index]
        where = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(where[-1]) - np.repeat(where[:-1] - starts[index], lengths)
        gathered = ids[places]

        out: list[np.ndarray] = [np.empty(0, dtype="<u4")] * len(texts)
        for k, i in enumerate(even):
            out[i] = gathered[where[offsets[k]] : where[offsets[k + 1]]]
        for k, i in enumerate(np.flatnonzero(uneven)):
            at = len(different) + len(even) + k
            out[i] = ids[starts[at] : starts[at + 1]]
        return out


@lru_cache(maxsize=2)
def _tokens(json_path: str, ranks_path: str, pattern: str) -> Tokens:
    return Tokens(json_path, ranks_path, pattern)


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded bytes; a longer row stands alone."""
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > _SLICE_BYTES:
            yield begin, i
            begin, total = i, 0
        total += n
    if len(sizes):
        yield begin, len(sizes)


def token_pieces(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document's ids are its text's (a null text is empty) and then ``end_id``, so every row gives a piece. Longer
    documents are cut into pieces of ``capacity``; the first is what is left over. Rows that repeat an id are rows of
    their own, and a null id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(json_path, ranks_path, pattern)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in _slices(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                rows, cols, ids_out = [], ([], [], [], []), []
                for row, ids in enumerate(tokens.many(texts.slice(a, b - a)), a):
                    ids = np.append(ids, np.array([end_id], dtype="<u4"))
                    begin, end = 0, (len(ids) - 1) % capacity + 1
                    while begin < len(ids):
                        part = ids[begin:end]
                        rows.append(row)
                        for col, value in zip(cols, (begin // capacity + bool(begin % capacity), begin, end - begin,
                                                     zlib.crc32(part.tobytes()))):
                            col.append(value)
                        if with_ids:
                            ids_out.append(part.astype(np.int32))
                        begin, end = end, end + capacity
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()),
                          *(pa.array(c, pa.int64()) for c in cols[1:])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(ids_out, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


# Configurations ----------------------------------------------------------------------------------------------------

Pattern = tuple[tuple[int, int], ...]  # (length, how many of it), longest first


def _knapsack(value: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each room, and the length that goes in first (0: none; one token is left empty)."""
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        n = np.searchsorted(lengths, room, side="right")
        best[room] = best[room - 1]
        if n:
            worth = value[:n] + best[room - lengths[:n]]
            k = int(worth.argmax())
            if worth[k] > best[room]:
                best[room], pick[room] = worth[k], lengths[k]
    return best, pick


def _filling(first: int, pick: np.ndarray, capacity: int) -> Pattern:
    """The configuration of ``first`` and the best filling of the room it leaves."""
    counts: dict[int, int] = {first: 1}
    room = capacity - first
    while room:
        if pick[room]:
            counts[int(pick[room])] = counts.get(int(pick[room]), 0) + 1
            room -= int(pick[room])
        else:
            room -= 1
    return tuple(sorted(counts.items(), reverse=True))


def solve_configurations(
    counts: dict[int, int], capacity: int = CAPACITY, rounds: int = 100, step: float = 0.1, tolerance: float = 0.02
) -> dict[Pattern, float]:
    """A nearly optimal fractional covering of all lengths by configurations, by multiplicative weights.

    Lengths weigh exp(-coverage / step) for each piece of them. In every round one knapsack prices all
    configurations: those that are within ``tolerance`` of the best one and hold a length of large weight get a
    share of sequences that covers none of their lengths by more than ``step``.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    need = np.array([counts[int(n)] for n in lengths], dtype=float)
    at = {int(n): i for i, n in enumerate(lengths)}
    cover, uses = np.zeros(len(lengths)), {}
    for _ in range(rounds):
        weight = np.exp(-(cover - cover.min()) / step) * lengths
        best, pick = _knapsack(weight, lengths, capacity)
        forced = weight + best[capacity - lengths]
        good = np.flatnonzero(forced >= (1 - tolerance) * best[capacity])
        fresh = cover.copy()
        for i in good[np.argsort(-weight[good], kind="stable")]:
            pattern = _filling(int(lengths[i]), pick, capacity)
            inside = [(at[n], k) for n, k in pattern]
            if any(fresh[j] - cover[j] >= step for j, _ in inside):
                continue  # it has had its share of this round
            amount = step * min(need[j] / k for j, k in inside)
            uses[pattern] = uses.get(pattern, 0.0) + amount
            for j, k in inside:
                fresh[j] += amount * k / need[j]
        cover = fresh
        if cover.min() >= 1 / step:
            break
    scale = max(cover.min(), np.median(cover) / 2)
    return {p: u / scale for p, u in uses.items()} if scale else uses


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over the histogram; equal sequences are handled together."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted((r for r in open_ if r >= length)):
            fit, groups = room // length, open_.pop(room)
            kept = []
            for pattern, many in groups:
                whole, rest = divmod(left, fit) if left < many * fit else (many, 0)
                for used, k in ((whole, fit), (1 if rest else 0, rest)):
                    if used and k:
                        open_.setdefault(room - k * length, []).append(((*pattern, (length, k)), used))
                        left -= used * k
                        many -= used
                if many:
                    kept.append((pattern, many))
            if kept:
                open_.setdefault(room, []).extend(kept)
            if not left:
                break
        fit = capacity // length
        whole, rest = divmod(left, fit)
        if whole:
            open_.setdefault(capacity - fit * length, []).append((((length, fit),), whole))
        if rest:
            open_.setdefault(capacity - rest * length, []).append((((length, rest),), 1))
    return [group for groups in open_.values() for group in groups]


def _rounded(
    counts: dict[int, int], capacity: int, tolerance: float
) -> tuple[list[tuple[Pattern, int]], list[tuple[Pattern, int]]]:
    """Sequences from the program, and best fit for what they leave.

    The configurations of least waste are used as often as the solution says, rounded down, and once more where at least
    half a use is left over and their pieces are; the rest is solved again as long as that places a fiftieth of it. The
    shortest pieces are held back meanwhile: best fit closes the last gaps with them.
    """
    left, short, out = dict(counts), {}, {}
    for length in sorted(counts):
        if length > capacity // 8 or sum(short.values()) >= HELD_BACK * sum(counts.values()):
            break
        short[length] = left.pop(length)
    while left:
        uses = solve_configurations(left, capacity, tolerance=tolerance)
        waste = {p: capacity - sum(n * k for n, k in p) for p in uses}
        least, placed = min(waste.values()), 0
        best = sorted((p for p in uses if waste[p] == least), key=lambda p: -uses[p])
        for times in (lambda p: int(uses[p]), lambda p: int(uses[p] % 1 >= 0.5)):
            for pattern in best:
                many = min([times(pattern), *(left[n] // k for n, k in pattern)])
                if many:
                    out[pattern] = out.get(pattern, 0) + many
                    placed += many
                    for n, k in pattern:
                        left[n] -= k * many
        left = {n: k for n, k in left.items() if k}
        if placed < max(1, sum(n * k for n, k in left.items()) / capacity / 50):
            break
    return list(out.items()), _best_fit({n: k for n, k in (left | short).items() if k}, capacity)


def configurations(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """(configuration, number of sequences) that hold every piece of the histogram exactly once.

    Those of the program first, then those of best fit for what they leave, see ``_rounded``. Of the solutions at two
    tolerances the one with fewer sequences is taken.
    """
    whole = [(((capacity, 1),), counts[capacity])] if counts.get(capacity) else []
    left = {n: k for n, k in counts.items() if k and n < capacity}
    solved = [sum(_rounded(left, capacity, tolerance), []) for tolerance in TOLERANCES] if left else [[]]
    return whole + min(solved, key=lambda groups: sum(times for _, times in groups))


def program_share(counts: dict[int, int], capacity: int = CAPACITY) -> float:
    """Share of the sequences of pieces shorter than the capacity that come from the program, not from best fit."""
    left = {n: k for n, k in counts.items() if k and n < capacity}
    solved = [tuple(sum(t for _, t in part) for part in _rounded(left, capacity, x)) for x in TOLERANCES] if left else [(0, 0)]
    program, rest = min(solved, key=sum)
    return program / max(1, program + rest)


class Slots:
    """Where the pieces of each length go, by their rank among those of that length."""

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        ends: dict[int, int] = {}
        sequence = 0
        for pattern, times in patterns:
            offset = 0
            for length, k in pattern:
                rows.setdefault(length, []).append((ends.get(length, 0), sequence, k, offset))
                ends[length] = ends.get(length, 0) + k * times
                offset += k * length
            sequence += times
        self.by_length = {n: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for n, r in rows.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), dtype=np.int64), np.empty(len(length), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
            n = int(length[part[0]])
            begins, base, k, at = self.by_length[n]
            row = np.searchsorted(begins, rank[part], side="right") - 1
            inside = rank[part] - begins[row]
            sequence[part] = base[row] + inside // k[row]
            offset[part] = at[row] + inside % k[row] * n
        return sequence, offset


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The stored pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Every piece gets a place; sequences are filled from offset 0 without gaps. Equal pieces may take each other's
    place. Without pieces there are no sequences.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = Slots(configurations(histogram, capacity))
    # As many salts as a length's own pieces need: frequent lengths are cut up, rare ones stay one group.
    salts = F.lit([-(-max(1, histogram.get(n, 0)) // GROUP_ROWS) for n in range(capacity + 1)])
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.element_at(salts, (F.col("length") + 1).cast("int")))
    salted = pieces.select(*names, salt.alias("salt"))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt",
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"),
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("inside", F.row_number().over(inside) - 1).join(before, ["length", "salt"]).select(
        *names, (F.col("before") + F.col("inside")).alias("rank")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            places = slots.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *map(pa.array, places)], names=[*names, "sequence_id", "offset"]
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents with their places; see ``token_pieces`` and ``place_pieces`` for odd rows."""
    return place_pieces(stored(token_pieces(docs, json_path, ranks_path, pattern, capacity, end_id), "pieces"), capacity)


def sequences(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, from placed pieces and pieces with ids."""
    key = ["doc_id", "piece", "ids_crc32"]
    ids = pieces.select(*key, "ids").dropDuplicates(key)
    match = placed.alias("p").join(
        ids.alias("i"), F.expr(" AND ".join(f"p.{c} <=> i.{c}" for c in key))
    ).select("p.sequence_id", "p.offset", "i.ids")
    parts = match.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
