"""Packing of token sequences: a configuration linear program over the lengths, rounded, and the rest best-fit.

Only the number of pieces of each length reaches the driver; pieces find their place by their rank among those
of their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.rows import blocks_of
from churnspark.llm.tokenizing import TOGETHER, byte_tokenizer, with_end
from churnspark.session import staged

ROUNDS = 150  # price updates of the linear program
STEP = 0.1  # how strongly a length's lag moves its price
NEAR = 0.01  # a round uses configurations that are worth at least so near to the best
CATCH_UP = 4  # a round uses up to so many times its part of a length
FINEST = 64  # pieces shorter than this part of a sequence fill gaps and are left out of the linear program

Config = tuple[tuple[int, int], ...]  # (length, how many), longest first


def knapsack(worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity`` the most worth that fits, and the length to take first (0: less room does as well).

    ``worth`` is indexed by length; absent lengths are worth minus infinity.
    """
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        with_length = worth[1 : room + 1] + best[room - 1 :: -1][:room]
        length = int(with_length.argmax())
        if with_length[length] > best[room - 1] + 1e-12:
            best[room], take[room] = with_length[length], length + 1
        else:
            best[room] = best[room - 1]
    return best, take


def fillings(lengths: np.ndarray, take: np.ndarray, capacity: int) -> np.ndarray:
    """The best configuration that holds each length: rows of (configuration, length, how many)."""
    room = capacity - lengths
    used = np.arange(len(take))  # the room in which the next length is taken
    used = np.maximum.accumulate(np.where(take > 0, used, 0))
    which = [np.arange(len(lengths))]
    what = [lengths]
    open_ = np.arange(len(lengths))
    while len(open_):
        room[open_] = used[room[open_]]
        length = take[room[open_]]
        open_, length = open_[length > 0], length[length > 0]
        which.append(open_)
        what.append(length)
        room[open_] -= length
    pairs, n = np.unique(np.concatenate(which) * (capacity + 1) + np.concatenate(what), return_counts=True)
    return np.column_stack([pairs // (capacity + 1), pairs % (capacity + 1), n])


def linear_program(count: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[Config, float], float]:
    """How much of each configuration to use, and a lower bound on the number of sequences.

    Multiplicative weights: every length has a price. A round prices all configurations by a knapsack and takes,
    best first, the best configurations that hold each length, but of no length much more than its part of a round
    (a whole piece at least). Lengths that lag behind then become dearer, those ahead cheaper, and those used up
    leave. Prices divided by the worth of the best configuration are a feasible dual solution, so each round
    over all lengths gives a bound.
    """
    lengths = np.flatnonzero(count)
    n = count[lengths].astype(float)
    at = np.full(capacity + 1, -1)
    at[lengths] = np.arange(len(lengths))
    price, left = lengths / capacity, n.copy()
    bound, weight = 0.0, defaultdict(float)
    for turn in range(1, rounds + 1):
        open_ = left > 1e-9
        if not open_.any():
            break
        worth = np.full(capacity + 1, -np.inf)
        worth[lengths[open_]] = price[open_]
        best, take = knapsack(worth, capacity)
        full = np.full(capacity + 1, -np.inf)
        full[lengths] = price
        top = best[capacity] if open_.all() else knapsack(full, capacity)[0][capacity]
        bound = max(bound, float(n @ price) / top)
        rows = fillings(lengths[open_], take, capacity)
        held = np.bincount(rows[:, 0], rows[:, 2] * price[at[rows[:, 1]]])
        begin = np.searchsorted(rows[:, 0], np.arange(len(held) + 1))
        ahead = np.minimum(left, np.maximum(n * CATCH_UP / rounds, 1)).tolist()
        items = list(zip(at[rows[:, 1]].tolist(), rows[:, 1].tolist(), rows[:, 2].tolist(), strict=True))
        for k in np.argsort(-held, kind="stable"):
            if held[k] < (1 - NEAR) * best[capacity]:
                break
            config = items[begin[k] : begin[k + 1]]
            much = min(ahead[i] / many for i, _, many in config)
            if much > 1e-9:
                for i, _, many in config:
                    ahead[i] -= much * many
                    left[i] -= much * many
                weight[tuple((length, many) for _, length, many in reversed(config))] += much
        lag = turn / rounds - (1 - left / n)
        price = lengths / capacity * np.exp(STEP * lag)
    return weight, bound


class Group(NamedTuple):
    """``copies`` sequences that hold the same lengths, with ``room`` left."""

    copies: int
    held: Config
    room: int


def whole_configs(weight: dict[Config, float], count: np.ndarray, capacity: int) -> list[Group]:
    """Whole numbers of configurations: fractions are rounded so that their running sum stays right, and no
    length is used more often than it occurs. ``count`` loses what is used."""
    groups = []
    carried = 0.0
    for config, x in sorted(weight.items(), reverse=True):
        copies = int(x + carried + 0.5)
        carried += x - copies
        copies = min([copies, *(int(count[length]) // many for length, many in config)])
        if copies > 0:
            for length, many in config:
                count[length] -= copies * many
            groups.append(Group(copies, config, capacity - sum(length * many for length, many in config)))
    return groups


def best_fit(groups: list[Group], count: np.ndarray, capacity: int) -> list[Group]:
    """Place what ``count`` holds, longest first, where the least room is left; what fits nowhere opens sequences.

    Equal sequences are filled together, so the work follows the number of lengths and groups, not of pieces.
    """
    by_room: dict[int, list[Group]] = defaultdict(list)
    for g in groups:
        by_room[g.room].append(g)
    filled = np.zeros(capacity + 2, bool)  # rooms that some group has
    filled[[*by_room]] = True
    for length in np.flatnonzero(count)[::-1].tolist():
        left = int(count[length])
        while left:
            room = length + int(filled[length:].argmax())
            if filled[room]:
                copies, held, _ = by_room[room].pop()
                if not by_room[room]:
                    filled[room] = False
                many = min(room // length, max(1, left // copies))
                used = min(copies, left // many)
                if used < copies:
                    by_room[room].append(Group(copies - used, held, room))
                    filled[room] = True
            else:
                room, held = capacity, ()
                many = min(capacity // length, left)
                used = left // many
            left -= used * many
            by_room[room - many * length].append(Group(used, (*held, (length, many)), room - many * length))
            filled[room - many * length] = True
    return [g for some in by_room.values() for g in some]


class Plan(NamedTuple):
    """Where the pieces of a length go, by rank: from ``rank`` on, ``many`` to a sequence, at ``offset``."""

    key: np.ndarray  # length, then rank, ascending
    sequence: np.ndarray
    many: np.ndarray
    offset: np.ndarray
    sequences: int
    bound: int  # no packing has fewer sequences

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (length << np.int64(40)) | rank
        at = np.searchsorted(self.key, wanted, "right") - 1
        row = wanted - self.key[at]
        return self.sequence[at] + row // self.many[at], self.offset[at] + row % self.many[at] * length


def plan_packing(count: np.ndarray, capacity: int) -> Plan:
    """The plan for ``count[l]`` pieces of each length l up to ``capacity``."""
    left = count.astype(np.int64).copy()
    full = int(left[capacity])
    left[capacity] = 0
    groups = [Group(full, ((capacity, 1),), 0)] if full else []
    large = left.copy()
    large[: max(1, capacity // FINEST)] = 0
    bound = -(-int(left @ np.arange(capacity + 1)) // capacity)
    if large.any():
        weight, dual = linear_program(large, capacity)
        bound = max(bound, int(np.ceil(dual - 1e-6)))
        groups += whole_configs(weight, left, capacity)
    groups = best_fit(groups, left, capacity)
    rows, base = [], 0
    for copies, held, _ in sorted(groups, key=lambda g: (g.held, g.copies), reverse=True):
        offset = 0
        for length, many in held:
            rows.append((length, copies * many, base, many, offset))
            offset += length * many
        base += copies
    if not rows:
        none = np.empty(0, np.int64)
        return Plan(none, none, none, none, 0, 0)
    rows = np.array(sorted(rows), np.int64)
    upto = np.cumsum(rows[:, 1]) - rows[:, 1]
    start = upto - upto[np.searchsorted(rows[:, 0], rows[:, 0])]
    return Plan((rows[:, 0] << np.int64(40)) | start, rows[:, 2], rows[:, 3], rows[:, 4], base, bound + full)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """The ids of every text and an end id, cut into pieces that fit; the first piece of a cut text may be shorter.

    Rows (part, rank, <id>, piece, start, length, ids_crc32) and, if asked for, ids, written to the shared
    folder. ``rank`` counts the pieces of one length within the part that a task wrote.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = byte_tokenizer(tokenizer).encode_all
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            at = 0
            for raw in blocks_of(batch.column(1).cast(pa.large_binary()), **TOGETHER):
                ids, size = with_end(*encode_all([t or b"" for t in raw]), end_id)
                n = -(-size // capacity)
                own = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                stop = size[own] - (n[own] - 1 - piece) * capacity
                start = np.maximum(stop - capacity, 0)
                length = stop - start
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(ranked)) - np.searchsorted(ranked, ranked) + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                base = (np.cumsum(size) - size)[own]
                views = [ids[a:b] for a, b in zip((base + start).tolist(), (base + stop).tolist(), strict=True)]
                columns = {
                    "part": pa.array(np.full(len(own), part, np.int32)),
                    "rank": pa.array(rank),
                    id_col: batch.column(0).slice(at, len(raw)).take(pa.array(own)),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(v) for v in views], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([v.astype(np.int32) for v in views], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)
                at += len(raw)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"part int, rank long, `{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    return staged(rows.mapInArrow(cut, schema + (", ids array<int>" if with_ids else "")), "pieces")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Return per piece (<id>, piece, start, length, ids_crc32, sequence_id, offset) and, if asked for, ids.

    A document is its ids and ``end_id``; only documents longer than ``capacity`` are cut, into pieces of that
    length, of which the first may be shorter. Pieces fill sequences without gaps from 0.

    The number of pieces of each length (at most ``capacity`` numbers) decides the plan; a piece finds its place
    by its rank among all pieces of its length, which is its rank within its part and the number of such pieces in
    the parts before. So a length that most pieces have needs no task of its own.

    A null text is empty: the end id alone. Rows with null or repeated ids are documents like others. Extra
    columns are ignored; an empty table gives no rows.
    """
    cut = token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids)
    runs = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    count = np.zeros(capacity + 1, np.int64)
    for row in runs.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        count[row["length"]] = row["n"]
    plan = plan_packing(count, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(runs, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    shown = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*shown, "rank")
    keep = len(shown)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = plan.place(batch.column(3).to_numpy(), batch.column(keep).to_numpy())
                placed = [*batch.columns[:keep], pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(placed, names=[*shown, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:keep])
    return ranked.mapInArrow(place, kinds + ", sequence_id long, offset long")


def packed_sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence (sequence_id, ids) from the pieces with their ids; a sequence has no more than the capacity."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(pieces["ids"]).alias("ids"))
