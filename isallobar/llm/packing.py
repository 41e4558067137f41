"""Best-fit packing of documents into fixed-length sequences by bin completion.

Only the number of pieces of each length matters to a packing, and there are at
most ``capacity`` lengths.  So the plan is made on the driver from that bounded
histogram, whatever the number of documents, and is a list of fillings with
their multiplicities.  Pieces then look up their place by their rank among the
pieces of the same length; the ranks are made by a distributed prefix sum.

Planning is bin completion: take the largest length left, enumerate undominated
fillings of the room beside it, prune those whose waste cannot beat the incumbent, and
branch over what remains, each filling as often as the counts allow and once.
Best-fit decreasing gives the first incumbent; where it meets the lower bound no branch
can beat it, and the search is over at its root.  Bounds on the search are parameters:
beyond them the best plan found so far is returned, never one that is worse.  All nodes
share one histogram of what is left, and only the deepest keep their fillings; others
enumerate them again on return, so the path from the root takes little memory.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isallobar.llm.bpe import MergeTable, batch_texts
from isallobar.llm.common import settle

CAPACITY = 2048
#: Nodes of the search beyond two for each length, and nodes visited for the fillings of one node.
NODES, FILLING_NODES = 3000, 400
#: Deepest nodes of the search that keep their fillings.
KEPT = 16

PIECE_SCHEMA = "piece int, start bigint, length bigint, ids_crc32 bigint, part int, row bigint"


@dataclass(frozen=True)
class Filling:
    """``times`` sequences that each hold ``lengths`` (largest first)."""

    lengths: tuple[int, ...]
    times: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing over a histogram of lengths, whole runs at a time."""
    rooms: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                deep = capacity // length
                full, rest = divmod(left, deep)
                for k, n in ((deep, full), (rest, 1)):
                    if k and n:
                        held = rooms.setdefault(capacity - k * length, {})
                        held[(length,) * k] = held.get((length,) * k, 0) + n
                left = 0
            else:
                inside, n = rooms[room].popitem()
                if not rooms[room]:
                    del rooms[room]
                used = min(n, left)
                if used < n:
                    rooms.setdefault(room, {})[inside] = n - used
                held = rooms.setdefault(room - length, {})
                held[(*inside, length)] = held.get((*inside, length), 0) + used
                left -= used
    return [Filling(x, n) for held in rooms.values() for x, n in held.items()]


def fillings(room: int, counts: dict[int, int], lengths: list[int], limit: int = FILLING_NODES) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Undominated fillings of ``room`` as (waste, ((length, times), ...)), least waste first.

    ``lengths`` are those of ``counts`` in rising order.  A filling is dominated if one more
    piece fits, or if one of its pieces may give way to a larger one that is left.  Fillings
    with the larger pieces come first; after ``limit`` nodes the enumeration ends, but not
    before the first filling.
    """
    found: list[tuple[int, tuple[tuple[int, int], ...]]] = []

    def undominated(waste: int, chosen: tuple[tuple[int, int], ...]) -> bool:
        used = dict(chosen)

        def spare(low: int, high: int) -> bool:
            return any(counts[y] > used.get(y, 0) for y in lengths[bisect_right(lengths, low) : bisect_right(lengths, high)])

        return not waste or not (spare(0, waste) or any(spare(x, x + waste) for x in used))

    stack: list[tuple[int, int, tuple[tuple[int, int], ...], int]] = [(room, len(lengths), (), -1)]
    nodes = 0
    while stack and (nodes < limit or not found):
        nodes += 1
        left, top, chosen, times = stack.pop()
        if times < 0:
            top = bisect_right(lengths, left, 0, top)
            if not top:
                if undominated(left, chosen):
                    found.append((left, chosen))
                continue
            times = min(counts[lengths[top - 1]], left // lengths[top - 1])
        x = lengths[top - 1]
        if times:
            stack.append((left, top, chosen, times - 1))
        stack.append((left - times * x, top - 1, (*chosen, (x, times)) if times else chosen, -1))
    return sorted(found, key=lambda f: (f[0], tuple((-x, -n) for x, n in f[1])))


def _sequences(plan: list[Filling]) -> int:
    return sum(f.times for f in plan)


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """Lower bound: all pieces end to end, or the large ones apart and what cannot stand beside them."""
    pieces = sorted(counts.items())
    best = -(-sum(x * n for x, n in pieces) // capacity)
    alone = sum(n for x, n in pieces if 2 * x > capacity)
    for low in {x for x, _ in pieces if 2 * x <= capacity}:
        sole = sum(n for x, n in pieces if x > capacity - low)
        room = sum((capacity - x) * n for x, n in pieces if 2 * x > capacity and x <= capacity - low)
        small = sum(x * n for x, n in pieces if low <= x and 2 * x <= capacity)
        best = max(best, alone + max(0, -(-(small - room) // capacity)), sole)
    return max(best, alone)


@dataclass
class Node:
    """The filling that led here, the waste and the sequences so far, how many fillings are tried, and those not yet tried, if kept."""

    filling: tuple[tuple[int, int], ...]
    times: int
    waste: int
    used: int
    tried: int = 0
    options: Iterator[tuple[int, tuple[tuple[int, int], ...], int]] | None = None


def _options(counts: dict[int, int], capacity: int) -> Iterator[tuple[int, tuple[tuple[int, int], ...], int]]:
    """(waste of one, lengths with their times, sequences) to try around the largest length left."""
    lengths = sorted(counts)
    top = lengths[-1]
    counts = counts | {top: counts[top] - 1}
    if not counts[top]:
        del counts[top]
        lengths.pop()
    once = []
    for lost, chosen in fillings(capacity - top, counts, lengths):
        inside = dict(chosen)
        inside[top] = inside.get(top, 0) + 1
        whole = tuple(sorted(inside.items(), reverse=True))
        most = min((counts.get(x, 0) + (x == top)) // n for x, n in whole)
        if most > 1:
            once.append((lost, whole, 1))
        yield lost, whole, most
    yield from once


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Filling]:
    """Fillings that hold every piece of the histogram once.

    An empty histogram gives an empty plan; lengths must lie in 1..capacity.
    """
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    counts = {x: n for x, n in counts.items() if n}
    best = best_fit_decreasing(counts, capacity)
    floor = least_sequences(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    if _sequences(best) <= floor:
        return best
    rest = dict(counts)
    stack = [Node((), 0, 0, 0)]
    left = nodes + 2 * len(counts)
    while stack and left and _sequences(best) > floor:
        node = stack[-1]
        if node.options is None:
            node.options = islice(_options(rest, capacity), node.tried, None)
        option = next(node.options, None)
        if option is None:
            stack.pop()
            for x, n in node.filling:
                rest[x] = rest.get(x, 0) + n * node.times
            continue
        node.tried += 1
        lost, whole, times = option
        waste, used = node.waste + lost * times, node.used + times
        # Any plan that beats the incumbent wastes at most this much in all.
        if waste > (_sequences(best) - 1) * capacity - total:
            continue
        left -= 1
        for x, n in whole:
            rest[x] -= n * times
            if not rest[x]:
                del rest[x]
        if rest:
            stack.append(Node(whole, times, waste, used))
            if len(stack) > KEPT:
                stack[-KEPT - 1].options = None
            continue
        # The waste bound holds, so it is better.
        best = [Filling(tuple(x for x, n in f for _ in range(n)), k) for f, k in [*((n.filling, n.times) for n in stack[1:]), (whole, times)]]
        for x, n in whole:
            rest[x] = rest.get(x, 0) + n * times
    return best


def place_table(plan: list[Filling]) -> np.ndarray:
    """Where the pieces of each length go, ordered by length and rank.

    Rows (length, first rank, times, first sequence, offset): the pieces with ranks
    from ``first rank`` up to ``first rank + times`` go to as many sequences.
    """
    rows, rank, base = [], {}, 0
    for filling in plan:
        offset = 0
        for x in filling.lengths:
            at = rank.get(x, 0)
            rows.append((x, at, filling.times, base, offset))
            rank[x] = at + filling.times
            offset += x
        base += filling.times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def document_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Tokenise whole texts, append ``end_id`` and cut what is longer than a sequence.

    Returns ``doc_id`` and a row for each piece; (part, row) numbers the rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, part, row = MergeTable.load(vocabulary), TaskContext.get().partitionId(), 0
        for keys, texts in batch_texts(batches):
            owner, rows = [], []
            for k, ids in enumerate(table.encode(texts)):
                raw = np.append(ids, end_id).astype("<u4").tobytes()
                for piece, (start, length) in enumerate(cut(len(ids) + 1, capacity)):
                    owner.append(k)
                    rows.append((piece, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), part, row))
                    row += 1
            piece, start, length, crc, parts, number = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(owner)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array(parts, pa.int32()), pa.array(number, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "row"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, {PIECE_SCHEMA}")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack whole documents into as few sequences of ``capacity`` ids as bin completion finds.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset, a row
    for each piece.  Null and empty texts are one id (the end).  Repeated rows are
    packed each on its own, a null doc_id stays null, other columns are ignored,
    an empty table gives no rows.  The driver sees the histogram of lengths only.
    """
    pieces = settle(document_pieces(docs, vocabulary, capacity), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = place_table(plan_packing(histogram, capacity))
    key = places[:, 0] << 40 | places[:, 1] if len(places) else np.empty(0, np.int64)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    within = Window.partitionBy("length", "part").orderBy("row")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["length", "part"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            at = np.searchsorted(key, length.astype(np.int64) << 40 | rank, "right") - 1
            sequence = places[at, 3] + rank - places[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), pa.array(sequence), pa.array(places[at, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("skip") + F.col("rank")).cast("long").alias("rank"))
    return chosen.mapInArrow(work, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
