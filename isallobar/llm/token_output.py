"""Packed token matrices: best-fit decreasing with a segment tree over capacities.

Each task packs the documents it reads, window by window, so nothing is shuffled
and memory is bounded by a window.  A window wastes at most a few sequences out
of thousands.  Overlong documents are split without loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from isallobar.llm.bpe import MergeTable, batch_texts

CAPACITY = 2048
#: Ids that a task gathers before it packs them.
WINDOW = 4_000_000


class CapacityTree:
    """Segment tree over room sizes: which open sequences have how much room."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.held[room].append(sequence)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) with the least room that is enough."""
        at = length + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, self.held[room].pop()


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, longest pieces first, ties in their order."""
    tree = CapacityTree(capacity)
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        found = tree.take(length)
        if found is None:
            room, number = capacity, opened
            opened += 1
        else:
            room, number = found
        sequence[k], offset[k] = number, capacity - room
        if room > length:
            tree.add(room - length, number)
    return sequence, offset


def packed_matrices(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, pad_id: int = 0, window: int = WINDOW) -> DataFrame:
    """Rows of a packed id matrix with the layout that attention kernels need.

    Returns ``sequence_id``, ``n_tokens``, ``ids`` (``capacity`` little-endian unsigned
    ids of ``id_bytes`` bytes each, padded with ``pad_id``), ``cu_seqlens`` (cumulative
    segment lengths from 0), ``position_resets`` (places where positions start
    again from 0), and for each segment ``doc_ids``, ``pieces`` and ``starts`` (the
    document's ids before it), so documents can be put together again.

    Null and empty texts are one id (the end).  Repeated rows are packed each on
    its own, a null doc_id stays null, other columns are ignored, an empty table
    gives no rows.  Sequence ids are the task number times 2**32 plus a count.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, base, made = MergeTable.load(vocabulary), TaskContext.get().partitionId() << 32, 0
        width = np.dtype("<u2") if len(table.token_size) <= 1 << 16 else np.dtype("<u4")
        held: list[tuple[object, int, int, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            lengths = np.array([len(x[3]) for x in held], np.int64)
            sequence, offset = best_fit(lengths, capacity)
            order = np.lexsort((offset, sequence))
            cuts = np.flatnonzero(np.diff(sequence[order])) + 1
            groups = np.split(order, cuts)
            for first in range(0, len(groups), 256):
                out: dict[str, list] = {k: [] for k in ("sequence_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "pieces", "starts")}
                for group in groups[first : first + 256]:
                    ids = np.full(capacity, pad_id, width)
                    ends = np.cumsum(lengths[group])
                    ids[: ends[-1]] = np.concatenate([held[k][3] for k in group])
                    out["sequence_id"].append(base + made)
                    out["n_tokens"].append(int(ends[-1]))
                    out["ids"].append(ids.tobytes())
                    out["cu_seqlens"].append([0, *ends.tolist()])
                    out["position_resets"].append([0, *ends[:-1].tolist()])
                    out["doc_ids"].append([held[k][0] for k in group])
                    out["pieces"].append([held[k][1] for k in group])
                    out["starts"].append([held[k][2] for k in group])
                    made += 1
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(key_type), pa.list_(pa.int32()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

        for keys, texts in batch_texts(batches):
            key_type = keys.type
            for key, ids in zip(keys.to_pylist(), table.encode(texts), strict=True):
                ids = np.append(ids, end_id).astype(width)
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    held.append((key, piece, start, ids[start : start + capacity]))
                size += len(ids)
                if size >= window:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        work,
        "sequence_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
        f"doc_ids array<{kind}>, pieces array<int>, starts array<bigint>",
    )
