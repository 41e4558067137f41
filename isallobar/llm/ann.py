"""Approximate nearest neighbours with randomly rotated one-bit codes.

Vectors are centred, normalised and rotated; the signs of the result are packed
into bits, and two scalars are kept: the length of the residual and the inner
product between the code and the residual's direction.  From these the inner
product with a query is estimated without bias, with a known error bound.  Only
vectors whose lower bound of the distance does not exceed a query's threshold are
measured exactly.

Vectors and queries are laid into blocks of bounded bytes.  Every block of vectors
meets every block of queries once, so a task holds two blocks whatever the input size,
and returns for each query its nearest vectors in the block.  Vectors are compared with
those of their own length; each length is searched on its own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isallobar.llm.common import settle

#: Nearest vectors asked for; bytes of a block of vectors and of queries.
K, VECTOR_BLOCK, QUERY_BLOCK = 10, 16 << 20, 1 << 19
#: Vector blocks that share a key.
TOGETHER = 4
#: Bound of the sample that gives each query its first threshold.
SAMPLE = 2_048
#: Half width of the error bound, in standard deviations of the estimate.
WIDTH = 4.0


def rotation(dimension: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same for each seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, residual lengths and code-to-direction inner products."""
    residual = vectors - centre
    length = np.sqrt((residual**2).sum(axis=1))
    turned = (residual / np.where(length, length, 1)[:, None]) @ turn
    agreement = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), length, np.where(length, agreement, 1.0)


def lower_bounds(bits: np.ndarray, length: np.ndarray, agreement: np.ndarray, query: np.ndarray, centre: np.ndarray, turn: np.ndarray, width: float = WIDTH) -> np.ndarray:
    """Lower bounds of the squared distances of ``query`` to the coded vectors."""
    dimension = len(query)
    residual = query - centre
    far = np.sqrt((residual**2).sum())
    turned = (residual / (far or 1.0)) @ turn
    # The inner product of the signs with the query: twice the sum over set bits less the whole sum.
    groups = np.zeros(8 * bits.shape[1])
    groups[:dimension] = turned
    shifts = (np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1
    tables = shifts @ groups.reshape(-1, 8).T
    signed = (2 * sum(tables[bits[:, k], k] for k in range(bits.shape[1])) - turned.sum()) / np.sqrt(dimension)
    estimate = signed / agreement
    error = width * np.sqrt(np.maximum(0, 1 - agreement**2)) / agreement / np.sqrt(max(1, dimension - 1))
    return length**2 + far**2 - 2 * length * far * np.minimum(1.0, estimate + error)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, squares added in the order of the components."""
    total = np.zeros(len(vectors))
    for k, x in enumerate(query.tolist()):
        step = vectors[:, k] - x
        total += step * step
    return np.sqrt(total)


def first_limits(ids: np.ndarray, queries: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Distance of each query to the ``k``-th nearest other vector of the sample (infinite if it has fewer)."""
    out = np.full(len(ids), np.inf)
    for i, (query_id, query) in enumerate(zip(ids, queries, strict=True)):
        known = distances(sample[sample_ids != query_id], query)
        if len(known) >= k:
            out[i] = np.partition(known, k - 1)[k - 1]
    return out


def _blocks(rows: DataFrame, size: int, dimension: int, label: str, finish: Callable[[np.ndarray, np.ndarray], list[np.ndarray]], names: tuple[str, ...]) -> DataFrame:
    """Lay rows (vec_id, embedding) into blocks of ``size`` rows: ids, float values, and what ``finish`` makes of them."""
    columns = ("ids", "vectors", *names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        ids: list[np.ndarray] = []
        values: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal made, ids, values
            one, many = np.concatenate(ids), np.concatenate(values)
            parts = [one, many, *finish(one, many)]
            made, ids, values = made + 1, [], []
            return pa.RecordBatch.from_arrays([pa.array([base + made], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["block", *columns])

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids.append(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
                values.append(part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension))
                held += part.num_rows
                if held >= size:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    shape = ", ".join(["block bigint", *(f"{c} binary" for c in columns)])
    return settle(rows.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(work, shape), label)


def nearest(vectors: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """The ``k`` nearest other rows of each row whose vec_id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id and score (the Euclidean distance),
    nearest first, ties to the smaller vec_id.  Null, zero and non-finite vectors and
    rows without an id take no part; vectors have a distance to those of their own
    length only.  Copies are separate candidates; a repeated vec_id counts as the
    query's own row.  A table with no usable vector, or with no query, gives no rows.
    The driver sees the different lengths, and a mean and a bounded sample of each.
    """
    spark = vectors.sparkSession
    whole = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(whole, lambda x: x != 0)
    usable = vectors.select("vec_id", whole.alias("embedding")).where(sound)
    lengths = sorted(r.n for r in usable.select(F.size("embedding").alias("n")).distinct().collect())
    found = [_nearest_of(usable.where(F.size("embedding") == n), n, every, k) for n in lengths]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionByName, found) if found else empty


def _nearest_of(usable: DataFrame, dimension: int, every: int, k: int) -> DataFrame:
    centre = np.array(usable.agg(*(F.avg(F.col("embedding")[i]) for i in range(dimension))).first(), np.float64)
    model = (centre, rotation(dimension))
    picked = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()  # bounded by SAMPLE
    sample_ids = np.array([r.vec_id for r in picked], np.int64)
    sample = np.array([r.embedding for r in picked], np.float64)

    rows = [max(1, size // (8 * dimension)) for size in (VECTOR_BLOCK, QUERY_BLOCK)]
    stored = _blocks(usable, rows[0], dimension, "vectors", lambda ids, values: list(encode(values, *model)), ("bits", "lengths", "agreements"))
    asked = _blocks(usable.where(F.col("vec_id") % every == 0), rows[1], dimension, "queries", lambda ids, values: [first_limits(ids, values, sample_ids, sample, k)], ("limits",))
    # Each query block goes to every key, and each vector block to one.
    keys = max(1, stored.count() // TOGETHER)
    spread = asked.select(F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"), "limits", F.explode(F.sequence(F.lit(0), F.lit(keys - 1))).alias("key"))
    dealt = stored.withColumn("key", F.pmod(F.xxhash64("block"), F.lit(keys)).cast("int"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                raw = [batch.column(c)[row].as_buffer() for c in range(8)]
                ids, query_ids = np.frombuffer(raw[0], np.int64), np.frombuffer(raw[5], np.int64)
                values, queries = (np.frombuffer(raw[c], np.float64).reshape(-1, dimension) for c in (1, 6))
                bits = np.frombuffer(raw[2], np.uint8).reshape(len(ids), -1)
                lengths, agreements, limits = (np.frombuffer(raw[c], np.float64) for c in (3, 4, 7))
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for query_id, query, limit in zip(query_ids.tolist(), queries, limits.tolist(), strict=True):
                    bound = lower_bounds(bits, lengths, agreements, query, *model)
                    near = np.flatnonzero((bound <= limit**2 * (1 + 1e-9)) & (ids != query_id))
                    if len(near) > 8 * k:  # measure the most promising ones first, they tighten the threshold
                        first = near[np.argpartition(bound[near], 4 * k)[: 4 * k]]
                        limit = min(limit, np.partition(distances(values[first], query), k - 1)[k - 1])
                        near = near[bound[near] <= limit**2 * (1 + 1e-9)]
                    exact = distances(values[near], query)
                    best = np.lexsort((ids[near], exact))[:k]
                    out.append((np.full(len(best), query_id), ids[near][best], exact[best]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    pairs = dealt.join(spread, "key").select("ids", "vectors", "bits", "lengths", "agreements", "query_ids", "queries", "limits")
    found = pairs.mapInArrow(work, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
