"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Statistics come from the UTF-8 bytes of whole texts, by flat numpy counting.  A
Gaussian kernel over the standardised statistics is approximated by random
cosines; each partition of labelled rows sums its part of the normal equations,
and only the sums (of fixed size) reach the driver.  Scores are calibrated by
isotonic regression over a fixed grid of raw scores, again from partition sums, on
labelled documents that the ridge has not seen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isallobar.llm.bpe import batch_texts
from isallobar.llm.common import discard, settle

#: Random cosines, kernel width (in standard deviations), ridge and calibration grid.
COSINES, KERNEL_WIDTH, RIDGE, GRID, SEED = 192, 6.0, 1e-3, 512, 11
#: Statistics count up to so many deviations, and half at so many bytes: a few words say little.
CLIP, SHORT_BYTES = 4.0, 40.0
#: Vectors that sums over all tasks are gathered in before the driver adds them.
SUMS = 16
#: A document is kept from this calibrated score on.
THRESHOLD = 0.7

STATISTICS = (
    "log_bytes", "log_words", "upper", "digit", "space", "newline", "stop", "comma", "bang", "marks", "brackets", "other",
    "high", "word_mean", "word_sd", "long_words", "lone_marks", "marked_words", "line_mean", "same_bytes", "entropy", "repeats",
)


def _group(chars: str) -> np.ndarray:
    mask = np.zeros(256)
    mask[[ord(c) for c in chars]] = 1
    return mask


GROUPS = np.stack(
    [
        _group("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _group("0123456789"), _group(" \t\r\x0b\x0c"), _group("\n"), _group("."), _group(",;:"),
        _group("!?"), _group("#$%&*@^~+=_"), _group("<>[]{}()/|\\"), _group("\"'`-"), (np.arange(256) > 127).astype(float),
    ]
)


def statistics(texts: list[str]) -> np.ndarray:
    """(texts x statistics); an empty text has zeros."""
    raw = [t.encode() for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((len(raw), len(STATISTICS)))
    if not size.sum():
        return out
    data = np.frombuffer(b"".join(raw), np.uint8)
    owner = np.repeat(np.arange(len(raw)), size)
    counts = np.bincount(owner * 256 + data, minlength=256 * len(raw)).reshape(-1, 256)
    bytes_ = np.maximum(size, 1)
    shares = counts @ GROUPS.T / bytes_[:, None]
    # Words: runs of bytes that are not white space, within a text.
    white = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data), bool)
    first[(np.cumsum(size) - size)[size > 0]] = True
    inside = ~white
    begin = np.flatnonzero(inside & (first | np.concatenate([[True], white[:-1]])))
    stop = np.flatnonzero(inside & np.concatenate([first[1:] | white[1:], [True]])) + 1
    length = stop - begin
    whose = owner[begin]
    words = np.bincount(whose, minlength=len(raw))
    some = np.maximum(words, 1)
    mean = np.bincount(whose, length, len(raw)) / some
    spread = np.sqrt(np.maximum(np.bincount(whose, length.astype(float) ** 2, len(raw)) / some - mean**2, 0))
    mark = (GROUPS[6] + GROUPS[7] + GROUPS[8]) > 0
    ends_marked = mark[data[stop - 1]] if len(stop) else np.empty(0, bool)
    lone = ends_marked & (length == 1)
    lines = counts[:, 10] + 1
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~first[1:] & ~white[1:]
    p = counts / bytes_[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    # Equal neighbouring lengths stand in for repeated passages.
    twin = np.zeros(len(length), bool)
    twin[1:] = (length[1:] == length[:-1]) & (whose[1:] == whose[:-1])
    columns = [np.log1p(size), np.log1p(words), *shares.T[:10], shares[:, 10]]
    columns += [mean, spread, np.bincount(whose, length > 15, len(raw)) / some, np.bincount(whose, lone, len(raw)) / some]
    columns += [np.bincount(whose, ends_marked, len(raw)) / some, np.log1p(bytes_ / lines), np.bincount(owner, same, len(raw)) / bytes_]
    columns += [entropy, np.bincount(whose, twin, len(raw)) / some]
    out = np.stack(columns, axis=1)
    out[size == 0] = 0
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text (null: empty)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batch_texts(batches):
            found = statistics(texts)
            yield pa.RecordBatch.from_arrays([keys, pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))], names=["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, stats array<double>")


@dataclass(frozen=True)
class Model:
    """Centre and scale of statistics, cosines, weights, and calibration over the raw score."""

    centre: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    grid: np.ndarray

    def lift(self, stats: np.ndarray) -> np.ndarray:
        size = np.expm1(stats[:, :1])
        z = np.clip((stats - self.centre) / self.scale, -CLIP, CLIP) * (size / (size + SHORT_BYTES))
        return np.concatenate([np.ones((len(z), 1)), np.sqrt(2 / len(self.phase)) * np.cos(z @ self.turn + self.phase)], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated probabilities, linear between the points of the grid."""
        at = np.clip(self.raw(stats), 0, 1) * (len(self.grid) - 1)
        return np.clip(np.interp(at, np.arange(len(self.grid)), self.grid), 0, 1)


def isotonic(good: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing fit of good/total on a grid; empty cells are filled linearly."""
    cells = np.flatnonzero(total > 0)
    pools: list[list[float]] = []
    for k in cells:
        pools.append([good[k], total[k], 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    fitted = np.concatenate([np.full(int(n), (g + 0.05) / (t + 0.1)) for g, t, n in pools])
    return np.interp(np.arange(len(total)), cells, np.maximum.accumulate(fitted))


def _sums(rows: DataFrame, width: int, part: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``part(stats, labels, apart)``, a vector of ``width`` numbers.

    Each task sends one packed vector; vectors are added up in ``SUMS`` groups before
    the driver sees as many.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                stats = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                held += part(stats, batch.column(1).to_numpy().astype(float), batch.column(2).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % SUMS], pa.int32()), pa.array([held.tobytes()], pa.binary())], names=["k", "v"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for v in batch.column(1):
                total += np.frombuffer(v.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    vectors = rows.select("stats", "label", "apart").mapInArrow(work, "k int, v binary")
    summed = vectors.repartition(SUMS, "k").mapInArrow(added, "v binary").collect()  # at most SUMS vectors
    return sum((np.frombuffer(r.v, np.float64) for r in summed), np.zeros(width))


def fit(rows: DataFrame) -> Model | None:
    """Fit on ``stats`` and ``label`` (0 or 1); None where there are no rows.

    Rows ``apart`` calibrate the scores and teach nothing else; if all rows or none are apart, all do both.
    """
    n = len(STATISTICS)
    first = _sums(rows, 4 * n + 2, lambda s, y, c: np.concatenate([x for k in (~c, c) for x in (s[k].sum(axis=0), (s[k] ** 2).sum(axis=0), [k.sum()])]))
    learned, other = first[: 2 * n + 1], first[2 * n + 1 :]
    if not learned[-1] + other[-1]:
        return None
    both = not learned[-1] or not other[-1]
    if both:
        learned = learned + other
    count = learned[-1]
    centre = learned[:n] / count
    scale = np.sqrt(np.maximum(learned[n : 2 * n] / count - centre**2, 1e-12))
    random = np.random.default_rng(SEED)
    model = Model(centre, scale, random.standard_normal((n, COSINES)) / KERNEL_WIDTH, random.uniform(0, 2 * np.pi, COSINES), np.zeros(COSINES + 1), np.zeros(GRID))
    m = COSINES + 1
    upper = np.triu_indices(m)

    def equations(stats: np.ndarray, labels: np.ndarray, apart: np.ndarray) -> np.ndarray:
        use = ~apart | both
        z = model.lift(stats[use])
        return np.concatenate([(z.T @ z)[upper], z.T @ labels[use]])

    sums = _sums(rows, len(upper[0]) + m, equations)
    left = np.zeros((m, m))
    left[upper] = sums[:-m]
    left = left + np.triu(left, 1).T
    weights = np.linalg.solve(left + RIDGE * count * np.diag([0.0] + [1.0] * COSINES) / m + 1e-9 * np.eye(m), sums[-m:])
    model = Model(centre, scale, model.turn, model.phase, weights, model.grid)

    def cells(stats: np.ndarray, labels: np.ndarray, apart: np.ndarray) -> np.ndarray:
        use = apart | both
        at = np.rint(np.clip(model.raw(stats[use]), 0, 1) * (GRID - 1)).astype(int)
        return np.concatenate([np.bincount(at, labels[use], GRID), np.bincount(at, minlength=GRID)])

    good, total = np.split(_sums(rows, 2 * GRID, cells), 2)
    return Model(centre, scale, model.turn, model.phase, weights, isotonic(good, total))


def remainder(doc_id: str) -> Column:
    """crc32 of a document's id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def held_out(doc_id: str) -> Column:
    """Whether a document's label is kept from training: its remainder is 2."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def learned(stats: DataFrame, labels: DataFrame) -> Model | None:
    """The model of all labels that may be learned from; those of remainder 3 calibrate it."""
    known = labels.where("quality IN (0, 1)").where(~held_out("doc_id")).groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where("label = most")
    joined = stats.join(known.select("doc_id", "label"), "doc_id").select("stats", "label", (remainder("doc_id") == 3).alias("apart"))
    rows = settle(joined, "labelled")
    model = fit(rows)
    discard(rows)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every whole text for quality as ``labels.quality`` marks it.

    Returns doc_id, held_out, score (0 to 1) and predicted (1 from ``THRESHOLD`` on).
    Only rows that are not held out, with a label of 0 or 1, are learned from; a
    label that repeats with the same value counts once, and a document whose labels
    contradict each other is not learned from.  Null and empty texts are scored
    from zero statistics.  Repeated rows each give a row, null ids stay null, other
    columns are ignored, an empty table gives no rows.  Without any label to learn
    from, every score is 0.5.
    """
    stats = settle(measured(docs), "statistics")
    model = learned(stats, labels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(found) if model else np.full(len(found), 0.5))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(work, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns unchanged, whose document scores ``threshold`` or more.

    The decision belongs to the row's own text, also where ids repeat or are null.
    """
    model = learned(measured(docs), labels)
    if model is None:
        return docs
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for _, texts in batch_texts(iter([pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch.column(place)], names=["k", "t"])])):
                keep = model.score(statistics(texts)) >= threshold
                yield batch.slice(start, len(texts)).filter(pa.array(keep))
                start += len(texts)

    return docs.mapInArrow(work, docs.schema)
