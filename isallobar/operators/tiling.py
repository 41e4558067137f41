"""Overlapping tiles: cutting a grid up, predicting tile by tile, and blending the results.

A cell finds its tiles from the short list of tile starts, held as a literal, so
cutting up is an explosion without a join.  Blending is one grouped weighted mean,
which Spark aggregates partially before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isallobar.operators import assemble
from isallobar.operators.grid import Grid, channels_negated, circular_pad, flipped, padded_size, spliced, zero_pad
from isallobar.plans.manifest import Model


class Predictor(Protocol):
    """Anything that maps patches (n, p, p, channels) to probabilities (n, p, p, classes)."""

    def predict_batch(self, patches: np.ndarray) -> np.ndarray: ...


class LinearSoftmax:
    """A small predictor without files: softmax of a linear map of the channels."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0) -> None:
        self.weights, self.bias, self.temperature = weights, bias, temperature

    def predict_batch(self, patches: np.ndarray) -> np.ndarray:
        logits = (patches @ self.weights + self.bias) / self.temperature
        raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
        return raised / raised.sum(axis=-1, keepdims=True)


class OnnxPredictor:
    """A model file read once in each Python worker; the first output is the prediction."""

    def __init__(self, path: str) -> None:
        self.path = path
        self._session = None

    def __getstate__(self) -> dict:
        return {"path": self.path, "_session": None}

    def predict_batch(self, patches: np.ndarray) -> np.ndarray:
        if self._session is None:
            import onnxruntime

            self._session = onnxruntime.InferenceSession(self.path, providers=["CPUExecutionProvider"])
        return self._session.run(None, {self._session.get_inputs()[0].name: patches.astype(np.float32)})[0]


class Volumetric:
    """Gives a predictor levels of variables (n, p, p, levels, variables) instead of flat channels."""

    def __init__(self, inner: Predictor, manifest: Model) -> None:
        self.inner, self.levels, self.variables = inner, len(manifest.levels), len(manifest.layered)

    def volume(self, channels: np.ndarray) -> np.ndarray:
        """Flat channels (last axis) as levels of variables; single-level values repeat at every level."""
        split = self.levels * self.variables
        layered = channels[..., :split].reshape(*channels.shape[:-1], self.levels, self.variables)
        return np.concatenate([layered, np.repeat(channels[..., None, split:], self.levels, axis=-2)], axis=-1)

    def predict_batch(self, patches: np.ndarray) -> np.ndarray:
        return self.inner.predict_batch(self.volume(patches))


def selected(found: np.ndarray, served: Sequence[int]) -> np.ndarray:
    """The served classes of predictions (classes last), in the order in which they are served."""
    return np.asarray(found)[..., list(served)]


def tile_starts(size: int, patch: int, overlap: int, multiple: int = 16) -> list[int]:
    """Starts of the tiles along one axis; the last one is moved back to the edge."""
    if patch % multiple:
        raise ValueError(f"the patch size must be a multiple of {multiple}, not {patch}")
    if not 0 <= overlap < patch:
        raise ValueError(f"the overlap must be at least 0 and below {patch}, not {overlap}")
    last = max(size - patch, 0)
    return sorted({*range(0, last + 1, patch - overlap), last})


def ramps(starts: Sequence[int], patch: int) -> list[tuple[int, int, int]]:
    """(start, left, right): how far each tile overlaps its neighbours, clamped so that ramps never meet."""
    out = []
    for k, s in enumerate(starts):
        left = max(0, patch - (s - starts[k - 1])) if k else 0
        right = max(0, patch - (starts[k + 1] - s)) if k + 1 < len(starts) else 0
        left = min(left, patch // 2)
        out.append((s, left, min(right, patch - left)))
    return out


def ramp_weight(i: Column, left: Column, right: Column, patch: int) -> Column:
    """Weight of place ``i`` in a tile: rising from 1/left, 1 inside, falling to 1/right."""
    falling = F.when(i >= patch - right, (patch - i) / right)
    rising = F.when(i < left, (i + 1) / left)
    return F.coalesce(falling, rising, F.lit(1.0))


def tile_table(spark: SparkSession, height: int, width: int, patch: int, overlap: int, multiple: int = 16) -> DataFrame:
    """All tiles, row by row: tile_id, row_start, row_end, col_start, col_end and the ramps of both axes."""
    rows = ramps(tile_starts(height, patch, overlap, multiple), patch)
    cols = ramps(tile_starts(width, patch, overlap, multiple), patch)
    data = [(i * len(cols) + j, r, r + patch, c, c + patch, rl, rr, cl, cr) for i, (r, rl, rr) in enumerate(rows) for j, (c, cl, cr) in enumerate(cols)]
    return spark.createDataFrame(data, "tile_id int, row_start int, row_end int, col_start int, col_end int, row_left int, row_right int, col_left int, col_right int")


def _axis(position: Column, table: list[tuple[int, int, int]], patch: int) -> Column:
    """The tiles along one axis that hold a position, with the weight there."""
    held = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(s).alias("start"), F.lit(a).alias("left"), F.lit(b).alias("right")) for k, (s, a, b) in enumerate(table)))
    inside = F.filter(held, lambda t: (t["start"] <= position) & (position < t["start"] + patch))
    return F.transform(inside, lambda t: F.struct(t["k"].alias("k"), t["start"].alias("start"), ramp_weight(position - t["start"], t["left"], t["right"], patch).alias("w")))


def on_tiles(df: DataFrame, height: int, width: int, patch: int, overlap: int, multiple: int = 16) -> DataFrame:
    """A row for each cell and tile that holds it: adds tile_id, row_start, col_start and weight."""
    rows = ramps(tile_starts(height, patch, overlap, multiple), patch)
    cols = ramps(tile_starts(width, patch, overlap, multiple), patch)
    spread = df.select("*", F.explode(_axis(F.col("r"), rows, patch)).alias("_i")).select("*", F.explode(_axis(F.col("c"), cols, patch)).alias("_j"))
    return spread.select(*df.columns, (F.col("_i.k") * len(cols) + F.col("_j.k")).alias("tile_id"), F.col("_i.start").alias("row_start"), F.col("_j.start").alias("col_start"), (F.col("_i.w") * F.col("_j.w")).alias("weight"))


def stitched(tiled: DataFrame, by: list[str], value: str = "p") -> DataFrame:
    """Weighted mean of the tiles' values in each cell; cells without weight are zero."""
    total, weight = F.sum(F.col(value) * F.col("weight")), F.sum("weight")
    return tiled.groupBy(*by).agg((total / F.when(weight == 0, 1.0).otherwise(weight)).alias(value))


def predicted(tiled: DataFrame, keys: list[str], predictor: Predictor, patch: int, served: Sequence[int], batch: int = 8) -> DataFrame:
    """Run a predictor over tiles of cells with ``channels``; returns keys, r, c, weight and probabilities.

    A group is ``batch`` tiles, so a task holds one batch whatever the number of fields.
    Classes that are not served are dropped before anything is shuffled again.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiled.schema if f.name in keys) + ", r int, c int, weight double, probabilities array<double>"

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        tiles = [t.sort_values(["r", "c"]) for _, t in part.groupby("tile_id")]
        if any(len(t) != patch * patch for t in tiles):
            raise ValueError("a tile does not have a row for each of its cells")
        stack = np.stack([np.stack(t["channels"].to_numpy()).astype(float).reshape(patch, patch, -1) for t in tiles])
        for tile, found in zip(tiles, predictor.predict_batch(stack), strict=True):
            kept = selected(found, served).reshape(patch * patch, -1)
            out.append(tile[[*keys, "r", "c", "weight"]].assign(probabilities=list(kept)))
        return pd.concat(out)

    return tiled.withColumn("_batch", (F.col("tile_id") / batch).cast("int")).groupBy(*keys, "_batch").applyInPandas(run, schema)


def single_pass(inputs: DataFrame, keys: list[str], grid: Grid, manifest: Model, predict: Callable[[DataFrame], DataFrame], patch: int, overlap: int, channels: int) -> DataFrame:
    """One tiled pass over cells with ``channels``: pad, tile, predict, blend, crop.

    ``predict`` turns tiled cells into (keys, r, c, weight, probabilities of served classes).
    """
    around = circular_pad(inputs, grid.cols, overlap)
    width = grid.cols + 2 * overlap
    height, wide = (max(padded_size(x, manifest.patch_multiple), patch) for x in (grid.rows, width))
    zeros = F.array_repeat(F.lit(0.0), channels)
    full = around.withColumn("_pad", F.lit(0.0))
    full = zero_pad(full.select(*keys, "r", "c", "_pad"), keys, ["_pad"], grid.rows, width, height, wide).where((F.col("r") >= grid.rows) | (F.col("c") >= width))
    cells = around.select(*keys, "r", "c", "channels").unionByName(full.select(*keys, "r", "c", zeros.alias("channels")))
    found = predict(on_tiles(cells, height, wide, patch, overlap, manifest.patch_multiple))
    split = assemble.by_class(found, "probabilities", list(manifest.served))
    blended = stitched(split.where((F.col("r") < grid.rows) & F.col("c").between(overlap, overlap + grid.cols - 1)), [*keys, "r", "c", "cls"])
    return blended.withColumn("c", F.col("c") - overlap)


def tiled_inference(inputs: DataFrame, keys: list[str], grid: Grid, manifest: Model, predictor: Predictor | None = None, patch: int = 256, overlap: int = 96, batch: int = 8, predict: Callable[[DataFrame], DataFrame] | None = None, two_pass: bool = True) -> DataFrame:
    """Class probabilities (keys, r, c, cls, p) of assembled inputs.

    The southern half comes from a second pass over the field with its meridional winds turned
    and its rows reversed, so that it looks like a northern one.
    """
    n = len(manifest.channels())
    chosen = predict or (lambda tiled: predicted(tiled, keys, predictor, patch, manifest.served_indices(), batch))
    north = single_pass(inputs, keys, grid, manifest, chosen, patch, overlap, n)
    if not two_pass:
        return north
    turned = inputs.withColumn("channels", channels_negated(F.col("channels"), manifest.channel_names(), grid.lat()))
    south = flipped(single_pass(flipped(turned, grid.rows), keys, grid, manifest, chosen, patch, overlap, n), grid.rows)
    return spliced(north, south.select(north.columns), grid)
