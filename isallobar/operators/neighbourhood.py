"""Moving windows over grids: smoothing, minima and maxima, extrema, bilinear samples.

Windows are separable: one pass along columns, one along rows, each over some lines of a
field at a time.  Rings are closed by repeating places of the other end.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isallobar.operators.grid import Grid

#: Lines of a field that are worked on together.
LINES = 64


def gaussian_weights(sigma: float, reach: float = 4.0) -> list[float]:
    """Normalised weights at offsets -n..n, n = reach * sigma rounded."""
    n = int(reach * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-n, n + 1)]
    return [x / sum(raw) for x in raw]


def over_lines(df: DataFrame, keys: list[str], axis: str, values: dict[str, str], work: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], length: int) -> DataFrame:
    """Run ``work`` along the rows (``axis`` c) or columns (``axis`` r) of fields, some lines at a time.

    ``work`` gets an array (lines x places) for each of ``values`` (name: column) and returns arrays
    of the same shape, which become columns.  A group holds ``LINES`` lines of one field, so its size
    depends on the grid alone.  Every line must have a value at each of its ``length`` places.
    """
    across = "r" if axis == "c" else "c"
    held = df.select(*keys, "r", "c", *(F.col(c).cast("double").alias(n) for n, c in values.items()))
    blocks = held.withColumn("_lines", (F.col(across) / LINES).cast("int"))
    head = {f.name: f.dataType.simpleString() for f in held.schema if f.name in keys}

    def run(part: pa.Table) -> pa.Table:
        line, place = (part.column(n).to_numpy() for n in (across, axis))
        order = np.lexsort((place, line))
        if part.num_rows % length or (place[order].reshape(-1, length) != np.arange(length)).any():
            raise ValueError("a field does not have one value for each cell")
        found = work({n: part.column(n).to_numpy()[order].reshape(-1, length) for n in values})
        same = part.select([*keys, "r", "c"]).take(pa.array(order))
        for name, array in found.items():
            same = same.append_column(name, pa.array(np.ascontiguousarray(array).ravel()))
        return same

    names = work({n: np.zeros((1, length)) for n in values})
    schema = ", ".join([*(f"`{n}` {t}" for n, t in head.items()), "r int, c int", *(f"`{n}` double" for n in names)])
    return blocks.groupBy(*keys, "_lines").applyInArrow(run, schema)


def _beyond(x: np.ndarray, reach: int, closed: bool) -> np.ndarray:
    """Lines with ``reach`` places more at both ends: those of the other end on a ring, else the end value."""
    if not closed:
        return np.pad(x, ((0, 0), (reach, reach)), mode="edge")
    return x[:, np.arange(-reach, x.shape[1] + reach) % x.shape[1]]


def _weighted(x: np.ndarray, weights: list[float], closed: bool) -> np.ndarray:
    """Weighted sums over neighbours, added from the first to the last."""
    wide = _beyond(x, len(weights) // 2, closed)
    total = weights[0] * wide[:, : x.shape[1]]
    for k, w in enumerate(weights[1:], 1):
        total = total + w * wide[:, k : k + x.shape[1]]
    return total


def smoothed(df: DataFrame, keys: list[str], value: str, grid: Grid, sigma: float = 2.0) -> DataFrame:
    """Gaussian smoothing: rows wrap on a closed grid; elsewhere the end values repeat."""
    weights = gaussian_weights(sigma)
    down = over_lines(df, keys, "r", {value: value}, lambda v: {value: _weighted(v[value], weights, False)}, grid.rows)
    return over_lines(down, keys, "c", {value: value}, lambda v: {value: _weighted(v[value], weights, grid.closed)}, grid.cols)


def _extreme(x: np.ndarray, reach: int, closed: bool, pick: Callable) -> np.ndarray:
    """Least or greatest value within ``reach`` places; windows double in size until they are wide enough."""
    reach = min(reach, x.shape[1])
    wide, have = _beyond(x, reach, closed), 1
    size = 2 * reach + 1
    while 2 * have <= size:
        wide = pick(wide[:, :-have], wide[:, have:])
        have *= 2
    return pick(wide[:, : x.shape[1]], wide[:, size - have : size - have + x.shape[1]])


def extremes(df: DataFrame, keys: list[str], value: str, grid: Grid, rows: int, cols: int, names: tuple[str, str] = ("low", "high")) -> DataFrame:
    """Least and greatest value within ``rows`` and ``cols`` cells either side (keys, r, c, value, names); a closed grid's rows wrap."""
    return windowed(df, keys, value, grid, {names: (rows, cols)})


def windowed(df: DataFrame, keys: list[str], value: str, grid: Grid, windows: dict[tuple[str, str], tuple[int, int]]) -> DataFrame:
    """Least and greatest values over several windows (names of both: cells either side), in one pass along each axis."""
    picks = (np.minimum, np.maximum)
    flat = [(name, pick, reach) for names, reach in windows.items() for name, pick in zip(names, picks, strict=True)]
    down = over_lines(df, keys, "r", {value: value}, lambda v: v | {n: _extreme(v[value], reach[0], False, pick) for n, pick, reach in flat}, grid.rows)
    across = {n: n for n, _, _ in flat}
    return over_lines(down, keys, "c", {value: value} | across, lambda v: {value: v[value]} | {n: _extreme(v[n], reach[1], grid.closed, pick) for n, pick, reach in flat}, grid.cols)


def window_cells(grid: Grid, degrees: float) -> tuple[int, int]:
    """How many rows and columns a reach in degrees is, one at least; halves to even."""
    return max(1, round(degrees / grid.dlat)), max(1, round(degrees / grid.dlon))


def candidates(df: DataFrame, keys: list[str], value: str, grid: Grid, footprint: float = 3.0, window: float = 35.0, prominence: float = 4.0, max_lat: float = 85.0, least_range: float = 1e-3) -> DataFrame:
    """Cells that are the lowest (L) or highest (H) of their footprint and stand out in their window."""
    radius = window_cells(grid, footprint)[0]
    far = windowed(df, keys, value, grid, {("low", "high"): (radius, radius), ("least", "most"): window_cells(grid, window)})
    v = F.col(value)
    varied = (F.col("high") - F.col("low") > least_range) & (F.abs(grid.lat()) <= max_lat)
    kinds = F.array_compact(F.array(F.when((v == F.col("low")) & (F.col("most") - v >= prominence), "L"), F.when((v == F.col("high")) & (v - F.col("least") >= prominence), "H")))
    return far.where(varied).withColumn("kind", F.explode(kinds)).select(*keys, "kind", "r", "c", value)


def _held(place: Column, last: float, clamp: bool) -> Column:
    """A place on an axis of places 0..last; off it null, or with ``clamp`` the nearer end."""
    return F.when(place.isNotNull(), F.least(F.greatest(place, F.lit(0.0)), F.lit(last))) if clamp else F.when(place.between(0.0, last), place)


def row_place(lat: Column, grid: Grid, clamp: bool = False) -> Column:
    """Place of a latitude among a grid's rows, fractions included."""
    return _held((grid.north - lat) / grid.dlat, grid.rows - 1.0, clamp)


def column_place(lon: Column, grid: Grid, clamp: bool = False) -> Column:
    """Place of a longitude among a grid's columns; beyond the last of an open grid the nearer edge is meant."""
    x = F.pmod(lon - grid.west, F.lit(360.0)) / grid.dlon
    if grid.closed:
        return x
    turn = 360.0 / grid.dlon
    return _held(F.when(x > (grid.cols - 1 + turn) / 2, x - turn).otherwise(x), grid.cols - 1.0, clamp)


def sampled(points: DataFrame, field: DataFrame, keys: list[str], grid: Grid, values: dict[str, str], clamp: bool = False) -> DataFrame:
    """Add bilinear values of fields to points with ``point``, ``lon`` and ``lat``.

    ``values`` gives the new column for each column of ``field``.  Longitudes wrap on a closed grid.
    Places off the grid give null, or with ``clamp`` the edge value.  Each point meets
    its four corner cells in one equi-join, for all values at once.
    """
    placed = points.withColumns({"_x": column_place(F.col("lon"), grid, clamp), "_y": row_place(F.col("lat"), grid, clamp)})
    r0 = F.least(F.floor("_y"), F.lit(grid.rows - 2)).cast("int")
    c0 = (F.floor("_x") if grid.closed else F.least(F.floor("_x"), F.lit(grid.cols - 2))).cast("int")
    fr, fc = F.col("_y") - r0, F.col("_x") - c0
    corner = lambda dr, dc, w: F.struct((r0 + dr).alias("r"), F.pmod(c0 + dc, F.lit(grid.cols)).cast("int").alias("c"), w.alias("w"))
    corners = F.array(corner(0, 0, (1 - fr) * (1 - fc)), corner(0, 1, (1 - fr) * fc), corner(1, 0, fr * (1 - fc)), corner(1, 1, fr * fc))
    spread = placed.where(F.col("_y").isNotNull() & F.col("_x").isNotNull()).select(*keys, "point", F.inline(corners))
    met = spread.join(field.select(*keys, "r", "c", *(F.col(v).alias(f"_{v}") for v in values)), [*keys, "r", "c"])
    found = met.groupBy(*keys, "point").agg(*(F.sum(F.col("w") * F.col(f"_{v}")).alias(name) for v, name in values.items()))
    return points.join(found, [*keys, "point"], "left")
