"""Sea level pressure: isobars by marching squares, and highs and lows by prominence.

Smoothing, cell crossings and candidate search are plans of built-in operators; only
linking crossings to lines (one field and level at a time) and flooding around the few
candidates (one field at a time) run in grouped functions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isallobar.functions import geo
from isallobar.operators import kernels
from isallobar.operators.grid import Grid, circular_pad, thinned
from isallobar.operators.neighbourhood import candidates, sampled, smoothed, window_cells

#: Degrees repeated beyond the seam, and the shortest isobar in degrees of arc.
PAD_DEGREES, LEAST_ARC = 20.0, 5.0
STANDARD_HPA = 1013.25
# For each combination of corners above the level (upper left 1, upper right 2,
# lower left 4, lower right 8) the sides that a line joins; 0 top, 1 right, 2 bottom, 3 left.
CASES = {1: [(0, 3)], 14: [(0, 3)], 2: [(0, 1)], 13: [(0, 1)], 4: [(2, 3)], 11: [(2, 3)], 8: [(1, 2)], 7: [(1, 2)], 3: [(1, 3)], 12: [(1, 3)], 5: [(0, 2)], 10: [(0, 2)], 6: [(0, 1), (2, 3)], 9: [(0, 3), (1, 2)]}


def checked_field(df: DataFrame, keys: list[str], value: str, grid: Grid) -> None:
    """Raise if a field is not finite or does not cover the grid."""
    if grid.rows < 2 or grid.cols < 2:
        raise ValueError("a field needs at least two rows and two columns")
    bad = df.where(F.col(value).isNull() | F.isnan(value) | (F.abs(value) == float("inf"))).limit(1).count()
    if bad:
        raise ValueError("the pressure field has missing or infinite values")
    if grid.check_complete(df, keys).limit(1).count():
        raise ValueError("the pressure field does not have one value for each cell")


def crossings(df: DataFrame, keys: list[str], value: str, grid: Grid, interval: float = 4.0, pad: int = 0) -> DataFrame:
    """Line segments through the cells of a field, one row for each level and pair of sides.

    Returns keys, level and for both ends the number of the cell edge and its place (x, y)
    in cells.  Levels are multiples of ``interval`` strictly inside the field's range.
    """
    wide = circular_pad(df, grid.cols, pad)
    cols = grid.cols + 2 * pad
    line = Window.partitionBy(*keys, "r").orderBy("c")
    pairs = wide.select(*keys, "r", "c", F.col(value).alias("ul"), F.lead(value).over(line).alias("ur"))
    down = Window.partitionBy(*keys, "c").orderBy("r")
    cells = pairs.withColumns({"ll": F.lead("ul").over(down), "lr": F.lead("ur").over(down)}).where("ur IS NOT NULL AND ll IS NOT NULL")
    span = df.groupBy(*keys).agg(F.min(value).alias("least"), F.max(value).alias("most"))
    ranged = cells.join(span, keys) if keys else cells.crossJoin(F.broadcast(span))
    low, high = F.least("ul", "ur", "ll", "lr"), F.greatest("ul", "ur", "ll", "lr")
    # Most cells hold no level at all; they are dropped before anything is made of them.
    first, last = F.ceil(low / interval), F.ceil(high / interval) - 1
    some = ranged.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    level = some.withColumn("_k", F.explode(F.sequence("_first", "_last"))).withColumn("level", F.col("_k") * interval).where("level > least AND level < most")
    case = sum((F.when(F.col(n) > F.col("level"), b).otherwise(0) for n, b in (("ul", 1), ("ur", 2), ("ll", 4), ("lr", 8))), start=F.lit(0))
    table = F.create_map(*(x for k, v in CASES.items() for x in (F.lit(k), F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in v)))))
    sides = level.withColumn("side", F.explode(table[case]))

    def share(a: str, b: str) -> Column:
        return F.try_divide(F.col("level") - F.col(a), F.col(b) - F.col(a))

    def end(side: Column) -> Column:
        r, c = F.col("r"), F.col("c")
        edge = lambda rr, cc, down_: ((rr * cols + cc) * 2 + down_).cast("long")
        spot = lambda e, x, y: F.struct(e.alias("edge"), x.cast("double").alias("x"), y.cast("double").alias("y"))
        return (
            F.when(side == 0, spot(edge(r, c, 0), c + share("ul", "ur"), r))
            .when(side == 1, spot(edge(r, c + 1, 1), c + 1, r + share("ur", "lr")))
            .when(side == 2, spot(edge(r + 1, c, 0), c + share("ll", "lr"), r + 1))
            .otherwise(spot(edge(r, c, 1), c, r + share("ul", "ll")))
        )

    return sides.select(*keys, "level", end(F.col("side.a")).alias("a"), end(F.col("side.b")).alias("b"))


def isobars(df: DataFrame, keys: list[str], value: str, grid: Grid, interval: float = 4.0, major: float = 20.0, sigma: float = 2.0, stride: int = 2, tolerance: float = 0.03) -> DataFrame:
    """Isobars of pressure fields (hPa): keys, hpa, major and coordinates [[lon, lat], ...].

    Lines start in [-180, 180) and are never cut; one that crosses the seam comes once.
    """
    soft = smoothed(df.select(*keys, "r", "c", value), keys, value, grid, sigma) if sigma > 0 else df
    coarse = thinned(soft, stride)
    small = Grid(-(-grid.rows // stride), -(-grid.cols // stride))
    dlat, dlon = grid.dlat * stride, grid.dlon * stride
    pad = max(1, round(PAD_DEGREES / dlon))
    pad = pad if grid.closed and pad < small.cols else 0
    width = small.cols + 2 * pad
    found = crossings(coarse, keys, value, small, interval, pad)
    flat = found.select(*keys, "level", *(F.col(f"{e}.{n}").alias(f"{e}_{n}") for e in "ab" for n in ("edge", "x", "y")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keys)

    def draw(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["a_edge", "b_edge"])
        spot = {e: (x, y) for e, x, y in zip(part["a_edge"], part["a_x"], part["a_y"], strict=True)}
        spot |= {e: (x, y) for e, x, y in zip(part["b_edge"], part["b_x"], part["b_y"], strict=True)}
        level, out = float(part["level"].iloc[0]), []
        for chain in kernels.linked(list(zip(part["a_edge"].tolist(), part["b_edge"].tolist(), strict=True))):
            xy = np.array([spot[e] for e in chain])
            around = pad and xy[:, 0].min() <= 1.0 and xy[:, 0].max() >= width - 2.0
            if pad and xy[:, 0].min() < pad and not around:
                continue  # its copy beyond the other edge is kept
            closed = chain[0] == chain[-1]
            points = kernels.simplified(np.column_stack([grid.west + (xy[:, 0] - pad) * dlon, grid.north - xy[:, 1] * dlat]), tolerance)
            if len(points) < (4 if closed else 2) or kernels.arc_degrees(*points.T) < LEAST_ARC:
                continue
            points[:, 0] += (points[0, 0] + 180.0) % 360.0 - 180.0 - points[0, 0]
            points = points.round(2)
            if points[0, 0] >= 180.0:
                points[:, 0] -= 360.0
            if closed:
                points[-1] = points[0]
            out.append(points.tolist())
        is_major = bool(np.isclose(level / major, round(level / major)))
        head = {k: [part[k].iloc[0]] * len(out) for k in keys}
        found = pd.DataFrame(head | {"hpa": [int(round(level))] * len(out), "major": [is_major] * len(out), "coordinates": pd.Series(out, dtype=object)})
        return found.astype({"hpa": "int32", "major": bool, **{k: part[k].dtype for k in keys}})

    return flat.groupBy(*keys, "level").applyInPandas(draw, f"{schema + ', ' if schema else ''}hpa int, major boolean, coordinates array<array<double>>")


def centres(df: DataFrame, keys: list[str], value: str, grid: Grid, surface: DataFrame | None = None, footprint: float = 3.0, prominence: float = 4.0, window: float = 35.0, separation_km: float = 1500.0, max_lat: float = 85.0, least_surface: float = 850.0, sigma: float = 2.0) -> DataFrame:
    """Lows and highs of pressure fields (hPa): keys, kind, rank, lon, lat and hpa, strongest first.

    ``surface`` (keys, r, c, surface in hPa) drops candidates over high ground.
    """
    soft = smoothed(df.select(*keys, "r", "c", value), keys, value, grid, sigma) if sigma > 0 else df.select(*keys, "r", "c", value)
    found = candidates(soft, keys, value, grid, footprint, window, prominence, max_lat)
    if surface is not None:
        points = found.withColumns({"point": F.concat_ws(":", "kind", "r", "c"), "lon": grid.lon(), "lat": grid.lat()})
        over = sampled(points, surface, keys, grid, {"surface": "sample"}, clamp=True)
        found = over.where(F.col("sample").isNull() | (F.col("sample") >= least_surface)).select(found.columns)
    rows, cols = window_cells(grid, window)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keys)

    def judge(field: pd.DataFrame, picked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(picked):
            whole = np.zeros((grid.rows, grid.cols))
            whole[field["r"], field["c"]] = field[value]
        for kind in ("L", "H") if len(picked) else ():
            own = picked[picked["kind"] == kind].sort_values(["r", "c"])
            good = [kernels.stands_out(*kernels.window_of(whole, r, c, rows, cols, grid.closed), kind == "L", prominence) for r, c in zip(own["r"], own["c"], strict=True)]
            own = own[np.array(good, bool)] if len(own) else own
            lon, lat, v = grid.west + own["c"].to_numpy() * grid.dlon, grid.north - own["r"].to_numpy() * grid.dlat, own[value].to_numpy()
            strength = STANDARD_HPA - v if kind == "L" else v - STANDARD_HPA
            for rank, k in enumerate(kernels.spaced_out(lon, lat, strength, separation_km)):
                x = round((lon[k] + 180.0) % 360.0 - 180.0, 2)
                out.append((kind, rank, x - 360.0 if x >= 180.0 else x, round(float(lat[k]), 2), int(round(float(v[k])))))
        head = {k: [picked[k].iloc[0]] * len(out) if out else [] for k in keys}
        columns = dict(zip(("kind", "rank", "lon", "lat", "hpa"), zip(*out, strict=True), strict=True)) if out else {n: [] for n in ("kind", "rank", "lon", "lat", "hpa")}
        return pd.DataFrame(head | {k: list(v) for k, v in columns.items()})

    # Fields without a candidate are not sent to Python at all.
    # Both sides come from one field, so the candidates' columns get names of their own.
    own = found.select(*(F.col(c).alias(c) for c in found.columns))
    some = soft.join(own.select(*keys).distinct(), keys, "left_semi") if keys else soft
    return some.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInPandas(judge, f"{schema + ', ' if schema else ''}kind string, rank int, lon double, lat double, hpa int")


def pressure_layer(lines: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """GeoJSON features of a field in order: isobars, then lows, then highs."""
    isobar = lines.select(
        *keys, F.lit(0).alias("place"), F.concat_ws(",", F.format_string("%06d", "hpa"), F.to_json("coordinates")).alias("within"),
        F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("LineString").alias("type"), "coordinates").alias("geometry"), F.struct(F.lit("isobar").alias("kind"), "hpa", "major").alias("properties"))).alias("feature"),
    )
    centre = points.select(
        *keys, F.when(F.col("kind") == "L", 1).otherwise(2).alias("place"), F.format_string("%06d", "rank").alias("within"),
        F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"), F.struct("kind", "hpa").alias("properties"))).alias("feature"),
    )
    return isobar.unionByName(centre)


def layer_text(features: DataFrame, keys: list[str], valid_time: Column | None = None) -> DataFrame:
    """One FeatureCollection text for each field."""
    ordered = features.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "within", "feature"))), lambda x: x["feature"]).alias("all"))
    head = F.coalesce(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), (valid_time if valid_time is not None else F.lit(None).cast("string")).alias("valid_time")), {"ignoreNullFields": "false"}), F.lit("{}"))
    return ordered.select(*keys, F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"features":['), F.array_join("all", ","), F.lit("]}")).alias("geojson"))
