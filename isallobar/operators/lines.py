"""Lines as point tables ``(keys..., i, lon, lat, ...)``: lengths, normals, nearest points, matching.

A line is the rows that share ``keys``; ``i`` orders them.  Windows are partitioned by
line, joins by the field a line belongs to, so groups stay as small as a line or field.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isallobar.functions import geo
from isallobar.operators import kernels
from isallobar.operators.grid import Grid

EARTH = geo.EARTH_RADIUS_KM


def _order(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("i")


def with_steps(points: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``step_km`` from the point before (0 at the start) and the running ``along_km``."""
    order = _order(keys)
    step = F.coalesce(geo.haversine_km(F.lag("lon").over(order), F.lag("lat").over(order), F.col("lon"), F.col("lat")), F.lit(0.0))
    return points.withColumn("step_km", step).withColumn("along_km", F.sum("step_km").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def lengths(points: DataFrame, keys: list[str]) -> DataFrame:
    """``length_km`` of every line."""
    return with_steps(points, keys).groupBy(*keys).agg(F.sum("step_km").alias("length_km"))


def per_line(points: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], columns: str) -> DataFrame:
    """Run one of the line kernels that tracing uses over every line, its points in order; ``columns`` names what it returns."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema if f.name in keys)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("i")
        found = work(part)
        return pd.concat([pd.DataFrame({k: [part[k].iloc[0]] * len(found) for k in keys}, index=found.index), found], axis=1)

    return points.groupBy(*keys).applyInPandas(run, f"{schema}, {columns}")


def arc_degrees(points: DataFrame, keys: list[str]) -> DataFrame:
    """Length of every line in degrees of arc, as short isobars are dropped by."""
    return per_line(points, keys, lambda p: pd.DataFrame({"arc_deg": [kernels.arc_degrees(p["lon"].to_numpy(), p["lat"].to_numpy())]}), "arc_deg double")


def unwrapped(points: DataFrame, keys: list[str]) -> DataFrame:
    """Longitudes that carry on over the seam: no step is longer than half a turn."""
    return per_line(points, keys, lambda p: pd.DataFrame({"i": p["i"], "lon": kernels.carried_on(p["lon"].to_numpy()), "lat": p["lat"]}), "i int, lon double, lat double")


def runs(points: DataFrame, keys: list[str], label: str, least_km: float = 0.0) -> DataFrame:
    """Stretches of equal ``label`` along each line (run, label, first, last), those shorter than ``least_km`` folded into neighbours.

    The last point of a stretch is the first of the next one.
    """

    def work(p: pd.DataFrame) -> pd.DataFrame:
        found = kernels.folded_runs(p[label].to_numpy(), kernels.along_km(p["lon"].to_numpy(), p["lat"].to_numpy()), least_km)
        return pd.DataFrame([(k, *x) for k, x in enumerate(found, 1)], columns=["run", "label", "first", "last"])

    return per_line(points, keys, work, "run int, label int, first int, last int")


def with_normals(points: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``east`` and ``north`` of the unit vector to the left of the way along the line."""
    from isallobar.operators.derive import gradient

    order = _order(keys)
    moved = points.withColumns({"_e": gradient("lon", order) * F.cos(F.radians("lat")), "_n": gradient("lat", order)})
    size = F.hypot("_e", "_n")
    return moved.withColumns({"east": F.try_divide(-F.col("_n"), size), "north": F.try_divide(F.col("_e"), size)}).drop("_e", "_n")


def turn_angles(points: DataFrame, keys: list[str], window_km: float = 100.0) -> DataFrame:
    """How far (degrees) a line turns at each of its points.

    Each leg reaches to the nearest point at least ``window_km`` away along the line, or to the
    line's end; legs are flat distances east and north.
    """

    def work(p: pd.DataFrame) -> pd.DataFrame:
        lon, lat = p["lon"].to_numpy(), p["lat"].to_numpy()
        return pd.DataFrame({"i": p["i"], "turn_deg": [kernels.turn_at(lon, lat, k, window_km) for k in range(len(lon))]})

    return per_line(points, keys, work, "i int, turn_deg double")


def resampled(points: DataFrame, keys: list[str], spacing_km: float = 25.0) -> DataFrame:
    """Points at an even spacing along each line, ends included."""

    def work(p: pd.DataFrame) -> pd.DataFrame:
        lon, lat = kernels.resampled(p["lon"].to_numpy(), p["lat"].to_numpy(), spacing_km)
        return pd.DataFrame({"i": np.arange(len(lon), dtype=np.int32), "lon": lon, "lat": lat})

    return per_line(points, keys, work, "i int, lon double, lat double")


def pinned(points: DataFrame, targets: DataFrame, keys: list[str], taper_km: float = 75.0) -> DataFrame:
    """Move line ends onto targets (keys, at_start, target_lon, target_lat), easing out along the line."""

    def work(p: pd.DataFrame) -> pd.DataFrame:
        one = p.iloc[0]
        lon, lat = kernels.moved_end((p["lon"].to_numpy(), p["lat"].to_numpy()), bool(one["at_start"]), (one["target_lon"], one["target_lat"]), taper_km)
        return pd.DataFrame({"i": p["i"].to_numpy(), "lon": lon, "lat": lat})

    return per_line(points.select(*keys, "i", "lon", "lat").join(targets, keys), keys, work, "i int, lon double, lat double")


def projected(queries: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """The place (lon, lat) on the polyline of its ``keys`` that is nearest to each query (keys, query, lon, lat), and how far (flat km)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema if f.name in [*keys, "query"])

    def work(asked: pd.DataFrame, line: pd.DataFrame) -> pd.DataFrame:
        line = line.sort_values("i")
        out = []
        for q in asked.itertuples() if len(line) > 1 else ():
            lon, lat = kernels.nearest_on((line["lon"].to_numpy(), line["lat"].to_numpy()), q.lon, q.lat)
            km = np.hypot((lon - q.lon) * np.cos(np.radians(q.lat)), lat - q.lat) * kernels.KM_PER_DEGREE
            out.append([*(getattr(q, k) for k in keys), q.query, lon, lat, km])
        return pd.DataFrame(out, columns=[*keys, "query", "lon", "lat", "km"])

    return queries.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInPandas(work, f"{schema}, lon double, lat double, km double")


def nearest(queries: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """The nearest point of the same ``keys`` for each query: (keys, query, point, km).

    Exact within its group; a group is the line points of one field, a few thousand at
    most.  Ties go to the smaller point number.
    """
    other = points.select(*keys, "point", F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    met = queries.join(other, keys).withColumn("km", geo.haversine_km(F.col("lon"), F.col("lat"), F.col("_lon"), F.col("_lat")))
    return met.groupBy(*keys, "query").agg(F.min(F.struct("km", "point")).alias("b")).select(*keys, "query", F.col("b.point").alias("point"), F.col("b.km").alias("km"))


def within(queries: DataFrame, points: DataFrame, keys: list[str], km: float, query_columns: tuple[str, ...] = (), point_columns: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (keys, query, point, km) no farther apart than ``km``, with further columns of both sides.

    Points lie in cubes on the unit sphere whose edge is the reach as a chord; a query looks into
    its own cube and those around it.  The join has an equality key of the right size everywhere,
    at the poles and over the seam too.
    """
    edge = 2 * math.sin(min(km / (2 * EARTH), math.pi / 2)) * (1 + 1e-9)

    def cube() -> list[Column]:
        return [F.floor((x + 1.0) / edge).cast("int") for x in geo.unit_vector(F.col("lon"), F.col("lat"))]

    place = [c.alias(f"_{n}") for n, c in zip("xyz", cube(), strict=True)]
    other = points.select(*keys, "point", *point_columns, F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), *place)
    asked = queries.select(*keys, "query", *query_columns, "lon", "lat", *place)
    for n in "xyz":
        asked = asked.withColumn(f"_{n}", F.explode(F.array(*(F.col(f"_{n}") + k for k in (-1, 0, 1)))))
    met = asked.join(other, [*keys, "_x", "_y", "_z"]).withColumn("km", geo.haversine_km(F.col("lon"), F.col("lat"), F.col("_lon"), F.col("_lat")))
    return met.where(F.col("km") <= km).select(*keys, "query", "point", "km", *query_columns, *point_columns)


def nearest_within(queries: DataFrame, points: DataFrame, keys: list[str], km: float) -> DataFrame:
    """The nearest point no farther than ``km`` for each query that has one; ties to the smaller point."""
    return within(queries, points, keys, km).groupBy(*keys, "query").agg(F.min(F.struct("km", "point")).alias("b")).select(*keys, "query", F.col("b.point").alias("point"), F.col("b.km").alias("km"))


def masked_mean(value: Column, masked: Column) -> Column:
    """Aggregate: mean of finite values that are not masked; all of them if all are masked; else 0."""
    finite = F.when(~F.isnan(value), value)
    return F.coalesce(F.when(F.min(masked.cast("int")) == 1, F.avg(finite)).otherwise(F.avg(F.when(~masked, finite))), F.lit(0.0))


def neighbours(cells: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """Edges (keys, r, c, r2, c2, km) between marked cells that touch, each once; a closed grid's columns wrap."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema if f.name in keys)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        rows, cols = part["r"].to_numpy(), part["c"].to_numpy()
        a, b = kernels.touching(rows, cols, grid.cols, grid.closed)
        lon, lat = grid.west + cols * grid.dlon, grid.north - rows * grid.dlat
        km = kernels.haversine_km(lon[a], lat[a], lon[b], lat[b])
        return pd.DataFrame({**{k: [part[k].iloc[0]] * len(a) for k in keys}, "r": rows[a], "c": cols[a], "r2": rows[b], "c2": cols[b], "km": km})

    return cells.groupBy(*keys).applyInPandas(run, f"{schema}, r int, c int, r2 int, c2 int, km double")


def interest(pairs: DataFrame, match_km: float = 500.0, weights: tuple[float, float, float] = (4.0, 1.0, 1.0)) -> DataFrame:
    """Score pairs (…, distance_km, short_km, long_km, types_a, types_b, group_a, group_b) from 0 to 1."""
    shared = F.size(F.array_intersect("types_a", "types_b")) / F.size(F.array_union("types_a", "types_b"))
    clues = weights[0] * (1 - F.col("distance_km") / match_km) + weights[1] * F.try_divide(F.col("short_km"), F.col("long_km")) + weights[2] * shared
    fits = (F.col("group_a") == F.col("group_b")) & (F.col("distance_km") < match_km)
    return pairs.withColumn("interest", F.when(fits, clues / sum(weights)).otherwise(0.0))


def event_index(sightings: DataFrame) -> DataFrame:
    """Summary of every event from sightings (event_id, time, classes, length_km, parents).

    Returns event_id, start_time, end_time, parents, children, classes and max_length_km.
    """
    own = sightings.groupBy("event_id").agg(
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("parents")))).alias("parents"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("classes"),
        F.max(F.round("length_km", 2)).alias("max_length_km"),
    )
    children = sightings.select("event_id", F.explode("parents").alias("parent")).groupBy("parent").agg(F.array_sort(F.collect_set("event_id")).alias("children"))
    joined = own.join(children, own.event_id == children.parent, "left")
    return joined.select("event_id", "start_time", "end_time", "parents", F.coalesce("children", F.array().cast("array<string>")).alias("children"), "classes", "max_length_km")
