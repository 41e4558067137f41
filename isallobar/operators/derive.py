"""Fields derived from neighbouring cells and levels: vorticity and potential vorticity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isallobar.functions import physics
from isallobar.operators.grid import Grid


def periodic_difference(v: str, keys: list[str]) -> Column:
    """Eastern less western neighbour of a cell; the row is a ring."""
    ring = Window.partitionBy(*keys, "r").orderBy("c")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    east = F.coalesce(F.lead(v).over(ring), F.first(v).over(whole))
    west = F.coalesce(F.lag(v).over(ring), F.last(v).over(whole))
    return east - west


def gradient(v: Column | str, order: Window) -> Column:
    """Difference along an order: half of next less previous, one-sided at the ends."""
    v = F.col(v) if isinstance(v, str) else v
    after, before = F.lead(v).over(order), F.lag(v).over(order)
    return F.when(before.isNull(), after - v).when(after.isNull(), v - before).otherwise((after - before) / 2)


def relative_vorticity(df: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """Add ``vorticity`` (1/s) to cells with winds ``u`` and ``v``.

    Two windows, one along the rows and one along the columns of each field: groups
    are as long as a row or a column, whatever the number of fields.
    """
    column = Window.partitionBy(*keys, "c").orderBy("r")
    cosine = F.cos(F.radians(grid.lat()))
    dx = physics.EARTH_RADIUS_M * F.when(F.abs(cosine) < 1e-6, 1e-6).otherwise(cosine) * F.radians(F.lit(grid.dlon))
    dy = physics.EARTH_RADIUS_M * F.radians(F.lit(-grid.dlat))
    out = df.withColumn("_dv", periodic_difference("v", keys)).withColumn("_du", gradient("u", column))
    return out.withColumn("vorticity", F.col("_dv") / (2.0 * dx) - F.col("_du") / dy).drop("_dv", "_du")


def potential_vorticity(df: DataFrame, keys: list[str], grid: Grid, level: str = "level") -> DataFrame:
    """Add ``pv`` (PVU) at every level to cells with ``u``, ``v`` and ``theta``.

    The vertical derivative takes the neighbouring levels of each column of air,
    one-sided at its ends; all levels come out of one pass.
    """
    air = Window.partitionBy(*keys, "r", "c").orderBy(level)
    theta, p = F.col("theta"), F.col(level)
    above = F.coalesce(F.lead(theta).over(air), theta) - F.coalesce(F.lag(theta).over(air), theta)
    depth = (F.coalesce(F.lead(p).over(air), p) - F.coalesce(F.lag(p).over(air), p)) * physics.PASCALS_PER_HPA
    spun = relative_vorticity(df, [*keys, level], grid)
    slope = F.try_divide(above, depth)
    return spun.withColumn("pv", -physics.GRAVITY * (F.col("vorticity") + physics.coriolis(grid.lat())) * slope * 1e6)
