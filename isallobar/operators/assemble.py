"""Model input: fields at levels pivoted into one array of channels per cell, in trained order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isallobar.functions import physics
from isallobar.operators import derive
from isallobar.operators.grid import Grid
from isallobar.plans.manifest import STATIC, Model, check_sources


def with_derived(fields: DataFrame, keys: list[str], grid: Grid, wanted: set[str]) -> DataFrame:
    """Add derived variables to long fields (keys, variable, level, r, c, v).

    Base variables are read once, pivoted to columns per level, and only those that the
    wanted variables need.
    """
    out = fields
    known = {"equivalent_potential_temperature": ("temperature", "specific_humidity"), "potential_vorticity": ("temperature", "u_component_of_wind", "v_component_of_wind")}
    for name in sorted(wanted):
        if name not in known:
            raise ValueError(f"nothing derives {name!r} at a level")
        base = known[name]
        wide = fields.where(F.col("variable").isin(*base) & F.col("level").isNotNull()).groupBy(*keys, "level", "r", "c").pivot("variable", list(base)).agg(F.first("v"))
        if name == "equivalent_potential_temperature":
            made = wide.withColumn("v", physics.equivalent_potential_temperature(F.col(base[0]), F.col(base[1]), F.col("level")))
        else:
            air = wide.select(*keys, "level", "r", "c", physics.potential_temperature(F.col(base[0]), F.col("level")).alias("theta"), F.col(base[1]).alias("u"), F.col(base[2]).alias("v"))
            made = derive.potential_vorticity(air, keys, grid).withColumn("v", F.col("pv"))
        out = out.unionByName(made.select(*keys, F.lit(name).alias("variable"), "level", "r", "c", "v"))
    return out


def assemble(fields: DataFrame, manifest: Model, keys: list[str], grid: Grid, static: DataFrame | None = None) -> DataFrame:
    """One row (keys, r, c, channels) for each cell; a cell that lacks a channel has a null there.

    ``fields`` is long (keys, variable, level, r, c, v), ``static`` is (variable, r, c, v) and
    holds for every key.  A single shuffle by cell pivots all channels; the filter on variables
    and levels reaches the scan.  The static grid is one small field, broadcast after its size
    (at most the grid's cells for each static variable) is checked.
    """
    check_sources(manifest)
    wanted = set(manifest.names)
    derived = wanted & {"equivalent_potential_temperature", "potential_vorticity"}
    whole = with_derived(fields, keys, grid, derived) if derived else fields
    levels = list(manifest.levels)
    picked = whole.where(F.col("variable").isin(*wanted) & (F.col("level").isNull() | F.col("level").isin(*levels)))
    name = F.when(F.col("level").isNull(), F.col("variable")).otherwise(F.concat_ws("_", "variable", F.col("level").cast("string")))
    own = [c for c in manifest.channel_names() if c not in STATIC]
    wide = _pivot(picked.withColumn("channel", name), keys, own)
    fixed = [c for c in manifest.channel_names() if c in STATIC]
    if fixed:
        if static is None:
            raise ValueError(f"{manifest.name} needs static fields {fixed}")
        ground = _pivot(static.where(F.col("variable").isin(*fixed)).withColumnRenamed("variable", "channel"), [], fixed)
        if ground.limit(grid.rows * grid.cols + 1).count() != grid.rows * grid.cols:
            raise ValueError("a static field does not cover the grid")
        wide = wide.join(F.broadcast(ground), ["r", "c"], "left")
    return wide.select(*keys, "r", "c", F.array(*(F.col(f"`{c}`") for c in manifest.channel_names())).alias("channels"))


def _pivot(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.groupBy(*keys, "r", "c").pivot("channel", names).agg(F.first("v"))


def by_class(df: DataFrame, probabilities: str, classes: list[str]) -> DataFrame:
    """A row (…, cls, p) for each class of an array of probabilities."""
    names = F.array(*(F.lit(c) for c in classes))
    rest = [c for c in df.columns if c != probabilities]
    return df.select(*rest, F.posexplode(probabilities).alias("_k", "p")).select(*rest, F.get(names, F.col("_k")).alias("cls"), "p")


def orientation_fields(inputs: DataFrame, manifest: Model, grid: Grid) -> DataFrame | None:
    """850 hPa temperature and winds of assembled inputs, thinned on fine grids, in signed longitudes."""
    names = manifest.channel_names()
    wanted = {"temperature": "equivalent_potential_temperature_850", "u": "u_component_of_wind_850", "v": "v_component_of_wind_850"}
    if any(n not in names for n in wanted.values()):
        return None
    from isallobar.operators.grid import rolled_to_signed, thinned

    stride = 2 if min(grid.rows, grid.cols) >= 200 else 1
    rest = [c for c in inputs.columns if c != "channels"]
    read = inputs.select(*rest, *(F.get("channels", F.lit(names.index(n))).cast("float").alias(k) for k, n in wanted.items()), grid.lat().alias("lat"))
    return rolled_to_signed(thinned(read, stride), -(-grid.cols // stride))
