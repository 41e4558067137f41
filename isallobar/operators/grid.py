"""Regular grids in long form: axes, adapters, padding, rolling, thinning, periodic selection.

Cells are rows ``(keys..., r, c, values...)`` with ``r`` counted from the north and ``c``
from the west.  Coordinates are expressions of ``r`` and ``c``, so no axis table is
joined.  All operators here are projections or explosions: none shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """An even grid, from pole to pole and once around the globe unless its edges say otherwise.

    A grid that spans 360 degrees is closed: its columns wrap.  Others end with their last
    row and column, which lie on the edges.
    """

    rows: int = 721
    cols: int = 1440
    north: float = 90.0
    south: float = -90.0
    west: float = 0.0
    span: float = 360.0

    @property
    def closed(self) -> bool:
        return self.span >= 360.0

    @property
    def gaps(self) -> int:
        """Steps of longitude between the edges."""
        return self.cols if self.closed else self.cols - 1

    @property
    def dlat(self) -> float:
        return (self.north - self.south) / (self.rows - 1)

    @property
    def dlon(self) -> float:
        return self.span / self.gaps

    def lat(self, r: Column | str = "r") -> Column:
        return self.north - (F.col(r) if isinstance(r, str) else r) * (self.north - self.south) / (self.rows - 1)

    def lon(self, c: Column | str = "c") -> Column:
        return self.west + (F.col(c) if isinstance(c, str) else c) * self.span / self.gaps

    def cells(self, spark: SparkSession) -> DataFrame:
        """Every cell (r, c) of the grid."""
        n = F.col("id")
        return spark.range(self.rows * self.cols).select((n / self.cols).cast("int").alias("r"), (n % self.cols).cast("int").alias("c"))

    def check_complete(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """The fields (keys) that do not have exactly one row for each cell."""
        counted = df.groupBy(*keys).agg(F.count("*").alias("cells"), F.count_distinct("r", "c").alias("distinct_cells"))
        return counted.where((F.col("cells") != self.rows * self.cols) | (F.col("cells") != F.col("distinct_cells")))


def table_grid(df: DataFrame, key: str, amount: str, grid: Grid) -> DataFrame:
    """Lay a keyed table over a grid: cell = key modulo cells, value = mean amount in exact cents."""
    cell = (F.col(key) % (grid.rows * grid.cols)).cast("int")
    cents = F.rint(F.col(amount) * 100).cast("long")
    summed = df.groupBy(cell.alias("cell")).agg(F.sum(cents).alias("cents"), F.count("*").alias("n"))
    return summed.select((F.col("cell") / grid.cols).cast("int").alias("r"), (F.col("cell") % grid.cols).alias("c"), (F.col("cents") / (F.col("n") * 100.0)).alias("v"))


def normalised_longitudes(df: DataFrame, lon: str = "lon") -> DataFrame:
    """Longitudes in [0, 360) and columns ``c`` numbered from the west.

    The axis (distinct longitudes of the field) is ranked within whole degrees, of which there
    are 360 whatever its size, and joined back.
    """
    moved = df.withColumn(lon, F.pmod(F.col(lon), F.lit(360.0)))
    axis = moved.select(lon).distinct().withColumn("_degree", F.floor(lon).cast("int"))
    counts = axis.groupBy("_degree").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("_degree").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_degree", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_degree").orderBy(lon))
    ranked = axis.join(F.broadcast(starts), "_degree").select(lon, (F.col("_before") + within - 1).cast("int").alias("c"))
    return moved.drop("c").join(ranked, lon)


def rolled_to_signed(df: DataFrame, cols: int) -> DataFrame:
    """Move a global 0..360 axis to -180..180: columns by half a turn, and ``lon`` with them."""
    if cols % 2:
        raise ValueError(f"a global longitude axis must have an even length to be rolled, not {cols}")
    lon = F.col("c") * 360.0 / cols
    return df.withColumn("lon", F.when(lon >= 180.0, lon - 360.0).otherwise(lon)).withColumn("c", F.pmod(F.col("c") + cols // 2, F.lit(cols)).cast("int"))


def thinned(df: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th row and column, numbered anew."""
    kept = df.where((F.col("r") % stride == 0) & (F.col("c") % stride == 0))
    return kept.withColumns({"r": (F.col("r") / stride).cast("int"), "c": (F.col("c") / stride).cast("int")})


def flipped(df: DataFrame, rows: int) -> DataFrame:
    """Rows in the opposite order."""
    return df.withColumn("r", F.lit(rows - 1) - F.col("r"))


def spliced(north: DataFrame, south: DataFrame, grid: Grid) -> DataFrame:
    """Northern rows (the equator among them) of one field, southern rows of another."""
    return north.where(grid.lat() >= 0).unionByName(south.where(grid.lat() < 0))


def circular_pad(df: DataFrame, cols: int, pad: int) -> DataFrame:
    """Repeat ``pad`` columns of each edge beyond the other; the field starts at column ``pad``."""
    if pad <= 0:
        return df
    if pad > cols:
        raise ValueError(f"cannot wrap {pad} of {cols} columns")
    c = F.col("c")
    copies = F.array_compact(F.array(c + pad, F.when(c >= cols - pad, c - cols + pad), F.when(c < pad, c + cols + pad)))
    return df.withColumn("c", F.explode(copies))


def zero_pad(df: DataFrame, keys: list[str], values: list[str], rows: int, cols: int, to_rows: int, to_cols: int) -> DataFrame:
    """Add cells of zeros below and right of every field.

    The new cells grow from the first cell of each field, so nothing is joined.
    """
    if to_rows < rows or to_cols < cols:
        raise ValueError("the padded grid is smaller than the field")
    if (to_rows, to_cols) == (rows, cols):
        return df
    corner = df.where("r = 0 AND c = 0").select(*keys, *(F.lit(0.0).alias(v) for v in values))
    everywhere = corner.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(to_rows - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(to_cols - 1))))
    return df.select(*keys, "r", "c", *values).unionByName(everywhere.where((F.col("r") >= rows) | (F.col("c") >= cols)).select(*keys, "r", "c", *values))


def padded_size(size: int, multiple: int) -> int:
    """The least multiple that is no smaller than ``size``."""
    if size <= 0 or multiple <= 0:
        raise ValueError(f"sizes must be positive, not {size} and {multiple}")
    return -(-size // multiple) * multiple


def in_periodic_range(lon: Column, start: float, stop: float, first: float = 0.0, period: float = 360.0) -> Column:
    """Whether an axis value lies in a closed range that may cross the seam; an inverted range is empty."""
    if stop < start:
        return F.lit(False)
    low, high = ((x - first) % period + first for x in (start, stop))
    return (lon >= low) & (lon <= high) if low < high else (lon >= low) | (lon <= high)


def channel_negated(channel: Column, value: Column, lat: Column) -> Column:
    """Meridional wind with its sign turned south of the equator; other channels as they are."""
    return F.when(F.contains(channel, F.lit("v_component_of_wind")) & (lat < 0), -value).otherwise(value)


def channels_negated(channels: Column, names: list[str], lat: Column) -> Column:
    """The same for an array with a value for each named channel."""
    turned = F.array(*(F.lit("v_component_of_wind" in n) for n in names))
    return F.transform(channels, lambda x, i: F.when(F.get(turned, i) & (lat < 0), -x).otherwise(x))
