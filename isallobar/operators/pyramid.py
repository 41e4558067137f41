"""Mean pyramids, byte packing, and the stores they are written to."""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isallobar.plans.manifest import Model

LEVELS = 6
# Packed numbers are probability * 254; 255 stands for a missing value.
SCALE, MISSING = 254.0, 255
#: Cells on a side of a stored chunk.
CHUNK = 128
PACK_VARIABLE = "ISALLOBAR_PACK_UINT8"


def level0(probabilities: DataFrame, manifest: Model) -> DataFrame:
    """Served classes as floats; classes that are missing or too many are an error at run time.

    The set of classes is checked by one aggregate over (cls), partially aggregated.
    """
    found = {r.cls for r in probabilities.select("cls").distinct().limit(1000).collect()}
    if odd := found ^ set(manifest.served):
        raise ValueError(f"{manifest.name}: classes that are missing or not served: {sorted(map(str, odd))}")
    return probabilities.withColumn("p", F.col("p").cast("float"))


def mean_pyramid(level_0: DataFrame, keys: list[str], levels: int = LEVELS) -> DataFrame:
    """Rows (keys, level, r, c, p): each level is the mean of two by two cells of the one before.

    Blocks at an odd edge average the cells that exist; missing values are left out.  Every
    level is made from the one before, so the work shrinks fourfold with each.  The four cells
    are added in a fixed order, so a mean does not depend on how rows are dealt to tasks.
    """
    if levels < 1:
        raise ValueError(f"a pyramid has at least one level, not {levels}")
    now = level_0.select(*keys, "r", "c", F.col("p").cast("double").alias("p"))
    out = now.withColumn("level", F.lit(0))
    corners = [(0, 0), (0, 1), (1, 0), (1, 1)]
    for k in range(1, levels):
        cells = [F.max(F.when((F.col("r") % 2 == a) & (F.col("c") % 2 == b), F.col("p"))).alias(f"_{a}{b}") for a, b in corners]
        four = now.groupBy(*keys, F.shiftright("r", 1).alias("_r"), F.shiftright("c", 1).alias("_c")).agg(*cells)
        there = [F.col(f"_{a}{b}") for a, b in corners]
        total = functools.reduce(lambda x, y: x + y, (F.coalesce(x, F.lit(0.0)) for x in there))
        count = functools.reduce(lambda x, y: x + y, (x.isNotNull().cast("int") for x in there))
        now = four.select(*keys, F.col("_r").alias("r"), F.col("_c").alias("c"), F.when(count > 0, total / count).alias("p"))
        out = out.unionByName(now.withColumn("level", F.lit(k)))
    return out


def store_checks(pyramid: DataFrame) -> DataFrame:
    """What a smoke test asks of a store, for each class: its levels, cells and missing values, its range, and whether it is sound.

    Sound is a class without missing values at full resolution, all of them in [0, 1].
    """
    first = F.col("level") == 0
    p = F.when(first, F.nanvl(F.col("p"), F.lit(None).cast("double")))
    found = pyramid.groupBy("cls").agg(F.count_distinct("level").alias("levels"), F.count_if(first).alias("cells"), F.count_if(first & p.isNull()).alias("missing"), F.min(p).alias("least"), F.max(p).alias("most"))
    return found.withColumn("sound", (F.col("missing") == 0) & (F.col("least") >= 0) & (F.col("most") <= 1))


def packed(p: Column) -> Column:
    """A probability as a small number: clipped, halves to even, missing values 255."""
    clean = F.nanvl(p, F.lit(None).cast("double"))
    # Spark's least and greatest skip nulls, so missing values are told apart first.
    return F.when(clean.isNull(), MISSING).otherwise(F.rint(F.least(F.greatest(clean, F.lit(0.0)), F.lit(1.0)) * SCALE)).cast("smallint")


def unpacked(q: Column) -> Column:
    return F.when(q != MISSING, q / F.lit(SCALE))


def packing_wanted(asked: bool | None = None) -> bool:
    """Whether to pack: what is asked for, else the environment, else no."""
    return asked if asked is not None else os.environ.get(PACK_VARIABLE, "").strip().lower() in ("1", "true", "yes", "on")


def chunked(df: DataFrame) -> DataFrame:
    """Add the chunk that a cell is stored in."""
    return df.withColumns({"chunk_r": (F.col("r") / CHUNK).cast("int"), "chunk_c": (F.col("c") / CHUNK).cast("int")})


def write_pyramid(pyramid: DataFrame, path: str, pack: bool | None = None) -> None:
    """Write levels as Parquet, one folder for each level and class, chunks kept together.

    Packed stores hold ``q`` and no ``p``; readers tell them apart by that.
    """
    out = pyramid.withColumn("q", packed(F.col("p"))).drop("p") if packing_wanted(pack) else pyramid.withColumn("p", F.col("p").cast("float"))
    chunked(out).repartition("level", "cls", "chunk_r", "chunk_c").sortWithinPartitions("level", "cls", "chunk_r", "chunk_c", "r", "c").write.mode("overwrite").partitionBy("level", "cls").parquet(path)


def is_packed(store: DataFrame) -> bool:
    return "q" in store.columns


def read_level0(spark, path: str) -> DataFrame:
    """Full-resolution probabilities (…, cls, p) of a store, packed or not; other levels are pruned."""
    store = spark.read.parquet(path).where("level = 0")
    return store.withColumn("p", unpacked(F.col("q"))).drop("q") if is_packed(store) else store


def requantized(store: DataFrame) -> DataFrame:
    """A store with packed values; one that is packed stays as it is."""
    return store if is_packed(store) else store.withColumn("q", packed(F.col("p").cast("double"))).drop("p")
