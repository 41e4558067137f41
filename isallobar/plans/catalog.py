"""The catalog of cycles, steps and stores: what is published, missing, complete, stale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isallobar.functions import names

# Lead times published by run hour, and those wanted.
SHORT = tuple(range(0, 145, 3))
LONG = SHORT + tuple(range(150, 361, 6))
WANTED = tuple(range(0, 241, 6))


def published_steps(run_hour: int) -> tuple[int, ...]:
    """Lead times (hours) that a cycle publishes."""
    if run_hour not in names.SYNOPTIC_HOURS:
        raise ValueError(f"cycles run at {names.SYNOPTIC_HOURS}, not {run_hour}")
    return LONG if run_hour % 12 == 0 else SHORT


def target_steps(run_hour: int, wanted: Sequence[int] = WANTED) -> tuple[int, ...]:
    """Those of the wanted lead times that a cycle publishes."""
    known = set(published_steps(run_hour))
    return tuple(s for s in wanted if s in known)


def published(run_hour: Column) -> Column:
    """:func:`published_steps` as a column."""
    short = F.sequence(F.lit(0), F.lit(144), F.lit(3))
    return F.when(run_hour % 12 == 0, F.concat(short, F.sequence(F.lit(150), F.lit(360), F.lit(6)))).otherwise(short)


def targets(run_hour: Column) -> Column:
    """:func:`target_steps` as a column."""
    return F.array_intersect(F.sequence(F.lit(0), F.lit(240), F.lit(6)), published(run_hour))


def stores(listing: DataFrame) -> DataFrame:
    """(model, cycle, step, store) of listed names that are stores with a lead time; impossible times are left out."""
    parsed = listing.withColumn("s", names.parsed_store(F.col("name"))).where("s.hour < 24")
    cycle = F.timestamp_add("HOUR", F.col("s.hour"), F.try_to_timestamp("s.date", F.lit("yyyy-MM-dd")))
    return parsed.select("model", cycle.alias("cycle"), F.col("s.step").alias("step"), F.col("name").alias("store")).where("cycle IS NOT NULL")


def newest_cycles(present: DataFrame) -> DataFrame:
    """The newest cycle of which each model has any store."""
    return present.groupBy("model").agg(F.max("cycle").alias("cycle"))


def _stored(present: DataFrame, cycles: DataFrame | None) -> DataFrame:
    """(model, cycle, steps, missing): what is stored of each cycle, and which of its target steps are not.

    A cycle's steps are gathered in one row; names leave room for a thousand at most.  Without
    ``cycles`` those that have any store are meant, and a single shuffle does.
    """
    has = present.groupBy("model", "cycle").agg(F.collect_set("step").alias("steps"))
    if cycles is not None:
        has = cycles.join(has, ["model", "cycle"], "left").withColumn("steps", F.coalesce("steps", F.array().cast("array<int>")))
    return has.withColumn("missing", F.array_except(targets(F.hour("cycle")), "steps"))


def missing_steps(present: DataFrame, cycles: DataFrame | None = None) -> DataFrame:
    """Target steps (model, cycle, step) that are not stored yet, of the cycles given or of all that have a store."""
    return _stored(present, cycles).select("model", "cycle", F.explode("missing").alias("step"))


def completeness(present: DataFrame, cycles: DataFrame | None = None) -> DataFrame:
    """(model, cycle, present, missing, complete) of the cycles given or of all that have a store."""
    return _stored(present, cycles).select("model", "cycle", F.size("steps").alias("present"), F.size("missing").alias("missing"), (F.size("missing") == 0).alias("complete"))


def newest_published(available: DataFrame, now: Column, tries: int = 4) -> DataFrame:
    """The newest cycle with its first step available, among the last ``tries`` up to now."""
    current = names.completed_cycle(now, 0)
    oldest = F.timestamp_add("HOUR", F.lit(-6 * (tries - 1)), current)
    return available.where((F.col("step") == 0) & (F.col("cycle") <= current) & (F.col("cycle") >= oldest)).agg(F.max("cycle").alias("cycle")).where("cycle IS NOT NULL")


def expired(listing: DataFrame, today: Column, days: int) -> DataFrame:
    """Stores, side files and side folders whose name bears a date more than ``days`` before today.

    Only names with the known layouts count; the pointer and everything else stay.
    """
    if days < 0:
        raise ValueError(f"files cannot be kept for {days} days")
    folder = F.coalesce(names.embedded_date(F.col("name"), names.STORE), names.embedded_date(F.col("name"), names.SIDE_FOLDER))
    date = F.when(F.col("is_folder"), folder).otherwise(names.embedded_date(F.col("name"), names.SIDE_FILE))
    return listing.withColumn("date", date).where(F.col("date") < F.date_sub(today, days)).select("model", "name", "date")


def expired_cache(listing: DataFrame, today: Column, days: int) -> DataFrame:
    """Cached downloads (name, is_folder) past their time, by the date in their names."""
    if days < 0:
        raise ValueError(f"files cannot be kept for {days} days")
    dated = listing.where(~F.col("is_folder")).withColumn("date", names.embedded_date(F.col("name"), names.CACHE_FILE))
    return dated.where(F.col("date") < F.date_sub(today, days)).select("name", "date")


def with_products(steps: DataFrame, listing: DataFrame) -> DataFrame:
    """Name the front and pressure files of every step that has them (null: none)."""
    files = listing.where(~F.col("is_folder")).select("model", "name")
    out = steps
    for kind in ("fronts", "pressure"):
        own = files.select("model", F.col("name").alias("_name"), F.col("name").alias(kind))
        out = out.withColumn("_name", names.side_name(F.col("store"), kind)).join(own, ["model", "_name"], "left").drop("_name")
    return out


def stale_copies(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Names in a copy (model, name) that the source does not have any more."""
    return copy.join(source, ["model", "name"], "left_anti")


def step_counts(present: DataFrame) -> DataFrame:
    return present.groupBy("model").agg(F.count("*").alias("steps"))


def catalog_rows(spark: SparkSession, model: str, cycle: str, steps: Sequence[int]) -> DataFrame:
    """Pointer rows of a cycle's steps: model, cycle_time, step_hours, valid_time, store."""
    base = spark.createDataFrame([(model, cycle, s) for s in steps], "model string, cycle string, step_hours int").withColumn("cycle_time", F.to_timestamp("cycle", "yyyy-MM-dd HH"))
    return base.select("model", "cycle_time", "step_hours", names.valid_time(F.col("cycle_time"), F.col("step_hours")).alias("valid_time"), names.store_name(F.date_format("cycle_time", "yyyy-MM-dd"), F.hour("cycle_time"), F.col("step_hours")).alias("store"))
