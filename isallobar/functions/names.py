"""Store names, cycle dates and lead times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layout of published names.
STORE = r"^(\d{4}-\d{2}-\d{2})T(\d{2})Z(?:_f\d{3})?\.zarr$"
STEP_STORE = r"^(\d{4}-\d{2}-\d{2})T(\d{2})Z_f(\d{3})\.zarr$"
CACHE_FILE = r"^(\d{4}-\d{2}-\d{2})_\d{2}z_.*\.grib2$"
SIDE_FILE = r"^(\d{4}-\d{2}-\d{2})T\d{2}Z(?:_f\d{3})?\.(?:fronts\.geojson|fields\.npz|probs\.npz|pressure\.geojson)$"
#: Folders of intermediate tables that stand beside a store.
SIDE_FOLDER = r"^(\d{4}-\d{2}-\d{2})T\d{2}Z_f\d{3}\.(?:fields|probs|points)$"
SUFFIXES = {"fronts": ".fronts.geojson", "fields": ".fields.npz", "probs": ".probs.npz", "pressure": ".pressure.geojson"}
SYNOPTIC_HOURS = (0, 6, 12, 18)


def store_name(date: Column, hour: Column, step: Column) -> Column:
    """``<date>T<hh>Z_f<nnn>.zarr`` of a cycle date (string), run hour and lead time."""
    return F.format_string("%sT%02dZ_f%03d.zarr", date, hour, step)


def side_name(store: Column, kind: str) -> Column:
    """Name of a file beside a store; raises for what is no store name."""
    return F.when(store.endswith(".zarr"), F.regexp_replace(store, r"\.zarr$", SUFFIXES[kind])).otherwise(F.raise_error(F.concat(F.lit("not a store name: "), store)))


def embedded_date(name: Column, pattern: str) -> Column:
    """The date in a name that has the layout, null for other names and impossible dates."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def parsed_store(name: Column) -> Column:
    """(date, hour, step) of a store name with a lead time, null otherwise."""
    part = lambda start, size: F.substring(name, start, size)  # noqa: E731  the layout's places are fixed
    return F.when(F.rlike(name, F.lit(STEP_STORE)), F.struct(part(1, 10).alias("date"), part(12, 2).cast("int").alias("hour"), part(17, 3).cast("int").alias("step")))


def served_as(path: Column) -> Column:
    """How a data path is served: not at all, for good (what lies in a store never changes), or looked at again after a minute."""
    return F.when(F.rlike(path, F.lit(r"\.npz$")), "404").when(F.rlike(path, F.lit(r"\.zarr/")), "public, max-age=31536000, immutable").otherwise("public, max-age=60")


def valid_time(cycle: Column, step: Column) -> Column:
    """When a forecast holds: its cycle's time and its lead time in hours."""
    return F.timestamp_add("HOUR", step, cycle)


def iso_time(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def completed_cycle(now: Column, lag_hours: int = 7) -> Column:
    """The newest six-hourly cycle that is ``lag_hours`` old."""
    then = F.timestamp_add("HOUR", F.lit(-lag_hours), now)
    return F.timestamp_add("HOUR", (F.floor(F.hour(then) / 6) * 6).cast("int"), F.date_trunc("day", then))


def cycles_between(after: Column, current: Column) -> Column:
    """Cycles after one (null: none known, then the current only) up to the current one."""
    six = F.expr("INTERVAL 6 HOURS")
    return F.when(after.isNull(), F.array(current)).when(after >= current, F.array().cast("array<timestamp>")).otherwise(F.sequence(after + six, current, six))


def channel_parts(channel: Column) -> Column:
    """Variable and level of a channel name, split at its last underscore before digits."""
    pattern = r"^(.*)_(\d+)$"
    return F.when(
        F.rlike(channel, F.lit(pattern)),
        F.struct(F.regexp_extract(channel, pattern, 1).alias("variable"), F.regexp_extract(channel, pattern, 2).cast("int").alias("level")),
    ).otherwise(F.struct(channel.alias("variable"), F.lit(None).cast("int").alias("level")))


def side_url(root: str, model: Column, file: Column) -> Column:
    """Where a step's side file lies, null if the step has none."""
    return F.when(F.coalesce(file, F.lit("")) != "", F.concat_ws("/", F.lit(root), model, file))
