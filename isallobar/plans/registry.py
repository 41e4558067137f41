"""Registered queries, their SQL, and the tables laid over grids, lines and catalogs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isallobar.functions import names
from isallobar.operators.grid import Grid, table_grid

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SMALL = Grid(24, 48)
LEVELS = (1000, 925, 850, 700, 500, 300)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that it must equal."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(x: Column | str, places: int = 6) -> Column:
    return F.round(x, places)


def r(x: str, places: int = 6) -> str:
    """SQL for :func:`rounded`, without negative zeros."""
    return f"(round({x}, {places}) + 0e0)"


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders laid over a small global grid: r, c, v."""
    return table_grid(read(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice", SMALL)


GRID = """grid AS (
  SELECT CAST(cell // 48 AS INTEGER) AS r, CAST(cell % 48 AS INTEGER) AS c, cents / (n * 1e2) AS v
  FROM (SELECT o_orderkey % 1152 AS cell, CAST(sum(CAST(round_even(o_totalprice * 1e2, 0) AS BIGINT)) AS DOUBLE) AS cents, count(*) AS n FROM orders GROUP BY 1)
)"""
LAT, LON = "(9e1 - r * 18e1 / 23)", "(c * 36e1 / 48)"


def part(v: str, size: float) -> Column:
    """Remainder of a positive value: spreads it evenly over [0, size)."""
    return F.pmod(F.col(v), F.lit(float(size)))


def winds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winds on the small grid: r, c, u, v."""
    return grid_cells(spark, sf_dir).select("r", "c", (part("v", 40) - 20.0).alias("u"), (part("v", 30) - 15.0).alias("v"))


WINDS = f"{GRID}, winds AS (SELECT r, c, v % 4e1 - 2e1 AS u, v % 3e1 - 15e0 AS v FROM grid)"


def level_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long fields (step, variable, level, r, c, v) of the small grid."""
    p = F.col("level")
    values = F.array(
        *(
            F.struct(F.lit(n).alias("variable"), x.alias("x"))
            for n, x in (
                ("temperature", 288.0 - 0.05 * (1000 - p) + part("v", 10) - 5.0),
                ("specific_humidity", 0.001 + part("v", 100) / 20000.0),
                ("u_component_of_wind", part("v", 40) - 20.0 + p / 100.0),
                ("v_component_of_wind", part("v", 30) - 15.0 - p / 200.0),
            )
        )
    )
    single = F.array(
        *(
            F.struct(F.lit(n).alias("variable"), x.alias("x"))
            for n, x in (
                ("10m_u_component_of_wind", part("v", 20) - 10.0),
                ("10m_v_component_of_wind", part("v", 24) - 12.0),
                ("2m_dewpoint_temperature", 270.0 + part("v", 17)),
                ("surface_pressure", 101325.0 - part("v", 900)),
            )
        )
    )
    cells = grid_cells(spark, sf_dir)
    levels = F.explode(F.array(*(F.lit(x) for x in LEVELS)))
    high = cells.withColumn("level", levels).select("level", "r", "c", F.inline(values))
    low = cells.select(F.lit(None).cast("int").alias("level"), "r", "c", F.inline(single))
    return high.unionByName(low).select(F.lit(0).alias("step"), "variable", "level", "r", "c", F.col("x").alias("v"))


def ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A static field: variable, r, c, v."""
    return grid_cells(spark, sf_dir).select(F.lit("geopotential_at_surface").alias("variable"), "r", "c", (part("v", 5000) - 900.0).alias("v"))


AIR = f"""{GRID}, air AS (
  SELECT r, c, level, 288e0 - 5e-2 * (1000 - level) + v % 1e1 - 5e0 AS t, 1e-3 + v % 1e2 / 2e4 AS q,
         v % 4e1 - 2e1 + level / 1e2 AS u, v % 3e1 - 15e0 - level / 2e2 AS w
  FROM grid, (VALUES (1000), (925), (850), (700), (500), (300)) AS l(level)
)"""


def theta_e_sql(t: str, q: str, p: str) -> str:
    """Equivalent potential temperature as one SQL expression."""
    ratio = f"(greatest({q}, 1e-9) / (1e0 - greatest({q}, 1e-9)))"
    s = f"ln({ratio} / (622e-3 + {ratio}) * {p} / 6112e-3)"
    dew = f"(2435e-1 * {s} / (1767e-2 - {s}) + 27315e-2)"
    lcl = f"(1e0 / (1e0 / ({dew} - 56e0) + ln({t} / {dew}) / 8e2) + 56e0)"
    return f"({t} * pow(1e3 / {p}, 28705e-2 / 1004e0) * exp(2501e3 * {ratio} / (1004e0 * {lcl})))"


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the five served classes on the small grid: r, c, cls, p."""
    classes = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(n).alias("cls")) for k, n in enumerate(("cold", "warm", "stationary", "occluded", "dryline"))))
    return grid_cells(spark, sf_dir).select("r", "c", "v", F.inline(classes)).select("r", "c", "cls", (F.pmod(F.col("v") * (F.col("k") + 3), F.lit(1000.0)) / 2500.0).alias("p"))


PROBABILITIES = f"""{GRID}, prob AS (
  SELECT r, c, cls, k, v * (k + 3) % 1e3 / 25e2 AS p
  FROM grid, (VALUES (0, 'cold'), (1, 'warm'), (2, 'stationary'), (3, 'occluded'), (4, 'dryline')) AS t(k, cls)
)"""


def line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line along every row of the small grid: line, i, lon, lat, label, p."""
    return grid_cells(spark, sf_dir).select(F.col("r").alias("line"), F.col("c").alias("i"), (SMALL.lon() + part("v", 7) / 3.0).alias("lon"), (SMALL.lat() * 0.9 + part("v", 11) / 5.0).alias("lat"), F.floor(part("v", 3)).cast("int").alias("label"), (part("v", 100) / 100.0).alias("p"))


LINES = f"""{GRID}, lines AS (
  SELECT r AS line, c AS i, {LON} + v % 7e0 / 3e0 AS lon, {LAT} * 9e-1 + v % 11e0 / 5e0 AS lat, CAST(floor(v % 3e0) AS INTEGER) AS label, v % 1e2 / 1e2 AS p FROM grid
)"""


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a = f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    return f"(12742e0 * asin(sqrt(least(1e0, greatest(0e0, {a})))))"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as a folder of stores would list them: model, name, is_folder, cycle, step."""
    cycle = F.timestamp_add("HOUR", (F.col("o_orderkey") % 4 * 6).cast("int"), F.date_trunc("day", F.col("o_orderdate").cast("timestamp")))
    base = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("model_"), "o_orderstatus").alias("model"), cycle.alias("cycle"), (F.col("o_orderkey") % 41 * 6).cast("int").alias("step"))
    store = names.store_name(F.date_format("cycle", "yyyy-MM-dd"), F.hour("cycle"), F.col("step"))
    kind = F.col("o_orderkey") % 5
    name = F.when(kind == 0, F.regexp_replace(store, r"\.zarr$", ".fronts.geojson")).when(kind == 1, F.concat(F.lit("notes-"), store)).when(F.col("o_orderkey") % 11 == 2, "latest.json").when(F.col("o_orderkey") % 13 == 3, "2001-13-45T00Z_f000.zarr").otherwise(store)
    return base.select("model", name.alias("name"), (name.endswith(".zarr")).alias("is_folder"), "cycle", "step")


LISTING = """base AS (
  SELECT o_orderkey, 'model_' || o_orderstatus AS model, date_trunc('day', o_orderdate) + to_hours(o_orderkey % 4 * 6) AS cycle, CAST(o_orderkey % 41 * 6 AS INTEGER) AS step FROM orders
), named AS (
  SELECT *, strftime(cycle, '%Y-%m-%dT%HZ') || '_f' || lpad(CAST(step AS VARCHAR), 3, '0') || '.zarr' AS store FROM base
), listing AS (
  SELECT model, cycle, step, CASE WHEN o_orderkey % 5 = 0 THEN replace(store, '.zarr', '.fronts.geojson') WHEN o_orderkey % 5 = 1 THEN 'notes-' || store
    WHEN o_orderkey % 11 = 2 THEN 'latest.json' WHEN o_orderkey % 13 = 3 THEN '2001-13-45T00Z_f000.zarr' ELSE store END AS name FROM named
), stores AS (
  SELECT DISTINCT model, name AS store, try_strptime(name[1:13], '%Y-%m-%dT%H') AS cycle, CAST(name[17:19] AS INTEGER) AS step
  FROM listing WHERE regexp_matches(name, '^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}Z_f[0-9]{3}[.]zarr$') AND try_strptime(name[1:13], '%Y-%m-%dT%H') IS NOT NULL
)"""
