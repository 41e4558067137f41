"""Queries over scalar fields, derivations, assembly and geography."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from isallobar.functions import geo, physics
from isallobar.operators import assemble as asm
from isallobar.operators import derive, tiling
from isallobar.operators.grid import Grid, channel_negated, flipped, normalised_longitudes, rolled_to_signed, spliced, thinned
from isallobar.operators.neighbourhood import row_place
from isallobar.plans.manifest import CLASS_CODES, channel_table, get_model
from isallobar.plans.registry import AIR, GRID, LAT, LEVELS, LON, PROBABILITIES, SMALL, WINDS, grid_cells, ground, haversine_sql, level_fields, probabilities, query, r, read, rounded, theta_e_sql, winds

THETA_E = theta_e_sql("(27e1 + 5e-1 * l_quantity)", "(1e-1 * l_discount)", "85e1")
LEVEL_OF_LINE = "[1000, 925, 850, 700, 500, 300, 200][l_linenumber]"


@query(f"SELECT l_orderkey, l_linenumber, {r(THETA_E)} AS theta_e FROM lineitem")
def theta_e(spark, sf_dir):
    found = physics.equivalent_potential_temperature(270.0 + 0.5 * F.col("l_quantity"), 0.1 * F.col("l_discount"), F.lit(850.0))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rounded(found).alias("theta_e"))


@query(f"SELECT l_orderkey, l_linenumber, {r(f'(27e1 + 5e-1 * l_quantity) * pow(1e3 / {LEVEL_OF_LINE}, 28705e-2 / 1004e0)')} AS theta FROM lineitem")
def potential_temp(spark, sf_dir):
    level = F.element_at(F.array(*(F.lit(float(x)) for x in (*LEVELS, 200))), F.col("l_linenumber"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rounded(physics.potential_temperature(270.0 + 0.5 * F.col("l_quantity"), level)).alias("theta"))


@query(f"SELECT l_orderkey, l_linenumber, {r('greatest(1e-1 * l_discount, 1e-9)', 10)} AS humidity, {r('1e-1 * l_discount / (1e0 - 1e-1 * l_discount)', 8)} AS ratio FROM lineitem")
def mixing_ratio(spark, sf_dir):
    q = 0.1 * F.col("l_discount")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rounded(physics.clamped_humidity(q), 10).alias("humidity"), rounded(physics.mixing_ratio(q), 8).alias("ratio"))


@query(f"SELECT CAST(r AS INTEGER) AS r, {r(LAT, 8)} AS lat, {r(f'2e4 * 7292115e-11 * sin(radians({LAT}))', 8)} AS f_1e4 FROM range(24) AS t(r)")
def coriolis(spark, sf_dir):
    return spark.range(24).select(F.col("id").cast("int").alias("r")).select("r", rounded(SMALL.lat(), 8).alias("lat"), rounded(1e4 * physics.coriolis(SMALL.lat()), 8).alias("f_1e4"))


@query(f"SELECT event_id, {r('value * 1e3 / 1e2')} AS hpa, CASE WHEN event_type = 'error' THEN 0e0 ELSE value END AS filled, {r('tanh(value / 1e2)', 8)} AS clue FROM events")
def scalar_clean(spark, sf_dir):
    gap = F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value"))
    return read(spark, sf_dir, "events").select("event_id", rounded(physics.to_hpa(F.col("value") * 1000.0)).alias("hpa"), physics.nan_to_zero(gap).alias("filled"), rounded(physics.squashed(F.col("value"), 100.0), 8).alias("clue"))


@query(f"WITH {AIR} SELECT level, r, c, {r(theta_e_sql('t', 'q', 'CAST(level AS DOUBLE)'))} AS v FROM air")
def level_dispatch(spark, sf_dir):
    made = asm.with_derived(level_fields(spark, sf_dir), ["step"], SMALL, {"equivalent_potential_temperature"}).where("variable = 'equivalent_potential_temperature'")
    return made.select("level", "r", "c", rounded("v").alias("v"))


DX = f"(6371e3 * greatest(cos(radians({LAT.replace('r ', 'g.r ')})), 1e-6) * radians(75e-1))"
DY = "(6371e3 * radians(-18e1 / 23))"
SPIN = f"(e.v - w.v) / (2 * {DX}) - CASE WHEN n.u IS NULL THEN s.u - g.u WHEN s.u IS NULL THEN g.u - n.u ELSE (s.u - n.u) / 2 END / {DY}"


def _spin_sql(table: str, extra: str = "") -> str:
    """Vorticity of a wind table by self-joins with the four neighbours."""
    more = "".join(f" AND g.{x} = {{0}}.{x}" for x in extra.split()) if extra else ""
    return f"""SELECT g.*, {SPIN} AS spin FROM {table} g
  JOIN {table} e ON e.r = g.r AND e.c = (g.c + 1) % 48{more.format("e")} JOIN {table} w ON w.r = g.r AND w.c = (g.c + 47) % 48{more.format("w")}
  LEFT JOIN {table} n ON n.r = g.r - 1 AND n.c = g.c{more.format("n")} LEFT JOIN {table} s ON s.r = g.r + 1 AND s.c = g.c{more.format("s")}"""


@query(f"WITH {WINDS}, spun AS ({_spin_sql('winds')}) SELECT r, c, {r('spin * 1e5')} AS vorticity_1e5 FROM spun")
def vorticity(spark, sf_dir):
    found = derive.relative_vorticity(winds(spark, sf_dir).withColumn("f", F.lit(0)), ["f"], SMALL)
    return found.select("r", "c", rounded(F.col("vorticity") * 1e5).alias("vorticity_1e5"))


@query(f"""WITH {AIR}, moving AS (SELECT r, c, level, u, w AS v, t * pow(1e3 / level, 28705e-2 / 1004e0) AS theta FROM air),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY level) AS k FROM moving),
spun AS ({_spin_sql('ranked', 'level')}),
sloped AS (
  SELECT a.r, a.c, a.level, a.spin, (coalesce(b.theta, a.theta) - coalesce(d.theta, a.theta)) / ((coalesce(b.level, a.level) - coalesce(d.level, a.level)) * 1e2) AS slope
  FROM spun a LEFT JOIN ranked b ON b.r = a.r AND b.c = a.c AND b.k = a.k + 1 LEFT JOIN ranked d ON d.r = a.r AND d.c = a.c AND d.k = a.k - 1
)
SELECT r, c, level, {r(f'-980665e-5 * (spin + 2e0 * 7292115e-11 * sin(radians({LAT}))) * slope * 1e6', 5)} AS pv FROM sloped""")
def pv_isobaric(spark, sf_dir):
    wide = level_fields(spark, sf_dir).where("level IS NOT NULL").groupBy("level", "r", "c").pivot("variable", ["temperature", "u_component_of_wind", "v_component_of_wind"]).agg(F.first("v"))
    air = wide.select(F.lit(0).alias("f"), "level", "r", "c", physics.potential_temperature(F.col("temperature"), F.col("level")).alias("theta"), F.col("u_component_of_wind").alias("u"), F.col("v_component_of_wind").alias("v"))
    return derive.potential_vorticity(air, ["f"], SMALL).select("r", "c", "level", rounded("pv", 5).alias("pv"))


@query("""WITH m(model, position, variable, levels) AS (
  SELECT * FROM (VALUES
    ('theta-e_uv_q', 0, 'equivalent_potential_temperature', [1000, 925, 850, 700, 500, 300]), ('theta-e_uv_q', 1, 'u_component_of_wind', [1000, 925, 850, 700, 500, 300]),
    ('theta-e_uv_q', 2, 'v_component_of_wind', [1000, 925, 850, 700, 500, 300]), ('theta-e_uv_q', 3, 'specific_humidity', [1000, 925, 850, 700, 500, 300]),
    ('model_1702', 0, 'geopotential', [1000, 950, 900, 850]), ('model_1702', 1, 'temperature', [1000, 950, 900, 850]), ('model_1702', 2, 'u_component_of_wind', [1000, 950, 900, 850]),
    ('model_1702', 3, 'v_component_of_wind', [1000, 950, 900, 850]), ('model_1702', 4, 'specific_humidity', [1000, 950, 900, 850]), ('model_1702', 5, 'surface_pressure', NULL),
    ('model_1702', 6, '2m_temperature', NULL), ('model_1702', 7, '2m_dewpoint_temperature', NULL), ('model_1702', 8, '10m_u_component_of_wind', NULL), ('model_1702', 9, '10m_v_component_of_wind', NULL))
), flat AS (
  SELECT model, variable || '_' || levels[k] AS channel, 0 AS single, k AS nth, position FROM m, range(1, 7) AS g(k) WHERE k <= len(levels)
  UNION ALL SELECT model, variable, 1, 0, position FROM m WHERE levels IS NULL
)
SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY single, nth, position) - 1 AS INTEGER) AS channel_index, channel FROM flat""")
def channel_names(spark, sf_dir):
    return channel_table(spark, (get_model("theta-e_uv_q"), get_model("model_1702")))


ASSEMBLED = f"""{AIR}, level_order AS (SELECT * FROM (VALUES (0, 1000), (1, 925), (2, 850), (3, 700), (4, 500), (5, 300)) AS t(k, level)),
channels AS (
  SELECT r, c, k * 4 AS i, {theta_e_sql('t', 'q', 'CAST(level AS DOUBLE)')} AS v FROM air JOIN level_order USING (level)
  UNION ALL SELECT r, c, k * 4 + 1, u FROM air JOIN level_order USING (level)
  UNION ALL SELECT r, c, k * 4 + 2, w FROM air JOIN level_order USING (level)
  UNION ALL SELECT r, c, k * 4 + 3, q FROM air JOIN level_order USING (level)
  UNION ALL SELECT r, c, 24, v % 2e1 - 1e1 FROM grid UNION ALL SELECT r, c, 25, v % 24e0 - 12e0 FROM grid
  UNION ALL SELECT r, c, 26, 27e1 + v % 17e0 FROM grid UNION ALL SELECT r, c, 27, v % 5e3 - 9e2 FROM grid
)"""


def _inputs(spark, sf_dir):
    return asm.assemble(level_fields(spark, sf_dir), get_model("spix_wce_loss_modified_dilation"), ["step"], SMALL, ground(spark, sf_dir))


@query(f"WITH {ASSEMBLED} SELECT r, c, CAST(i AS INTEGER) AS i, {r('v')} AS v FROM channels")
def assemble_channels(spark, sf_dir):
    return _inputs(spark, sf_dir).select("r", "c", F.posexplode("channels").alias("i", "v")).select("r", "c", "i", rounded("v").alias("v"))


@query(f"""WITH {ASSEMBLED} SELECT r, c, CAST(l AS INTEGER) AS l, CAST(j AS INTEGER) AS j, {r('v')} AS v FROM channels, range(6) AS a(l), range(8) AS b(j)
WHERE i = CASE WHEN j < 4 THEN l * 4 + j ELSE 20 + j END""")
def volume_reshape(spark, sf_dir):
    """Channels as the volumetric predictor is given them."""
    shaped = tiling.Volumetric(None, get_model("spix_wce_loss_modified_dilation"))

    def work(batches):
        for batch in batches:
            found = shaped.volume(np.stack(batch["channels"].to_numpy()).astype(float)) if len(batch) else np.empty((0, 6, 8))
            n, l, j = np.indices(found.shape)
            yield pd.DataFrame({"r": batch["r"].to_numpy()[n.ravel()], "c": batch["c"].to_numpy()[n.ravel()], "l": l.ravel(), "j": j.ravel(), "v": found.ravel()})

    cube = _inputs(spark, sf_dir).select("r", "c", "channels").mapInPandas(work, "r int, c int, l int, j int, v double")
    return cube.select("r", "c", "l", "j", rounded("v").alias("v"))


@query(f"WITH {ASSEMBLED} SELECT r, c, CAST(i AS INTEGER) AS i, {r(f'CASE WHEN i IN (2, 6, 10, 14, 18, 22, 25) AND {LAT} < 0 THEN -v ELSE v END')} AS v FROM channels")
def hemisphere_negate(spark, sf_dir):
    from isallobar.operators.grid import channels_negated

    turned = channels_negated(F.col("channels"), get_model("spix_wce_loss_modified_dilation").channel_names(), SMALL.lat())
    return _inputs(spark, sf_dir).select("r", "c", F.posexplode(turned).alias("i", "v")).select("r", "c", "i", rounded("v").alias("v"))


@query(f"WITH {WINDS} SELECT r, c, name, {r(f'CASE WHEN {LAT} < 0 AND n = 1 THEN -x ELSE x END')} AS v FROM (SELECT r, c, 0 AS n, 'u_component_of_wind_850' AS name, u AS x FROM winds UNION ALL SELECT r, c, 1, '10m_v_component_of_wind', v FROM winds)")
def negate_long(spark, sf_dir):
    both = F.array(F.struct(F.lit("u_component_of_wind_850").alias("name"), F.col("u").alias("x")), F.struct(F.lit("10m_v_component_of_wind").alias("name"), F.col("v").alias("x")))
    return winds(spark, sf_dir).select("r", "c", F.inline(both)).select("r", "c", "name", rounded(channel_negated(F.col("name"), F.col("x"), SMALL.lat())).alias("v"))


@query(f"WITH {GRID} SELECT r, c, {r(f'CASE WHEN {LAT} >= 0 THEN v ELSE (SELECT g.v FROM grid g WHERE g.r = 23 - grid.r AND g.c = grid.c) * 2 END', 4)} AS v FROM grid")
def hemisphere_splice(spark, sf_dir):
    north = grid_cells(spark, sf_dir)
    south = flipped(north.withColumn("v", F.col("v") * 2), 24).select("r", "c", "v")
    return spliced(north, south, SMALL).select("r", "c", rounded("v", 4).alias("v"))


@query(f"WITH {GRID} SELECT CAST(23 - r AS INTEGER) AS r, c, {r('v', 4)} AS v FROM grid")
def flip_rows(spark, sf_dir):
    return flipped(grid_cells(spark, sf_dir), 24).select("r", "c", rounded("v", 4).alias("v"))


@query(f"WITH {PROBABILITIES}, i AS (SELECT r, c, k, p FROM prob WHERE k IN (1, 4)) SELECT r, c, CAST(CASE k WHEN 4 THEN 0 ELSE 1 END AS INTEGER) AS i, {r('p')} AS p FROM i")
def select_classes(spark, sf_dir):
    every = probabilities(spark, sf_dir).groupBy("r", "c").pivot("cls", ["cold", "warm", "stationary", "occluded", "dryline"]).agg(F.first("p"))

    def work(batches):
        for batch in batches:
            found = tiling.selected(batch[["cold", "warm", "stationary", "occluded", "dryline"]].to_numpy(), [4, 1])
            n, i = np.indices(found.shape)
            yield pd.DataFrame({"r": batch["r"].to_numpy()[n.ravel()], "c": batch["c"].to_numpy()[n.ravel()], "i": i.ravel(), "p": found.ravel()})

    return every.mapInPandas(work, "r int, c int, i int, p double").select("r", "c", "i", rounded("p").alias("p"))


@query(f"WITH {PROBABILITIES} SELECT r, c, ['CF', 'WF', 'SF', 'OF', 'DL'][k + 1] AS code, {r('p')} AS p FROM prob")
def class_codes(spark, sf_dir):
    every = probabilities(spark, sf_dir).groupBy("r", "c").pivot("cls", ["cold", "warm", "stationary", "occluded", "dryline"]).agg(F.first("p"))
    held = every.select("r", "c", F.array("cold", "warm", "stationary", "occluded", "dryline").alias("p"))
    split = asm.by_class(held, "p", ["cold", "warm", "stationary", "occluded", "dryline"])
    code = F.create_map(*(F.lit(x) for pair in CLASS_CODES.items() for x in pair))
    return split.select("r", "c", code[F.col("cls")].alias("code"), rounded("p").alias("p"))


@query(f"WITH {GRID} SELECT r, CAST((c + 24) % 48 AS INTEGER) AS c, {r(f'CASE WHEN {LON} >= 180 THEN {LON} - 360 ELSE {LON} END', 4)} AS lon, {r('v', 4)} AS v FROM grid")
def roll_lon(spark, sf_dir):
    return rolled_to_signed(grid_cells(spark, sf_dir), 48).select("r", "c", rounded("lon", 4).alias("lon"), rounded("v", 4).alias("v"))


@query(f"WITH {GRID} SELECT CAST(r // 3 AS INTEGER) AS r, CAST(c // 3 AS INTEGER) AS c, {r('v', 4)} AS v FROM grid WHERE r % 3 = 0 AND c % 3 = 0")
def thin_stride(spark, sf_dir):
    return thinned(grid_cells(spark, sf_dir), 3).select("r", "c", rounded("v", 4).alias("v"))


@query(f"""WITH {GRID}, moved AS (SELECT r, v, ({LON} - 18e1 + 36e1) % 36e1 AS lon FROM grid)
SELECT r, CAST(dense_rank() OVER (ORDER BY lon) - 1 AS INTEGER) AS c, {r('lon', 4)} AS lon, {r('v', 4)} AS v FROM moved""")
def normalise_lon(spark, sf_dir):
    signed = grid_cells(spark, sf_dir).select("r", "v", (SMALL.lon() - 180.0).alias("lon"))
    return normalised_longitudes(signed).select("r", "c", rounded("lon", 4).alias("lon"), rounded("v", 4).alias("v"))


@query(f"""WITH {ASSEMBLED}, wide AS (SELECT r, c, max(v) FILTER (i = 8) AS temperature, max(v) FILTER (i = 9) AS u, max(v) FILTER (i = 10) AS v FROM channels GROUP BY r, c)
SELECT r, CAST((c + 24) % 48 AS INTEGER) AS c, {r(f'CASE WHEN {LON} >= 180 THEN {LON} - 360 ELSE {LON} END', 4)} AS lon, {r('CAST(CAST(temperature AS FLOAT) AS DOUBLE)', 3)} AS temperature, {r('CAST(CAST(u AS FLOAT) AS DOUBLE)', 3)} AS u, {r('CAST(CAST(v AS FLOAT) AS DOUBLE)', 3)} AS v FROM wide""")
def orientation(spark, sf_dir):
    found = asm.orientation_fields(_inputs(spark, sf_dir), get_model("spix_wce_loss_modified_dilation"), SMALL)
    return found.select("r", "c", rounded("lon", 4).alias("lon"), *(rounded(F.col(n).cast("double"), 3).alias(n) for n in ("temperature", "u", "v")))


SPOT = "(c_custkey * 37 % 360 + 25e-2)", "(c_custkey * 53 % 179 - 89 + 5e-1)"
SPOT2 = "(c_custkey * 41 % 360 + 75e-2)", "(c_custkey * 59 % 179 - 89 + 25e-2)"


def _spots(spark, sf_dir):
    k = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        "c_custkey", (k * 37 % 360 + 0.25).alias("lon"), (k * 53 % 179 - 89 + 0.5).alias("lat"), (k * 41 % 360 + 0.75).alias("lon2"), (k * 59 % 179 - 89 + 0.25).alias("lat2")
    )


@query(f"SELECT c_custkey, {r(haversine_sql(SPOT[0], SPOT[1], SPOT2[0], SPOT2[1]), 4)} AS km FROM customer")
def haversine_pairs(spark, sf_dir):
    return _spots(spark, sf_dir).select("c_custkey", rounded(geo.haversine_km(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")), 4).alias("km"))


@query(f"""SELECT c_custkey, {r(f'cos(radians({SPOT[1]})) * cos(radians({SPOT[0]}))', 8)} AS x, {r(f'cos(radians({SPOT[1]})) * sin(radians({SPOT[0]}))', 8)} AS y, {r(f'sin(radians({SPOT[1]}))', 8)} AS z,
{r(haversine_sql(SPOT[0], SPOT[1], SPOT2[0], SPOT2[1]), 3)} AS km FROM customer""")
def unit_vectors(spark, sf_dir):
    x, y, z = geo.unit_vector(F.col("lon"), F.col("lat"))
    x2, y2, z2 = geo.unit_vector(F.col("lon2"), F.col("lat2"))
    chord = F.sqrt((x - x2) * (x - x2) + (y - y2) * (y - y2) + (z - z2) * (z - z2))
    return _spots(spark, sf_dir).select("c_custkey", rounded(x, 8).alias("x"), rounded(y, 8).alias("y"), rounded(z, 8).alias("z"), rounded(geo.chord_km(chord), 3).alias("km"))


ANY_LON = "(c_custkey * 7253 % 100000 / 1e2 - 4e2)"
SHIFTED = f"((({ANY_LON} + 18e1) % 36e1 + 36e1) % 36e1 - 18e1)"


@query(f"SELECT c_custkey, {r(f'{SHIFTED} - {ANY_LON}', 4)} AS shift, CASE WHEN round_even({SHIFTED}, 2) >= 180 THEN round_even({SHIFTED}, 2) - 36e1 ELSE round_even({SHIFTED}, 2) + 0e0 END AS wrapped FROM customer")
def lon_wrap(spark, sf_dir):
    lon = F.col("c_custkey") * 7253 % 100000 / 100.0 - 400.0
    return read(spark, sf_dir, "customer").select("c_custkey", rounded(geo.signed_shift(lon), 4).alias("shift"), geo.wrapped_longitude(lon).alias("wrapped"))


@query(f"SELECT c_custkey, {r(f'{ANY_LON} + 36e1 * round_even((9e1 - {ANY_LON}) / 36e1, 0)', 4)} AS near FROM customer")
def lon_near(spark, sf_dir):
    lon = F.col("c_custkey") * 7253 % 100000 / 100.0 - 400.0
    return read(spark, sf_dir, "customer").select("c_custkey", rounded(geo.near_longitude(lon, F.lit(90.0)), 4).alias("near"))


@query(f"SELECT c_custkey, {r(f'{SPOT[0]} + degrees(15e1 / (6371e0 * cos(radians({SPOT[1]}))))')} AS lon, {r(f'{SPOT[1]} + degrees(-75e0 / 6371e0)')} AS lat FROM customer")
def offset_points(spark, sf_dir):
    lon, lat = geo.offset_point(F.col("lon"), F.col("lat"), F.lit(150.0), F.lit(-75.0))
    return _spots(spark, sf_dir).select("c_custkey", rounded(lon).alias("lon"), rounded(lat).alias("lat"))


@query("SELECT * FROM (VALUES ('global', true, true), ('regional', false, false)) AS t(axis, spans, periodic)")
def global_axis(spark, sf_dir):
    c = F.col("id")
    axes = spark.range(48).select(F.lit("global").alias("axis"), (c * 7.5).alias("lon")).unionByName(spark.range(30).select(F.lit("regional").alias("axis"), (c * 7.5).alias("lon")))
    ends = axes.groupBy("axis").agg(F.sort_array(F.collect_list("lon")).alias("x"), F.count("*").alias("n"))  # an axis, some thousand numbers
    first, second, last = F.get("x", F.lit(0)), F.get("x", F.lit(1)), F.element_at("x", -1)
    return ends.select("axis", geo.axis_is_global(first, second, last).alias("spans"), geo.axis_is_periodic(F.col("n"), first, second).alias("periodic"))


@query(f"SELECT c_custkey, CASE WHEN {SPOT[1]} BETWEEN -6e1 AND 6e1 THEN {r(f'(6e1 - {SPOT[1]}) / 25e-1')} END AS y FROM customer")
def fractional_index(spark, sf_dir):
    """Places on the axis of a grid from 60 to -60 degrees, as samples of fields are taken at them."""
    band = Grid(49, 144, north=60.0, south=-60.0)
    return _spots(spark, sf_dir).select("c_custkey", rounded(row_place(F.col("lat"), band)).alias("y"))


@query("SELECT variable, CAST(count(*) AS BIGINT) AS n, count(DISTINCT level) AS levels FROM (VALUES ('temperature', 850), ('temperature', 500), ('surface_pressure', NULL)) AS t(variable, level), range(24 * 48) GROUP BY variable")
def synthetic_source(spark, sf_dir):
    from isallobar.sources.fields import SyntheticSource

    found = SyntheticSource(spark, SMALL).fields(["temperature", "surface_pressure"], [850, 500], [0])
    return found.groupBy("variable").agg(F.count("*").alias("n"), F.count_distinct("level").alias("levels"))
