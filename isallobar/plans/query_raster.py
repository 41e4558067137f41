"""Queries over tiles, pyramids, neighbourhoods, pressure and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from isallobar.operators import neighbourhood, pressure, pyramid, tiling
from isallobar.operators.grid import circular_pad, in_periodic_range, zero_pad
from isallobar.plans.manifest import Model, get_model, single
from isallobar.plans.registry import GRID, LAT, LON, PROBABILITIES, SMALL, grid_cells, part, probabilities, query, r, read, rounded


@query(f"WITH {GRID} SELECT r, CAST(c + 6 + 48 * k AS INTEGER) AS c, {r('v', 4)} AS v FROM grid, (VALUES (-1), (0), (1)) AS t(k) WHERE c + 6 + 48 * k BETWEEN 0 AND 59")
def circular_padding(spark, sf_dir):
    return circular_pad(grid_cells(spark, sf_dir), 48, 6).select("r", "c", rounded("v", 4).alias("v"))


@query(f"WITH {GRID} SELECT r, c, {r('v', 4)} AS v FROM grid WHERE {LON} >= 35e1 OR {LON} <= 2e1")
def periodic_select(spark, sf_dir):
    return grid_cells(spark, sf_dir).where(in_periodic_range(SMALL.lon(), -10.0, 20.0)).select("r", "c", rounded("v", 4).alias("v"))


@query(f"WITH {GRID} SELECT CAST(a.r AS INTEGER) AS r, CAST(b.c AS INTEGER) AS c, coalesce({r('v', 4)}, 0e0) AS v FROM range(32) AS a(r) CROSS JOIN range(64) AS b(c) LEFT JOIN grid ON grid.r = a.r AND grid.c = b.c")
def zero_padding(spark, sf_dir):
    return zero_pad(grid_cells(spark, sf_dir).withColumn("f", F.lit(0)), ["f"], ["v"], 24, 48, 32, 64).select("r", "c", rounded("v", 4).alias("v"))


STARTS = """rs AS (SELECT * FROM (VALUES (0, 0, 0, 6), (1, 10, 6, 10), (2, 16, 10, 0)) AS t(k, s, a, b)),
cs AS (SELECT * FROM (VALUES (0, 0, 0, 6), (1, 10, 6, 6), (2, 20, 6, 6), (3, 30, 6, 6), (4, 40, 6, 8), (5, 48, 8, 0)) AS t(k, s, a, b))"""
# Ramps are cut so that the two of a tile never meet: the middle row tile has 8 and 8, the last one 8.
STARTS = STARTS.replace("(1, 10, 6, 10), (2, 16, 10, 0)", "(1, 10, 6, 10), (2, 16, 8, 0)")


def _w(t: str, i: str) -> str:
    return f"CASE WHEN {t}.b > 0 AND {i} >= 16 - {t}.b THEN CAST(16 - ({i}) AS DOUBLE) / {t}.b WHEN {i} < {t}.a THEN CAST({i} + 1 AS DOUBLE) / {t}.a ELSE 1e0 END"


@query(f"""WITH {STARTS} SELECT CAST(rs.k * 6 + cs.k AS INTEGER) AS tile_id, rs.s AS row_start, rs.s + 16 AS row_end, cs.s AS col_start, cs.s + 16 AS col_end,
rs.a AS row_left, rs.b AS row_right, cs.a AS col_left, cs.b AS col_right FROM rs, cs""")
def tiles(spark, sf_dir):
    return tiling.tile_table(spark, 32, 64, 16, 6)


@query(f"WITH {STARTS} SELECT CAST(cs.k AS INTEGER) AS k, CAST(i AS INTEGER) AS i, {r(_w('cs', 'i'), 8)} AS w FROM cs, range(16) AS g(i)")
def ramp_weights(spark, sf_dir):
    table = spark.createDataFrame([(k, *x) for k, x in enumerate(tiling.ramps(tiling.tile_starts(64, 16, 6), 16))], "k int, s int, a int, b int")
    spread = table.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return spread.select("k", "i", rounded(tiling.ramp_weight(F.col("i"), F.col("a"), F.col("b"), 16), 8).alias("w"))


PADDED = f"""{GRID}, padded AS (SELECT CAST(a.r AS INTEGER) AS r, CAST(b.c AS INTEGER) AS c, CASE WHEN a.r < 24 AND b.c < 60 THEN coalesce(grid.v, 0) ELSE 0e0 END AS v
  FROM range(32) AS a(r) CROSS JOIN range(64) AS b(c) LEFT JOIN grid ON grid.r = a.r AND grid.c = (b.c + 42) % 48)"""
PADDED = PADDED.replace("(b.c + 42) % 48", "((b.c - 6 + 48) % 48) AND b.c < 60")


@query(f"""WITH {PADDED}, {STARTS} SELECT p.r, p.c, CAST(rs.k * 6 + cs.k AS INTEGER) AS tile_id, {r(f"({_w('rs', 'p.r - rs.s')}) * ({_w('cs', 'p.c - cs.s')})", 8)} AS weight
FROM padded p JOIN rs ON p.r >= rs.s AND p.r < rs.s + 16 JOIN cs ON p.c >= cs.s AND p.c < cs.s + 16""")
def cells_on_tiles(spark, sf_dir):
    full = zero_pad(circular_pad(grid_cells(spark, sf_dir), 48, 6).withColumn("f", F.lit(0)), ["f"], ["v"], 24, 60, 32, 64)
    return tiling.on_tiles(full, 32, 64, 16, 6).select("r", "c", "tile_id", rounded("weight", 8).alias("weight"))


def _blend_sql(value: str) -> str:
    return f"""WITH {PADDED}, {STARTS}, tiled AS (
  SELECT p.r, p.c, {value} AS p, ({_w('rs', 'p.r - rs.s')}) * ({_w('cs', 'p.c - cs.s')}) AS w
  FROM padded p JOIN rs ON p.r >= rs.s AND p.r < rs.s + 16 JOIN cs ON p.c >= cs.s AND p.c < cs.s + 16
)
SELECT r, CAST(c - 6 AS INTEGER) AS c, {r('sum(p * w) / sum(w)', 4)} AS p FROM tiled WHERE r < 24 AND c BETWEEN 6 AND 53 GROUP BY r, c"""


def _blended(spark, sf_dir, value):
    full = zero_pad(circular_pad(grid_cells(spark, sf_dir), 48, 6).withColumn("f", F.lit(0)), ["f"], ["v"], 24, 60, 32, 64)
    found = tiling.on_tiles(full, 32, 64, 16, 6).withColumn("p", value)
    blended = tiling.stitched(found.where((F.col("r") < 24) & F.col("c").between(6, 53)), ["r", "c"])
    return blended.select("r", (F.col("c") - 6).alias("c"), rounded("p", 4).alias("p"))


@query(f"WITH {GRID} SELECT r, c, {r('v', 4)} AS p FROM grid")
def stitch_identity(spark, sf_dir):
    return _blended(spark, sf_dir, F.col("v"))


@query(_blend_sql("p.v + 1e3 * rs.s + 1e1 * cs.s"))
def stitch_blend(spark, sf_dir):
    return _blended(spark, sf_dir, F.col("v") + 1000.0 * F.col("row_start") + 10.0 * F.col("col_start"))


TWO = Model("two", "", single("surface_pressure", "10m_v_component_of_wind"), classes=("background", "cold", "warm"), served=("cold", "warm"))


def _pass_sql(table: str) -> str:
    """One tiled pass over (r, c, a, b) with a predictor that depends on the tile."""
    return f"""SELECT r, c - 6 AS c, cls, sum(p * w) / sum(w) AS p FROM (
  SELECT p.r, p.c, cls, t.k * (p.a / 1e3 + p.b) + rs.s / 1e1 + cs.s / 1e2 AS p, ({_w('rs', 'p.r - rs.s')}) * ({_w('cs', 'p.c - cs.s')}) AS w
  FROM (SELECT CAST(x.r AS INTEGER) AS r, CAST(y.c AS INTEGER) AS c, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM range(32) AS x(r) CROSS JOIN range(64) AS y(c)
        LEFT JOIN {table} t ON t.r = x.r AND t.c = (y.c - 6 + 48) % 48 AND y.c < 60) p
  JOIN rs ON p.r >= rs.s AND p.r < rs.s + 16 JOIN cs ON p.c >= cs.s AND p.c < cs.s + 16, (VALUES (1, 'cold'), (2, 'warm')) AS t(k, cls)
) WHERE r < 24 AND c BETWEEN 6 AND 53 GROUP BY r, c, cls"""


@query(f"""WITH {GRID}, {STARTS}, north AS (SELECT r, c, v AS a, v % 3e1 - 15e0 AS b FROM grid), south AS (SELECT 23 - r AS r, c, a, CASE WHEN {LAT} < 0 THEN -b ELSE b END AS b FROM north),
one AS ({_pass_sql('north')}), two AS ({_pass_sql('south')})
SELECT r, CAST(c AS INTEGER) AS c, cls, {r('p', 8)} AS p FROM one WHERE {LAT} >= 0
UNION ALL SELECT CAST(23 - r AS INTEGER), CAST(c AS INTEGER), cls, {r('p', 8)} FROM two WHERE {LAT.replace('r ', '(23 - r) ')} < 0""")
def tiled_inference(spark, sf_dir):
    inputs = grid_cells(spark, sf_dir).select(F.lit(0).alias("step"), "r", "c", F.array(F.col("v"), part("v", 30) - 15.0).alias("channels"))

    def predict(tiled):
        x = F.get("channels", F.lit(0)) / 1000.0 + F.get("channels", F.lit(1))
        found = F.array(*(k * x + F.col("row_start") / 10.0 + F.col("col_start") / 100.0 for k in (1, 2)))
        return tiled.select("step", "r", "c", "weight", found.alias("probabilities"))

    out = tiling.tiled_inference(inputs, ["step"], SMALL, TWO, patch=16, overlap=6, predict=predict)
    return out.select("r", "c", "cls", rounded("p", 8).alias("p"))


@query()
def model_inference(spark, sf_dir):
    """Tiles through a Python predictor, batch by batch; probabilities sum to one with the background."""
    import numpy as np

    inputs = grid_cells(spark, sf_dir).select(F.lit(0).alias("step"), "r", "c", F.array(part("v", 50) / 50.0, part("v", 30) / 30.0).alias("channels"))
    model = tiling.LinearSoftmax(np.array([[0.0, 1.0, -1.0], [0.5, 0.0, 1.0]]), np.zeros(3), 2.0)
    return tiling.tiled_inference(inputs, ["step"], SMALL, TWO, model, patch=16, overlap=6).select("r", "c", "cls", rounded("p", 5).alias("p"))


def _halved(k: int) -> str:
    """SQL of a pyramid level from the one before; the four cells are added in reading order."""
    cells = ", ".join(f"max(p) FILTER (WHERE r % 2 = {a} AND c % 2 = {b}) AS p{a}{b}" for a in (0, 1) for b in (0, 1))
    total = " + ".join(f"coalesce(p{a}{b}, 0e0)" for a in (0, 1) for b in (0, 1))
    return f"l{k} AS (SELECT cls, r, c, ({total}) / n AS p FROM (SELECT cls, r // 2 AS r, c // 2 AS c, count(p) AS n, {cells} FROM l{k - 1} GROUP BY 1, 2, 3))"


@query(f"""WITH {PROBABILITIES}, l0 AS (SELECT cls, r, c, p FROM prob), {', '.join(_halved(k) for k in range(1, 6))}
SELECT level, cls, CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c, {r('p', 9)} AS p FROM ({' UNION ALL '.join(f'SELECT {k} AS level, * FROM l{k}' for k in range(6))})""")
def pyramid_mean(spark, sf_dir):
    level_0 = pyramid.level0(probabilities(spark, sf_dir), get_model("theta-e_uv_q")).drop("p").join(probabilities(spark, sf_dir), ["r", "c", "cls"])
    return pyramid.mean_pyramid(level_0, ["cls"]).select("level", "cls", "r", "c", rounded("p", 9).alias("p"))


GAPPY = "CASE WHEN k = 3 AND r % 7 = 0 THEN NULL ELSE p * 3 - 1e-1 END"


def _gappy(spark, sf_dir):
    gap = F.when((F.col("cls") == "occluded") & (F.col("r") % 7 == 0), float("nan")).otherwise(F.col("p") * 3 - 0.1)
    return probabilities(spark, sf_dir).withColumn("p", gap)


@query(f"WITH {PROBABILITIES} SELECT r, c, cls, CAST(CASE WHEN {GAPPY} IS NULL THEN 255 ELSE round_even(least(greatest({GAPPY}, 0e0), 1e0) * 254e0, 0) END AS SMALLINT) AS q FROM prob")
def pack_u8(spark, sf_dir):
    return _gappy(spark, sf_dir).select("r", "c", "cls", pyramid.packed(F.col("p")).alias("q"))


@query(f"WITH {PROBABILITIES} SELECT r, c, cls, CASE WHEN {GAPPY} IS NULL THEN NULL ELSE {r(f'round_even(least(greatest({GAPPY}, 0e0), 1e0) * 254e0, 0) / 254e0', 8)} END AS p FROM prob")
def unpack_u8(spark, sf_dir):
    return _gappy(spark, sf_dir).select("r", "c", "cls", rounded(pyramid.unpacked(pyramid.packed(F.col("p"))), 8).alias("p"))


@query(f"WITH {GRID} SELECT CAST(r // 128 AS INTEGER) AS chunk_r, CAST(c * 30 // 128 AS INTEGER) AS chunk_c, count(*) AS n FROM grid GROUP BY 1, 2")
def chunk_layout(spark, sf_dir):
    wide = grid_cells(spark, sf_dir).withColumn("c", F.col("c") * 30)
    return pyramid.chunked(wide).groupBy("chunk_r", "chunk_c").agg(F.count("*").alias("n"))


WEIGHTS = ", ".join(f"({k - 8}, {w!r}::DOUBLE)" for k, w in enumerate(neighbourhood.gaussian_weights(2.0)))
HPA = "(98e1 + v % 6e1)"


def _hpa(spark, sf_dir):
    return grid_cells(spark, sf_dir).select(F.lit(0).alias("f"), "r", "c", (980.0 + part("v", 60)).alias("v"))


SMOOTH = f"""{GRID}, w(k, w) AS (VALUES {WEIGHTS}), field AS (SELECT r, c, {HPA} AS v FROM grid),
down AS (SELECT a.r, a.c, sum(w.w * b.v) AS v FROM field a, w JOIN field b ON b.c = a.c AND b.r = least(greatest(a.r + w.k, 0), 23) GROUP BY a.r, a.c),
soft AS (SELECT a.r, a.c, sum(w.w * b.v) AS v FROM down a, w JOIN down b ON b.r = a.r AND b.c = (a.c + w.k + 48) % 48 GROUP BY a.r, a.c)"""


@query(f"WITH {SMOOTH} SELECT r, c, {r('v')} AS v FROM soft")
def gaussian_smooth(spark, sf_dir):
    return neighbourhood.smoothed(_hpa(spark, sf_dir), ["f"], "v", SMALL).select("r", "c", rounded("v").alias("v"))


def _near(rows: int, cols: int) -> str:
    return f"b.r BETWEEN a.r - {rows} AND a.r + {rows} AND least((b.c - a.c + 48) % 48, (a.c - b.c + 48) % 48) <= {cols}"


@query(f"WITH {GRID}, field AS (SELECT r, c, {HPA} AS v FROM grid) SELECT a.r, a.c, {r('min(b.v)')} AS low, {r('max(b.v)')} AS high FROM field a JOIN field b ON {_near(1, 1)} GROUP BY a.r, a.c")
def local_minmax(spark, sf_dir):
    return neighbourhood.extremes(_hpa(spark, sf_dir), ["f"], "v", SMALL, 1, 1).select("r", "c", rounded("low").alias("low"), rounded("high").alias("high"))


@query(f"WITH {GRID}, field AS (SELECT r, c, {HPA} AS v FROM grid) SELECT a.r, a.c, {r('max(b.v) - min(a.v)')} AS rise, {r('min(a.v) - min(b.v)')} AS fall FROM field a JOIN field b ON {_near(4, 5)} GROUP BY a.r, a.c")
def relief(spark, sf_dir):
    far = neighbourhood.extremes(_hpa(spark, sf_dir), ["f"], "v", SMALL, 4, 5)
    return far.select("r", "c", rounded(F.col("high") - F.col("v")).alias("rise"), rounded(F.col("v") - F.col("low")).alias("fall"))


@query(f"""WITH {GRID}, field AS (SELECT r, c, {HPA} AS v FROM grid),
near AS (SELECT a.r, a.c, min(a.v) AS v, min(b.v) AS low, max(b.v) AS high FROM field a JOIN field b ON {_near(1, 1)} GROUP BY a.r, a.c),
far AS (SELECT a.r, a.c, min(b.v) AS least, max(b.v) AS most FROM field a JOIN field b ON {_near(4, 5)} GROUP BY a.r, a.c),
both_ AS (SELECT * FROM near JOIN far USING (r, c) WHERE high - low > 1e-3 AND abs({LAT}) <= 85)
SELECT 'L' AS kind, r, c, {r('v')} AS v FROM both_ WHERE v = low AND most - v >= 4 UNION ALL SELECT 'H', r, c, {r('v')} FROM both_ WHERE v = high AND v - least >= 4""")
def centre_candidates(spark, sf_dir):
    return neighbourhood.candidates(_hpa(spark, sf_dir), ["f"], "v", SMALL).select("kind", "r", "c", rounded("v").alias("v"))


POINT_LON, POINT_LAT = "(c_custkey * 137 % 7200 / 1e1 - 18e1)", "(c_custkey * 53 % 2000 / 1e1 - 1e2)"


def _bilinear_sql(y: str) -> str:
    return f"""WITH {GRID}, pts AS (SELECT c_custkey, ((({POINT_LON}) % 36e1 + 36e1) % 36e1) / 75e-1 AS x, {y} AS y FROM customer),
cut AS (SELECT c_custkey, CAST(least(floor(y), 22) AS INTEGER) AS r0, CAST(floor(x) AS INTEGER) AS c0, y - least(floor(y), 22) AS fr, x - floor(x) AS fc FROM pts WHERE y IS NOT NULL),
met AS (SELECT c_custkey, sum((CASE WHEN dr = 0 THEN 1 - fr ELSE fr END) * (CASE WHEN dc = 0 THEN 1 - fc ELSE fc END) * g.v) AS s
  FROM cut, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(dr, dc) JOIN grid g ON g.r = r0 + dr AND g.c = (c0 + dc) % 48 GROUP BY c_custkey)
SELECT c_custkey, {r('s', 4)} AS v FROM pts LEFT JOIN met USING (c_custkey)"""


def _sampled(spark, sf_dir, clamp):
    k = F.col("c_custkey")
    points = read(spark, sf_dir, "customer").select(F.lit(0).alias("f"), k.alias("point"), (k * 137 % 7200 / 10.0 - 180.0).alias("lon"), (k * 53 % 2000 / 10.0 - 100.0).alias("lat"))
    field = grid_cells(spark, sf_dir).withColumn("f", F.lit(0))
    return neighbourhood.sampled(points, field, ["f"], SMALL, {"v": "sample"}, clamp).select(F.col("point").alias("c_custkey"), rounded("sample", 4).alias("v"))


@query(_bilinear_sql(f"CASE WHEN (9e1 - {POINT_LAT}) / (18e1 / 23) BETWEEN 0 AND 23 THEN (9e1 - {POINT_LAT}) / (18e1 / 23) END"))
def bilinear(spark, sf_dir):
    return _sampled(spark, sf_dir, False)


@query(_bilinear_sql(f"least(greatest((9e1 - {POINT_LAT}) / (18e1 / 23), 0e0), 23e0)"))
def bilinear_clamped(spark, sf_dir):
    return _sampled(spark, sf_dir, True)


@query(f"""WITH {GRID}, field AS (SELECT r, c, {HPA} AS v FROM grid), cells AS (
  SELECT a.r, a.c, a.v AS ul, b.v AS ur, d.v AS ll, e.v AS lr FROM field a JOIN field b ON b.r = a.r AND b.c = a.c + 1 JOIN field d ON d.r = a.r + 1 AND d.c = a.c JOIN field e ON e.r = a.r + 1 AND e.c = a.c + 1),
levels AS (SELECT CAST(k * 4 AS DOUBLE) AS level FROM range(240, 270) AS g(k) WHERE k * 4 > (SELECT min(v) FROM field) AND k * 4 < (SELECT max(v) FROM field)),
cases AS (SELECT level, (ul > level)::INT + 2 * (ur > level)::INT + 4 * (ll > level)::INT + 8 * (lr > level)::INT AS k FROM cells, levels)
SELECT level, CAST(sum(CASE WHEN k IN (6, 9) THEN 2 ELSE 1 END) AS BIGINT) AS segments FROM cases WHERE k NOT IN (0, 15) GROUP BY level""")
def isobar_segments(spark, sf_dir):
    found = pressure.crossings(_hpa(spark, sf_dir), ["f"], "v", SMALL)
    return found.groupBy(F.col("level").cast("double").alias("level")).agg(F.count("*").alias("segments"))


@query(f"WITH {SMOOTH} SELECT CAST(k * 4 AS INTEGER) AS hpa, k * 4 % 20 = 0 AS major FROM range(200, 300) AS g(k) WHERE k * 4 > (SELECT min(v) FROM soft) AND k * 4 < (SELECT max(v) FROM soft)")
def isobar_levels(spark, sf_dir):
    soft = neighbourhood.smoothed(_hpa(spark, sf_dir), ["f"], "v", SMALL)
    span = soft.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    hpa = span.select("low", "high", F.explode(F.sequence(F.ceil(F.col("low") / 4), F.floor(F.col("high") / 4))).alias("k")).withColumn("hpa", (F.col("k") * 4).cast("int"))
    return hpa.where("hpa > low AND hpa < high").select("hpa", (F.col("hpa") % 20 == 0).alias("major"))


@query()
def isobars(spark, sf_dir):
    found = pressure.isobars(_hpa(spark, sf_dir), ["f"], "v", SMALL, sigma=1.0, stride=1)
    return found.select("hpa", "major", F.size("coordinates").alias("points"), F.to_json("coordinates").alias("coordinates"))


@query()
def centres(spark, sf_dir):
    surface = grid_cells(spark, sf_dir).select(F.lit(0).alias("f"), "r", "c", (800.0 + part("v", 210)).alias("surface"))
    return pressure.centres(_hpa(spark, sf_dir), ["f"], "v", SMALL, surface, sigma=1.0).select("kind", "rank", "lon", "lat", "hpa")


@query()
def pressure_layer(spark, sf_dir):
    field = _hpa(spark, sf_dir)
    features = pressure.pressure_layer(pressure.isobars(field, ["f"], "v", SMALL, sigma=1.0, stride=1), pressure.centres(field, ["f"], "v", SMALL, sigma=1.0), ["f"])
    return pressure.layer_text(features, ["f"], F.lit("2024-01-01T00:00:00"))


@query(f"""WITH {PROBABILITIES}, l0 AS (SELECT cls, CASE WHEN k = 3 AND r % 7 = 0 THEN NULL ELSE p * 3 - 1e-1 END AS p FROM prob)
SELECT cls, CAST(2 AS BIGINT) AS levels, count(*) AS cells, count(*) - count(p) AS missing, {r('min(p)')} AS least, {r('max(p)')} AS most, count(*) = count(p) AND min(p) >= 0 AND max(p) <= 1 AS sound FROM l0 GROUP BY cls""")
def store_checks(spark, sf_dir):
    found = pyramid.store_checks(pyramid.mean_pyramid(_gappy(spark, sf_dir), ["cls"], 2))
    return found.select("cls", "levels", "cells", "missing", rounded("least").alias("least"), rounded("most").alias("most"), "sound")


@query(f"""SELECT event_type, count(*) AS n, min(value) AS least, max(value) AS most, {r('CAST(sum(CAST(round_even(value * 1e2, 0) AS BIGINT)) AS DOUBLE) / (count(*) * 1e2)')} AS mean,
count(*) FILTER (value IS NULL OR isnan(value)) AS missing, {r('CAST(count(*) FILTER (value > 5e1 AND value < 4e2) AS DOUBLE) / count(*)')} AS plausible FROM events GROUP BY event_type""")
def field_stats(spark, sf_dir):
    v = F.col("value")
    return read(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), rounded(F.sum(F.rint(v * 100).cast("long")) / (F.count("*") * 100.0)).alias("mean"),
        F.count_if(v.isNull() | F.isnan(v)).alias("missing"), rounded(F.count_if((v > 50) & (v < 400)) / F.count("*")).alias("plausible"),
    )


@query(f"""WITH {PROBABILITIES}, top AS (SELECT r, c, arg_max(cls, p) AS winner, sum(p) AS total FROM (SELECT * FROM prob ORDER BY k) GROUP BY r, c)
SELECT cls, {r('max(p)')} AS most, {r('CAST(count(*) FILTER (p > 2e-1) AS DOUBLE) / count(*)')} AS above, (SELECT count(*) FROM top WHERE winner = cls) AS wins FROM prob GROUP BY cls""")
def class_diagnostics(spark, sf_dir):
    every = probabilities(spark, sf_dir)
    names_ = ["cold", "warm", "stationary", "occluded", "dryline"]
    wide = every.groupBy("r", "c").pivot("cls", names_).agg(F.first("p")).select(F.array(*names_).alias("p"))
    winner = F.get(F.array(*(F.lit(n) for n in names_)), F.array_position("p", F.array_max("p")).cast("int") - 1)
    wins = wide.groupBy(winner.alias("cls")).agg(F.count("*").alias("wins"))
    stats = every.groupBy("cls").agg(rounded(F.max("p")).alias("most"), rounded(F.count_if(F.col("p") > 0.2) / F.count("*")).alias("above"))
    return stats.join(wins, "cls", "left").select("cls", "most", "above", F.coalesce("wins", F.lit(0)).cast("long").alias("wins"))


@query(f"""WITH flat AS (SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT i, {r('min(x)')} AS least, {r('max(x)')} AS most, {r('min(x) * 25e-2 + 5e-1')} AS scaled_least, {r('max(x) * 25e-2 + 5e-1')} AS scaled_most, count(*) FILTER (isnan(x)) AS missing, bool_and(x = 0) AS all_zero FROM flat GROUP BY i""")
def channel_stats(spark, sf_dir):
    flat = read(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    least, most = F.min("x"), F.max("x")
    return flat.groupBy("i").agg(
        rounded(least).alias("least"), rounded(most).alias("most"), rounded(least * 0.25 + 0.5).alias("scaled_least"), rounded(most * 0.25 + 0.5).alias("scaled_most"),
        F.count_if(F.isnan("x")).alias("missing"), F.bool_and(F.col("x") == 0).alias("all_zero"),
    )
