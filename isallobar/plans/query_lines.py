"""Queries over lines, crests, fronts and their tracking."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from isallobar.functions import geo, physics
from isallobar.operators import fronts, kernels, lines, tiling
from isallobar.plans.registry import GRID, LAT, LINES, LON, PROBABILITIES, SMALL, grid_cells, haversine_sql, line_points, part, probabilities, query, r, read, rounded

STEP = haversine_sql("lag(lon) OVER w", "lag(lat) OVER w", "lon", "lat")
STEPS = f"{LINES}, steps AS (SELECT *, coalesce({STEP}, 0) AS step_km FROM lines WINDOW w AS (PARTITION BY line ORDER BY i)), way AS (SELECT *, sum(step_km) OVER (PARTITION BY line ORDER BY i) AS along_km FROM steps)"


@query(f"WITH {STEPS} SELECT line, {r('sum(step_km)', 3)} AS length_km FROM way GROUP BY line")
def line_length(spark, sf_dir):
    return lines.lengths(line_points(spark, sf_dir), ["line"]).select("line", rounded("length_km", 3).alias("length_km"))


@query(f"WITH {STEPS} SELECT line, i, {r('along_km', 3)} AS along_km FROM way")
def cumulative_km(spark, sf_dir):
    return lines.with_steps(line_points(spark, sf_dir), ["line"]).select("line", "i", rounded("along_km", 3).alias("along_km"))


@query(f"""WITH {LINES}, steps AS (SELECT line, sqrt(pow((lead(lon) OVER w - lon) * cos(radians(lat)), 2) + pow(lead(lat) OVER w - lat, 2)) AS d FROM lines WINDOW w AS (PARTITION BY line ORDER BY i))
SELECT line, {r('sum(d)', 5)} AS arc_deg FROM steps GROUP BY line""")
def arc_length(spark, sf_dir):
    return lines.arc_degrees(line_points(spark, sf_dir), ["line"]).select("line", rounded("arc_deg", 5).alias("arc_deg"))


@query(f"""WITH {LINES}, cut AS (SELECT line, i, (lon + 2e2) % 36e1 AS lon FROM lines), turned AS (SELECT *, lon - lag(lon) OVER (PARTITION BY line ORDER BY i) AS d FROM cut)
SELECT line, i, {r('lon + sum(CASE WHEN d < -18e1 THEN 36e1 WHEN d > 18e1 THEN -36e1 ELSE 0e0 END) OVER (PARTITION BY line ORDER BY i)', 5)} AS lon FROM turned""")
def unwrap_lon(spark, sf_dir):
    cut = line_points(spark, sf_dir).withColumn("lon", F.pmod(F.col("lon") + 200.0, F.lit(360.0)))
    return lines.unwrapped(cut, ["line"]).select("line", "i", rounded("lon", 5).alias("lon"))


@query(f"""WITH {LINES}, marked AS (SELECT line, i, label, CASE WHEN lag(label) OVER w IS NOT DISTINCT FROM label AND i > 0 THEN 0 ELSE 1 END AS new FROM lines WINDOW w AS (PARTITION BY line ORDER BY i)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY line ORDER BY i) AS run FROM marked)
SELECT line, CAST(run AS INTEGER) AS run, min(label) AS label, min(i) AS first, max(i) AS last FROM runs GROUP BY line, run""")
def sections_rle(spark, sf_dir):
    found = lines.runs(line_points(spark, sf_dir), ["line"], "label")
    # A stretch ends where the next begins; its own last point is the one before.
    final = F.max("run").over(Window.partitionBy("line"))
    return found.withColumn("last", F.when(F.col("run") < final, F.col("last") - 1).otherwise(F.col("last")))


GRADIENT = "CASE WHEN lag({0}) OVER w IS NULL THEN lead({0}) OVER w - {0} WHEN lead({0}) OVER w IS NULL THEN {0} - lag({0}) OVER w ELSE (lead({0}) OVER w - lag({0}) OVER w) / 2 END"


@query(f"""WITH {LINES}, d AS (SELECT line, i, ({GRADIENT.format('lon')}) * cos(radians(lat)) AS e, {GRADIENT.format('lat')} AS n FROM lines WINDOW w AS (PARTITION BY line ORDER BY i))
SELECT line, i, {r('-n / sqrt(e * e + n * n)')} AS east, {r('e / sqrt(e * e + n * n)')} AS north FROM d""")
def left_normals(spark, sf_dir):
    return lines.with_normals(line_points(spark, sf_dir), ["line"]).select("line", "i", rounded("east").alias("east"), rounded("north").alias("north"))


@query(f"""WITH {STEPS}, flat AS (
  SELECT *, coalesce(((lon - lag(lon) OVER w + 18e1) % 36e1 + 36e1) % 36e1 - 18e1, 0) * coalesce(cos(radians(lat + lag(lat) OVER w) / 2), 0) * radians(6371e0) AS e, coalesce(lat - lag(lat) OVER w, 0) * radians(6371e0) AS n
  FROM way WINDOW w AS (PARTITION BY line ORDER BY i)),
spots AS (SELECT line, i, along_km, sum(e) OVER v AS x, sum(n) OVER v AS y FROM flat WINDOW v AS (PARTITION BY line ORDER BY i)),
legs AS (
  SELECT s.line, s.i, s.x, s.y,
    coalesce((SELECT max(b.i) FROM spots b WHERE b.line = s.line AND s.along_km - b.along_km >= 2e3), 0) AS bi,
    coalesce((SELECT min(a.i) FROM spots a WHERE a.line = s.line AND a.along_km - s.along_km >= 2e3), 47) AS ai FROM spots s),
ways AS (SELECT l.line, l.i, l.x - b.x AS cx, l.y - b.y AS cy, a.x - l.x AS gx, a.y - l.y AS gy FROM legs l JOIN spots b ON b.line = l.line AND b.i = l.bi JOIN spots a ON a.line = l.line AND a.i = l.ai)
SELECT line, i, CASE WHEN sqrt(cx * cx + cy * cy) * sqrt(gx * gx + gy * gy) = 0 THEN 0e0
  ELSE {r('degrees(acos(least(1e0, greatest(-1e0, (cx * gx + cy * gy) / (sqrt(cx * cx + cy * cy) * sqrt(gx * gx + gy * gy))))))', 3)} END AS turn_deg FROM ways""")
def turn_angles(spark, sf_dir):
    return lines.turn_angles(line_points(spark, sf_dir), ["line"], 2000.0).select("line", "i", rounded("turn_deg", 3).alias("turn_deg"))


@query(f"""WITH {STEPS}, total AS (SELECT line, max(along_km) AS total, greatest(2, CAST(round_even(max(along_km) / 9e2, 0) AS INTEGER) + 1) AS n FROM way GROUP BY line),
goal AS (SELECT line, CAST(k AS INTEGER) AS i, k * total / (n - 1) AS km FROM total, range(200) AS g(k) WHERE k < n),
seg AS (SELECT line, lon, lat, along_km, lead(lon) OVER w AS lon1, lead(lat) OVER w AS lat1, lead(along_km) OVER w AS far FROM way WINDOW w AS (PARTITION BY line ORDER BY i)),
met AS (SELECT g.line, g.i, s.lon + (g.km - s.along_km) / (s.far - s.along_km) * (s.lon1 - s.lon) AS lon, s.lat + (g.km - s.along_km) / (s.far - s.along_km) * (s.lat1 - s.lat) AS lat,
  row_number() OVER (PARTITION BY g.line, g.i ORDER BY s.along_km DESC) AS k FROM goal g JOIN seg s ON s.line = g.line AND s.far > s.along_km AND g.km >= s.along_km - 1e-6 AND g.km <= s.far + 1e-6)
SELECT line, i, {r('lon', 3)} AS lon, {r('lat', 3)} AS lat FROM met WHERE k = 1""")
def even_resample(spark, sf_dir):
    return lines.resampled(line_points(spark, sf_dir), ["line"], 900.0).select("line", "i", rounded("lon", 3).alias("lon"), rounded("lat", 3).alias("lat"))


@query(f"""WITH {STEPS}, ends AS (SELECT line, max(along_km) AS total, arg_max(lon, i) AS lon1, arg_max(lat, i) AS lat1, arg_min(lon, i) AS lon0, arg_min(lat, i) AS lat0 FROM way GROUP BY line),
m AS (SELECT w.*, e.*, line % 2 = 0 AS at_start FROM way w JOIN ends e USING (line)),
n AS (SELECT *, CASE WHEN at_start THEN along_km ELSE total - along_km END AS away, least(5e3, total / 2) AS taper, CASE WHEN at_start THEN lon0 ELSE lon1 END AS lon_end, CASE WHEN at_start THEN lat0 ELSE lat1 END AS lat_end FROM m),
k AS (SELECT *, CASE WHEN away < taper THEN 5e-1 * (1 + cos(pi() * away / taper)) ELSE 0e0 END AS weight, 37e1 + 36e1 * round_even((lon_end - 37e1) / 36e1, 0) AS goal FROM n)
SELECT line, i, {r('lon + weight * (goal - lon_end)', 4)} AS lon, {r('lat + weight * (1e1 - lat_end)', 4)} AS lat FROM k""")
def pin_ends(spark, sf_dir):
    points = line_points(spark, sf_dir)
    targets = points.select("line").distinct().select("line", (F.col("line") % 2 == 0).alias("at_start"), F.lit(370.0).alias("target_lon"), F.lit(10.0).alias("target_lat"))
    return lines.pinned(points, targets, ["line"], 5000.0).select("line", "i", rounded("lon", 4).alias("lon"), rounded("lat", 4).alias("lat"))


QUERIES_SQL = "asked AS (SELECT CAST(s_suppkey AS INTEGER) AS query, CAST(s_suppkey % 24 AS INTEGER) AS line, s_suppkey * 31 % 360 + 5e-1 AS lon, s_suppkey * 17 % 150 - 75 + 25e-2 AS lat FROM supplier)"


def _asked(spark, sf_dir):
    k = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(k.cast("int").alias("query"), (k % 24).cast("int").alias("line"), (k * 31 % 360 + 0.5).alias("lon"), (k * 17 % 150 - 75 + 0.25).alias("lat"))


FLAT = "radians({0} + 36e1 * round_even((q.lon - {0}) / 36e1, 0) - q.lon) * 6371e0 * cos(radians(q.lat))"


@query(f"""WITH {LINES}, {QUERIES_SQL}, seg AS (SELECT line, i, lon AS lon0, lat AS lat0, lead(lon) OVER w AS lon1, lead(lat) OVER w AS lat1 FROM lines WINDOW w AS (PARTITION BY line ORDER BY i)),
f AS (SELECT q.query, q.lon, q.lat, s.i, {FLAT.format('s.lon0')} AS e0, radians(s.lat0 - q.lat) * 6371e0 AS n0, {FLAT.format('s.lon1')} AS e1, radians(s.lat1 - q.lat) * 6371e0 AS n1 FROM asked q JOIN seg s USING (line) WHERE s.lon1 IS NOT NULL),
t AS (SELECT *, least(1e0, greatest(0e0, -(e0 * (e1 - e0) + n0 * (n1 - n0)) / CASE WHEN pow(e1 - e0, 2) + pow(n1 - n0, 2) > 0 THEN pow(e1 - e0, 2) + pow(n1 - n0, 2) ELSE 1 END)) AS s FROM f),
d AS (SELECT *, e0 + s * (e1 - e0) AS e, n0 + s * (n1 - n0) AS n FROM t), b AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY e * e + n * n, i) AS k FROM d)
SELECT query, {r('sqrt(e * e + n * n)', 3)} AS km, {r('lat + degrees(n / 6371e0)', 4)} AS lat FROM b WHERE k = 1""")
def project_points(spark, sf_dir):
    found = lines.projected(_asked(spark, sf_dir), line_points(spark, sf_dir), ["line"])
    return found.select("query", rounded("km", 3).alias("km"), rounded("lat", 4).alias("lat"))


@query(f"WITH {LINES}, {QUERIES_SQL} SELECT q.query, arg_min(p.i, {haversine_sql('q.lon', 'q.lat', 'p.lon', 'p.lat')}) AS point, {r('min(' + haversine_sql('q.lon', 'q.lat', 'p.lon', 'p.lat') + ')', 3)} AS km FROM asked q JOIN lines p USING (line) GROUP BY q.query")
def nearest_prev(spark, sf_dir):
    points = line_points(spark, sf_dir).select("line", F.col("i").alias("point"), "lon", "lat")
    return lines.nearest(_asked(spark, sf_dir), points, ["line"]).select("query", "point", rounded("km", 3).alias("km"))


@query(f"WITH {LINES}, {QUERIES_SQL} SELECT q.query, p.line * 48 + p.i AS point, {r(haversine_sql('q.lon', 'q.lat', 'p.lon', 'p.lat'), 3)} AS km FROM asked q, lines p WHERE {haversine_sql('q.lon', 'q.lat', 'p.lon', 'p.lat')} <= 5e2")
def within_km(spark, sf_dir):
    points = line_points(spark, sf_dir).select(F.lit(0).alias("f"), (F.col("line") * 48 + F.col("i")).alias("point"), "lon", "lat")
    asked = _asked(spark, sf_dir).select(F.lit(0).alias("f"), "query", "lon", "lat")
    return lines.within(asked, points, ["f"], 500.0).select("query", "point", rounded("km", 3).alias("km"))


@query(f"""WITH {LINES}, {QUERIES_SQL}, near AS (SELECT q.query, min({haversine_sql('q.lon', 'q.lat', 'p.lon', 'p.lat')}) AS km FROM asked q JOIN lines p USING (line) GROUP BY q.query)
SELECT query, km < 1e3 AS masked FROM near""")
def clearance(spark, sf_dir):
    points = line_points(spark, sf_dir).select("line", F.col("i").alias("point"), "lon", "lat")
    return lines.nearest(_asked(spark, sf_dir), points, ["line"]).select("query", (F.col("km") < 1000.0).alias("masked"))


@query(f"""WITH {LINES} SELECT line, {r('coalesce(CASE WHEN bool_and(label = 0 OR line % 5 = 0) THEN avg(p) ELSE avg(p) FILTER (NOT (label = 0 OR line % 5 = 0)) END, 0)')} AS mean FROM lines GROUP BY line""")
def masked_mean(spark, sf_dir):
    masked = (F.col("label") == 0) | (F.col("line") % 5 == 0)
    return line_points(spark, sf_dir).groupBy("line").agg(rounded(lines.masked_mean(F.col("p"), masked)).alias("mean"))


BAND = f"{PROBABILITIES}, band AS (SELECT r, c, sum(p) AS p FROM prob WHERE k < 4 GROUP BY r, c)"


def _on_grid(cells, work, columns):
    """A kernel over the small grid's fields, one array for each class; it returns rows of ``columns``."""

    def run(part):
        fields = {}
        for cls, own in part.groupby("cls"):
            fields[cls] = np.zeros((SMALL.rows, SMALL.cols))
            fields[cls][own["r"], own["c"]] = own["p"]
        return work(fields)

    return cells.select(F.lit(0).alias("f"), "cls", "r", "c", physics.nan_to_zero(F.col("p")).alias("p")).groupBy("f").applyInPandas(run, columns)


FOUR = ["cold", "warm", "stationary", "occluded"]


def _crest(spark, sf_dir):
    """Cells where four classes together reach 0.9, by the mask that tracing uses."""

    def work(fields):
        r, c = np.nonzero(fronts.crest_mask(fields, FOUR, fronts.Settings(threshold=0.9)))
        return pd.DataFrame({"r": r.astype(np.int32), "c": c.astype(np.int32), "p": sum(fields[t] for t in FOUR)[r, c]})

    return _on_grid(probabilities(spark, sf_dir), work, "r int, c int, p double")


@query(f"WITH {BAND} SELECT r, c, {r('p')} AS p FROM band WHERE p >= 9e-1")
def crest_threshold(spark, sf_dir):
    return _crest(spark, sf_dir).select("r", "c", rounded("p").alias("p"))


@query(f"""WITH {BAND}, crest AS (SELECT r, c FROM band WHERE p >= 9e-1), edges AS (
  SELECT a.r, a.c, b.r AS r2, b.c AS c2 FROM crest a, (VALUES (0, 1), (1, -1), (1, 0), (1, 1)) AS o(dr, dc) JOIN crest b ON b.r = a.r + dr AND b.c = (a.c + dc + 48) % 48)
SELECT r, c, r2, c2, {r(haversine_sql(LON, LAT, LON.replace('c ', 'c2 '), LAT.replace('r ', 'r2 ')), 3)} AS km FROM edges""")
def crest_graph(spark, sf_dir):
    crest = _crest(spark, sf_dir).withColumn("f", F.lit(0))
    return lines.neighbours(crest, ["f"], SMALL).select("r", "c", "r2", "c2", rounded("km", 3).alias("km"))


@query(f"""WITH {PROBABILITIES}, best AS (SELECT r, c, k, row_number() OVER (PARTITION BY r, c ORDER BY p DESC, k) AS n FROM prob) SELECT r, c, CAST(k AS INTEGER) AS winner FROM best WHERE n = 1""")
def class_argmax(spark, sf_dir):
    def work(fields):
        best = fronts.dominant(np.stack([fields[t] for t in (*FOUR, "dryline")]))
        r, c = np.indices(best.shape)
        return pd.DataFrame({"r": r.ravel().astype(np.int32), "c": c.ravel().astype(np.int32), "winner": best.ravel().astype(np.int32)})

    return _on_grid(probabilities(spark, sf_dir), work, "r int, c int, winner int")


@query(f"WITH {GRID} SELECT r, c, {r('exp(v % 5e0 / 2e0) / (exp(v % 5e0 / 2e0) + exp(v % 3e0 / 2e0) + 1e0)')} AS p FROM grid")
def softmax_temperature(spark, sf_dir):
    """The predictor's softmax, batch by batch."""
    model = tiling.LinearSoftmax(np.eye(3), np.zeros(3), 2.0)

    def work(batches):
        for batch in batches:
            found = model.predict_batch(np.stack([batch["a"], batch["b"], np.zeros(len(batch))], axis=-1))
            yield pd.DataFrame({"r": batch["r"], "c": batch["c"], "p": found[:, 0]})

    return grid_cells(spark, sf_dir).select("r", "c", part("v", 5).alias("a"), part("v", 3).alias("b")).mapInPandas(work, "r int, c int, p double").select("r", "c", rounded("p").alias("p"))


PATHS = f"{LINES}, cells AS (SELECT line % 8 AS crest, line AS path, i AS pos, CAST(floor(v % 4e1) AS INTEGER) AS cell FROM (SELECT r AS line, c AS i, v FROM grid))"


@query(f"""WITH {PATHS}, first AS (SELECT crest, path, cell, min(pos) AS pos FROM cells GROUP BY crest, path, cell)
SELECT c.crest, c.path AS branch, f.path AS parent, f.pos FROM cells c JOIN first f ON f.crest = c.crest AND f.path = c.path - 8 AND f.cell = c.cell WHERE c.pos = 0""")
def junction_lookup(spark, sf_dir):
    """Each path of a crest is a branch of the one before; where it begins on that one."""

    def work(part):
        paths = [(k - 1, own.sort_values("pos")[["cell"]].to_numpy()) for k, (_, own) in enumerate(part.groupby("path"))]
        names, crest = sorted(part["path"].unique()), part["crest"].iloc[0]
        return pd.DataFrame([(crest, names[branch], names[parent], pos) for parent, pos, branch in kernels.junctions(paths)], columns=["crest", "branch", "parent", "pos"])

    cells = grid_cells(spark, sf_dir).select((F.col("r") % 8).alias("crest"), F.col("r").alias("path"), F.col("c").alias("pos"), F.floor(part("v", 40)).cast("int").alias("cell"))
    return cells.groupBy("crest").applyInPandas(work, "crest int, branch int, parent int, pos int")


@query(f"WITH {STEPS} SELECT line, CAST(count(*) AS BIGINT) AS points FROM way GROUP BY line HAVING sum(step_km) >= 3e4")
def length_prune(spark, sf_dir):
    """Lines as trees without branches: tracing keeps those whose longest path is long enough."""

    def work(p):
        lon, lat = p["lon"].to_numpy(), p["lat"].to_numpy()
        step = kernels.haversine_km(lon[:-1], lat[:-1], lon[1:], lat[1:])
        tree = kernels.spanning_forest(len(lon), [(float(d), k, k + 1) for k, d in enumerate(step)])
        return pd.DataFrame({"points": [len(nodes) for _, nodes in kernels.long_paths(tree, 0, 3e4, 0.0)]})

    return lines.per_line(line_points(spark, sf_dir), ["line"], work, "points bigint")


def tracked_points(spark, sf_dir):
    """Fronts of three steps: all lines of the small grid, moved a little at each step."""
    steps = F.explode(F.array(F.lit(0), F.lit(6), F.lit(12)))
    moved = line_points(spark, sf_dir).withColumn("step", steps).withColumn("lon", F.col("lon") + F.col("step") * 0.2)
    kind = F.when(F.col("line") % 3 == 0, "WF").otherwise("CF")
    return moved.select(F.lit(0).alias("cycle"), "step", F.col("line").alias("front"), F.lit(0).alias("grp"), F.lit(0).alias("line"), (F.col("i") / 10).cast("int").alias("section"), kind.alias("front_type"), "i", "lon", "lat", "p")


def tracked_steps(spark):
    """The good steps: those with fronts, and one without after the first two."""
    return spark.createDataFrame([(0, s) for s in (0, 6, 9, 12)], "cycle int, step int")


TRACKED_SQL = f"""{LINES}, pts AS (SELECT s AS step, line AS front, CAST(i // 10 AS INTEGER) AS section, CASE WHEN line % 3 = 0 THEN 'WF' ELSE 'CF' END AS t, i, lon + s * 2e-1 AS lon, lat
  FROM lines, (VALUES (0), (6), (12)) AS v(s)),
secs AS (SELECT *, {haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} AS d FROM pts WINDOW w AS (PARTITION BY step, front, section ORDER BY i)),
sums AS (SELECT step, front, sum(d) AS km, min(t) AS t FROM secs GROUP BY step, front), thin AS (SELECT * FROM pts WHERE i % 4 = 0),
near AS (SELECT b.step, a.front AS before, b.front AS after, a.i AS ai, b.i AS bi, {haversine_sql('a.lon', 'a.lat', 'b.lon', 'b.lat')} AS km FROM thin a JOIN thin b ON b.step = a.step + 6),
pairs AS (SELECT n.*, x.km AS ka, y.km AS kb, x.t = y.t AS same FROM near n JOIN sums x ON x.step = n.step - 6 AND x.front = n.before JOIN sums y ON y.step = n.step AND y.front = n.after),
close AS (SELECT step, before, after FROM pairs GROUP BY 1, 2, 3 HAVING min(km) <= 5e2),
least_ AS (SELECT step, before, after, CASE WHEN ka <= kb THEN ai ELSE bi END AS s, min(km) AS km, min(ka) AS ka, min(kb) AS kb, bool_and(same) AS same FROM pairs JOIN close USING (step, before, after) GROUP BY 1, 2, 3, 4),
mean AS (SELECT step, before, after, avg(km) AS km, min(least(ka, kb)) / min(greatest(ka, kb)) AS ratio, bool_and(same) AS same FROM least_ GROUP BY 1, 2, 3)"""


@query(f"WITH {TRACKED_SQL} SELECT CAST(step AS INTEGER) AS step, before, after, {r('CASE WHEN km < 5e2 THEN (4 * (1 - km / 5e2) + ratio + CASE WHEN same THEN 1e0 ELSE 0e0 END) / 6e0 ELSE 0e0 END', 5)} AS interest FROM mean")
def match_interest(spark, sf_dir):
    points = tracked_points(spark, sf_dir)
    steps = points.select("cycle", "step").distinct()
    return fronts.match_scores(points, steps, ["cycle"]).select("step", "before", "after", rounded("interest", 5).alias("interest"))


@query()
def track_fronts(spark, sf_dir):
    """Event ids of the batch plan; the good step without fronts ends all events."""
    return fronts.tracked(tracked_points(spark, sf_dir), tracked_steps(spark), ["cycle"]).select("step", "front", "event_id", F.array_join("parents", ",").alias("parents"))


SIGHTINGS = """s AS (SELECT 'event_' || user_id % 50 AS event_id, date_trunc('day', ts) AS time, event_type AS cls, value AS km, CASE WHEN event_type = 'error' THEN 'event_' || (user_id + 1) % 50 END AS parent FROM events)"""


@query(f"""WITH {SIGHTINGS}, kids AS (SELECT parent, array_to_string(list_sort(list(DISTINCT event_id)), ',') AS children FROM s WHERE parent IS NOT NULL GROUP BY parent),
own AS (SELECT event_id, min(time) AS start_time, max(time) AS end_time, coalesce(array_to_string(list_sort(list(DISTINCT parent) FILTER (parent IS NOT NULL)), ','), '') AS parents,
  array_to_string(list_sort(list(DISTINCT cls)), ',') AS classes, max(round(km, 2)) AS max_length_km FROM s GROUP BY event_id)
SELECT event_id, CAST(start_time AS DATE) AS start_time, CAST(end_time AS DATE) AS end_time, parents, coalesce(children, '') AS children, classes, max_length_km FROM own LEFT JOIN kids ON parent = event_id""")
def event_index(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    name = lambda k: F.concat(F.lit("event_"), (k % 50).cast("string"))
    parents = F.when(F.col("event_type") == "error", F.array(name(F.col("user_id") + 1))).otherwise(F.array().cast("array<string>"))
    seen = e.select(name(F.col("user_id")).alias("event_id"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("time"), F.array("event_type").alias("classes"), F.col("value").alias("length_km"), parents.alias("parents"))
    found = lines.event_index(seen)
    return found.select("event_id", F.to_date("start_time").alias("start_time"), F.to_date("end_time").alias("end_time"), *(F.array_join(n, ",").alias(n) for n in ("parents", "children", "classes")), "max_length_km")


def _front_probabilities(spark, sf_dir):
    """Two steps of probabilities with bands that run along some rows of the small grid."""
    cells = grid_cells(spark, sf_dir)
    band = F.when((F.col("r") % 6 == 3) & F.col("c").between(4, 30), 0.5 + part("v", 40) / 100.0).otherwise(part("v", 10) / 100.0)
    kinds = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(n).alias("cls")) for k, n in enumerate(("cold", "warm", "stationary"))))
    steps = F.explode(F.array(F.lit(0), F.lit(6)))
    spread = cells.withColumn("step", steps).select("step", "r", "c", F.lit(0).alias("cycle"), band.alias("p"), "v", F.inline(kinds))
    share = F.when(F.pmod(F.floor(F.col("c") / 9), F.lit(3)) == F.col("k"), 0.8).otherwise(0.1)
    return spread.select("cycle", "step", "r", "c", "cls", (F.col("p") * share).alias("p"))


def _air(spark, sf_dir):
    cells = grid_cells(spark, sf_dir).withColumn("step", F.explode(F.array(F.lit(0), F.lit(6))))
    return cells.select(F.lit(0).alias("cycle"), "step", "r", "c", (320.0 - F.abs(SMALL.lat()) * 0.8).alias("temperature"), (part("v", 20) - 10.0).alias("u"), (part("v", 12) - 6.0).alias("v"))


@query()
def front_lines(spark, sf_dir):
    found = fronts.front_points(_front_probabilities(spark, sf_dir), ["cycle", "step"], SMALL)
    return found.select("step", "front", "line", "section", "front_type", "i", rounded("lon", 3).alias("lon"), rounded("lat", 3).alias("lat"), rounded("p", 4).alias("p"))


@query()
def symbol_side(spark, sf_dir):
    keys = ["cycle", "step"]
    points = fronts.front_points(_front_probabilities(spark, sf_dir), keys, SMALL).persist()
    before = fronts.with_previous(points, points.select(*keys).distinct(), ["cycle"])
    found = fronts.symbol_sides(points, keys, SMALL, air=_air(spark, sf_dir), previous=before)
    return found.select("step", "front", "line", "section", "front_type", rounded("score", 4).alias("score"), "side")


@query()
def front_geojson(spark, sf_dir):
    keys = ["cycle", "step"]
    probs = _front_probabilities(spark, sf_dir)
    points, sides, events = fronts.fronts_over_time(probs, probs.select(*keys).distinct(), ["cycle"], SMALL, air=_air(spark, sf_dir))
    return fronts.front_features(points, sides, events, keys, overall=True).select("step", "front", "place", "feature")


@query(f"""WITH {LINES}, s AS (SELECT line, label, i, p, {STEP} AS d FROM lines WINDOW w AS (PARTITION BY line, label ORDER BY i))
SELECT line, label, {r('avg(p)', 3)} AS mean, {r('max(p)', 3)} AS most, {r('coalesce(sum(d), 0)', 2)} AS km FROM s GROUP BY line, label""")
def type_summary(spark, sf_dir):
    points = line_points(spark, sf_dir)
    km = lines.lengths(points, ["line", "label"])
    stats = points.groupBy("line", "label").agg(rounded(F.avg("p"), 3).alias("mean"), rounded(F.max("p"), 3).alias("most"))
    return stats.join(km, ["line", "label"]).select("line", "label", "mean", "most", rounded("length_km", 2).alias("km"))


@query(f"""WITH {LINES}, a AS (SELECT * FROM lines WHERE line % 2 = 0), b AS (SELECT line - 1 AS line, i, lon, lat FROM lines WHERE line % 2 = 1),
near AS (SELECT a.line, a.i, a.lon, a.lat, b.lon AS blon, b.lat AS blat, {haversine_sql('a.lon', 'a.lat', 'b.lon', 'b.lat')} AS km, row_number() OVER (PARTITION BY a.line, a.i ORDER BY {haversine_sql('a.lon', 'a.lat', 'b.lon', 'b.lat')}, b.i) AS k FROM a JOIN b USING (line))
SELECT line, {r('avg(radians(((lon - blon + 18e1) % 36e1 + 36e1) % 36e1 - 18e1) * 6371e0 * cos(radians(lat)))', 3)} AS east_km, {r('avg(radians(lat - blat) * 6371e0)', 3)} AS north_km FROM near WHERE k = 1 AND km <= 3e3 GROUP BY line""")
def mean_motion(spark, sf_dir):
    points = line_points(spark, sf_dir)
    now = points.where("line % 2 = 0").select("line", F.col("i").alias("query"), "lon", "lat")
    before = points.where("line % 2 = 1").select((F.col("line") - 1).alias("line"), F.col("i").alias("point"), "lon", "lat")
    found = lines.nearest(now, before, ["line"]).where("km <= 3000")
    met = now.join(found, ["line", "query"]).join(before.withColumnsRenamed({"lon": "blon", "lat": "blat"}), ["line", "point"])
    east = F.radians(F.pmod(F.col("lon") - F.col("blon") + 180.0, F.lit(360.0)) - 180.0) * geo.EARTH_RADIUS_KM * F.cos(F.radians("lat"))
    north = F.radians(F.col("lat") - F.col("blat")) * geo.EARTH_RADIUS_KM
    return met.groupBy("line").agg(rounded(F.avg(east), 3).alias("east_km"), rounded(F.avg(north), 3).alias("north_km"))


@query("WITH e AS (SELECT DISTINCT CAST(user_id % 9 AS INTEGER) AS cycle, CAST(event_id % 17 * 6 AS INTEGER) AS step FROM events WHERE event_type <> 'error') SELECT cycle, step, lag(step) OVER (PARTITION BY cycle ORDER BY step) AS previous FROM e")
def previous_good_step(spark, sf_dir):
    good = read(spark, sf_dir, "events").where("event_type <> 'error'").select((F.col("user_id") % 9).cast("int").alias("cycle"), (F.col("event_id") % 17 * 6).cast("int").alias("step")).distinct()
    return good.select("cycle", "step", F.lag("step").over(Window.partitionBy("cycle").orderBy("step")).alias("previous"))
