"""Queries over the catalog, dates and names, display rules, and streams."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from isallobar.functions import names, style
from isallobar.plans import catalog
from isallobar.plans.registry import LISTING, listing, query, r, read, rounded
from isallobar.sources.storage import shared_folder
from isallobar.streaming import cycles


@query("""SELECT hour, CAST(step AS INTEGER) AS step FROM (SELECT * FROM (VALUES (0), (6), (12), (18)) AS h(hour)), range(0, 361, 3) AS s(step)
WHERE step <= 144 OR (hour % 12 = 0 AND step >= 150 AND step % 6 = 0)""")
def published_steps(spark, sf_dir):
    hours = spark.createDataFrame([(h,) for h in names.SYNOPTIC_HOURS], "hour int")
    return hours.select("hour", F.explode(catalog.published(F.col("hour"))).alias("step"))


@query("SELECT hour, CAST(step AS INTEGER) AS step FROM (SELECT * FROM (VALUES (0), (6), (12), (18)) AS h(hour)), range(0, 241, 6) AS s(step) WHERE step <= 144 OR hour % 12 = 0")
def target_steps(spark, sf_dir):
    hours = spark.createDataFrame([(h,) for h in names.SYNOPTIC_HOURS], "hour int")
    return hours.select("hour", F.explode(catalog.targets(F.col("hour"))).alias("step"))


ISO = "'%Y-%m-%dT%H:%M:%S'"


@query(f"WITH {LISTING} SELECT model, store AS name, strftime(cycle, {ISO}) AS cycle, step FROM stores")
def parse_store(spark, sf_dir):
    return _present(spark, sf_dir).select("model", F.col("store").alias("name"), names.iso_time(F.col("cycle")).alias("cycle"), "step")


def _present(spark, sf_dir):
    """Stores of the listing, among whose names are side files, notes, pointers and impossible dates."""
    return catalog.stores(listing(spark, sf_dir).select("model", "name").distinct())


@query(f"WITH {LISTING} SELECT o_orderkey, store, strftime(cycle, {ISO}) AS cycle_time, strftime(cycle + to_hours(step), {ISO}) AS valid_time, replace(store, '.zarr', '.fronts.geojson') AS fronts FROM base JOIN named USING (o_orderkey, model, cycle, step)")
def store_names(spark, sf_dir):
    cycle = F.timestamp_add("HOUR", (F.col("o_orderkey") % 4 * 6).cast("int"), F.date_trunc("day", F.col("o_orderdate").cast("timestamp")))
    base = read(spark, sf_dir, "orders").select("o_orderkey", cycle.alias("cycle"), (F.col("o_orderkey") % 41 * 6).cast("int").alias("step"))
    store = names.store_name(F.date_format("cycle", "yyyy-MM-dd"), F.hour("cycle"), F.col("step"))
    named = base.withColumn("store", store)
    return named.select("o_orderkey", "store", names.iso_time(F.col("cycle")).alias("cycle_time"), names.iso_time(names.valid_time(F.col("cycle"), F.col("step"))).alias("valid_time"), names.side_name(F.col("store"), "fronts").alias("fronts"))


@query(f"WITH {LISTING} SELECT model, strftime(max(cycle), {ISO}) AS cycle FROM stores GROUP BY model")
def newest_cycles(spark, sf_dir):
    return catalog.newest_cycles(_present(spark, sf_dir)).select("model", names.iso_time(F.col("cycle")).alias("cycle"))


@query(f"WITH {LISTING} SELECT model, CAST(count(*) AS BIGINT) AS steps FROM stores GROUP BY model")
def step_counts(spark, sf_dir):
    return catalog.step_counts(_present(spark, sf_dir))


TARGETS = "targets AS (SELECT model, cycle, CAST(step AS INTEGER) AS step FROM (SELECT DISTINCT model, cycle FROM stores), range(0, 241, 6) AS s(step) WHERE step <= 144 OR hour(cycle) % 12 = 0)"


@query(f"WITH {LISTING}, {TARGETS} SELECT model, strftime(cycle, {ISO}) AS cycle, step FROM targets ANTI JOIN stores USING (model, cycle, step)")
def missing_steps(spark, sf_dir):
    return catalog.missing_steps(_present(spark, sf_dir)).select("model", names.iso_time(F.col("cycle")).alias("cycle"), "step")


@query(f"""WITH {LISTING}, {TARGETS}, gaps AS (SELECT model, cycle, count(*) AS n FROM targets ANTI JOIN stores USING (model, cycle, step) GROUP BY model, cycle),
has AS (SELECT model, cycle, count(DISTINCT step) AS n FROM stores GROUP BY model, cycle)
SELECT t.model, strftime(t.cycle, {ISO}) AS cycle, CAST(coalesce(h.n, 0) AS BIGINT) AS present, CAST(coalesce(g.n, 0) AS BIGINT) AS missing, g.n IS NULL AS complete
FROM (SELECT DISTINCT model, cycle FROM targets) t LEFT JOIN has h ON h.model = t.model AND h.cycle = t.cycle LEFT JOIN gaps g ON g.model = t.model AND g.cycle = t.cycle""")
def cycle_completeness(spark, sf_dir):
    found = catalog.completeness(_present(spark, sf_dir))
    return found.select("model", names.iso_time(F.col("cycle")).alias("cycle"), F.col("present").cast("long").alias("present"), F.col("missing").cast("long").alias("missing"), "complete")


@query(f"WITH {LISTING} SELECT strftime(max(cycle), {ISO}) AS cycle FROM stores WHERE step = 0 AND cycle <= TIMESTAMP '2001-07-20 12:00:00' AND cycle >= TIMESTAMP '2000-07-20 12:00:00'")
def newest_published(spark, sf_dir):
    found = catalog.newest_published(_present(spark, sf_dir), F.lit("2001-07-20 13:40:00").cast("timestamp"), tries=1461)
    return found.select(names.iso_time(F.col("cycle")).alias("cycle"))


@query(f"SELECT o_orderkey, strftime(time_bucket(INTERVAL 6 HOURS, o_orderdate + to_hours(o_orderkey % 24) - INTERVAL 7 HOURS), {ISO}) AS cycle FROM orders")
def completed_cycle(spark, sf_dir):
    now = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate").cast("timestamp"))
    return read(spark, sf_dir, "orders").select("o_orderkey", names.iso_time(names.completed_cycle(now)).alias("cycle"))


@query(f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate - to_hours(o_orderkey % 7 * 6) END AS a, o_orderdate AS b FROM orders)
SELECT o_orderkey, strftime(unnest(CASE WHEN a IS NULL THEN [b] ELSE range(a + INTERVAL 6 HOURS, b + INTERVAL 6 HOURS, INTERVAL 6 HOURS) END), {ISO}) AS cycle FROM o""")
def cycles_between(spark, sf_dir):
    end = F.col("o_orderdate").cast("timestamp")
    after = F.when(F.col("o_orderkey") % 7 > 0, F.timestamp_add("HOUR", (F.col("o_orderkey") % 7 * -6).cast("int"), end))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.explode(names.cycles_between(after, end)).alias("cycle")).select("o_orderkey", names.iso_time(F.col("cycle")).alias("cycle"))


@query(f"""WITH {LISTING} SELECT DISTINCT model, name, try_strptime(name[1:10], '%Y-%m-%d')::DATE AS date FROM listing
WHERE regexp_matches(name, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}Z_f[0-9]{{3}}[.](zarr|fronts[.]geojson)$') AND try_strptime(name[1:10], '%Y-%m-%d')::DATE < DATE '1996-01-01' - 10""")
def retention_cut(spark, sf_dir):
    found = listing(spark, sf_dir).select("model", "name", "is_folder").distinct()
    return catalog.expired(found, F.lit("1996-01-01").cast("date"), 10)


@query("SELECT name, date FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') || '_00z_f000_t_' || o_orderkey || '.grib2' AS name, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderkey % 3 > 0) WHERE date < DATE '1997-01-01' - 7")
def retention_cache(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = F.concat(day, F.lit("_00z_f000_t_"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 > 0, ".grib2").otherwise(".idx"))
    return catalog.expired_cache(read(spark, sf_dir, "orders").select(name.alias("name"), F.lit(False).alias("is_folder")), F.lit("1997-01-01").cast("date"), 7)


@query(f"""WITH {LISTING}, files AS (SELECT DISTINCT model, name FROM listing WHERE name LIKE '%.fronts.geojson')
SELECT s.model, s.store, f.name AS fronts, CAST(NULL AS VARCHAR) AS pressure FROM stores s LEFT JOIN files f ON f.model = s.model AND f.name = replace(s.store, '.zarr', '.fronts.geojson')""")
def attach_products(spark, sf_dir):
    files = listing(spark, sf_dir).select("model", "name", "is_folder").distinct()
    found = catalog.with_products(_present(spark, sf_dir).distinct(), files)
    return found.select("model", "store", "fronts", "pressure")


@query(f"WITH {LISTING} SELECT DISTINCT 'model_F' AS model, a.store AS name FROM stores a WHERE a.model = 'model_F' AND NOT EXISTS (SELECT 1 FROM stores b WHERE b.model = 'model_O' AND b.store = a.store)")
def stale_copies(spark, sf_dir):
    present = _present(spark, sf_dir).select("model", F.col("store").alias("name")).distinct()
    source = present.where("model = 'model_O'").withColumn("model", F.lit("model_F"))
    return catalog.stale_copies(source, present.where("model = 'model_F'"))


@query(f"""WITH {LISTING}, paths AS (SELECT DISTINCT '/data/' || model || '/' || name || CASE WHEN name LIKE '%.zarr' THEN '/level=0/part.parquet' ELSE '' END AS path FROM listing
UNION ALL SELECT '/data/m/2026-08-20T18Z_f006.probs.npz')
SELECT path, CASE WHEN ends_with(path, '.npz') THEN '404' WHEN contains(path, '.zarr/') THEN 'public, max-age=31536000, immutable' ELSE 'public, max-age=60' END AS rule FROM paths""")
def serving_rules(spark, sf_dir):
    name = F.col("name")
    paths = listing(spark, sf_dir).select(F.concat(F.lit("/data/"), "model", F.lit("/"), name, F.when(name.endswith(".zarr"), "/level=0/part.parquet").otherwise("")).alias("path")).distinct()
    paths = paths.unionByName(spark.createDataFrame([("/data/m/2026-08-20T18Z_f006.probs.npz",)], "path string"))
    return paths.select("path", names.served_as(F.col("path")).alias("rule"))


@query("SELECT p_partkey, regexp_extract(x, '^(.*)_([0-9]+)$', 1) AS variable, CAST(regexp_extract(x, '^(.*)_([0-9]+)$', 2) AS INTEGER) AS level FROM (SELECT p_partkey, replace(p_name, ' ', '_') || '_' || p_size AS x FROM part)")
def channel_split(spark, sf_dir):
    name = F.concat(F.regexp_replace("p_name", " ", "_"), F.lit("_"), F.col("p_size").cast("string"))
    return read(spark, sf_dir, "part").select("p_partkey", names.channel_parts(name).alias("x")).select("p_partkey", "x.variable", "x.level")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN NULL ELSE '/data/' || o_orderstatus || '/' || o_orderkey || '.json' END AS url FROM orders")
def side_urls(spark, sf_dir):
    k = F.col("o_orderkey")
    file = F.when(k % 3 == 1, "").when(k % 3 == 2, F.concat(k.cast("string"), F.lit(".json")))
    return read(spark, sf_dir, "orders").select("o_orderkey", names.side_url("/data", F.col("o_orderstatus"), file).alias("url"))


@query(f"""SELECT event_id, CAST(greatest(0, least(9, CAST(floor(value / 5e2 * 10 + 5e-1) AS INTEGER) - 1)) AS INTEGER) AS bin, {r('(user_id % 10 + 1) / 1e1', 4)} AS opacity,
printf('%.2f', CASE WHEN user_id % 10 = 0 THEN 5e-2 ELSE user_id % 10 * 1e-1 END) || '–' || printf('%.1f', (user_id % 10 + 1) * 1e-1) AS label FROM events""")
def bins(spark, sf_dir):
    b = (F.col("user_id") % 10).cast("int")
    return read(spark, sf_dir, "events").select("event_id", style.bin_of_opacity(F.col("value") / 500.0).alias("bin"), rounded(style.band_opacity(b), 4).alias("opacity"), style.bin_label(b).alias("label"))


@query("SELECT CAST(k AS INTEGER) AS index, CASE WHEN k = 0 THEN 5e-2 ELSE round(k * 1e-1, 10) END AS value, CASE WHEN k = 0 THEN '0.05' ELSE printf('%.1f', k * 1e-1) END AS label, k % 2 = 0 AS labelled FROM range(11) AS t(k)")
def bin_boundaries(spark, sf_dir):
    return style.bin_boundaries(spark)


COLOURS = "(VALUES ('#3987e5'), ('#d62728'), ('#199e70'), ('#ffffff')) AS h(hex)"


@query(f"""WITH h AS (SELECT hex, [('0x' || hex[2:3])::INT / 255e0, ('0x' || hex[4:5])::INT / 255e0, ('0x' || hex[6:7])::INT / 255e0] AS q FROM {COLOURS}),
s AS (SELECT p_partkey, hex, q, [p_size / 5e1, p_partkey % 10 / 1e1, 5e-1] AS p FROM part, h),
t AS (SELECT p_partkey, hex, list_sum([(1 - p[k]) * (1 - q[k]) for k in [1, 2, 3]]) AS n, list_sum([(1 - q[k]) * (1 - q[k]) for k in [1, 2, 3]]) AS d FROM s)
SELECT p_partkey, hex, CASE WHEN d = 0 THEN 0e0 ELSE {r('greatest(0e0, least(1e0, n / d))')} END AS alpha FROM t""")
def class_alpha(spark, sf_dir):
    k = F.col("p_partkey")
    pixel = F.array(F.col("p_size") / 50.0, k % 10 / 10.0, F.lit(0.5))
    colours = F.array(*(F.lit(x) for x in ("#3987e5", "#d62728", "#199e70", "#ffffff")))
    spread = read(spark, sf_dir, "part").withColumn("hex", F.explode(colours))
    return spread.select("p_partkey", "hex", rounded(style.class_alpha(pixel, style.rgb(F.col("hex")))).alias("alpha"))


@query("""SELECT cls, side, oriented, CASE cls WHEN 'cold' THEN '#3987e5' WHEN 'stationary' THEN '#3987e5' WHEN 'trough' THEN '#8c8c8c' ELSE '#888888' END AS colour,
CASE WHEN cls IN ('cold', 'stationary') THEN 'front-sym-' || cls || '-' || CASE WHEN side = 'right' THEN 'right' ELSE 'left' END END AS image,
cls = 'trough' AS dashed, cls = 'cold' OR (cls = 'stationary' AND NOT oriented) AS solid, cls = 'cold' AND oriented AS symbols
FROM (VALUES ('cold'), ('stationary'), ('trough'), ('other')) AS a(cls), (VALUES ('left'), ('right')) AS b(side), (VALUES (true), (false)) AS c(oriented)""")
def line_styles(spark, sf_dir):
    rows = [(c, s, o) for c in ("cold", "stationary", "trough", "other") for s in ("left", "right") for o in (True, False)]
    seen = ["cold", "stationary", "trough"]
    cls, oriented = F.col("cls"), F.col("oriented")
    return spark.createDataFrame(rows, "cls string, side string, oriented boolean").select(
        "cls", "side", "oriented", style.line_colour(cls).alias("colour"), style.symbol_image(cls, F.col("side")).alias("image"),
        style.shown_dashed(cls, seen).alias("dashed"), style.shown_solid(cls, oriented, seen).alias("solid"), style.shown_symbols(cls, oriented, 26, seen).alias("symbols"),
    )


@query("SELECT cls, count(*) AS symbols, min(period) AS period FROM (VALUES ('cold', 26), ('warm', 26), ('occluded', 52), ('occluded', 52), ('stationary', 52), ('stationary', 52)) AS t(cls, period) GROUP BY cls")
def symbol_patterns(spark, sf_dir):
    return style.symbol_table(spark).groupBy("cls").agg(F.count("*").alias("symbols"), F.min("period").alias("period"))


@query("""SELECT kind, zoom, kind = 'isobar' AND (zoom = 1 OR zoom >= 4) AS label, CASE kind WHEN 'H' THEN '#1f5fbf' WHEN 'L' THEN '#c0392b' ELSE '#39424f' END AS colour
FROM (VALUES ('isobar'), ('H'), ('L')) AS a(kind), (VALUES (1), (2), (4), (6)) AS b(zoom)""")
def pressure_styles(spark, sf_dir):
    rows = spark.createDataFrame([(k, z) for k in ("isobar", "H", "L") for z in (1, 2, 4, 6)], "kind string, zoom int")
    return rows.select("kind", "zoom", style.shown_label(F.col("kind"), F.col("zoom") == 1, F.col("zoom"), 4).alias("label"), style.centre_colour(F.col("kind")).alias("colour"))


@query("""SELECT CAST(user_id % 4 AS INTEGER) AS step, CASE user_id % 4 WHEN 0 THEN '(isobars or centres for this step)' WHEN 1 THEN '(centres for this step)' WHEN 2 THEN '(isobars for this step)' ELSE '' END AS status FROM events GROUP BY ALL""")
def status_text(spark, sf_dir):
    k = F.col("user_id") % 4
    kinds = F.array_compact(F.array(F.when(k.isin(1, 3), "isobar"), F.when(k.isin(2, 3), "L")))
    return read(spark, sf_dir, "events").select(k.cast("int").alias("step"), style.missing_kinds(kinds).alias("status")).distinct()


def _collections(spark):
    line = lambda name, kind="MultiLineString", sides=("right",): {"type": "Feature", "geometry": {"type": kind, "coordinates": [[[0, 1], [2, 3]], [[4, 5]], [[6, 7], [8, 9]]]}, "properties": {"event_id": "front_0001", "name": name, "summary": {"symbol_sides": list(sides)}}}
    texts = [json.dumps({"oriented": True, "features": [line("cold_front"), line("overall_geometry"), line("trough", "LineString")]}), json.dumps({"features": [line("dryline", sides=())]}), json.dumps({"features": []})]
    return spark.createDataFrame(list(enumerate(texts)), "step int, geojson string")


@query("SELECT * FROM (VALUES (0, 'cold', 0, 'right', true), (0, 'cold', 2, 'left', true), (1, 'dryline', 0, 'left', false), (1, 'dryline', 2, 'left', false)) AS t(step, cls, part, side, oriented)")
def viewer_lines(spark, sf_dir):
    return style.line_features(_collections(spark)).select("step", "cls", "part", "side", "oriented")


@query("SELECT * FROM (VALUES (0, 'isobar', 1004e0, true), (0, 'L', 985e0, false), (0, 'H', 1031e0, false)) AS t(step, kind, hpa, major)")
def viewer_pressure(spark, sf_dir):
    one = lambda kind, shape, hpa, **more: {"geometry": {"type": shape}, "properties": {"kind": kind, "hpa": hpa, **more}}
    features = [one("isobar", "LineString", 1004, major=True), one("L", "Point", " 985 "), one("H", "Point", 1031), one("H", "LineString", 1), one("L", "Point", ""), one("L", "Point", None), one("X", "Point", 1), one("isobar", "Point", 1000)]
    return style.pressure_features(spark.createDataFrame([(0, json.dumps({"features": features}))], "step int, geojson string"))


WINDOW_SQL = "SELECT time_bucket(INTERVAL 6 HOURS, ts) AS cycle, event_type, count(*) AS n, CAST(sum(CAST(round_even(value * 1e2, 0) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL"


@query(f"SELECT strftime(cycle, {ISO}) AS cycle, event_type, n, cents FROM ({WINDOW_SQL})")
def window_6h(spark, sf_dir):
    found = cycles.six_hour_buckets(read(spark, sf_dir, "events"))
    return found.select(names.iso_time(F.col("cycle")).alias("cycle"), "event_type", "n", "cents")


@query(f"SELECT strftime(cycle, {ISO}) AS cycle, event_type, n, cents FROM ({WINDOW_SQL})")
def stream_6h(spark, sf_dir):
    """The same buckets from a stream over the table's files, one at a time, run until all is read."""
    table, folder = read(spark, sf_dir, "events"), _folder(spark)
    table.repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    found = cycles.six_hour_buckets(stream).writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/state")
    found.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{folder}/out")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(names.iso_time(F.col("cycle")).alias("cycle"), "event_type", "n", "cents")


def _folder(spark):
    """A new folder that all machines see."""
    return f"{shared_folder(spark)}/isallobar/stream-{uuid.uuid4().hex}"


@query()
def stream_tracking(spark, sf_dir):
    """Event ids from the stateful stream, fed file by file; they equal those of the batch plan (:func:`track_fronts`).

    Of each step the points come in two files, and then the mark that the step is whole; one
    good step has no fronts.
    """
    from isallobar.plans.query_lines import tracked_points, tracked_steps

    points = tracked_points(spark, sf_dir).withColumn("cycle", F.lit("2024-01-01").cast("timestamp"))
    folder = _folder(spark)
    rows = cycles.with_marks(points, tracked_steps(spark).select(F.lit("2024-01-01").cast("timestamp").alias("cycle"), "step"))
    for step in sorted(r.step for r in tracked_steps(spark).collect()):  # a few steps
        own = rows.where(F.col("step") == step)
        for part in (own.where("front % 2 = 0"), own.where("front % 2 = 1"), own.where("front IS NULL")):
            part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run = cycles.tracked_stream(stream).writeStream.outputMode("append").option("checkpointLocation", f"{folder}/state")
    run.format("parquet").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(cycles.TRACKED).parquet(f"{folder}/out").select("step", "front", "event_id", F.array_join("parents", ",").alias("parents"))
