"""Front lines from drawn ridges, their tracking, and the cycle that publishes them."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from isallobar.operators import fronts, kernels
from isallobar.operators.grid import Grid
from isallobar.plans import catalog, cycle
from isallobar.plans.manifest import Model, on, single
from isallobar.sources.fields import SyntheticSource
from isallobar.sources.storage import Storage

GRID = Grid(181, 360)
SETTINGS = fronts.Settings()


def ridge(lat_of, lons, peak=0.9, width=1.0):
    """A band of probability along lat = lat_of(lon)."""
    field = np.zeros((GRID.rows, GRID.cols))
    lat = 90.0 - np.arange(GRID.rows) * GRID.dlat
    for lon in lons:
        c = int(lon) % 360
        field[:, c] = np.maximum(field[:, c], peak * np.exp(-((lat - lat_of(lon)) ** 2) / (2 * width**2)))
    return field


def test_thinning_leaves_the_middle():
    mask = np.zeros((20, 40), bool)
    mask[8:13, 5:35] = True
    thin = kernels.thinned_mask(mask)
    assert set(np.nonzero(thin)[0]) <= {9, 10, 11} and 20 <= thin.sum() <= 34 and not (thin & ~mask).any()


def test_a_straight_ridge_is_one_line():
    points = fronts.trace({"CF": ridge(lambda x: 40.0, range(230, 291))}, GRID, SETTINGS)
    assert points["front"].nunique() == 1 and points["line"].nunique() == 1 and set(points["front_type"]) == {"CF"}
    assert abs(points["lat"] - 40).max() < 0.6 and points["lon"].min() < 234 and points["lon"].max() > 286
    km = kernels.haversine_km(points["lon"][:-1].to_numpy(), points["lat"][:-1].to_numpy(), points["lon"][1:].to_numpy(), points["lat"][1:].to_numpy())
    assert abs(km - 25).max() < 2.5


def test_a_ridge_over_the_seam_is_one_line():
    points = fronts.trace({"WF": ridge(lambda x: 45.0, range(340, 381))}, GRID, SETTINGS)
    assert points["line"].nunique() == 1 and points["lon"].max() - points["lon"].min() > 30


def test_short_ridges_go_and_types_split():
    assert not len(fronts.trace({"CF": ridge(lambda x: 40.0, range(250, 252))}, GRID, SETTINGS))
    cold, warm = ridge(lambda x: 40.0, range(230, 260)), ridge(lambda x: 40.0, range(260, 290))
    points = fronts.trace({"CF": cold, "WF": warm}, GRID, SETTINGS)
    assert points.groupby("section")["front_type"].first().tolist() in (["CF", "WF"], ["WF", "CF"])
    assert not len(fronts.trace({"CF": cold * 0.2}, GRID, SETTINGS))


def test_arms_meet_in_one_point():
    field = np.maximum(ridge(lambda x: 40.0, range(230, 291)), 0)
    lat = 90.0 - np.arange(GRID.rows) * GRID.dlat
    for r in np.flatnonzero((lat <= 60) & (lat >= 40)):
        field[r] = np.maximum(field[r], 0.9 * np.exp(-((np.arange(360) - 260.0) ** 2) / 2))
    points = fronts.trace({"OF": field}, GRID, SETTINGS)
    assert points["line"].nunique() >= 2
    arm = points[points["line"] == points["line"].max()].sort_values("i")
    main = points[points["line"] != points["line"].max()]
    ends = arm.iloc[[0, -1]]
    gap = min(kernels.haversine_km(e.lon, e.lat, main["lon"].to_numpy(), main["lat"].to_numpy()).min() for e in ends.itertuples())
    assert gap < 15


def test_folding_gives_short_stretches_to_the_longer_neighbour():
    far = np.arange(11) * 50.0
    assert kernels.folded_runs(np.array([0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0]), far, 100.0) == [(0, 0, 10)]
    assert kernels.folded_runs(np.array([0, 0, 0, 0, 0, 1, 1, 1, 1, 1, 1]), far, 100.0) == [(0, 0, 5), (1, 5, 10)]
    assert kernels.folded_runs(np.array([2, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0]), far, 100.0) == [(1, 0, 10)]


def test_smoothing_calms_zigzags_and_keeps_ends():
    lon = np.arange(230.0, 280.0)
    lat = 40 + 0.3 * (-1) ** np.arange(50)
    x, y = kernels.smooth_line(lon, lat, 0.25, 25.0)
    assert abs(y - 40)[3:-3].max() < 0.15 and abs(x[0] - 230) < 0.3 and abs(x[-1] - 279) < 0.3


def test_trees_split_into_long_paths():
    edges = [(1.0, k, k + 1) for k in range(9)] + [(1.0, 4, 10), (1.0, 10, 11), (1.0, 11, 12), (1.0, 2, 13)]
    tree = kernels.spanning_forest(14, [*edges, (5.0, 0, 9)])
    paths = kernels.long_paths(tree, 3, 5.0, 2.0)
    assert sorted(len(p) for _, p in paths) == [4, 10] and paths[1][0] == 0 and paths[1][1][0] == 4
    assert kernels.long_paths(tree, 3, 50.0, 2.0) == []


def test_corner_angles():
    lon = np.array([0.0, 1, 2, 3, 3, 3, 3])
    lat = np.array([0.0, 0, 0, 0, 1, 2, 3])
    assert abs(kernels.turn_at(lon, lat, 3, 100) - 90) < 1 and kernels.turn_at(lon, lat, 1, 50) < 1


def test_pinned_ends_land_on_their_target():
    line = (np.linspace(0, 10, 41), np.zeros(41))
    lon, lat = kernels.moved_end(line, True, (360.5, 1.0), 75.0)
    assert (lon[0], lat[0]) == (0.5, 1.0) and lat[-1] == 0 and (np.diff(lat) <= 1e-12).all()


def test_matching_is_one_to_one_and_keeps_lineage():
    fresh = iter(f"n{k}" for k in range(9))
    ids, parents = fronts.assign_events(["a", "b"], 3, [(0.9, 0, 0), (0.8, 0, 1), (0.7, 1, 1), (0.6, 1, 0)], fresh)
    assert ids == ["a", "b", "n0"] and parents == [["b"], ["a"], []]


def probabilities(spark, steps):
    """Cells of drawn fields: {step: {class: field}}."""
    rows = []
    for step, fields in steps.items():
        for cls, field in fields.items():
            r, c = np.nonzero(field > 1e-3)
            rows += [(0, step, int(a), int(b), cls, float(field[a, b])) for a, b in zip(r, c, strict=True)]
    return spark.createDataFrame(rows, "cycle int, step int, r int, c int, cls string, p double")


def test_symbols_point_into_warm_air_and_fronts_keep_their_ids(spark):
    steps = {0: {"cold": ridge(lambda x: 45.0, range(230, 291))}, 6: {"cold": ridge(lambda x: 44.0, range(232, 293))}, 12: {"cold": ridge(lambda x: 43.0, range(234, 295)), "warm": ridge(lambda x: -30.0, range(20, 60))}}
    air = GRID.cells(spark).withColumn("step", F.explode(F.array(F.lit(0), F.lit(6), F.lit(12)))).select(F.lit(0).alias("cycle"), "step", "r", "c", (320.0 - GRID.lat()).alias("temperature"), F.lit(0.0).alias("u"), F.lit(-5.0).alias("v"))
    known = spark.createDataFrame([(0, s) for s in steps], "cycle int, step int")
    points, sides, events = fronts.fronts_over_time(probabilities(spark, steps), known, ["cycle"], GRID, air=air)
    ids = {(x.step, x.front): x.event_id for x in events.collect()}
    assert ids[0, 0] == ids[6, 0] == ids[12, 0] == "front_0000" and ids[12, 1] == "front_0001"
    for x in sides.where("front_type = 'CF'").collect():
        first, last = (points.where(f"step = {x.step} AND front = {x.front}").orderBy(F.col("i").desc() if d else "i").first() for d in (0, 1))
        assert x.side == ("right" if last.lon > first.lon else "left")  # the warm side is south
    features = [json.loads(x.feature) for x in fronts.front_features(points, sides, events, ["cycle", "step"], overall=True).where("step = 12").orderBy("front", "place").collect()]
    assert [f["properties"]["name"] for f in features] == ["overall_geometry", "cold_front", "overall_geometry", "warm_front"]
    assert features[1]["properties"]["summary"]["probability_diagnostics"]["max_probability"] > 0.8
    assert -180 <= features[1]["geometry"]["coordinates"][0][0][0] < 180


def test_a_step_without_fronts_breaks_the_chain(spark):
    steps = {0: {"cold": ridge(lambda x: 45.0, range(230, 291))}, 12: {"cold": ridge(lambda x: 45.0, range(230, 291))}}
    points = fronts.front_points(probabilities(spark, steps), ["cycle", "step"], GRID).persist()
    ids = lambda known: {x.step: x.event_id for x in fronts.tracked(points, spark.createDataFrame([(0, s) for s in known], "cycle int, step int"), ["cycle"]).collect()}
    assert ids([0, 12]) == {0: "front_0000", 12: "front_0000"}  # a bad step between them is left out
    assert ids([0, 6, 12]) == {0: "front_0000", 12: "front_0001"}  # a good step without fronts is not


class Faulty:
    """Predicts high probabilities on the equator; fails where it is told to."""

    def predict_batch(self, patches):
        out = np.full((*patches.shape[:3], 6), 0.02)
        out[..., 1] = 0.6
        return out


SMALL = Grid(24, 48)
MINI = Model("mini", "", on((850,), "u_component_of_wind", "v_component_of_wind") + single("surface_pressure"))


class Broken(SyntheticSource):
    bad = ()

    def fields(self, variables, levels, steps):
        if set(steps) & set(self.bad):
            raise OSError("no such file")
        return super().fields(variables, levels, steps)


def test_cycles_resume_and_publish(spark, tmp_path):
    source = Broken(spark, SMALL)
    run = cycle.ModelRun(MINI, Faulty(), patch=16, overlap=6, levels=2, pressure=True, fronts=True)
    root = str(tmp_path)
    source.bad = (0,)
    done = cycle.run_cycle([run], source, "2026-08-20", 18, root, [0, 6])
    assert [p.rsplit("_", 1)[1] for p in done["mini"]] == ["f006.zarr"]
    pointer = Storage(spark).read_json(f"{root}/mini/latest.json")
    assert pointer["cycle_time"] == "2026-08-20T18:00:00" and pointer["expected_steps"] == [0, 6]
    assert [s["valid_time"] for s in pointer["steps"]] == ["2026-08-21T00:00:00"] and all("pressure" in s for s in pointer["steps"])
    listing = Storage(spark).table(root)
    present = catalog.stores(listing)
    assert catalog.completeness(present, present.select("model", "cycle").distinct()).first().present == 1
    source.bad = ()
    before = Storage(spark).names(f"{root}/mini/2026-08-20T18Z_f006.zarr")
    done = cycle.run_cycle([run], source, "2026-08-20", 18, root, [0, 6])
    assert len(done["mini"]) == 2 and Storage(spark).names(f"{root}/mini/2026-08-20T18Z_f006.zarr") == before
    copied = f"{tmp_path}-packed"
    assert set(cycle.requantize(spark, root, copied).values()) == {"packed"} and set(cycle.requantize(spark, root, copied).values()) == {"skipped"}
    from datetime import datetime

    assert cycle.prune(spark, root, datetime(2026, 8, 27), 7) == []
    gone = cycle.prune(spark, root, datetime(2026, 8, 28), 7)
    assert len([x for x in gone if x.endswith(".zarr")]) == 2 and Storage(spark).exists(f"{root}/mini/latest.json")


def test_cycles_know_their_limits():
    assert len(catalog.target_steps(0)) == 41 and len(catalog.target_steps(6)) == 25 and catalog.published_steps(18)[-1] == 144
    for bad in ("2026-08-20", 5, 0), ("2026-08-20", 6, -1), ("20 August", 6, 0):
        with pytest.raises(ValueError):
            cycle.Cycle(*bad)
    with pytest.raises(ValueError):
        catalog.published_steps(7)


def test_arrivals_are_published_once(spark, tmp_path):
    from isallobar.streaming import cycles

    rows = [("m", "2026-08-20 18:00:00", s, f"f{s}") for s in (0, 6, 6)]
    shape = "model string, cycle string, step int, store string"
    for k, part in enumerate((rows, [*rows[:1], ("m", "2026-08-20 18:00:00", 12, "f12")])):
        spark.createDataFrame(part, shape).select("model", F.col("cycle").cast("timestamp").alias("cycle"), "step", "store").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("model string, cycle timestamp, step int, store string").parquet(f"{tmp_path}/in")
        cycles.publish_arrivals(stream, f"{tmp_path}/catalog", f"{tmp_path}/checkpoint").awaitTermination()
        known = spark.read.parquet(f"{tmp_path}/catalog")
        assert sorted(x.step for x in known.collect()) == [0, 6, 12][: 2 + k]
    assert cycles.cycle_status(known).first().missing == 22


def test_streams_track_as_the_batch_plan_does(spark, tmp_path):
    """Empty good steps, steps in several batches, and a late mark."""
    from isallobar.streaming import cycles

    steps = {0: {"cold": ridge(lambda x: 45.0, range(230, 291)), "warm": ridge(lambda x: -30.0, range(20, 60))}, 12: {"cold": ridge(lambda x: 45.0, range(230, 291))}, 18: {"cold": ridge(lambda x: 44.0, range(232, 293))}}
    points = fronts.front_points(probabilities(spark, steps), ["cycle", "step"], GRID).withColumn("cycle", F.lit("2024-01-01").cast("timestamp")).persist()
    known = spark.createDataFrame([(s,) for s in (0, 6, 12, 18)], "step int").select(F.lit("2024-01-01").cast("timestamp").alias("cycle"), "step")
    rows = cycles.with_marks(points, known)
    for step in (0, 6, 12, 18):
        own = rows.where(F.col("step") == step)
        for part in ("i % 2 = 0", "i % 2 = 1", "front IS NULL"):
            own.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sink = cycles.tracked_stream(stream).writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/state").format("parquet").option("path", f"{tmp_path}/out")
    sink.trigger(availableNow=True).start().awaitTermination()
    key = lambda df: sorted((x.step, x.front, x.event_id, tuple(x.parents)) for x in df.collect())
    got = key(spark.read.schema(cycles.TRACKED).parquet(f"{tmp_path}/out"))
    assert got == key(fronts.tracked(points, known, ["cycle"])) and {e for s, _, e, _ in got if s == 12} == {"front_0002"}


def test_models_on_different_devices_run_at_the_same_time(spark, tmp_path, monkeypatch):
    import threading
    import time

    spans, lock = [], threading.Lock()

    def step(run, source, at, folder):
        begin = time.monotonic()
        time.sleep(0.4)
        with lock:
            spans.append((run.manifest.name, begin, time.monotonic()))
        return f"{folder}/{at.store}"

    monkeypatch.setattr(cycle, "run_step", step)
    models = [Model(n, "", single("surface_pressure")) for n in ("one", "two")]
    for devices, together in ((("a", "b"), True), ((None, None), False)):
        spans.clear()
        done = cycle.run_cycle([cycle.ModelRun(m, Faulty(), d) for m, d in zip(models, devices, strict=True)], SyntheticSource(spark, SMALL), "2026-08-20", 18, f"{tmp_path}/{together}", [0])
        assert set(done) == {"one", "two"}
        (_, a, b), (_, c, d) = sorted(spans, key=lambda s: s[1])
        assert (c < b) == together


def test_pressure_without_the_ground(spark, tmp_path):
    class NoGround(SyntheticSource):
        def single(self, variable, step):
            if variable == "surface_pressure":
                raise OSError("no such field")
            return super().single(variable, step)

    name = cycle.write_pressure(NoGround(spark, SMALL), cycle.Cycle("2026-08-20", 18, 0), str(tmp_path))
    layer = Storage(spark).read_json(f"{tmp_path}/{name}")
    assert layer["features"] and layer["valid_time"] == "2026-08-20T18:00:00"


def test_polls_run_the_newest_published_cycle_once(spark, tmp_path):
    from datetime import datetime

    from isallobar.plans.manifest import MODELS
    from isallobar.sources.fields import stage

    MODELS["mini"] = MINI
    try:
        staged, out, cache = (f"{tmp_path}/{n}" for n in ("staged", "out", "cache"))
        source = SyntheticSource(spark, SMALL)
        for at, steps in (("2026-08-20T06Z", (0, 6)), ("2026-08-20T12Z", (6,))):
            stage(source, f"{staged}/{at}", ["u_component_of_wind", "v_component_of_wind", "surface_pressure"], [850], steps)
        Storage(spark).write_text(f"{cache}/2026-08-01_00z_f000_t.grib2", "x")
        Storage(spark).write_text(f"{cache}/2026-08-19_00z_f000_t.grib2", "x")
        arguments = ["--poll", "--fields", staged, "--output", out, "--cache", cache, "--model", "mini", "--rows", "24", "--cols", "48", "--patch", "16", "--overlap", "6"]
        now = datetime(2026, 8, 20, 13, 5)
        # 12Z is not there yet with its first step, so 06Z is run; of its steps two are staged.
        assert cycle.main(arguments, Faulty(), now) == 0
        names = [n for n, folder, _ in Storage(spark).names(f"{out}/mini") if folder and n.endswith(".zarr")]
        assert names == ["2026-08-20T06Z_f000.zarr", "2026-08-20T06Z_f006.zarr"]
        assert [n for n, _, _ in Storage(spark).names(cache)] == ["2026-08-19_00z_f000_t.grib2"]
        available = cycle_of(spark, staged)
        assert cycle.pending_cycle(spark, available, ["mini"], out, now) == ("2026-08-20", 6)  # still lacks steps
        for s in catalog.target_steps(6):
            Storage(spark).write_text(f"{out}/mini/2026-08-20T06Z_f{s:03d}.zarr/_SUCCESS", "")
        assert cycle.pending_cycle(spark, available, ["mini"], out, now) is None and cycle.main(arguments, Faulty(), now) == 0
        assert cycle.pending_cycle(spark, available, ["mini"], out, datetime(2026, 8, 22, 13, 5)) is None  # more than a day old
    finally:
        del MODELS["mini"]


def cycle_of(spark, path):
    from isallobar.sources.fields import StagedCycles

    return StagedCycles(spark, path, SMALL).available()


def test_steps_are_traced_once_and_tracked_as_they_come(spark, tmp_path, monkeypatch):
    traced = []
    front_points = fronts.front_points

    def counted(cells, *rest):
        traced.append(1)
        return front_points(cells, *rest)

    monkeypatch.setattr(fronts, "front_points", counted)
    folder = str(tmp_path)
    drawn = {s: {"cold": ridge(lambda x, s=s: 45.0 - s / 6, range(230, 291))} for s in (0, 6, 12)}
    entries = []
    for step, fields in drawn.items():
        store = cycle.Cycle("2026-08-20", 18, step).store
        probabilities(spark, {step: fields}).select("cls", "r", "c", F.col("p").cast("float").alias("p")).write.parquet(f"{folder}/{store.removesuffix('.zarr')}.probs")
        entries.append({"step_hours": step, "valid_time": "x", "store": store})
        found = cycle.write_fronts(spark, folder, entries, GRID)
        assert list(found) == [e["store"] for e in entries]
    assert len(traced) == 3
    ids = [{f["properties"]["event_id"] for f in Storage(spark).read_json(f"{folder}/{n}")["features"]} for n in found.values()]
    assert ids == [{"front_0000"}] * 3
    assert cycle.write_fronts(spark, folder, entries, GRID) == found and len(traced) == 3


def test_files_are_decoded_where_they_are_read(spark, tmp_path):
    import io

    from isallobar.sources.fields import DecodedSource

    def decode(content):
        with np.load(io.BytesIO(content)) as f:
            return [(k.split("@")[0], int(k.split("@")[1]) if "@" in k else None, f[k]) for k in f.files]

    for step in (0, 6):
        for name, messages in (("t", {"t@850": np.full((3, 4), 280.0 + step), "t@500": np.full((3, 4), 250.0)}), ("sp", {"sp": np.arange(12.0).reshape(3, 4)})):
            buffer = io.BytesIO()
            np.savez(buffer, **messages)
            (tmp_path / f"2026-08-20_18z_f{step:03d}_{name}.grib2").write_bytes(buffer.getvalue())
    (tmp_path / "2026-08-20_18z_f006_q.grib2").write_bytes(b"never opened")
    source = DecodedSource(spark, str(tmp_path), Grid(3, 4), decode)
    rows = source.fields(["temperature", "surface_pressure"], [850], [6]).collect()
    assert len(rows) == 24 and {x.v for x in rows if x.variable == "temperature"} == {286.0} and {x.step for x in rows} == {6}
    assert {(x.r, x.c, x.v) for x in source.single("surface_pressure", 0).collect()} == {(k // 4, k % 4, float(k)) for k in range(12)}
    with pytest.raises(Exception, match="File|pickle|zip|format"):
        source.fields(["specific_humidity"], [850], [6]).collect()
