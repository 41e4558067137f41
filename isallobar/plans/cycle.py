"""Running forecast cycles: one step at a time, resumable, published as each step lands."""

from __future__ import annotations

import argparse
import functools
import json
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isallobar.functions import names, physics
from isallobar.operators import assemble, fronts, pressure, pyramid, tiling
from isallobar.operators.fronts import Settings
from isallobar.operators.grid import Grid, rolled_to_signed
from isallobar.plans import catalog
from isallobar.plans.manifest import STATIC, Model, get_model, on
from isallobar.sources.fields import GridSource
from isallobar.sources.storage import Storage

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ModelRun:
    """A model and how it is run."""

    manifest: Model
    predictor: tiling.Predictor
    device: str | None = None
    patch: int = 256
    overlap: int = 96
    batch: int = 8
    levels: int = pyramid.LEVELS
    pack: bool | None = None
    fronts: bool = False
    pressure: bool = False
    settings: Settings = field(default_factory=Settings)


@dataclass(frozen=True)
class Cycle:
    """A cycle's date and run hour, and a lead time."""

    date: str
    hour: int
    step: int = 0

    def __post_init__(self) -> None:
        if self.hour not in names.SYNOPTIC_HOURS:
            raise ValueError(f"cycles run at {names.SYNOPTIC_HOURS}, not {self.hour}")
        if self.step < 0:
            raise ValueError(f"a lead time cannot be {self.step} hours")
        datetime.strptime(self.date, "%Y-%m-%d")

    @property
    def time(self) -> datetime:
        return datetime.strptime(self.date, "%Y-%m-%d") + timedelta(hours=self.hour)

    @property
    def store(self) -> str:
        return f"{self.date}T{self.hour:02d}Z_f{self.step:03d}.zarr"

    @property
    def valid_time(self) -> str:
        return (self.time + timedelta(hours=self.step)).strftime("%Y-%m-%dT%H:%M:%S")


def model_inputs(run: ModelRun, source: GridSource, step: int) -> DataFrame:
    """Assembled inputs (step, r, c, channels) of one step; base variables are read once."""
    m = run.manifest
    base = set(m.names) - set(STATIC)
    derived = {"equivalent_potential_temperature": {"temperature", "specific_humidity"}, "potential_vorticity": {"temperature", "u_component_of_wind", "v_component_of_wind"}}
    for name, needs in derived.items():
        if name in base:
            base = base - {name} | needs
    fixed = [v for v in m.names if v in STATIC]
    fields = source.fields(sorted(base), list(m.levels), [step])
    return assemble.assemble(fields, m, ["step"], source.grid, source.static(fixed) if fixed else None)


def run_step(run: ModelRun, source: GridSource, cycle: Cycle, folder: str) -> str:
    """Infer one step and write its pyramid; the store gets its name once it is whole."""
    storage, grid = Storage(source.spark), source.grid
    inputs = model_inputs(run, source, cycle.step).persist()
    try:
        found = tiling.tiled_inference(inputs, ["step"], grid, run.manifest, run.predictor, run.patch, run.overlap, run.batch)
        signed = rolled_to_signed(found, grid.cols).select("cls", "r", "c", "p")
        tree = pyramid.mean_pyramid(signed, ["cls"], run.levels)
        target, draft = f"{folder}/{cycle.store}", f"{folder}/.{cycle.store}.draft"
        pyramid.write_pyramid(tree, draft, run.pack)
        if run.fronts:
            side = cycle.store.removesuffix(".zarr")
            if pyramid.packing_wanted(run.pack):
                found.select("cls", "r", "c", F.col("p").cast("float").alias("p")).write.mode("overwrite").parquet(f"{folder}/{side}.probs")
            air = assemble.orientation_fields(inputs, run.manifest, grid)
            if air is not None:
                air.write.mode("overwrite").parquet(f"{folder}/{side}.fields")
        storage.delete(target)
        storage.move(draft, target)
    finally:
        inputs.unpersist()
    return target


def write_pressure(source: GridSource, cycle: Cycle, folder: str) -> str | None:
    """Write a step's isobars and centres; a failure is logged and gives None.

    The pressure of the ground only drops centres over high terrain: without it there are more.
    """
    name = cycle.store.removesuffix(".zarr") + names.SUFFIXES["pressure"]
    storage = Storage(source.spark)
    if storage.exists(f"{folder}/{name}"):
        return name
    kept = []
    try:
        hpa = source.single("mean_sea_level_pressure", cycle.step).select("r", "c", physics.to_hpa(F.col("v")).alias("v"), F.lit(0).alias("f")).persist()
        kept.append(hpa)
        pressure.checked_field(hpa, ["f"], "v", source.grid)
        ground = None
        try:
            ground = source.single("surface_pressure", cycle.step).select("r", "c", physics.to_hpa(F.col("v")).alias("surface"), F.lit(0).alias("f")).persist()
            ground.count()
            kept.append(ground)
        except Exception:
            log.exception("centres of %s are placed without the pressure of the ground", cycle.store)
            ground = None
        lines = pressure.isobars(hpa, ["f"], "v", source.grid)
        points = pressure.centres(hpa, ["f"], "v", source.grid, ground)
        features = pressure.pressure_layer(lines, points, ["f"]).orderBy("place", "within").select("feature").collect()  # one field's lines
        head = json.dumps({"type": "FeatureCollection", "valid_time": cycle.valid_time}, separators=(",", ":"))[:-1]
        storage.write_text(f"{folder}/{name}", f'{head},"features":[{",".join(r.feature for r in features)}]}}')
    except Exception:
        log.exception("no pressure layer for %s", cycle.store)
        return None
    finally:
        for df in kept:
            df.unpersist()
    return name


def traced(spark: SparkSession, folder: str, entry: dict, grid: Grid, settings: Settings) -> str:
    """The folder with a step's front points; the step is traced if it is not there yet."""
    storage, side = Storage(spark), f"{folder}/{entry['store'].removesuffix('.zarr')}"
    path = f"{side}.points"
    if not storage.exists(path):
        if storage.exists(f"{side}.probs"):
            cells = spark.read.parquet(f"{side}.probs")
        else:
            half = grid.cols // 2
            cells = pyramid.read_level0(spark, f"{folder}/{entry['store']}").withColumn("c", F.pmod(F.col("c") + half, F.lit(grid.cols)).cast("int"))
        one = cells.select(F.lit(0).alias("cycle"), F.lit(entry["step_hours"]).alias("step"), "r", "c", "cls", F.col("p").cast("double").alias("p"))
        fronts.front_points(one, ["cycle", "step"], grid, settings).write.mode("overwrite").parquet(f"{path}.draft")
        storage.move(f"{path}.draft", path)
    return path


def write_fronts(spark: SparkSession, folder: str, steps: Sequence[dict], grid: Grid, settings: Settings = Settings()) -> dict[str, str]:
    """Write front lines of a cycle's steps; a step that cannot be read is left out.

    Each step is traced once, its points are kept beside its store.  Tracking reads the points of
    all steps in one scan, so ids agree over the cycle; each good step is tracked against the
    last good one before it.  Files are written from the first step on that has none or comes
    after one that was traced just now: those before cannot have changed.  Returns file names by store.
    """
    storage = Storage(spark)
    paths, good, changed = [], [], None
    for entry in sorted(steps, key=lambda e: e["step_hours"]):
        stem = entry["store"].removesuffix(".zarr")
        known = storage.exists(f"{folder}/{stem}.points") and storage.exists(f"{folder}/{stem}{names.SUFFIXES['fronts']}")
        try:
            paths.append(traced(spark, folder, entry, grid, settings))
        except Exception:
            log.exception("front lines of %s are left out", entry["store"])
            continue
        good.append(entry)
        if not known and changed is None:
            changed = entry["step_hours"]
    out = {e["store"]: e["store"].removesuffix(".zarr") + names.SUFFIXES["fronts"] for e in good}
    if changed is None:
        return out
    keys = ["cycle", "step"]
    points = spark.read.parquet(*paths).persist()
    known = spark.createDataFrame([(0, e["step_hours"]) for e in good], "cycle int, step int")
    sides = [(e, f"{folder}/{e['store'].removesuffix('.zarr')}.fields") for e in good]
    held = [(e, path) for e, path in sides if storage.exists(path)]
    air, air_grid = None, grid
    if held:
        stride = 2 if min(grid.rows, grid.cols) >= 200 else 1
        air_grid = Grid(-(-grid.rows // stride), -(-grid.cols // stride))
        each = [spark.read.parquet(path).select(F.lit(0).alias("cycle"), F.lit(e["step_hours"]).alias("step"), "r", F.rint(F.pmod(F.col("lon"), F.lit(360.0)) / air_grid.dlon).cast("int").alias("c"), "temperature", "u", "v") for e, path in held]
        air = functools.reduce(DataFrame.unionByName, each)
    late = F.col("step") >= changed
    wanted = points.where(late)
    arrows = fronts.symbol_sides(wanted, keys, air_grid, settings, air, fronts.with_previous(points, known, ["cycle"]).where(late))
    events = fronts.tracked(points, known, ["cycle"], settings)
    by_step: dict[int, list[str]] = {e["step_hours"]: [] for e in good if e["step_hours"] >= changed}
    for r in fronts.front_features(wanted, arrows, events, keys).orderBy("step", "front", "place").select("step", "feature").toLocalIterator():
        by_step[r.step].append(r.feature)
    for entry in good:
        if entry["step_hours"] in by_step:
            head = json.dumps({"type": "FeatureCollection", "valid_time": entry["valid_time"], "oriented": bool(held)}, separators=(",", ":"))[:-1]
            storage.write_text(f"{folder}/{out[entry['store']]}", f'{head},"features":[{",".join(by_step[entry["step_hours"]])}]}}')
    points.unpersist()
    return out


def publish(storage: Storage, folder: str, cycle: Cycle, steps: Sequence[dict], expected: Sequence[int]) -> None:
    """Point readers at what a cycle has so far."""
    storage.write_text(f"{folder}/latest.json", json.dumps({"cycle_time": cycle.time.strftime("%Y-%m-%dT%H:%M:%S"), "steps": list(steps), "expected_steps": list(expected)}))


def run_cycle(runs: Sequence[ModelRun], source: GridSource, date: str, hour: int, root: str, steps: Sequence[int] | None = None) -> dict[str, list[str]]:
    """Run every model over every step; steps that are stored are skipped, steps that fail are left out.

    Models on different devices run at the same time, models that share one after the other.
    The pointer is written after each step, so readers see a cycle grow, and a cycle without a
    single good step never replaces the one before.
    """
    spark = source.spark
    storage = Storage(spark)
    wanted = tuple(steps if steps is not None else catalog.target_steps(hour))
    entries: dict[str, list[dict]] = {r.manifest.name: [] for r in runs}

    def one(run: ModelRun, cycle: Cycle) -> dict | None:
        folder = f"{root}/{run.manifest.name}"
        try:
            if not storage.exists(f"{folder}/{cycle.store}"):
                run_step(run, source, cycle, folder)
        except Exception:
            log.exception("%s fails at step %s, which is left out", run.manifest.name, cycle.step)
            return None
        return {"step_hours": cycle.step, "valid_time": cycle.valid_time, "store": cycle.store}

    with ThreadPoolExecutor(max_workers=max(1, len({r.device for r in runs}))) as pool:
        for step in wanted:
            cycle = Cycle(date, hour, step)
            by_device: dict[str | None, list[ModelRun]] = {}
            for run in runs:
                by_device.setdefault(run.device, []).append(run)
            found = pool.map(lambda own, cycle=cycle: [(run, one(run, cycle)) for run in own], by_device.values())
            done = {run.manifest.name: entry for own in found for run, entry in own}
            for run in runs:
                if (entry := done[run.manifest.name]) is None:
                    continue
                folder, own = f"{root}/{run.manifest.name}", entries[run.manifest.name]
                own.append(entry)
                if run.pressure and (name := write_pressure(source, cycle, folder)):
                    entry["pressure"] = name
                if run.fronts:
                    attach_fronts(spark, folder, own, source.grid, run.settings)
                publish(storage, folder, cycle, own, wanted)
    return {m: [f"{root}/{m}/{e['store']}" for e in own] for m, own in entries.items() if own}


def attach_fronts(spark: SparkSession, folder: str, entries: list[dict], grid: Grid, settings: Settings) -> None:
    """Write the steps' front lines and name them in their entries; old names go. Never raises."""
    try:
        found = write_fronts(spark, folder, entries, grid, settings)
    except Exception:
        log.exception("no front lines in %s", folder)
        found = {}
    for entry in entries:
        entry.pop("fronts", None)
        if name := found.get(entry["store"]):
            entry["fronts"] = name


def backfill_fronts(spark: SparkSession, root: str, grid: Grid, settings: Settings = Settings()) -> dict[str, int]:
    """Add front lines to the cycle that each model's pointer names; returns steps by model."""
    storage, out = Storage(spark), {}
    for model, folder, _ in storage.names(root):
        pointer = storage.read_json(f"{root}/{model}/latest.json") if folder else None
        if pointer is None:
            continue
        before = json.dumps(pointer)
        attach_fronts(spark, f"{root}/{model}", pointer["steps"], grid, settings)
        if json.dumps(pointer) != before:
            storage.write_text(f"{root}/{model}/latest.json", json.dumps(pointer))
        out[model] = sum("fronts" in e for e in pointer["steps"])
    return out


def rebuild_air(run: ModelRun, source: GridSource, folder: str, steps: Sequence[dict]) -> int:
    """Write the 850 hPa temperature and winds of steps that lack them, from three channels only."""
    storage = Storage(source.spark)
    wanted = ("equivalent_potential_temperature", "u_component_of_wind", "v_component_of_wind")
    if not set(wanted) <= set(run.manifest.layered):
        return 0
    small = Model("air", "", on((850,), *(v for v in run.manifest.layered if v in wanted)))
    made = 0
    for entry in steps:
        side = f"{folder}/{entry['store'].removesuffix('.zarr')}.fields"
        if not storage.exists(side):
            inputs = model_inputs(ModelRun(small, run.predictor), source, entry["step_hours"])
            assemble.orientation_fields(inputs, small, source.grid).write.mode("overwrite").parquet(side)
            made += 1
    return made


def prune(spark: SparkSession, root: str, today: datetime, days: int) -> list[str]:
    """Delete stores and side files past their time; returns what was deleted."""
    storage = Storage(spark)
    gone = catalog.expired(storage.table(root), F.lit(today.date()), days).orderBy("model", "name").collect()  # names of stores
    for r in gone:
        storage.delete(f"{root}/{r.model}/{r.name}")
    return [f"{root}/{r.model}/{r.name}" for r in gone]


def requantize(spark: SparkSession, root: str, to: str, prune_stale: bool = False) -> dict[str, str]:
    """Copy all stores packed: skip whole ones, copy packed ones, pack the rest; pointers come last."""
    storage, out = Storage(spark), {}
    for model, folder, _ in storage.names(root):
        stores = [n for n, f, _ in storage.names(f"{root}/{model}") if f and n.endswith(".zarr")] if folder else []
        for name in stores:
            source, target = f"{root}/{model}/{name}", f"{to}/{model}/{name}"
            if storage.exists(f"{target}/_SUCCESS"):
                out[f"{model}/{name}"] = "skipped"
                continue
            store = spark.read.parquet(source)
            out[f"{model}/{name}"] = "copied" if pyramid.is_packed(store) else "packed"
            storage.delete(target)
            pyramid.requantized(store).write.mode("overwrite").partitionBy("level", "cls").parquet(f"{to}/{model}/.{name}.draft")
            storage.move(f"{to}/{model}/.{name}.draft", target)
        if prune_stale:
            for name, is_folder, _ in storage.names(f"{to}/{model}"):
                if is_folder and name.endswith(".zarr") and name not in stores:
                    storage.delete(f"{to}/{model}/{name}")
        if folder and storage.exists(f"{root}/{model}/latest.json"):
            storage.write_text(f"{to}/{model}/latest.json", storage.read_text(f"{root}/{model}/latest.json"))
    return out


def prune_cache(spark: SparkSession, path: str, today: datetime, days: int) -> list[str]:
    """Delete downloaded files past their time, by the date in their names; returns what was deleted."""
    storage = Storage(spark)
    listed = spark.createDataFrame([(n, folder) for n, folder, _ in storage.names(path)], "name string, is_folder boolean")
    gone = [r.name for r in catalog.expired_cache(listed, F.lit(today.date()), days).orderBy("name").collect()]  # names in one folder
    for name in gone:
        storage.delete(f"{path}/{name}")
    return gone


def pending_cycle(spark: SparkSession, available: DataFrame, models: Sequence[str], root: str, now: datetime) -> tuple[str, int] | None:
    """The newest published cycle of the last day (date, hour), unless every model has all its steps.

    ``available`` has (cycle, step); older cycles that were missed are not caught up with.
    """
    found = catalog.newest_published(available, F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")).first()
    if found is None:
        log.info("no cycle of the last day is published")
        return None
    date, hour = found.cycle.strftime("%Y-%m-%d"), found.cycle.hour
    wanted = spark.createDataFrame([(m, f"{date} {hour:02d}") for m in models], "model string, at string").select("model", F.to_timestamp("at", "yyyy-MM-dd HH").alias("cycle"))
    present = catalog.stores(Storage(spark).table(root))
    if not catalog.completeness(present, wanted).where(~F.col("complete")).limit(1).count():
        log.info("%s %02dZ is whole", date, hour)
        return None
    return date, hour


def main(argv: Sequence[str] | None = None, predictor: tiling.Predictor | None = None, now: datetime | None = None) -> int:
    """Run one cycle over staged fields: with --poll the newest published one, if it lacks steps; else the newest that is old enough, or the one named.

    Returns 1 if a cycle was run and has no good step.
    """
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--fields", required=True, help="folder of staged fields; with --poll of staged cycles")
    parser.add_argument("--output", required=True, help="folder of stores")
    parser.add_argument("--model", required=True)
    parser.add_argument("--onnx", help="model file")
    parser.add_argument("--poll", action="store_true", help="run the newest cycle whose first step is staged, if it lacks any")
    parser.add_argument("--cycle", help="date and hour, as 2026-08-20T18; otherwise by --lag")
    parser.add_argument("--lag", type=int, default=7, help="hours after which a cycle counts as published")
    parser.add_argument("--rows", type=int, default=721)
    parser.add_argument("--cols", type=int, default=1440)
    parser.add_argument("--keep-days", type=int, default=7)
    parser.add_argument("--cache", help="folder of downloads to prune")
    parser.add_argument("--fronts", action="store_true")
    parser.add_argument("--pressure", action="store_true")
    parser.add_argument("--threshold", type=float, default=0.25)
    parser.add_argument("--patch", type=int, default=256)
    parser.add_argument("--overlap", type=int, default=96)
    args = parser.parse_args(argv)
    from isallobar.sources.fields import StagedCycles, StagedSource

    if predictor is None:
        if not args.onnx:
            parser.error("--onnx names the model file")
        predictor = tiling.OnnxPredictor(args.onnx)
    spark = SparkSession.builder.appName("isallobar cycle").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now = now or datetime.now(timezone.utc)
    grid = Grid(args.rows, args.cols)
    if args.poll:
        cycles = StagedCycles(spark, args.fields, grid)
        if (target := pending_cycle(spark, cycles.available(), [args.model], args.output, now)) is None:
            return 0
        date, hour = target
        source = cycles.open(date, hour)
    else:
        then = datetime.strptime(args.cycle, "%Y-%m-%dT%H") if args.cycle else now - timedelta(hours=args.lag)
        date, hour = then.strftime("%Y-%m-%d"), then.hour // 6 * 6
        source = StagedSource(spark, args.fields, grid)
    run = ModelRun(get_model(args.model), predictor, patch=args.patch, overlap=args.overlap, fronts=args.fronts, pressure=args.pressure, settings=Settings(threshold=args.threshold))
    done = run_cycle([run], source, date, hour, args.output)
    try:
        prune(spark, args.output, now, args.keep_days)
        if args.cache:
            prune_cache(spark, args.cache, now, args.keep_days)
    except Exception:
        log.exception("nothing is pruned")
    return 0 if done else 1


if __name__ == "__main__":
    raise SystemExit(main())
