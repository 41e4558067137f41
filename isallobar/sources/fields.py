"""Field sources: each gives long rows (step, variable, level, r, c, v) of one cycle."""

from __future__ import annotations

import io
import re
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from isallobar.operators.grid import Grid
from isallobar.plans.manifest import SHORT_NAMES
from isallobar.sources.storage import Storage

FIELD = "step int, variable string, level int, r int, c int, v double"
# Centre, spread and range of synthetic variables.
SHAPES = {"temperature": (288.0, 5.0, None), "specific_humidity": (0.005, 0.002, (1e-6, 0.03)), "surface_pressure": (101_325.0, 500.0, None), "mean_sea_level_pressure": (101_325.0, 500.0, None)}


class GridSource(ABC):
    """One cycle's fields on one grid."""

    spark: SparkSession
    grid: Grid

    @abstractmethod
    def fields(self, variables: Sequence[str], levels: Sequence[int], steps: Sequence[int]) -> DataFrame:
        """Pressure-level variables at the levels, and single-level ones (level null)."""

    @abstractmethod
    def static(self, variables: Sequence[str]) -> DataFrame:
        """Invariant fields as (variable, r, c, v)."""

    def at_level(self, variable: str, level: int, step: int) -> DataFrame:
        """One field at one level; raises at run time if the source has another level only."""
        found = self.fields([variable], [level], [step]).where((F.col("variable") == variable) & (F.col("step") == step))
        return found.where(F.assert_true(F.col("level") == level, f"{variable} is not on level {level}").isNull()).select("r", "c", "v")

    def single(self, variable: str, step: int) -> DataFrame:
        """One single-level field."""
        return self.fields([variable], [], [step]).where((F.col("variable") == variable) & F.col("level").isNull() & (F.col("step") == step)).select("r", "c", "v")


def uniform(*key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    return (F.pmod(F.xxhash64(*key), F.lit(1 << 48)) + 0.5) / float(1 << 48)


def normal(*key: Column) -> Column:
    """A standard normal number that depends on the key alone."""
    return F.sqrt(-2 * F.ln(uniform(*key, F.lit("a")))) * F.cos(2 * F.pi() * uniform(*key, F.lit("b")))


class SyntheticSource(GridSource):
    """Deterministic normal values for every variable, level, step and cell, made where they are used."""

    def __init__(self, spark: SparkSession, grid: Grid, cycle: str = "1970-01-01T00", seed: int = 0, single: Sequence[str] = ("surface_pressure", "mean_sea_level_pressure", "2m_temperature", "2m_dewpoint_temperature", "10m_u_component_of_wind", "10m_v_component_of_wind")) -> None:
        self.spark, self.grid, self.cycle, self.seed, self.singles = spark, grid, cycle, seed, tuple(single)

    def _values(self, named: DataFrame) -> DataFrame:
        cells = named.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(self.grid.rows - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(self.grid.cols - 1))))
        noise = normal(F.lit(self.seed), F.lit(self.cycle), "step", "variable", F.coalesce("level", F.lit(-1)), "r", "c")
        value = F.lit(5.0) * noise
        for name, (centre, spread, span) in SHAPES.items():
            middle = F.lit(centre) - (0.05 * (1000 - F.coalesce("level", F.lit(1000))) if name == "temperature" else 0.0)
            own = middle + spread * noise
            own = F.least(F.lit(span[1]), F.greatest(F.lit(span[0]), own)) if span else own
            value = F.when(F.col("variable") == name, own).otherwise(value)
        return cells.withColumn("v", value)

    def fields(self, variables: Sequence[str], levels: Sequence[int], steps: Sequence[int]) -> DataFrame:
        rows = [(s, v, p) for s in steps for v in variables for p in ([None] if v in self.singles else levels)]
        return self._values(self.spark.createDataFrame(rows, "step int, variable string, level int"))

    def static(self, variables: Sequence[str]) -> DataFrame:
        named = self.spark.createDataFrame([(0, v, None) for v in variables], "step int, variable string, level int")
        return self._values(named).select("variable", "r", "c", (F.abs("v") * 100).alias("v"))


class StagedSource(GridSource):
    """Fields staged as Parquet, partitioned by step and variable; filters prune files."""

    def __init__(self, spark: SparkSession, path: str, grid: Grid) -> None:
        self.spark, self.path, self.grid = spark, path, grid

    def fields(self, variables: Sequence[str], levels: Sequence[int], steps: Sequence[int]) -> DataFrame:
        storage = Storage(self.spark)
        if missing := [s for s in steps if not storage.exists(f"{self.path}/fields/step={s}")]:
            raise FileNotFoundError(f"steps {missing} are not staged in {self.path}")
        staged = self.spark.read.schema(FIELD).parquet(f"{self.path}/fields")
        return staged.where(F.col("step").isin(*steps) & F.col("variable").isin(*variables) & (F.col("level").isNull() | F.col("level").isin(*levels)))

    def static(self, variables: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/static").where(F.col("variable").isin(*variables)).select("variable", "r", "c", "v")

    def steps(self) -> DataFrame:
        """Steps and variables that are staged: an availability table from file names alone."""
        return self.spark.read.schema(FIELD).parquet(f"{self.path}/fields").select("step", "variable").distinct()


def stage(source: GridSource, path: str, variables: Sequence[str], levels: Sequence[int], steps: Sequence[int], static: Sequence[str] = ()) -> StagedSource:
    """Fetch once: write what is not staged yet, one folder for each step, and read it from there.

    A step's folder gets its name only when it is whole, so a broken run leaves nothing that
    would be taken for data.
    """
    spark = source.spark
    storage = Storage(spark)
    for step in steps:
        target = f"{path}/fields/step={step}"
        if not storage.exists(target):
            source.fields(variables, levels, [step]).drop("step").write.mode("overwrite").partitionBy("variable").parquet(f"{path}/staging/step={step}")
            storage.move(f"{path}/staging/step={step}", target)
    if static and not storage.exists(f"{path}/static"):
        source.static(static).write.mode("overwrite").parquet(f"{path}/static-staging")
        storage.move(f"{path}/static-staging", f"{path}/static")
    return StagedSource(spark, path, source.grid)


def read_arrays(spark: SparkSession, path: str, pattern: str = "*.npy") -> DataFrame:
    """Arrays saved as .npy files: (file, r, c, v) of two-dimensional ones, read where the files are.

    Files that cannot be read as an array give one row with ``error`` set instead of stopping the job.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.string())
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                file = name.rsplit("/", 1)[-1]
                try:
                    field = np.load(io.BytesIO(content.as_py()), allow_pickle=False)
                    if field.ndim != 2:
                        raise ValueError(f"{field.ndim} dimensions")
                    r, c = np.indices(field.shape)
                    columns = [[file] * field.size, r.ravel(), c.ravel(), field.astype(float).ravel(), [None] * field.size]
                except (ValueError, EOFError, OSError) as e:
                    columns = [[file], [None], [None], [None], [str(e)]]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["file", "r", "c", "v", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(work, "file string, r int, c int, v double, error string")


Message = tuple[str, int | None, np.ndarray]


class DecodedSource(GridSource):
    """Downloaded files of one cycle, decoded where they are read.

    Files are named ``<date>_<hh>z_f<step>_<short name>....grib2``; only those of the steps and
    variables asked for are opened.  ``decode`` turns a file's bytes into messages (short name,
    level or None, values from the north and the west); any GRIB library will do.  A file that
    cannot be decoded fails the step that needs it.
    """

    def __init__(self, spark: SparkSession, path: str, grid: Grid, decode: Callable[[bytes], Iterable[Message]], static: DataFrame | None = None) -> None:
        self.spark, self.path, self.grid, self.decode, self._static = spark, path, grid, decode, static

    def fields(self, variables: Sequence[str], levels: Sequence[int], steps: Sequence[int]) -> DataFrame:
        if odd := sorted(set(variables) - set(SHORT_NAMES)):
            raise ValueError(f"no short name is known for {odd}")
        short = {SHORT_NAMES[v]: v for v in variables}
        glob = "{" + ",".join(f"*z_f{s:03d}_{n}[._]*grib2" for s in steps for n in short) + "}"
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", glob).load(self.path)
        step = F.regexp_extract("path", r"z_f(\d{3})_[^/]*$", 1).cast("int").alias("step")
        decode, shape, wanted = self.decode, (self.grid.rows, self.grid.cols), set(levels)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            r, c = (x.ravel().astype(np.int32) for x in np.indices(shape))
            for batch in batches:
                for at, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    for name, level, values in decode(content.as_py()):
                        if name not in short or (level is not None and level not in wanted):
                            continue
                        if values.shape != shape:
                            raise ValueError(f"{name} has {values.shape} values, not {shape}")
                        columns = (pa.array([at] * values.size, pa.int32()), pa.array([short[name]] * values.size), pa.array([level] * values.size, pa.int32()), pa.array(r), pa.array(c), pa.array(values.ravel().astype(float)))
                        yield pa.RecordBatch.from_arrays(list(columns), names=["step", "variable", "level", "r", "c", "v"])

        return files.select(step, "content").mapInArrow(work, FIELD)

    def static(self, variables: Sequence[str]) -> DataFrame:
        if self._static is None:
            raise ValueError("the source has no static fields")
        return self._static.where(F.col("variable").isin(*variables)).select("variable", "r", "c", "v")


@dataclass(frozen=True)
class StagedCycles:
    """Staged cycles, one folder ``<date>T<hh>Z`` for each."""

    spark: SparkSession
    path: str
    grid: Grid

    def available(self) -> DataFrame:
        """(cycle, step) of what is staged, from folder names alone."""
        storage = Storage(self.spark)
        rows = []
        for name, folder, _ in storage.names(self.path):
            if folder and re.fullmatch(r"\d{4}-\d{2}-\d{2}T\d{2}Z", name):
                steps = [n for n, is_folder, _ in storage.names(f"{self.path}/{name}/fields") if is_folder]
                rows += [(name, int(n.removeprefix("step="))) for n in steps if re.fullmatch(r"step=\d+", n)]
        named = self.spark.createDataFrame(rows, "name string, step int")
        return named.select(F.try_to_timestamp(F.regexp_replace(F.regexp_replace("name", "Z$", ""), "T", " "), F.lit("yyyy-MM-dd HH")).alias("cycle"), "step").where("cycle IS NOT NULL")

    def folder(self, date: str, hour: int) -> str:
        return f"{self.path}/{date}T{hour:02d}Z"

    def open(self, date: str, hour: int) -> StagedSource:
        return StagedSource(self.spark, self.folder(date, hour), self.grid)


class GridDataSource(DataSource):
    """``spark.read.format("isallobar_grid")``: synthetic fields, one partition for each step and variable.

    Options: rows, cols, steps and variables (comma-separated), seed.
    """

    @classmethod
    def name(cls) -> str:
        return "isallobar_grid"

    def schema(self) -> str:
        return FIELD

    def reader(self, schema) -> DataSourceReader:
        return _GridReader(dict(self.options))


class _GridPartition(InputPartition):
    def __init__(self, step: int, variable: str) -> None:
        self.step, self.variable = step, variable


class _GridReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.rows, self.cols, self.seed = (int(options.get(k, d)) for k, d in (("rows", "24"), ("cols", "48"), ("seed", "0")))
        self.steps = [int(s) for s in options.get("steps", "0").split(",")]
        self.variables = options.get("variables", "temperature").split(",")

    def partitions(self) -> list[InputPartition]:
        return [_GridPartition(s, v) for s in self.steps for v in self.variables]

    def read(self, partition: _GridPartition) -> Iterator[pa.RecordBatch]:
        centre, spread, span = SHAPES.get(partition.variable, (0.0, 5.0, None))
        key = [self.seed, partition.step, *partition.variable.encode()]
        values = np.random.default_rng(key).normal(centre, spread, self.rows * self.cols)
        values = np.clip(values, *span) if span else values
        r, c = np.indices((self.rows, self.cols))
        n = values.size
        yield pa.RecordBatch.from_arrays(
            [pa.array([partition.step] * n, pa.int32()), pa.array([partition.variable] * n), pa.nulls(n, pa.int32()), pa.array(r.ravel(), pa.int32()), pa.array(c.ravel(), pa.int32()), pa.array(values)],
            names=["step", "variable", "level", "r", "c", "v"],
        )
