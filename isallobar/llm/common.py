"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rough number of characters handled by one round of vectorised work.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole input table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(df: DataFrame, name: str) -> Column:
    """The column called exactly so, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, out of the way of names that an operator adds."""
    return F.struct(*(named(df, c).alias(c) for c in df.columns)).alias("row")


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset and the master
    is local (tests on one machine) a temporary folder is made and remembered.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("isallobar.shared.dir", None)
    if not found:
        own = spark._jsc.sc().getCheckpointDir()
        if own.isDefined():
            return own.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="isallobar-")
        spark.conf.set("isallobar.shared.dir", found)
    return found


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts lineage: later jobs, and retries after a lost executor, reread
    files that every machine sees.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/isallobar/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files behind a settled frame that nothing reads any more."""
    path = getattr(df, "_settled_at", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Settled frames of one operator, deleted together once its own result is settled."""

    def __init__(self) -> None:
        self.held: list[DataFrame] = []

    def settle(self, df: DataFrame, label: str) -> DataFrame:
        self.held.append(settle(df, label))
        return self.held[-1]

    def clear(self) -> None:
        for df in self.held:
            discard(df)
        self.held.clear()


def slices(sizes: Iterable[int], budget: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to about ``budget`` (one item at least)."""
    start = held = count = 0
    for size in sizes:
        if count > start and held + size > budget:
            yield start, count
            start, held = count, 0
        held += size
        count += 1
    if count > start:
        yield start, count


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]
