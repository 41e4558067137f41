"""Small file operations through Hadoop's file systems, so any store that Spark reaches will do."""

from __future__ import annotations

import json
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: that of ``spark.checkpoint.dir``, else, on one machine, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="isallobar-")


class Storage:
    """List, move, delete and write small files."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self, path: str) -> bool:
        files, where = self._at(path)
        return files.exists(where)

    def names(self, path: str) -> list[tuple[str, bool, int]]:
        """(name, is a folder, bytes) of what a folder holds, by name; nothing if there is no folder."""
        files, where = self._at(path)
        if not files.exists(where):
            return []
        return sorted((s.getPath().getName(), s.isDirectory(), s.getLen()) for s in files.listStatus(where))

    def table(self, root: str) -> DataFrame:
        """(model, name, is_folder, bytes) of everything one folder below ``root``."""
        rows = [(model, *found) for model, folder, _ in self.names(root) if folder for found in self.names(f"{root}/{model}")]
        return self.spark.createDataFrame(rows, "model string, name string, is_folder boolean, bytes long")

    def size(self, path: str) -> int:
        files, where = self._at(path)
        return files.getContentSummary(where).getLength()

    def contents(self, path: str) -> DataFrame:
        """Bytes and number of the files below a folder, from their listing alone."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count("*").alias("files"))

    def move(self, path: str, to: str) -> None:
        files, where = self._at(path)
        target = self._at(to)[1]
        files.mkdirs(target.getParent())
        if not files.rename(where, target):
            raise OSError(f"{path} cannot be moved to {to}")

    def delete(self, path: str) -> None:
        files, where = self._at(path)
        files.delete(where, True)

    def write_text(self, path: str, text: str) -> None:
        """Write beside the target, then rename over it."""
        files, where = self._at(f"{path}.tmp")
        out = files.create(where, True)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._at(path)[1]
        files.delete(target, False)
        if not files.rename(where, target):
            raise OSError(f"{path} cannot be written")

    def read_text(self, path: str) -> str:
        files, where = self._at(path)
        stream = files.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read_json(self, path: str) -> dict | None:
        return json.loads(self.read_text(path)) if self.exists(path) else None
