"""Numbered commits: files that are created only if absent, so that of two writers one is told to look again."""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_DIGITS = 20


class CommitLog:
    """One JSON row per file, named by its version; versions have no gaps.

    A file is written under a hidden name and renamed without overwriting. That is atomic on HDFS and on object stores
    whose connector renames so; it goes through Hadoop's file system layer, like Spark's own streaming logs.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def _path(self, name: str = ""):
        """A path in Hadoop's terms, with its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def bootstrap(self) -> None:
        path, system = self._path()
        system.mkdirs(path)

    def exists(self) -> bool:
        path, system = self._path()
        return system.exists(path)

    def version(self) -> int:
        """Number of the newest commit, 0 if there is none."""
        path, system = self._path()
        names = [f.getPath().getName() for f in system.listStatus(path)]
        return max([int(n[:_DIGITS]) for n in names if len(n) == _DIGITS + 5 and n.endswith(".json")], default=0)

    def create(self, version: int, row: dict) -> bool:
        """Write a commit; false if that version is there already."""
        hidden, system = self._path(f".{uuid.uuid4().hex}")
        target, _ = self._path(f"{version:0{_DIGITS}d}.json")
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(system.getUri(), self.spark._jsc.hadoopConfiguration())
        out = system.create(hidden, False)
        out.write(bytearray((json.dumps({**row, "version": version}) + "\n").encode()))
        out.close()
        kind = getattr(hadoop, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(hidden, target, options)
        except Exception as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            system.delete(hidden, False)
            return False
        return True

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).json(self.path)
