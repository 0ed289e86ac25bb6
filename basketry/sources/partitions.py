"""The partition folders of a stored table: what there is, and dropping some whole."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

#: the folder value of a null
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Folder:
    """A path in whatever store Spark reads it from."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._make(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def names(self) -> list[str]:
        """What the folder holds, in order; nothing if it is not there."""
        if not self.exists():
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._make(self.path)))

    def drop(self, name: str = "") -> None:
        self._files.delete(self._at(name), True)

    def _at(self, name: str):
        return self._make(self.path, name) if name else self._make(self.path)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's partition folders, which are listed, not read."""
    mark = f"{column}="
    return [name.removeprefix(mark) for name in Folder(spark, path).names() if name.startswith(mark)]


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    folder = Folder(spark, path)
    for value in values:
        folder.drop(f"{column}={value}")
