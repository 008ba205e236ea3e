"""Folders on whatever file system a path names, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Paths below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, folder: str, prefix: str = "") -> list[str]:
        """Sorted names in a folder; none where it doesn't exist."""
        if not self.exists(folder):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(folder))) if n.startswith(prefix))

    def complete(self, folder: str, prefix: str) -> list[str]:
        """Names of finished Spark outputs in a folder."""
        return [n for n in self.names(folder, prefix) if self.exists(f"{folder}/{n}/_SUCCESS" if folder else f"{n}/_SUCCESS")]

    def create(self, name: str) -> bool:
        """Creates an empty file in one step; False where it stands already."""
        return self._fs.createNewFile(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
