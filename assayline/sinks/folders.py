"""Small file operations on whatever store a path lies in, through Spark's Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession):
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._conf = context._jsc.hadoopConfiguration()

    def _at(self, path: str):
        path = self._path(path)
        return path.getFileSystem(self._conf), path

    def names(self, folder: str) -> list[str]:
        """What lies in a folder; nothing if there is none."""
        store, path = self._at(folder)
        return [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []

    def matching(self, pattern: str) -> list[str]:
        """Paths that match a pattern, without the store's name if the pattern had none."""
        store, path = self._at(pattern)
        return [str(s.getPath().toString()) for s in store.globStatus(path) or []]

    def exists(self, path: str) -> bool:
        store, path = self._at(path)
        return store.exists(path)

    def write(self, path: str, content: str = "") -> None:
        """A small file, written at once; one of that name is replaced."""
        store, path = self._at(path)
        out = store.create(path, True)
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        """The content of a small file."""
        store, path = self._at(path)
        size = store.getFileStatus(path).getLen()
        source = store.open(path)
        try:
            return bytes(source.readNBytes(int(size))).decode()
        finally:
            source.close()

    def remove(self, path: str) -> None:
        store, path = self._at(path)
        store.delete(path, True)
