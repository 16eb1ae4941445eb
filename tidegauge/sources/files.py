"""File operations on the shared file system, through the Hadoop client Spark already uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._to_text = spark._jvm.org.apache.commons.io.IOUtils.toString
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self._fs(path).getFileStatus(self._path(path)).isFile()

    def children(self, path: str) -> list[str]:
        """Names directly below a folder, sorted; empty where the folder does not exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs(path).listStatus(self._path(path)))

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._to_text(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        self.write_bytes(path, text.encode("utf-8"))

    def write_bytes(self, path: str, data: bytes) -> None:
        """Write next to the final name, then rename, so that readers never see half a file."""
        draft = f"{path}.draft"
        fs = self._fs(path)
        stream = fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        if not fs.rename(self._path(draft), self._path(path)):
            raise OSError(f"could not write {path}")

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)
