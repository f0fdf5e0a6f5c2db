"""A few driver-side folder operations through Spark's own file system client."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import SparkSession


class Folder:
    """Existence, listing and removal of folders; data files are never read here."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(conf)

    def _at(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(
            f"{self.path}/{relative}" if relative else self.path
        )

    def exists(self, relative: str = "") -> bool:
        return self._fs.exists(self._at(relative))

    def is_folder(self) -> bool:
        return self._fs.exists(self._root) and self._fs.getFileStatus(self._root).isDirectory()

    def names(self, relative: str = "") -> list[str]:
        if not self.exists(relative):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(relative)))

    def files(self, relative: str = "") -> list[str]:
        if not self.exists(relative):
            return []
        statuses = self._fs.listStatus(self._at(relative))
        return sorted(s.getPath().getName() for s in statuses if s.isFile())

    def folders(self, pattern: str) -> list[str]:
        """Relative paths of the folders that match a glob below this one."""
        found = self._fs.globStatus(self._at(pattern)) or []
        depth = len(pattern.split("/"))
        out = []
        for s in found:
            if s.isDirectory():
                out.append("/".join(s.getPath().toString().split("/")[-depth:]))
        return sorted(out)

    def modified(self, relative: str) -> datetime:
        """When a file or folder was last changed, in UTC without a zone."""
        millis = self._fs.getFileStatus(self._at(relative)).getModificationTime()
        return datetime(1970, 1, 1) + timedelta(milliseconds=millis)

    def read_text(self, relative: str) -> str:
        stream = self._fs.open(self._at(relative))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, relative: str, text: str) -> None:
        """Create a file at once: written aside, then renamed; an existing file is an error."""
        if self.exists(relative):
            raise FileExistsError(f"{self.path}/{relative}")
        aside = self._at(f"{relative}.writing")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not self._fs.rename(aside, self._at(relative)):
            raise FileExistsError(f"{self.path}/{relative}")

    def size(self, relative: str = "") -> int:
        """Bytes of all files below."""
        return self._fs.getContentSummary(self._at(relative)).getLength()

    def remove(self, relative: str, recursive: bool = False) -> bool:
        return self._fs.delete(self._at(relative), recursive)
