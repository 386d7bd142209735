"""Small control files on the shared file system, through Hadoop's own client."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class ControlFiles:
    """JSON records that say which data folders count."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self.root = root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, folder: str) -> list[str]:
        """Sorted names of the records in a folder."""
        if not self.exists(folder):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))]
        return sorted(n for n in found if n.endswith(".json") and not n.startswith((".", "_")))

    def read(self, name: str) -> dict:
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, name: str, record: dict) -> None:
        """Write a record that is either whole or absent; an existing one is an error."""
        if self.exists(name):
            raise FileExistsError(f"{self.root}/{name}")
        draft = self._at(f"_draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(json.dumps(record).encode())
        finally:
            stream.close()
        self._fs.mkdirs(self._at(name).getParent())
        if not self._fs.rename(draft, self._at(name)):
            raise FileExistsError(f"{self.root}/{name}")

    def move(self, name: str, to: str) -> None:
        self._fs.mkdirs(self._at(to).getParent())
        self._fs.rename(self._at(name), self._at(to))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
