"""Small files that say what is part of a table: each appears whole and once, or not at all."""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession


class CommitLog:
    """Named JSON entries in a folder of a Hadoop file system.

    An entry is written under another name and renamed without overwriting, which such file systems do at once: whoever is second
    with a name is told so, and an entry that a lost writer left half-way has no name.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def names(self) -> list[str]:
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        store = top.getFileSystem(self._conf())
        if not store.exists(top):
            return []
        found = (s.getPath().getName() for s in store.listStatus(top))
        return sorted(unquote(n.removesuffix(".json")) for n in found if n.endswith(".json"))

    def has(self, name: str) -> bool:
        path = self._path(quote(name, safe="") + ".json")
        return path.getFileSystem(self._conf()).exists(path)

    def read(self, name: str) -> dict:
        path = self._path(quote(name, safe="") + ".json")
        stream = path.getFileSystem(self._conf()).open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def add(self, name: str, entry: dict) -> bool:
        """Whether the entry was added; False if there is one of this name already."""
        from py4j.protocol import Py4JJavaError

        draft, final = self._path(f".{uuid.uuid4().hex}.draft"), self._path(quote(name, safe="") + ".json")
        store = final.getFileSystem(self._conf())
        out = store.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), self._conf())
        try:
            files.rename(store.makeQualified(draft), store.makeQualified(final), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as error:
            store.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        path = self._path(quote(name, safe="") + ".json")
        path.getFileSystem(self._conf()).delete(path, False)
