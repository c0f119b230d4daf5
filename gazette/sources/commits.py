"""A log of numbered records, one small file each, that several writers may add to.

A record's file is written aside and then given its name in one step that fails
if the name is taken: by a hard link on local disks, elsewhere by a rename, which
HDFS refuses where the target exists. So of two writers with one number only one
succeeds. Records never change; an object reads each of them once.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self.folder = folder
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._known: dict[str, dict] = {}

    def names(self) -> list[str]:
        """Names of all records, in order."""
        folder = self._path(self.folder)
        if not self._files.exists(folder):
            return []
        found = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and n[0] not in "._")

    def read(self, name: str) -> dict:
        if name not in self._known:
            stream = self._files.open(self._path(f"{self.folder}/{name}.json"))
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            self._known[name] = json.loads(text)
        return self._known[name]

    def add(self, name: str, record: dict) -> bool:
        """Add a record; False if there is one of this name, which then stays."""
        aside = self._path(f"{self.folder}/_new-{uuid.uuid4().hex}")
        target = self._path(f"{self.folder}/{name}.json")
        self._files.mkdirs(self._path(self.folder))
        stream = self._files.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        try:
            return self._named(aside, target)
        finally:
            self._files.delete(aside, False)

    def _named(self, aside, target) -> bool:
        if self._files.getScheme() != "file":
            return not self._files.exists(target) and self._files.rename(aside, target)
        made, link = (self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (aside, target))
        try:
            self._jvm.java.nio.file.Files.createLink(link, made)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def remove(self, names: list[str]) -> None:
        for name in names:
            self._files.delete(self._path(f"{self.folder}/{name}.json"), False)
            self._known.pop(name, None)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
