"""A commit log on any file system: numbered entries, each created only where its number is still free.

An entry is a small JSON document. Two writers can't take one number: on HDFS and on stores with conditional writes a file is created
without overwriting; on local file systems a complete file is linked to its name, which fails where the name exists. An entry that is not
complete yet (its writer has taken the number and not closed the file) is not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitLog:
    """Entries under a folder, by number."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.folder = self.jvm.org.apache.hadoop.fs.Path(folder)
        self.fs = self.folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(self.folder)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, name)

    def put(self, number: int, entry: dict) -> bool:
        """Take a number for an entry; False if it is taken."""
        target, data = self._path(f"{number:012d}.json"), bytearray(json.dumps(entry, sort_keys=True, ensure_ascii=False).encode())
        try:
            if self.fs.getScheme() == "file":
                part = self._path(f".{uuid.uuid4().hex}.part")
                self._write(part, data)
                at = lambda p: self.jvm.java.io.File(self.fs.makeQualified(p).toUri().getPath()).toPath()
                try:
                    self.jvm.java.nio.file.Files.createLink(at(target), at(part))
                finally:
                    self.fs.delete(part, False)
            else:
                self._write(target, data)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _write(self, path, data: bytearray) -> None:
        out = self.fs.create(path, False)
        try:
            out.write(data)
        finally:
            out.close()

    def append(self, entry: dict) -> int:
        """The entry's number: the first free one after all others."""
        number = self.last() + 1
        while not self.put(number, entry):
            number += 1
        return number

    def numbers(self) -> list[int]:
        names = [f.getPath().getName() for f in self.fs.listStatus(self.folder)]
        return sorted(int(x[:-5]) for x in names if x.endswith(".json"))

    def last(self) -> int:
        return max(self.numbers(), default=0)

    def get(self, number: int) -> dict | None:
        """An entry; None if there is none, or it is not complete."""
        path = self._path(f"{number:012d}.json")
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        except ValueError:
            return None
        finally:
            stream.close()

    def entries(self) -> Iterator[tuple[int, dict]]:
        for number in self.numbers():
            if (entry := self.get(number)) is not None:
                yield number, entry

    def current(self) -> dict | None:
        """The last complete entry."""
        for number in reversed(self.numbers()):
            if (entry := self.get(number)) is not None:
                return entry
        return None
