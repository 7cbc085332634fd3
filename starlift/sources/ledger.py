"""Which extracts a step has taken in: what did not change is not read again.

An extract is known by its place, its files' names, sizes and modification times, and by the rules
it was read with. The entry goes before a step begins and comes back when it has ended, so a step that
dies is done again whatever the extract looks like by then.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def files_of(spark: SparkSession, place: str) -> list[tuple[str, int, int]]:
    """(path below ``place``, bytes, time of the last change) of a file, or of all in a folder
    but for hidden ones."""
    path, files = _file_system(spark, place)
    if not files.exists(path):
        return []
    root, found = files.getFileStatus(path).getPath().toString(), []
    listed = files.listFiles(path, True)
    while listed.hasNext():
        status = listed.next()
        below = status.getPath().toString().removeprefix(root).strip("/")
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            found.append((below, status.getLen(), status.getModificationTime()))
    return sorted(found)


def signature(spark: SparkSession, place: str, *rules: object) -> str:
    """A digest of an extract's place and files and of the rules it is read with; '' if there are none."""
    found = files_of(spark, place)
    return hashlib.sha256(repr((place.rstrip("/"), found, rules)).encode()).hexdigest() if found else ""


class Ledger:
    """One small file for each step and entity under a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _entry(self, step: str, entity: str):
        return _file_system(self.spark, f"{self.folder}/{step}-{entity}")

    def holds(self, step: str, entity: str, mark: str) -> bool:
        """Whether the step has ended for an extract with this signature."""
        path, files = self._entry(step, entity)
        if not mark or not files.exists(path):
            return False
        stream = files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") == mark
        finally:
            stream.close()

    def forget(self, step: str, entity: str) -> None:
        path, files = self._entry(step, entity)
        files.delete(path, False)

    def record(self, step: str, entity: str, mark: str) -> None:
        path, files = self._entry(step, entity)
        stream = files.create(path, True)
        try:
            stream.write(bytearray(mark.encode()))
        finally:
            stream.close()
