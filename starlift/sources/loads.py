"""A table's loads: every write is a folder of its own, and shows only when it has ended.

    {place}/load_id=7/[order_month=202001/]part-...     the rows of the seventh write
    {place}/load_id=7/_SUCCESS                           the write has ended

A write that dies leaves a folder without the mark: no reader sees it, and the next write of
the table removes it. So an append is there whole or not at all, and an overwrite leaves the
earlier rows in place until its own are complete. What a write replaces is told by an empty
file put into its folder before its rows: all earlier loads, the earlier copies of its own
partition values, or nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

COLUMN = "load_id"

# The mark of Hadoop's committer, and the files that tell what a load replaces.
ENDED = "_SUCCESS"
APPENDS, REPLACES_PARTITIONS, REPLACES_TABLE = "", "_REPLACES_PARTITIONS", "_REPLACES_TABLE"

# How the folder of a NULL partition value is called.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Load:
    """What an ended write replaces, and the partition folders it has ('' for a plain table)."""

    replaces: str
    values: tuple[str, ...]


def base(loads: dict[int, Load]) -> int:
    """The newest load that replaced the whole table; earlier ones don't count."""
    return max((number for number, load in loads.items() if load.replaces == REPLACES_TABLE), default=0)


def shown(loads: dict[int, Load]) -> list[tuple[int, str]]:
    """The (load, partition folder) pairs that make up the table."""
    start = base(loads)
    newest: dict[str, int] = {}
    for number in sorted(loads):
        if loads[number].replaces == REPLACES_PARTITIONS and number >= start:
            newest |= dict.fromkeys(loads[number].values, number)
    every = [(number, value) for number in sorted(loads) if number >= start for value in loads[number].values]
    return [(number, value) for number, value in every if number >= newest.get(value, 0)]


def outdated(loads: dict[int, Load]) -> list[tuple[int, str | None]]:
    """What neither the table nor its state before the last load is made of: whole loads (None)
    and single partition folders. The state before is kept for readers that have begun on it."""
    if not loads:
        return []
    now = set(shown(loads)) | set(shown({number: load for number, load in loads.items() if number < max(loads)}))
    kept = {number for number, _ in now} | {max(loads), base(loads)}
    found: list[tuple[int, str | None]] = [(number, None) for number in loads if number not in kept]
    return found + [(number, value) for number in sorted(kept & set(loads)) for value in loads[number].values if (number, value) not in now]


class LoadFolders:
    """The loads under one folder. What an ended load holds is listed once."""

    def __init__(self, spark: SparkSession, place: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path(place)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._known: dict[int, Load] = {}
        self._last = 0

    def _child(self, *names: str):
        path = self._path
        for name in names:
            path = self._jvm.org.apache.hadoop.fs.Path(path, name)
        return path

    def _names(self, path) -> list[str]:
        return [status.getPath().getName() for status in self._files.listStatus(path)]

    def folder(self, number: int) -> str:
        return self._child(f"{COLUMN}={number}").toString()

    def ended(self) -> dict[int, Load]:
        """All writes that have ended, by number."""
        names = self._names(self._path) if self._files.exists(self._path) else []
        numbers = [int(name.removeprefix(f"{COLUMN}=")) for name in names if re.fullmatch(rf"{COLUMN}=\d+", name)]
        strange = [name for name in names if not name.startswith((f"{COLUMN}=", "_", "."))]
        if strange:
            raise RuntimeError(f"{self._path.toString()} holds {strange[0]}, which no load wrote")
        known = {number: self._known[number] for number in numbers if number in self._known}
        for number in set(numbers) - set(known):
            inside = self._names(self._child(f"{COLUMN}={number}"))
            if ENDED in inside:
                replaces = next((name for name in (REPLACES_TABLE, REPLACES_PARTITIONS) if name in inside), APPENDS)
                folders = tuple(sorted(name for name in inside if "=" in name))
                rows = [name for name in inside if not name.startswith(("_", "."))]
                known[number] = Load(replaces, folders if folders or not rows else ("",))
        self._known = known
        return dict(known)

    def begin(self, replaces: str) -> int:
        """A folder for the next write. What earlier ones left behind half done goes, and so
        does what has not been part of the table for a whole load."""
        ended = self.ended()
        names = self._names(self._path) if self._files.exists(self._path) else []
        unfinished = [name for name in names if name.startswith(f"{COLUMN}=") and int(name.split("=")[1]) not in ended]
        for name in unfinished:
            self._files.delete(self._child(name), True)
        for number, value in outdated(ended):
            self._files.delete(self._child(f"{COLUMN}={number}", *([value] if value else [])), True)
            self._known.pop(number, None)  # listed anew
        # A number is not used again in this process, in case a lost task still writes to it.
        self._last = max([*ended, *(int(name.split("=")[1]) for name in unfinished), self._last]) + 1
        folder = self._child(f"{COLUMN}={self._last}")
        self._files.mkdirs(folder)
        if replaces:
            self._files.create(self._jvm.org.apache.hadoop.fs.Path(folder, replaces)).close()
        return self._last

    def end(self, number: int) -> None:
        """Let the write be seen. Committers that leave no mark get it here."""
        mark = self._child(f"{COLUMN}={number}", ENDED)
        if not self._files.exists(mark):
            self._files.create(mark).close()

    def give_up(self, number: int) -> None:
        self._files.delete(self._child(f"{COLUMN}={number}"), True)
        self._known.pop(number, None)

    def remove(self) -> None:
        """Delete the folder with all loads."""
        self._files.delete(self._path, True)
        self._known = {}
