"""Small files on the tables' file system, and the manifest that says what a stored history consists of.

A version of the manifest is one file. It is written beside its place and renamed into it, so a reader finds either the old
version or the new one, and what a version does not name is not part of the table, whatever lies in the folders. One
compaction writes at a time; a version that is already there is an error.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, wherever it is stored; one that is not there is no error."""
    files, place = _place(spark, path)
    files.delete(place, True)


def listing(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order; none is no error."""
    files, place = _place(spark, pattern)
    return sorted(s.getPath().toString() for s in files.globStatus(place) or [])


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all; one that is there already is an error."""
    files, place = _place(spark, path)
    _, beside = _place(spark, f"{path}.writing")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(beside, place):
        raise FileExistsError(path)


@dataclass(frozen=True)
class Day:
    """A compacted day: the commit whose folder holds it, and the last micro-batch whose rows are in it."""

    commit: str
    through: int


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    days: dict[str, Day] = field(default_factory=dict)
    first: str = ""  # days before it are no part of the table any more

    def holds(self, day: str, batch: int) -> bool:
        """Whether a micro-batch's rows of a day are compacted or expired, so that their folder is not read."""
        return day < self.first or (day in self.days and batch <= self.days[day].through)


def _versions(spark: SparkSession, path: str) -> list[str]:
    return listing(spark, f"{path}_manifest/v*.json")


def current(spark: SparkSession, path: str) -> Manifest:
    """The newest version; before the first compaction an empty one."""
    versions = _versions(spark, path)
    if not versions:
        return Manifest()
    state = json.loads(read_text(spark, versions[-1]))
    return Manifest(state["version"], {d: Day(**x) for d, x in state["days"].items()}, state["first"])


def commit(spark: SparkSession, path: str, state: Manifest) -> None:
    body = {"version": state.version, "first": state.first, "days": {d: vars(x) for d, x in sorted(state.days.items())}}
    write_text(spark, f"{path}_manifest/v{state.version:012d}.json", json.dumps(body))


def forget_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    for old in _versions(spark, path)[:-keep]:
        remove(spark, old)
