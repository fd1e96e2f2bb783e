"""Replacing part of a table in one step, and numbers that two writers cannot both take.

What belongs to one key (a run, a day) is written into a folder of its own
generation; a marker, made when everything is there, tells readers to use it.  A
writer that dies before leaves the generation before it in place.  Numbers are
taken by creating a file that must not exist yet, so two writers of one key get
two generations, and the one that began later counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Characters that Spark writes as %XX in the name of a partition's folder.
ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | {chr(n) for n in range(1, 32)}
MARKS = "_generations"


def folder_of(column: str, value: str) -> str:
    """The folder of a partition, named as Spark names it."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def _value_of(folder: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), folder.partition("=")[2])


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already."""
    files, place = _place(spark, path)
    try:
        files.create(place, False).close()
    except Py4JJavaError as problem:
        if "FileAlreadyExists" in problem.java_exception.getClass().getName():
            return False
        raise
    return True


def _names(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """(folder, file) of the files that match ``pattern``."""
    files, place = _place(spark, pattern)
    return [(s.getPath().getParent().getName(), s.getPath().getName()) for s in files.globStatus(place) or []]


def take_number(spark: SparkSession, folder: str, at_least: int = 1, ending: str = "") -> int:
    """The lowest number from ``at_least`` on that is above all taken ones; it is taken now."""
    taken = [int(name.partition(".")[0]) for _, name in _names(spark, f"{folder}/[0-9]*")]
    number = max([at_least - 1, *taken]) + 1
    while not create_new(spark, f"{folder}/{number:08d}{ending}"):
        number += 1
    return number


@dataclass(frozen=True)
class Generation:
    """One writer's share of a key: nothing of it is read before ``commit``."""

    spark: SparkSession
    base: str
    column: str
    value: str
    number: int

    def folder(self, table: str) -> str:
        return f"{self.base}/{table}/{folder_of(self.column, self.value)}/generation={self.number}"

    def append(self, df: DataFrame, table: str, *partitions: str) -> None:
        """Write rows of the key; they do not have the key's own column any more."""
        df.drop(self.column).write.mode("append").partitionBy(*partitions).parquet(self.folder(table))

    def commit(self) -> None:
        """From now on readers take this generation, unless one that began later is there."""
        create_new(self.spark, f"{self.base}/{MARKS}/{folder_of(self.column, self.value)}/{self.number:08d}.done")


def begin(spark: SparkSession, base: str, column: str, value: str) -> Generation:
    """A new generation of what belongs to ``value``, for this writer alone."""
    folder = f"{base}/{MARKS}/{folder_of(column, value)}"
    return Generation(spark, base, column, value, take_number(spark, folder, ending=".open"))


def committed(spark: SparkSession, base: str, column: str) -> dict[str, int]:
    """The generation of every key that readers take."""
    latest: dict[str, int] = {}
    for folder, name in _names(spark, f"{base}/{MARKS}/{column}=*/*.done"):
        value = _value_of(folder)
        latest[value] = max(latest.get(value, 0), int(name.partition(".")[0]))
    return latest


def read_committed(
    spark: SparkSession, base: str, table: str, column: str, schema: T.StructType, value: str | None = None
) -> DataFrame:
    """The rows of all keys, or of one, as they are now; what is committed later is not mixed in."""
    latest = committed(spark, base, column)
    chosen = latest if value is None else {v: n for v, n in latest.items() if v == value}
    folders = []
    for key, number in sorted(chosen.items()):
        folder = f"{base}/{table}/{folder_of(column, key)}/generation={number}"
        files, place = _place(spark, folder)
        if files.exists(place):
            folders.append(folder)
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", f"{base}/{table}").parquet(*folders)
    return found.select(*schema.names)


def vacuum(spark: SparkSession, base: str, column: str, tables: tuple[str, ...]) -> int:
    """Remove generations older than the one that readers take; returns how many folders went.

    To be called when nobody reads an earlier state any more.  Younger ones are left:
    their writers may still be at work.
    """
    gone = 0
    for value, number in committed(spark, base, column).items():
        for table in tables:
            files, place = _place(spark, f"{base}/{table}/{folder_of(column, value)}")
            for status in files.listStatus(place) if files.exists(place) else []:
                name = status.getPath().getName()
                if name.startswith("generation=") and int(name.partition("=")[2]) < number:
                    gone += bool(files.delete(status.getPath(), True))
    return gone
