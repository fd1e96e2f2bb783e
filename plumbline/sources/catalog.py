"""The dataset catalog: where each dataset is, who owns it, what it promises."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from plumbline.model import CATALOG_SCHEMA
from plumbline.sources.csv import read_csv

FILE_TYPES = ("parquet", "json", "orc")
# Files of these types are parsed whole, whatever columns are wanted.
ROW_FORMATS = ("csv", "json")

Entry = Mapping[str, Any]


def load_dataset(spark: SparkSession, entry: Entry, root: str | None = None) -> DataFrame:
    """A lazy DataFrame for one catalog entry; its ``options`` go to the reader."""
    kind = str(entry["source_type"]).lower()
    location = entry["source_location"]
    if kind == "table":
        return spark.table(location)
    if root and "://" not in location and not location.startswith("/"):
        location = f"{root.rstrip('/')}/{location}"
    if kind == "csv":
        return read_csv(spark, location, entry.get("schema"), **(entry.get("options") or {}))
    if kind in FILE_TYPES:
        reader = spark.read.format(kind).options(**(entry.get("options") or {}))
        if entry.get("schema") is not None:
            reader = reader.schema(entry["schema"])
        return reader.load(location)
    raise ValueError(f"Unsupported source_type: {entry['source_type']}")


def load_datasets(
    spark: SparkSession, entries: Iterable[Entry], root: str | None = None
) -> dict[str, DataFrame]:
    return {e["dataset_id"]: load_dataset(spark, e, root) for e in entries}


def row_formats(entries: Iterable[Entry]) -> list[str]:
    """The datasets whose files hold rows, not columns."""
    return [e["dataset_id"] for e in entries if str(e.get("source_type", "")).lower() in ROW_FORMATS]


def load_by_id(
    spark: SparkSession, entries: Iterable[Entry], dataset_id: str, root: str | None = None
) -> DataFrame:
    for entry in entries:
        if entry["dataset_id"] == dataset_id:
            return load_dataset(spark, entry, root)
    raise KeyError(dataset_id)


def catalog_table(spark: SparkSession, entries: Iterable[Entry]) -> DataFrame:
    """The catalog as a table, for the operators that work on all datasets at once."""
    rows = []
    for e in entries:
        age = e.get("freshness_max_age_days")
        rows.append(
            tuple(
                (None if age is None else str(age)) if f == "freshness_max_age_days" else e.get(f)
                for f in CATALOG_SCHEMA.fieldNames()
            )
        )
    return spark.createDataFrame(rows, CATALOG_SCHEMA)
