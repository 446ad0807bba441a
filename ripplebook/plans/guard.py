"""Guards that keep strategy fields and settlement labels out of a dataset."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ripplebook import schemas
from ripplebook.sources import files


def invalid_events(events: DataFrame, dataset_format: str = schemas.EVENTS) -> DataFrame:
    """Event rows that speak of settlements or carry another format."""
    return events.filter(
        F.col("event_type").contains("settlement") | F.col("payload_table").contains("settlement") | (F.col("dataset_format") != dataset_format)
    )


def missing_references(availability: DataFrame) -> DataFrame:
    """Bar inputs that are not available."""
    return availability.filter((F.col("group") == schemas.KLINE_GROUP) & (F.col("status") != "available"))


def walk_keys(value) -> Iterator[str]:
    """Every object key of a JSON value, at any depth (without recursion, so depth is no limit)."""
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            yield from v
            todo.extend(v.values())
        elif isinstance(v, list):
            todo.extend(v)


def schema_keys(kind: DataType) -> Iterator[str]:
    """Every field name of a schema, at any depth."""
    if isinstance(kind, StructType):
        for f in kind.fields:
            yield f.name
            yield from schema_keys(f.dataType)
    elif isinstance(kind, ArrayType):
        yield from schema_keys(kind.elementType)
    elif isinstance(kind, MapType):
        yield from schema_keys(kind.valueType)


def banned_in_lines(spark: SparkSession, paths: list[str], banned: tuple[str, ...] = schemas.BANNED_FIELDS) -> DataFrame:
    """(path, field), distinct: banned keys anywhere in the objects of JSON-lines files.

    Keys can lie at any depth and differ from line to line, which no schema shows; so each line is walked, in batches.
    """
    lines = spark.read.text(paths).filter(F.trim("value") != "").select(F.col("_metadata.file_path").alias("path"), "value")

    def scan(batches):
        wanted = set(banned)
        for pdf in batches:
            found = [(p, k) for p, v in zip(pdf["path"], pdf["value"], strict=True) for k in wanted.intersection(walk_keys(json.loads(v)))]
            yield pd.DataFrame(found, columns=["path", "field"]).drop_duplicates()

    return lines.mapInPandas(scan, "path string, field string").distinct().orderBy("path", "field")


def banned_fields(spark: SparkSession, root: str, banned: tuple[str, ...] = schemas.BANNED_FIELDS) -> list[tuple[str, str]]:
    """(path, field), sorted and distinct, of a dataset folder on any file system: JSON documents, JSON-lines files and
    Parquet schemas. A root that is absent or cannot be listed raises: nothing has been looked at then."""
    found, tables, lines = set(), {}, []
    for path in files.listing(root):
        if path.endswith(".jsonl"):
            lines.append(path)
        elif path.endswith(".json"):
            document = files.read_json(path)
            keys = set(walk_keys(document))
            if posixpath.basename(path) == "_schema.json":  # a sidecar lists its fields as values
                keys.update(document.get("fields", []))
            found |= {(path, k) for k in keys.intersection(banned)}
        elif path.endswith(".parquet"):
            tables.setdefault(posixpath.dirname(path), path)
    for folder, path in sorted(tables.items()):  # files of one folder are parts of one table
        found |= {(folder, k) for k in schema_keys(spark.read.parquet(path).schema) if k in banned}
    if lines:
        found |= {(r["path"], r["field"]) for r in banned_in_lines(spark, lines, banned).collect()}
    return sorted(found)
