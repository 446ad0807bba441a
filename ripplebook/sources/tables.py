"""Strict readers of JSON lines and tables, and table writers."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplebook import schemas
from ripplebook.sources import files


def require(df: DataFrame, columns: tuple[str, ...] | list[str], where: str = "input") -> DataFrame:
    """``df``, failing on the first row that lacks one of ``columns`` (JSON readers turn missing keys to nulls)."""
    if not columns:
        return df
    lacks = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    message = F.concat(F.lit(f"{where}: required field is missing: "), F.coalesce(*lacks))
    ok = F.when(F.coalesce(*lacks).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.filter(ok)


def require_domain(df: DataFrame, column: str, domain: tuple[str, ...]) -> DataFrame:
    """``df``, failing on a value of ``column`` outside ``domain``."""
    bad = F.raise_error(F.concat(F.lit(f"{column}: unknown value "), F.col(column))).cast("boolean")
    return df.filter(F.when(~F.col(column).isin(*domain), bad).otherwise(F.lit(True)))


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str, required: tuple[str, ...] = (), **options) -> DataFrame:
    """Typed JSON lines; blank lines are skipped, malformed ones fail."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return require(reader.options(**options).json(paths), required, str(paths))


def read_raw_book(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Raw snapshots of all book files below the roots; overlapping roots give rows more than once.

    A missing root gives nothing; absent sides are empty.
    """
    parts = [
        read_jsonl(spark, root, schemas.RAW_BOOK, schemas.REQUIRED_BOOK, recursiveFileLookup="true", pathGlobFilter="{" + ",".join(schemas.BOOK_FILES) + "}")
        for root in roots
        if files.exists(root)
    ]
    if not parts:
        return spark.createDataFrame([], schemas.RAW_BOOK)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    empty = F.array().cast("array<struct<price:double,size:double>>")
    return out.withColumns({"bids": F.coalesce("bids", empty), "asks": F.coalesce("asks", empty)})


def read_values(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(value VARIANT) of each line that is not blank."""
    return spark.read.text(paths).filter(F.trim("value") != "").select(F.parse_json("value").alias("value"))


def read_cached(spark: SparkSession, paths: list[str], schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """Rows of cache files, each a JSON array or JSON lines, with ``file`` (its name), ``block`` and ``line_pos``.

    (block, line_pos) is a row's place in its file: the start of the split that held it, and an order within that. Lines are
    read by line, in as many tasks as there are splits; arrays are streamed an element at a time, a file a task. One plan
    reads all files of a layout. File names must differ.
    """
    names = [posixpath.basename(p) for p in paths]
    if len(set(names)) < len(names):
        raise ValueError(f"cache files share a name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    arrays = [p for p in paths if files.first_byte(p) == b"["]
    lines = [p for p in paths if p not in set(arrays)]
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_pos")]
    out = spark.createDataFrame([], f"file string, block bigint, line_pos bigint, {schema}")
    for some, multi in ((lines, "false"), (arrays, "true")):
        if some:
            reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi)
            one = reader.json(some)
            out = out.unionByName(one.select(*place, *one.columns))
    return require(out, required, "cache")


def write_table(df: DataFrame, path: str) -> None:
    """Parquet; replaces the whole table, stale parts included."""
    df.write.mode("overwrite").parquet(path)


def field_names(df: DataFrame) -> list[str]:
    """The columns as a table's sidecar lists them."""
    return sorted(df.columns)


def write_jsonl(df: DataFrame, path: str) -> dict:
    """JSON lines as ``part-00000.jsonl`` and so on, in the frame's order, keys in alphabetical order, nulls written out, and a
    ``_schema.json`` beside them; replaces the whole table. Returns the sidecar."""
    names = field_names(df)
    df.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
    fs, _, _ = files._at(path)
    parts = []
    for old in (p for p in files.listing(path) if posixpath.basename(p).startswith("part-")):  # Spark numbers them in order
        new = f"part-{len(parts):05d}.jsonl"
        if not fs.rename(files._at(old)[1], files._at(files.join(path, new))[1]):
            raise OSError(f"cannot rename {old}")
        parts.append(new)
    sidecar = {"fields": names, "part_files": parts, "physical_format": "jsonl"}
    files.write_json(files.join(path, "_schema.json"), sidecar)
    return sidecar


def read_jsonl_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All ``part-*.jsonl`` files of a folder."""
    return read_jsonl(spark, path, schema, pathGlobFilter="part-*.jsonl")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dataset's table in either physical format: JSON lines where a ``_schema.json`` says so, else Parquet."""
    sidecar = files.join(path, "_schema.json")
    if files.exists(sidecar) and files.read_json(sidecar).get("physical_format") == "jsonl":
        return read_jsonl_table(spark, path, schema)
    return spark.read.parquet(path)
