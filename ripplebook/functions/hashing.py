"""Row hashes and table digests."""

from __future__ import annotations

import hashlib
import json
import posixpath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplebook.sources import files


def row_hash(columns: list[str], keep_hash: bool = False) -> Column:
    """SHA-256 of the row as compact JSON, keys in alphabetical order, nulls written out.

    ``row_hash`` itself is left out unless ``keep_hash``. Doubles are printed as Spark prints them, so hashes agree between
    tables of this engine and are not promised to agree with another's.
    """
    names = sorted(c for c in columns if keep_hash or c != "row_hash")
    return F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("row_hash", row_hash(df.columns))


def digest_folds(df: DataFrame) -> DataFrame:
    """(row_count, xor60, sum60): folds over the rows that do not depend on their order or partitioning.

    Each row counts by the first 60 bits of its hash; one aggregation, whatever the size.
    """
    bits = F.conv(F.substring(row_hash(df.columns, keep_hash=True), 1, 15), 16, 10).cast("bigint")
    return df.select(bits.alias("h")).agg(
        F.count("*").alias("row_count"), F.coalesce(F.bit_xor("h"), F.lit(0)).cast("bigint").alias("xor60"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum60")
    )


def table_digest(df: DataFrame) -> dict:
    """Row count and a digest of the rows and column names."""
    r = digest_folds(df).first()
    body = json.dumps([sorted(df.columns), r["row_count"], r["xor60"], r["sum60"]], separators=(",", ":"))
    return {"row_count": r["row_count"], "table_hash": hashlib.sha256(body.encode()).hexdigest()}


def sha256_bytes(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def hash_path(path: str) -> str:
    """A file's SHA-256, or a folder's over sorted (relative path, NUL, bytes, NUL); for small driver-side files."""
    if files.is_file(path):
        return sha256_bytes(files.read_bytes(path))
    h = hashlib.sha256()
    if files.exists(path):
        found = files.listing(path)
        root = files.qualified(path)
        below = {p[p.index(root) + len(root) :].lstrip("/") if root in p else posixpath.relpath(p, path): p for p in map(files.qualified, found)}
        for name in sorted(below):
            h.update(name.encode() + b"\0" + files.read_bytes(below[name]) + b"\0")
    return h.hexdigest()


def existing_hash(path: str) -> str | None:
    return hash_path(path) if files.exists(path) else None
