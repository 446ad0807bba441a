"""Shared helpers: durable intermediate tables, safe column names, text splitting.

Intermediate tables go to the shared folder named by ``spark.checkpoint.dir``, so that a
lost executor costs the recomputation of unfinished tasks only and lineage stays short.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplebook.sources.durable import shared_base

#: Fixed by the contract of every word-based operator: words are runs of other characters.
SPACES = " \t\n\u000b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_open: list[Scratch] = []


def _close_all() -> None:
    """At the driver's end no result can be read any more: the tables that results were read from go."""
    for scratch in _open:
        with contextlib.suppress(Exception):  # the session may have ended before
            scratch.close()


@contextlib.contextmanager
def closing_scratch() -> Iterator[None]:
    """Deletes at its end the tables of all operators called within: for callers that have written the results by then."""
    before = len(_open)
    try:
        yield
    finally:
        for scratch in _open[before:]:
            scratch.close()
        del _open[before:]


class Scratch:
    """Parquet tables of one operator call in the shared folder.

    ``save`` writes a frame and returns it re-read: later plans start at the files, and both
    sides of a join on such tables are plain exchanges that AQE may split where a key is hot.
    ``drop`` deletes a table no later plan reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"
        if not _open:
            atexit.register(_close_all)
        _open.append(self)
        self._n = 0
        self.paths: list[str] = []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        self.paths.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._ripple_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := getattr(df, "_ripple_path", None):
                self._delete(path)

    def keep_only(self, *frames: DataFrame) -> None:
        """Deletes all tables but these, which are what the operator's result reads."""
        kept = {getattr(df, "_ripple_path", None) for df in frames}
        for path in [p for p in self.paths if p not in kept]:
            self._delete(path)

    def close(self) -> None:
        """Deletes all tables."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        self.paths = [p for p in self.paths if p != path]
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One of the corpus tables, pruned to ``cols``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def words_of(text: Column | str) -> Column:
    """Words of a text as an array; null and blank texts have none. Native."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))
