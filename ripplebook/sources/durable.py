"""Intermediate tables in the folder that driver and executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None
#: Tables that no scope has taken: results may still read them, so they go when the driver ends.
_kept: list[tuple[SparkSession, str]] = []
_scopes: list[list[tuple[SparkSession, str]]] = []


def shared_base(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Without one, a private folder on a local master; elsewhere driver
    and executors would each write to a disk of their own, so that is refused."""
    global _own
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="ripplebook-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return _own


def _delete(tables: list[tuple[SparkSession, str]]) -> None:
    while tables:
        spark, path = tables.pop()
        with contextlib.suppress(Exception):  # the session may have ended before
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what lies there is deleted at the end of the innermost :func:`scope`, or else when
    the driver ends."""
    path = f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"
    if not _kept and not _scopes:
        atexit.register(_delete, _kept)
    (_scopes[-1] if _scopes else _kept).append((spark, path))
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and reread, so that later stages never compute it again; see :func:`folder` for its end."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scope() -> Iterator[None]:
    """Tables saved within are deleted at its end: for builds that write their result before."""
    _scopes.append([])
    try:
        yield
    finally:
        _delete(_scopes.pop())
