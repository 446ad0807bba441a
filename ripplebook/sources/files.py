"""Small files on any file system that Spark can reach (driver side): documents, listings, copies.

Paths go through Hadoop's FileSystem, so ``file://``, HDFS and object stores work alike, and a path without a
scheme means the session's default file system, as it does where Spark reads or writes a table.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Files that are copied at a time.
COPIES = 16


def _session() -> SparkSession:
    """The running session, or else a local one."""
    from ripplebook.session import local_session

    return SparkSession.getActiveSession() or SparkSession._instantiatedSession or local_session()


def _at(path: str):
    """(file system, path object, configuration)."""
    context = _session().sparkContext
    conf = context._jsc.hadoopConfiguration()
    p = context._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, conf


def join(root: str, *parts: str) -> str:
    return posixpath.join(root, *parts)


def qualified(path: str) -> str:
    """The path with scheme and authority, ``.`` and ``..`` resolved."""
    fs, p, _ = _at(path)
    whole = fs.makeQualified(p).toString()
    if whole.startswith("file:"):  # links of local folders are followed, so that two names of one folder agree
        import os

        whole = "file:" + os.path.realpath(fs.makeQualified(p).toUri().getPath())
    return whole.rstrip("/")


def exists(path: str) -> bool:
    fs, p, _ = _at(path)
    return fs.exists(p)


def is_file(path: str) -> bool:
    fs, p, _ = _at(path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def listing(root: str) -> list[str]:
    """All files below a folder, at any depth, sorted. A root that is absent or cannot be listed raises."""
    fs, p, _ = _at(root)
    todo, out = [fs.getFileStatus(p)], []
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo.extend(fs.listStatus(status.getPath()))
        else:
            out.append(status.getPath().toString())
    return sorted(out)


def read_bytes(path: str) -> bytes:
    fs, p, _ = _at(path)
    stream = fs.open(p)
    try:
        return bytes(_session().sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def first_byte(path: str) -> bytes:
    """The first byte that is no white space; empty for a blank file. Reads no further."""
    fs, p, _ = _at(path)
    stream = fs.open(p)
    try:
        while (b := stream.read()) >= 0:
            if bytes([b]).strip():
                return bytes([b])
        return b""
    finally:
        stream.close()


def write_bytes(path: str, data: bytes) -> None:
    """Written beside and moved into place whole; folders are made."""
    fs, p, _ = _at(path)
    temporary = _at(f"{path}.{uuid.uuid4().hex}")[1]
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    fs.delete(p, False)
    if not fs.rename(temporary, p):
        fs.delete(temporary, False)
        raise OSError(f"cannot move a file to {path}")


def read_json(path: str):
    return json.loads(read_bytes(path))


def write_json(path: str, value) -> None:
    """Indented JSON."""
    write_bytes(path, json.dumps(value, indent=2).encode())


def delete(path: str) -> None:
    fs, p, _ = _at(path)
    fs.delete(p, True)


def copy_folder(source: str, target: str) -> None:
    """Every file below ``source`` to the same place below ``target``, which is replaced."""
    base = qualified(source)
    _, _, conf = _at(source)
    delete(target)
    util = _session().sparkContext._jvm.org.apache.hadoop.fs.FileUtil
    # listed names are qualified as the root is, so what follows the root is the place below it
    fs, p, _ = _at(source)
    root = fs.resolvePath(p).toString().rstrip("/")

    def copy(path: str) -> None:
        below = path[len(root) :].lstrip("/") if path.startswith(root) else path[len(base) :].lstrip("/")
        from_fs, from_path, _ = _at(path)
        to_fs, to_path, _ = _at(join(target, below))
        if not util.copy(from_fs, from_path, to_fs, to_path, False, conf):
            raise OSError(f"cannot copy {path}")

    with ThreadPoolExecutor(COPIES) as pool:
        list(pool.map(copy, listing(root)))
