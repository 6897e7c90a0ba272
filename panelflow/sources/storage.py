"""Path probes on whatever file system the path names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_local(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path)[0].getUri().getScheme() == "file"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, or a pattern names any."""
    fs, p = _fs(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def require(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return path


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Every data file of a path, a folder's at any depth; hidden files and folders are left out."""
    fs, p = _fs(spark, path)
    out, left = [], [s for s in (fs.globStatus(p) or [])]
    while left:
        s = left.pop()
        if s.isDirectory():
            left.extend(c for c in fs.listStatus(s.getPath()) if c.getPath().getName()[:1] not in ("_", "."))
        else:
            out.append(s.getPath().toString())
    return sorted(out)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote; nothing happens if it is gone."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text, unless the name is taken; of several writers only one gets True.

    The text is written under another name first. On a local disk a hard link then gives it its name, elsewhere a rename does:
    both fail if the name exists. HDFS renames that way; a store without such a rename is not safe for several writers.
    """
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(p) and fs.rename(draft, p)
        nio = spark._jvm.java.nio.file
        link, target = (nio.Paths.get(x.toUri().getPath(), spark._sc._gateway.new_array(spark._jvm.java.lang.String, 0)) for x in (p, draft))
        try:
            nio.Files.createLink(link, target)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass()):
                return False
            raise
        return True
    finally:
        fs.delete(draft, False)
