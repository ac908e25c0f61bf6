"""Folder handling through Hadoop's file system API, so that any cluster storage works."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with its file system."""
    fs, p = _path(spark, path)
    uri = fs.makeQualified(p).toUri().toString()
    # Hadoop writes local paths with one slash.
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none if the folder is missing."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def written(spark: SparkSession, path: str) -> dict[str, float]:
    """When each child of a folder was last written, in seconds of the epoch, by its name."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return {}
    return {status.getPath().getName(): status.getModificationTime() / 1000 for status in fs.listStatus(p)}


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; its parent folders are made."""
    fs, p = _path(spark, path)
    fs.create(p).close()


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line of every data file at these files, folders or patterns, by its path."""
    found = {}
    for path in paths:
        fs, p = _path(spark, path)
        stack = [status.getPath() for status in fs.globStatus(p) or ()]
        while stack:
            at = stack.pop()
            if fs.getFileStatus(at).isDirectory():
                stack += [s.getPath() for s in fs.listStatus(at) if not s.getPath().getName().startswith(("_", "."))]
                continue
            stream = fs.open(at)
            try:
                jvm = spark._jvm
                reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
                found[at.toString()] = reader.readLine() or ""
            finally:
                stream.close()
    return found


def lines(spark: SparkSession, path: str) -> list[str]:
    """The lines of a small file."""
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, replacing the target and making its parent folder."""
    fs, src = _path(spark, source)
    _, dst = _path(spark, target)
    parent = dst.getParent()
    if parent is not None:
        fs.mkdirs(parent)
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")
