"""Small files and listings in whatever store a path belongs to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: How Parquet tables are packed.
PACKED = {"compression": "zstd"}


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the class of paths."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    return paths(path).getFileSystem(spark._jsc.hadoopConfiguration()), paths


def read_text(spark: SparkSession, path: str) -> str | None:
    system, paths = file_system(spark, path)
    if not system.exists(paths(path)):
        return None
    stream = system.open(paths(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place whole; False if there is one already, which then stays."""
    system, paths = file_system(spark, path)
    parent, name = path.rsplit("/", 1)
    part = paths(f"{parent}/_{name}.{uuid.uuid4().hex}")
    stream = system.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.exists(paths(path)) and system.rename(part, paths(path)):
        return True
    system.delete(part, False)
    return False


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Names of what matches a glob pattern, in order."""
    system, paths = file_system(spark, pattern)
    return sorted(f.getPath().getName() for f in system.globStatus(paths(pattern)) or [])


def delete(spark: SparkSession, path: str) -> None:
    system, paths = file_system(spark, path)
    system.delete(paths(path), True)
