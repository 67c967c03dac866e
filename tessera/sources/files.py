"""Files on any file system that Spark can open: the driver reads and writes whole small files by Hadoop paths.

A path without a scheme is on the session's default file system, so state of a base is where every
executor sees it. Files are written under another name and renamed, so a reader sees all or nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Found:
    path: str
    name: str
    modified: int  # milliseconds


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, folder: str) -> list[Found]:
    """The files and folders in a folder, by name; none if it is absent."""
    fs, p = _at(spark, folder)
    if not fs.exists(p):
        return []
    return sorted((Found(s.getPath().toString(), s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)), key=lambda f: f.name)


def modified(spark: SparkSession, path: str) -> int:
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def read(spark: SparkSession, path: str) -> bytes:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write(spark: SparkSession, path: str, data: bytes, replace: bool = True) -> None:
    """All of ``data`` under ``path``; without ``replace`` a file that is there already is an error."""
    fs, p = _at(spark, path)
    _, draft = _at(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(data))
    out.close()
    if replace and fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(draft, p):
        fs.delete(draft, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
