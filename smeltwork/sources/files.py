"""Folder operations through the Hadoop file system, so any storage Spark reads works."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    """``length`` is that of all files below a folder, ``modified`` a time in milliseconds; both only where asked for."""

    name: str
    path: str
    is_folder: bool
    length: int = 0
    modified: int = 0


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def encoded_path(spark: SparkSession, path: str) -> str:
    """The path of a folder without scheme and host, percent-encoded the way scans report it."""
    system, target = _resolve(spark, path)
    return system.makeQualified(target).toUri().getRawPath()


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _resolve(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str, sizes: bool = False) -> list[Entry]:
    """Direct children of a folder in name order; a missing folder has none."""
    system, target = _resolve(spark, path)
    if not system.exists(target):
        return []

    def sized(status) -> tuple[int, int]:
        whole = status.isDirectory()
        return system.getContentSummary(status.getPath()).getLength() if whole else status.getLen(), status.getModificationTime()

    found = [
        Entry(status.getPath().getName(), status.getPath().toString(), status.isDirectory(), *(sized(status) if sizes else ()))
        for status in system.listStatus(target)
    ]
    return sorted(found, key=lambda entry: entry.name)


def matching(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths below a folder, without it, that fit a pattern of names: one call, however many there are."""
    literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", folder)
    system, target = _resolve(spark, f"{literal}/{pattern}")
    depth = pattern.count("/") + 1
    return ["/".join(status.getPath().toString().rsplit("/", depth)[1:]) for status in system.globStatus(target) or ()]


def move(spark: SparkSession, source: str, destination: str) -> None:
    system, origin = _resolve(spark, source)
    _, target = _resolve(spark, destination)
    system.mkdirs(target.getParent())
    if not system.rename(origin, target):
        raise OSError(f"could not move {source} to {destination}")


def delete(spark: SparkSession, path: str) -> None:
    system, target = _resolve(spark, path)
    system.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text into a file, whole or not at all; one of that name is replaced."""
    system, target = _resolve(spark, path)
    _, part = _resolve(spark, f"{path.rsplit('/', 1)[0]}/_{path.rsplit('/', 1)[1]}.part")
    out = system.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    system.delete(target, False)
    if not system.rename(part, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    system, target = _resolve(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The path itself if it is a file, else all files below it that a scan would read."""
    system, target = _resolve(spark, path)
    if not system.getFileStatus(target).isDirectory():
        return [target.toString()]
    found = []
    for entry in children(spark, path):
        hidden = entry.name.startswith(".") or (entry.name.startswith("_") and "=" not in entry.name)
        if not hidden:
            found += data_files(spark, entry.path) if entry.is_folder else [entry.path]
    return found


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file that is not blank, read from its beginning only; None if there is none."""
    jvm = spark._jvm
    system, target = _resolve(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(target)
    stream = system.open(target)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line
    finally:
        stream.close()


def make_until_exit(spark: SparkSession, path: str) -> None:
    """Create a folder that goes, with all it holds, when the session's process ends."""
    system, target = _resolve(spark, path)
    system.mkdirs(target)
    system.deleteOnExit(target)
