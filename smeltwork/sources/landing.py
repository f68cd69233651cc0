"""What lies in the landing folder and which target each file belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.sources import files

# The formats that can be read, by file extension.
FORMATS = ("csv", "json", "xml", "parquet")
ARCHIVE_WORD = "archive"


def landing_entries(spark: SparkSession, landing: str) -> list[files.Entry]:
    """Files and dataset folders waiting in the landing folder; archive folders are not input."""
    return [
        entry
        for entry in files.children(spark, landing, sizes=True)
        if not (entry.is_folder and ARCHIVE_WORD in entry.name.lower())
    ]


def _without_slash(path: Column) -> Column:
    return F.rtrim(path, F.lit("/"))


def file_name(path: Column) -> Column:
    """The last part of a path; a trailing slash does not count."""
    return F.substring_index(_without_slash(path), "/", -1)


def extension(path: Column) -> Column:
    """Lower-case text after the last dot, or the whole name when there is none."""
    return F.lower(F.substring_index(file_name(path), ".", -1))


def target_of(path: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """The first target, in priority order, whose pattern occurs in the path in any case.

    ``patterns`` are (target, pattern) pairs from the control table. They become one
    conditional expression, so routing needs no join.
    """
    lowered = F.lower(path)
    tests = [F.when(F.contains(lowered, F.lit(pattern.lower())), F.lit(target)) for target, pattern in patterns]
    return F.coalesce(*tests, F.lit(None).cast("string"))


def route(paths: DataFrame, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``file_name``, ``extension``, ``target_table`` and ``route`` to a frame with ``path``.

    ``route`` is ``MATCHED``, ``UNMATCHED`` (no active target) or ``UNSUPPORTED``.
    """
    located = paths.select(
        "*",
        file_name(F.col("path")).alias("file_name"),
        extension(F.col("path")).alias("extension"),
        target_of(F.col("path"), patterns).alias("target_table"),
    )
    return located.withColumn(
        "route",
        F.when(F.col("target_table").isNull(), "UNMATCHED")
        .when(F.col("extension").isin(*FORMATS), "MATCHED")
        .otherwise("UNSUPPORTED"),
    )


PATH_SCHEMA = "name string, path string, length bigint, modified bigint"


def routed_entries(
    spark: SparkSession, entries: Sequence[files.Entry], patterns: Sequence[tuple[str, str]]
) -> list[dict]:
    """Route one landing listing."""
    if not entries:
        return []
    listing = spark.createDataFrame([(entry.name, entry.path, entry.length, entry.modified) for entry in entries], PATH_SCHEMA)
    found = [row.asDict() for row in route(listing, patterns).collect()]
    return sorted(found, key=lambda entry: entry["name"])
