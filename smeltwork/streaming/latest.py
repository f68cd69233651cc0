"""The newest row of every key, kept by a stream in Spark's state store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions.naming import ref, refs
from smeltwork.operators.changes import newest_changes
from smeltwork.sources import files
from smeltwork.sources.zones import version_folder

_NUMBER = "_update"


def _updates(folder: str) -> str:
    return f"{folder}/updates"


def _gathered(folder: str) -> str:
    return f"{folder}/gathered"


def latest_of(stream: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("ingest_timestamp",)) -> DataFrame:
    """The newest row of every key that a trigger touches; equals ``keep_latest`` over all rows so far.

    A plain aggregation: the state holds one row per key, partial results are combined before the
    shuffle, and a row that comes again, late, or after a restart changes nothing.
    """
    leading = list(order_by)
    if "source_file" in stream.columns and "source_file" not in leading:
        leading.append("source_file")
    rest = [name for name in stream.columns if name not in leading and name not in keys]
    newest = F.max(F.struct(*refs([*leading, *rest]))).alias("_newest")
    return stream.groupBy(*refs(keys)).agg(newest).select(*[ref(name) if name in keys else F.col("_newest")[name].alias(name) for name in stream.columns])


def feed_latest(stream: DataFrame, keys: Sequence[str], folder: str, checkpoint: str, order_by: Sequence[str] = ("ingest_timestamp",)) -> int:
    """Take everything not seen before, write the rows that are now newest, and stop; returns the triggers run.

    A trigger owns one update folder and replaces it, so a trigger that is replayed after a failure
    leaves its rows once. Earlier rows are not read again: what is newest comes from the state.
    """
    numbers: list[int] = []

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(version_folder(_updates(folder), number + 1))
        numbers.append(number)

    query = (
        latest_of(stream, keys, order_by).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return len(numbers)


def _numbered(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished versions below a folder, in order."""
    names = [entry.name for entry in files.children(spark, folder) if files.exists(spark, f"{entry.path}/_SUCCESS")]
    return sorted(int(name.partition("=")[2]) for name in names)


def _live(spark: SparkSession, folder: str) -> tuple[int, list[str]]:
    """The newest update, and the folders that hold the newest rows: what was gathered last, and the updates since."""
    held = _numbered(spark, _gathered(folder))[-1:]
    since = [number for number in _numbered(spark, _updates(folder)) if number > (held[0] if held else 0)]
    paths = [version_folder(_gathered(folder), number) for number in held]
    return max([*held, *since], default=0), [*paths, *[version_folder(_updates(folder), number) for number in since]]


def read_latest(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame | None:
    """The newest row of every key, from the newest update that names it; None before the first."""
    _, paths = _live(spark, folder)
    if not paths:
        return None
    number = F.regexp_extract(F.col("_metadata.file_path"), "/v=([0-9]+)/[^/]*$", 1).cast("bigint")
    return newest_changes(spark.read.parquet(*paths).withColumn(_NUMBER, number), keys, _NUMBER)


def compact_latest(spark: SparkSession, folder: str, keys: Sequence[str]) -> None:
    """Gather the newest rows of all updates so far, so that reading stays short.

    The gathered rows count once they are written; only then do the updates they hold go. A trigger
    that is replayed writes its update again, which is not read, for the gathered rows are as new.
    """
    newest, paths = _live(spark, folder)
    if len(paths) < 2:
        return
    read_latest(spark, folder, keys).write.mode("overwrite").parquet(version_folder(_gathered(folder), newest))
    for below in (_updates(folder), _gathered(folder)):
        for number in _numbered(spark, below):
            if number < newest or below == _updates(folder) and number == newest:
                files.delete(spark, version_folder(below, number))
