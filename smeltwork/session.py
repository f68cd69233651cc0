"""Session settings and scratch space shared by every layer."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

from smeltwork.sources import files

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_SETTINGS = {
    # Silver and gold are split by a column of two or three values: with a writer for each, a task need not sort.
    _WRITERS: "4",
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Digests are the bulk of a dimension: their hexadecimal text takes half the bytes that snappy leaves.
DIMENSION_CODEC = "zstd"

_local_scratch: str | None = None
_made: set[str] = set()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("smeltwork")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session that names none gets one temporary folder; a cluster session
    must name one, because executors cannot read each other's local disks.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="smeltwork-")
    return _local_scratch


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that no earlier run has used, removed when the session's process ends."""
    base = f"{scratch_root(spark)}/smeltwork/{spark.sparkContext.applicationId}"
    if base not in _made:
        files.make_until_exit(spark, base)
        _made.add(base)
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def split_unsorted(spark: SparkSession, values: int = 4) -> Iterator[None]:
    """For writes split by a column of few ``values``: a writer for each, so that no task sorts all its rows for it.

    A session that has its own limit keeps it.
    """
    own = spark.conf.get(_WRITERS, "0") != "0"
    if not own:
        spark.conf.set(_WRITERS, str(values))
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(_WRITERS)


class Scratch:
    """Frames written to the shared folder, removed when the block ends.

    ``keep=True`` leaves them in place until the session's process ends, for callers
    that return a lazy frame reading from them.
    """

    def __init__(self, spark: SparkSession, keep: bool = False) -> None:
        self._spark = spark
        self._keep = keep
        self._folders: list[str] = []

    def store(self, frame: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
        """Write ``frame`` once and return a scan of it, so no later action recomputes it.

        Spark judges by the size of the files whether the scan can be broadcast, so a closer ``codec`` is for frames
        that no join takes as its small side.
        """
        folder = fresh_folder(self._spark, label)
        self._folders.append(folder)
        frame.write.option("compression", codec).parquet(folder)
        return self._spark.read.schema(frame.schema).parquet(folder)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if not self._keep:
            for folder in self._folders:
                files.delete(self._spark, folder)
        self._folders = []
