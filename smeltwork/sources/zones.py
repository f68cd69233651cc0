"""Where each layer keeps its data, and how a new version becomes visible.

Bronze batches, silver and gold are published as ``v=<n>`` folders. A version counts once its write
job has left ``_SUCCESS``; until then readers stay on the one before, and a rerun
overwrites the unfinished folder. Nothing is ever overwritten that a plan reads.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions import rules
from smeltwork.functions.naming import path_text, refs
from smeltwork.operators.joining import anti
from smeltwork.operators.quarantine import VERDICT
from smeltwork.session import DIMENSION_CODEC, split_unsorted
from smeltwork.sources import files

_VERSION, _DONE, _IS_ACTIVE, _FOLDED, _CHANGES, _STATE = "v", "_SUCCESS", "is_active", "folded", "changes", "state"
BATCH, QUARANTINE_BATCH, SOURCE_FILE = "batch_id", "quarantine_batch", "source_file"


@dataclass(frozen=True)
class Zones:
    """Root folders. ``under`` lays them out below one base folder."""

    landing: str
    bronze: str
    raw_archive: str
    silver: str
    quarantine: str
    gold: str
    audit: str

    @classmethod
    def under(cls, base: str) -> Zones:
        base = base.rstrip("/")
        return cls(
            landing=f"{base}/landing",
            bronze=f"{base}/landing/archive",
            raw_archive=f"{base}/landing/raw_archive",
            silver=f"{base}/silver",
            quarantine=f"{base}/quarantine",
            gold=f"{base}/gold",
            audit=f"{base}/audit",
        )


def _number(name: str) -> int:
    label, _, number = name.partition("=")
    return int(number) if label == _VERSION else 0


def current_version(spark: SparkSession, folder: str) -> int:
    """The newest finished version, 0 when there is none."""
    numbers = sorted((_number(entry.name) for entry in files.children(spark, folder)), reverse=True)
    done = (number for number in numbers if number and files.exists(spark, f"{folder}/{_VERSION}={number}/{_DONE}"))
    return next(done, 0)


def version_folder(folder: str, number: int) -> str:
    return f"{folder}/{_VERSION}={number}"


def _versions(spark: SparkSession, folder: str, label: str) -> list[files.Entry]:
    """The ``<label>=…`` folders below ``folder``.

    They are read by path and not as partitions, so a source column may have any name.
    """
    return [entry for entry in files.children(spark, folder) if entry.name.startswith(f"{label}=")]


def _has_data(spark: SparkSession, folder: str) -> bool:
    return any(not entry.name.startswith(("_", ".")) for entry in files.children(spark, folder))


# --- bronze -----------------------------------------------------------------


def write_bronze(
    rows: DataFrame,
    folder: str,
    batch_id: str,
    delivered: Sequence[str] | None = None,
    note: Callable[[str], None] | None = None,
) -> int:
    """Publish a new attempt at a batch and return its number.

    The unit that an attempt replaces is the file: rows that earlier attempts took from
    files not ``delivered`` now stay, and a file delivered again replaces its own rows. So
    a retry after some files were archived loses nothing and repeats nothing. Without
    ``delivered`` the whole batch is replaced. ``note`` is told the attempt's name before its
    rows are written.
    """
    spark = rows.sparkSession
    batch = f"{folder}/{BATCH}={batch_id}"
    number = current_version(spark, batch)
    if number and delivered is not None:
        names = spark.createDataFrame([(name,) for name in delivered], f"`{SOURCE_FILE}` string")
        before = spark.read.parquet(version_folder(batch, number))
        rows = rows.unionByName(anti(before, names, [SOURCE_FILE]), allowMissingColumns=True)
    if note is not None:
        note(version_folder(f"{BATCH}={batch_id}", number + 1))
    rows.write.mode("overwrite").parquet(version_folder(batch, number + 1))
    return number + 1


MALFORMED = "malformed"


def write_malformed(bad: DataFrame, folder: str, batch_id: str, number: int) -> None:
    """Put aside the text of records that could not be read, with the file they came from.

    They lie beside the attempt that took the file's other rows, and are replaced with it.
    """
    line = F.col("_corrupt_record").alias("record")
    others = [name for name in bad.columns if name not in ("_corrupt_record", SOURCE_FILE, "ingest_timestamp")]
    # Spark answers no query on the corrupt column alone, so the others are looked at too.
    read = F.length(F.concat_ws("", *refs(others))) >= 0 if others else F.lit(True)
    rows = bad.where(read).select(F.col(SOURCE_FILE), line, F.lit("not a record of its format").alias("reason"), "ingest_timestamp")
    rows.hint("rebalance").write.mode("overwrite").parquet(version_folder(f"{folder}/{MALFORMED}/{BATCH}={batch_id}", number))


def read_malformed(spark: SparkSession, folder: str) -> DataFrame | None:
    """``source_file, record, reason, ingest_timestamp`` of all records put aside, of each batch's newest attempt."""
    paths = [f"{folder}/{MALFORMED}/{attempt}" for attempt in bronze_attempts(spark, f"{folder}/{MALFORMED}")]
    return spark.read.parquet(*paths) if paths else None


def drop_attempt(spark: SparkSession, folder: str, batch_id: str, number: int) -> None:
    """Take back an attempt; the one before it counts again."""
    files.delete(spark, version_folder(f"{folder}/{BATCH}={batch_id}", number))


def bronze_attempts(spark: SparkSession, folder: str) -> list[str]:
    """The newest attempt at every batch, as ``batch_id=<id>/v=<n>``, found in one listing."""
    newest: dict[str, int] = {}
    for path in files.matching(spark, folder, f"{BATCH}=*/{_VERSION}=*/{_DONE}"):
        batch, version, _ = path.split("/")
        newest[batch] = max(newest.get(batch, 0), _number(version))
    return [version_folder(batch, number) for batch, number in sorted(newest.items()) if number]


def read_attempts(spark: SparkSession, folder: str, attempts: Sequence[str]) -> DataFrame | None:
    """The rows of these attempts; columns one of them lacks are NULL. None without data."""
    paths = [f"{folder}/{attempt}" for attempt in attempts if _has_data(spark, f"{folder}/{attempt}")]
    return spark.read.option("mergeSchema", True).parquet(*paths) if paths else None


def read_bronze(spark: SparkSession, folder: str, batch_id: str | None = None) -> DataFrame | None:
    """All batches of a target, or one; columns a batch lacks are NULL. None without data."""
    wanted = [
        attempt
        for attempt in bronze_attempts(spark, folder)
        if batch_id is None or attempt.rsplit("/", 1)[0] == f"{BATCH}={batch_id}"
    ]
    return read_attempts(spark, folder, wanted)


# --- silver and quarantine --------------------------------------------------


def _note(folder: str, label: str, number: int) -> str:
    """Where a version keeps a small note about itself."""
    return f"{version_folder(f'{folder}/{label}', number)}/note.json"


BUCKET = "key_bucket"


@dataclass(frozen=True)
class SilverState:
    """What a silver version holds besides its own files.

    ``attempts`` are the bronze attempts folded into it, ``settings`` what decided its verdicts. With ``buckets``
    its rows lie in folders by key, and ``kept`` names those (bucket, verdict, path) that an earlier version wrote
    and this one left where they are. Such a version notes its ``schema``: a kept bucket may lack newer columns.
    """

    attempts: tuple[str, ...] = ()
    settings: str | None = None
    buckets: int = 0
    kept: tuple[tuple[int, str, str], ...] = ()
    schema: str | None = None


def write_silver(
    flagged: DataFrame, folder: str, state: SilverState = SilverState(), bucket: Column | None = None
) -> int:
    """Publish a version holding clean and bad rows apart, in one write job.

    With ``bucket``, ``flagged`` holds the rows of the buckets to write and is split by it too.
    The note is written first: a version that counts always has it.
    """
    spark = flagged.sparkSession
    number = current_version(spark, folder) + 1
    path = version_folder(folder, number)
    if bucket is None:
        files.write_text(spark, _note(folder, _FOLDED, number), json.dumps(asdict(state)))
        with split_unsorted(spark):
            flagged.write.mode("overwrite").partitionBy(VERDICT).parquet(path)
        return number
    if BUCKET in flagged.columns:
        raise ValueError(f"column name is reserved for buckets: {BUCKET}")
    noted = replace(state, schema=flagged.drop(VERDICT).schema.json())
    files.write_text(spark, _note(folder, _FOLDED, number), json.dumps(asdict(noted)))
    dealt = flagged.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
    dealt.write.mode("overwrite").partitionBy(VERDICT, BUCKET).parquet(path)
    return number


def silver_state(spark: SparkSession, folder: str, number: int | None = None) -> SilverState:
    """The state of the current silver version, or of a given one; a lost note says nothing."""
    number = current_version(spark, folder) if number is None else number
    text = files.read_text(spark, _note(folder, _FOLDED, number))
    if text is None:
        return SilverState()
    noted = json.loads(text)
    noted["kept"] = tuple((bucket, verdict, path) for bucket, verdict, path in noted.get("kept", ()))
    return SilverState(**noted | {"attempts": tuple(noted["attempts"])})


def silver_places(spark: SparkSession, folder: str, state: SilverState) -> list[tuple[int, str, str]]:
    """(bucket, verdict, path) of all folders of the current version: those it kept and those it wrote."""
    number = current_version(spark, folder)
    wrote = []
    for kind in _versions(spark, version_folder(folder, number), VERDICT):
        below = f"{_VERSION}={number}/{kind.name}"
        verdict = kind.name.partition("=")[2]
        wrote += [(int(entry.name.partition("=")[2]), verdict, f"{below}/{entry.name}")
                  for entry in _versions(spark, kind.path, BUCKET)]
    return [*state.kept, *wrote]


def read_silver(
    spark: SparkSession, folder: str, verdict: str = rules.CLEAN, buckets: Collection[int] | None = None
) -> DataFrame | None:
    """Rows of one verdict of the current version; None when the target has no rows at all.

    ``buckets`` leaves out the rows of all others, where they lie in buckets.
    """
    number = current_version(spark, folder)
    path = version_folder(folder, number)
    state = silver_state(spark, folder, number) if number else SilverState()
    if state.buckets:
        places = silver_places(spark, folder, state)
        if not places:
            return None
        schema = T.StructType.fromJson(json.loads(state.schema))
        chosen = [f"{folder}/{path}" for bucket, kind, path in places
                  if kind == verdict and (buckets is None or bucket in buckets)]
        return spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)
    if number == 0 or not _has_data(spark, path):
        return None
    return spark.read.parquet(path).where(F.col(VERDICT) == verdict).drop(VERDICT)


def write_changes(changes: DataFrame, folder: str, number: int) -> None:
    """Publish what silver version ``number`` changed; a version without this list has to be merged whole."""
    changes.hint("rebalance").write.mode("overwrite").parquet(version_folder(f"{folder}/{_CHANGES}", number))


def read_changes(spark: SparkSession, folder: str, after: int, upto: int, version_column: str) -> DataFrame | None:
    """The change sets of the versions in (after, upto], each row with its version; None if one is missing."""
    paths = [version_folder(f"{folder}/{_CHANGES}", number) for number in range(after + 1, upto + 1)]
    if not paths or not all(files.exists(spark, f"{path}/{_DONE}") for path in paths):
        return None
    number = F.regexp_extract(F.col("_metadata.file_path"), f"/{_VERSION}=([0-9]+)/[^/]*$", 1).cast("bigint")
    return spark.read.option("mergeSchema", True).parquet(*paths).withColumn(version_column, number)


def write_quarantine(bad: DataFrame, folder: str, batch_id: str) -> None:
    """Replace the batch's own folder; the few rows are gathered into full files."""
    bad.hint("rebalance").write.mode("overwrite").parquet(f"{folder}/{QUARANTINE_BATCH}={batch_id}")


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame | None:
    """Every quarantined row with the batch that caught it first."""
    paths = [e.path for e in _versions(spark, folder, QUARANTINE_BATCH) if _has_data(spark, e.path)]
    if not paths:
        return None
    # Taken from the path and not as a partition column: Spark would guess a type, and read 007 as 7.
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/{QUARANTINE_BATCH}=([^/]*)/[^/]*$", 1)
    return spark.read.option("mergeSchema", True).parquet(*paths).withColumn(QUARANTINE_BATCH, path_text(name))


# --- gold -------------------------------------------------------------------


def _active(folder: str) -> str:
    return f"{folder}/active"


def _ended(folder: str) -> str:
    return f"{folder}/ended"


@dataclass(frozen=True)
class GoldState:
    """What a gold version was made from, and how.

    ``silver_version`` is None where the version does not stand for all of one silver version,
    ``max_key`` where the highest surrogate key is not known without reading the rows. ``layout``
    names the folder of every key bucket of the active rows, below the gold folder: a bucket that
    a batch did not touch stays where an earlier version put it.
    """

    silver_version: int | None = None
    settings: str | None = None
    max_key: int | None = None
    layout: tuple[tuple[int, str], ...] = ()


def read_state(spark: SparkSession, folder: str) -> GoldState:
    """The state of the current gold version; one that was lost says nothing, and all is read from the data."""
    return _state_of(spark, folder, current_version(spark, _ended(folder)))


def _state_of(spark: SparkSession, folder: str, number: int) -> GoldState:
    text = files.read_text(spark, _note(folder, _STATE, number))
    if text is None:
        return GoldState()
    noted = json.loads(text)
    return GoldState(**noted | {"layout": tuple((bucket, path) for bucket, path in noted["layout"])})


def _bucket_places(spark: SparkSession, folder: str, number: int) -> list[tuple[int, str]]:
    """The buckets of active rows that a version wrote, each with its folder."""
    below = f"{version_folder('active', number)}/{_IS_ACTIVE}=true"
    found = _versions(spark, f"{folder}/{below}", BUCKET)
    return [(int(entry.name.partition("=")[2]), f"{below}/{entry.name}") for entry in found]


def write_gold(current: DataFrame, folder: str, state: GoldState = GoldState(), bucket: Column | None = None) -> int:
    """Publish the rows that were active before plus the new ones.

    One job writes them, split by ``is_active``: the active part replaces the one
    before. The rows this batch ended are few and lie in many small files, so a second
    job gathers them into ``ended``, which grows and is never written again. The
    version counts once that second job is done.

    With ``bucket``, the active part is split by it too, and ``current`` holds the rows of the
    buckets to write; those in the ``layout`` of ``state`` stay where they are.
    """
    spark = current.sparkSession
    number = current_version(spark, _ended(folder)) + 1
    written = version_folder(_active(folder), number)
    if bucket is None:
        with split_unsorted(spark):
            _dimension_writer(current).partitionBy(_IS_ACTIVE).parquet(written)
        layout = ()
    else:
        dealt = current.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
        _dimension_writer(dealt).partitionBy(_IS_ACTIVE, BUCKET).parquet(written)
        layout = (*state.layout, *_bucket_places(spark, folder, number))
    files.write_text(spark, _note(folder, _STATE, number), json.dumps(asdict(replace(state, layout=layout))))
    ended = _rows_of(spark, written, current.schema).where(~F.col(_IS_ACTIVE)).drop(_IS_ACTIVE, BUCKET)
    _dimension_writer(ended.hint("rebalance")).parquet(version_folder(_ended(folder), number))
    return number


def _dimension_writer(rows: DataFrame) -> DataFrameWriter:
    return rows.write.mode("overwrite").options(**{"compression": DIMENSION_CODEC, "parquet.compression.codec.zstd.level": "1"})


def _rows_of(spark: SparkSession, written: str, schema: T.StructType) -> DataFrame:
    """Rows of one version. The schema is given: a boolean folder name would be read as text."""
    return spark.read.schema(schema).parquet(written)


def read_gold(spark: SparkSession, folder: str, buckets: Collection[int] | None = None) -> DataFrame | None:
    """Active rows of the current version and all ended versions; None before the first load.

    ``buckets`` leaves out the active rows of all others, where they lie in buckets.
    """
    number = current_version(spark, _ended(folder))
    if number == 0:
        return None
    # The newest version has every column seen so far, also when it ended no row.
    columns = spark.read.parquet(version_folder(_ended(folder), number)).schema.fields
    flag = T.StructField(_IS_ACTIVE, T.BooleanType())
    layout = read_state(spark, folder).layout
    if layout:
        paths = [f"{folder}/{path}" for bucket, path in layout if buckets is None or bucket in buckets]
        rows = spark.read.schema(T.StructType(columns))
        live = rows.parquet(*paths) if paths else spark.createDataFrame([], T.StructType(columns))
        live = live.withColumn(_IS_ACTIVE, F.lit(True))
    else:
        live = _rows_of(spark, version_folder(_active(folder), number), T.StructType([*columns, flag]))
    past = [entry.path for entry in _versions(spark, _ended(folder), _VERSION) if _number(entry.name) <= number]
    ended = spark.read.schema(T.StructType(columns)).parquet(*past)
    names = [field.name for field in columns]
    order = [*names[:-1], _IS_ACTIVE, names[-1]]
    both = live.where(F.col(_IS_ACTIVE)).unionByName(ended.withColumn(_IS_ACTIVE, F.lit(False)))
    return both.select(*refs(order))


def _drop_before(spark: SparkSession, folder: str, oldest: int, but: Collection[int] = ()) -> list[str]:
    numbers = ((entry.path, _number(entry.name)) for entry in _versions(spark, folder, _VERSION))
    old = [path for path, number in numbers if number < oldest and number not in but]
    for path in old:
        files.delete(spark, path)
    return old


def drop_superseded(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete the active parts of a gold target older than the newest ``keep`` versions; ended rows stay.

    A version that one of those still takes a bucket from stays too.
    """
    newest = current_version(spark, _ended(folder))
    oldest = newest - keep + 1
    _drop_before(spark, f"{folder}/{_STATE}", oldest)
    states = [_state_of(spark, folder, number) for number in range(max(oldest, 1), newest + 1)]
    used = {_number(path.split("/")[1]) for state in states for _, path in state.layout}
    return _drop_before(spark, _active(folder), oldest, used)


def drop_old_silver(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` versions of a silver target, and the change sets that led to the others.

    A gold target that is further behind merges all of silver once. A version that one of those
    left still takes a bucket from stays too.
    """
    newest = current_version(spark, folder)
    oldest = newest - keep + 1
    _drop_before(spark, f"{folder}/{_FOLDED}", oldest)
    _drop_before(spark, f"{folder}/{_CHANGES}", oldest)
    states = [silver_state(spark, folder, number) for number in range(max(oldest, 1), newest + 1)]
    used = {_number(path.split("/")[0]) for state in states for _, _, path in state.kept}
    return _drop_before(spark, folder, oldest, used)
