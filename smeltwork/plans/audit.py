"""The audit trail: one typed row per file or target, and the skip decision read from it.

The rows of a day, by their end in UTC, lie in one folder: a lookup of the newest record reads the newest days, and
old days can be dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.sources import files

# Layer names, statuses and the table name of a skipped run.
BRONZE, SILVER, GOLD = "Bronze_V2", "Silver_V2", "Gold_V2"
SUCCESS, FAILED, SKIPPED_NO_FILES = "Success", "Failed", "SKIPPED_NO_FILES"
ALL_TARGETS = "ALL_TARGETS"
NO_ERROR = "None"

SKIPPED_NO_DATA, UNMATCHED, TAKEN_BEFORE = "SKIPPED_NO_DATA", "UNMATCHED", "TAKEN_BEFORE"

# The first eight columns of the audit trail; the others are added here.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_expired", T.LongType()),
        T.StructField("rows_quarantined", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
    ]
)
_ARROW = {
    "string": pa.string(),
    "timestamp": pa.timestamp("us", "UTC"),
    "double": pa.float64(),
    "bigint": pa.int64(),
}
_KINDS = [field_.dataType.simpleString() for field_ in AUDIT_SCHEMA.fields]
_END, _DAY = AUDIT_SCHEMA.fieldNames().index("end_time"), "day="
CLASSIC_COLUMNS = [field_.name for field_ in AUDIT_SCHEMA.fields[:8]]


def now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Outcome:
    """What a unit of work reports back."""

    status: str = SUCCESS
    rows_processed: int = 0
    error_message: str | None = None
    source_file: str | None = None
    rows_inserted: int | None = None
    rows_expired: int | None = None
    rows_quarantined: int | None = None
    rows_updated: int | None = None


@dataclass
class AuditTrail:
    """Collects the records of one run and appends them as one typed write per layer and day."""

    spark: SparkSession
    folder: str
    run_id: str
    _pending: list[tuple] = field(default_factory=list)
    outcomes: list[tuple[str, str, Outcome]] = field(default_factory=list)

    def record(self, table: str, layer: str, start: datetime, outcome: Outcome) -> None:
        end = now()
        values = asdict(outcome)
        values.update(
            table_name=table,
            layer=layer,
            start_time=start.replace(microsecond=0),
            end_time=end.replace(microsecond=0),
            duration_seconds=(end - start).total_seconds(),
            run_id=self.run_id,
        )
        self._pending.append(tuple(values[name] for name in AUDIT_SCHEMA.fieldNames()))
        self.outcomes.append((layer, table, outcome))

    def guard(self, table: str, layer: str, work: Callable[[], Outcome], fail_fast: bool = False) -> Outcome:
        """Run one unit; an error becomes its audit row and does not stop the others."""
        start = now()
        try:
            outcome = work()
        except Exception as error:
            outcome = Outcome(FAILED, error_message=str(error))
            self.record(table, layer, start, outcome)
            if fail_fast:
                raise
            return outcome
        self.record(table, layer, start, outcome)
        return outcome

    def last_status(self, layer: str) -> str | None:
        """The newest status this run has recorded for a layer, if it has run here."""
        return next((outcome.status for name, _, outcome in reversed(self.outcomes) if name == layer), None)

    def upstream_skipped(self, layer: str) -> bool:
        """Did the layer before find nothing? Asked of the stored trail when it ran in another job."""
        here = self.last_status(layer)
        if here is not None:
            return here == SKIPPED_NO_FILES
        return skipped_before(self.spark, self.folder, layer, self.run_id)

    def flush(self) -> None:
        rows, self._pending = self._pending, []
        days: dict[str, list[tuple]] = {}
        for row in rows:
            days.setdefault(f"{row[_END]:%Y-%m-%d}", []).append(row)
        for day, own in days.items():
            columns = [pa.array(values, _ARROW[kind]) for values, kind in zip(zip(*own), _KINDS)]
            table = pa.Table.from_arrays(columns, names=AUDIT_SCHEMA.fieldNames())
            frame = self.spark.createDataFrame(table, AUDIT_SCHEMA).coalesce(1)
            frame.write.mode("append").parquet(f"{self.folder}/{_DAY}{day}")


def _by_day(spark: SparkSession, folder: str) -> list[list[str]]:
    """Paths of each day, newest first; files written before there were days come last."""
    found = files.children(spark, folder)
    days = [[entry.path] for entry in reversed(found) if entry.is_folder and entry.name.startswith(_DAY)]
    loose = [entry.path for entry in found if not entry.is_folder and entry.name.endswith(".parquet")]
    return [*days, loose] if loose else days


def _day_of(path: str) -> str:
    """The day of a path as text, empty for a file written before there were days."""
    name = path.rsplit("/", 1)[1]
    return name.removeprefix(_DAY) if name.startswith(_DAY) else ""


def _rows_in(spark: SparkSession, groups: Sequence[list[str]]) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(*[path for group in groups for path in group])


def read_audit(spark: SparkSession, folder: str, since: date | None = None) -> DataFrame | None:
    """The trail, whole or of the days from ``since`` on; None where there is none."""
    groups = [group for group in _by_day(spark, folder) if since is None or _day_of(group[0]) >= since.isoformat()]
    return _rows_in(spark, groups) if groups else None


def drop_audit_before(spark: SparkSession, folder: str, day: date) -> list[str]:
    """Delete the days before ``day``, and files written before there were days."""
    old = [path for group in _by_day(spark, folder) for path in group if _day_of(path) < day.isoformat()]
    for path in old:
        files.delete(spark, path)
    return old


def classic_view(audit: DataFrame) -> DataFrame:
    """The eight shared columns, with the text ``None`` where there was no error."""
    return audit.select(*CLASSIC_COLUMNS).withColumn("error_message", F.ifnull("error_message", F.lit(NO_ERROR)))


def _newest() -> Column:
    """Newest end time first; of equal times the one that names its table last."""
    return F.struct("end_time", "start_time", "table_name", "status")


def last_status(audit: DataFrame, by: Sequence[str] = ("layer",)) -> DataFrame:
    """The newest status of each layer, or of each layer of each run.

    A plain aggregate: each task sends one row per group, however long the trail is.
    """
    return audit.groupBy(*by).agg(F.max_by("status", _newest()).alias("status"))


def _newest_status(audit: DataFrame, layer: str, run_id: str | None) -> str | None:
    scope = audit.where(F.col("layer") == layer)
    row = last_status(scope if run_id is None else scope.where(F.col("run_id") == run_id)).first()
    return None if row is None else row["status"]


def should_skip(audit: DataFrame | None, upstream: str, run_id: str | None = None) -> bool:
    """True when the upstream layer's newest record says there were no files."""
    return audit is not None and _newest_status(audit, upstream, run_id) == SKIPPED_NO_FILES


def skipped_before(spark: SparkSession, folder: str, upstream: str, run_id: str | None = None) -> bool:
    """``should_skip`` of the stored trail: reads the newest day, then 2, 4, 8 ... days before it, until there is a record."""
    groups, step = _by_day(spark, folder), 1
    while groups:
        status = _newest_status(_rows_in(spark, groups[:step]), upstream, run_id)
        if status is not None:
            return status == SKIPPED_NO_FILES
        groups, step = groups[step:], 2 * step
    return False
