"""Landing files to all-text bronze rows."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import chain, count

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions.clock import BatchClock
from smeltwork.functions.naming import refs
from smeltwork.operators.joining import anti
from smeltwork.plans.audit import (
    ALL_TARGETS,
    BRONZE,
    FAILED,
    SKIPPED_NO_FILES,
    TAKEN_BEFORE,
    UNMATCHED,
    AuditTrail,
    Outcome,
    now,
)
from smeltwork.plans.control import Target, in_priority_order
from smeltwork.sources import files
from smeltwork.sources.landing import landing_entries, routed_entries
from smeltwork.sources.ledger import OFF, already_taken, write_ledger
from smeltwork.sources.readers import CORRUPT, SOURCE_FILE, BadFile, Feed, ReadOptions, bronze_frame, feeds
from smeltwork.sources.zones import Zones, drop_attempt, read_bronze, write_bronze, write_malformed


_MOVES = 16  # files moved to the archive side by side


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def _readable(
    spark: SparkSession,
    feed: Feed,
    zones: Zones,
    clock: BatchClock,
    options: ReadOptions,
    errors: dict[str, str],
    probe: bool,
) -> list[DataFrame]:
    """The feed as one frame, or file by file when the group holds a bad file.

    ``probe`` parses each file completely, to find the one that broke a write.
    """
    try:
        if probe and len(feed.paths) > 1:
            raise BadFile("look at each file")
        frame = bronze_frame(spark, feed, zones.landing, clock, options)
        if probe:
            frame.write.format("noop").mode("overwrite").save()
        return [frame]
    except Exception as error:  # noqa: BLE001 - the error becomes the file's audit row
        if len(feed.paths) == 1:
            errors[feed.paths[0]] = str(error)
            return []
        parts = [_readable(spark, single, zones, clock, options, errors, probe) for single in map(feed.only, feed.paths)]
        return [frame for part in parts for frame in part]


def ingest_target(
    spark: SparkSession,
    target: Target,
    routed: Sequence[dict],
    zones: Zones,
    clock: BatchClock,
    batch_id: str,
    options: ReadOptions = ReadOptions(),
) -> dict[str, Outcome]:
    """Write the routed files of one target as one batch; an outcome for every file.

    All files go out in a single job. When that job fails, each file is parsed alone,
    the bad ones are reported, and the good ones are written. Files that another batch has
    taken are passed over.
    """
    folder = f"{zones.bronze}/{target.name}"
    held = already_taken(spark, folder, routed, zones.landing, options.ledger, batch_id)
    before = {entry["path"]: _taken_before(entry, held[entry["name"]]) for entry in routed if entry["name"] in held}
    routed = [entry for entry in routed if entry["path"] not in before]
    supported = [entry for entry in routed if entry["route"] == "MATCHED"]
    outcomes = {
        entry["path"]: Outcome(FAILED, error_message=f"Unsupported file format: {entry['extension']}")
        for entry in routed
        if entry["route"] != "MATCHED"
    }
    groups, errors = feeds(spark, target.name, supported, target.row_tag, options, zones.landing)
    names = {entry["path"]: entry["name"] for entry in supported}

    def frames(probe: bool) -> list[DataFrame]:
        parts = [_readable(spark, feed, zones, clock, options, errors, probe) for feed in groups]
        return [frame for part in parts for frame in part]

    def write(ready: list[DataFrame]) -> None:
        """One attempt at the batch, of the files that no error names."""
        delivered = [name for path, name in names.items() if path not in errors]
        noted = [entry for entry in supported if entry["path"] not in errors]

        def note(attempt: str) -> None:
            if options.ledger != OFF and noted:
                write_ledger(spark, folder, attempt, noted, zones.landing, options.ledger)

        rows = _stack(ready)
        if CORRUPT not in rows.columns:
            write_bronze(_without(spark, rows, errors, names), folder, batch_id, delivered, note)
            return
        seen = Observation()
        kept = _without(spark, rows, errors, names).observe(seen, F.count(CORRUPT).alias("malformed"))
        if options.malformed == "divert":
            number = write_bronze(kept.where(F.col(CORRUPT).isNull()).drop(CORRUPT), folder, batch_id, delivered, note)
            if seen.get["malformed"]:
                bad = _without(spark, rows, errors, names).where(F.col(CORRUPT).isNotNull())
                write_malformed(bad, f"{zones.quarantine}/{target.name}", batch_id, number)
            return
        number = write_bronze(kept.drop(CORRUPT), folder, batch_id, delivered, note)
        if options.malformed == "reject" and seen.get["malformed"]:
            drop_attempt(spark, folder, batch_id, number)
            # Spark answers no query on the corrupt column alone, so the others are looked at too.
            others = F.length(F.concat_ws("", *refs(name for name in rows.columns if name != CORRUPT))) >= 0
            bad = rows.where(F.col(CORRUPT).isNotNull() & others).groupBy(SOURCE_FILE).agg(F.count("*").alias("n"))
            found = {row[SOURCE_FILE]: row["n"] for row in bad.collect()}
            for path, name in names.items():
                if name in found:
                    errors[path] = f"{found[name]} malformed rows in {name}"
            if set(names) - set(errors):
                write(ready)

    ready = frames(probe=False)
    if ready:
        try:
            write(ready)
        except Exception:  # noqa: BLE001 - find the file that broke the job
            ready = frames(probe=True)
            if ready:
                write(ready)

    counts = _rows_per_file(spark, folder, batch_id) if ready else {}
    for entry in supported:
        name = entry["name"]
        if entry["path"] in errors:
            outcomes[entry["path"]] = Outcome(FAILED, error_message=errors[entry["path"]])
        elif entry["extension"] == "xml" and not counts.get(name):
            outcomes[entry["path"]] = Outcome(FAILED, error_message=f"No rows under the row tag in {name}")
        else:
            outcomes[entry["path"]] = Outcome(rows_processed=counts.get(name, 0))
    for entry in routed:
        outcomes[entry["path"]].source_file = entry["name"]
    return outcomes | before


def _taken_before(entry: dict, attempt: str) -> Outcome:
    """A file whose rows are in bronze: it is only put away."""
    return Outcome(TAKEN_BEFORE, source_file=entry["name"], error_message=f"bronze holds it in {attempt}")


def _without(spark: SparkSession, rows: DataFrame, errors: dict[str, str], names: dict[str, str]) -> DataFrame:
    """Rows of files without an error; a refused folder may have parts in feeds that can be read."""
    refused = [(names[path],) for path in errors if path in names]
    if not refused:
        return rows
    return anti(rows, spark.createDataFrame(refused, f"`{SOURCE_FILE}` string"), [SOURCE_FILE])


def _rows_per_file(spark: SparkSession, folder: str, batch_id: str) -> dict[str, int]:
    """Rows per landing file, from the one column of the batch just written."""
    written = read_bronze(spark, folder, batch_id)
    if written is None:
        return {}
    counted = written.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("n")).collect()
    return {row[SOURCE_FILE]: row["n"] for row in counted}


def archive(spark: SparkSession, zones: Zones, target: str, entry: dict, batch_id: str) -> str:
    """Move an ingested raw file out of landing and return where it went.

    A feed may deliver under the same name every day: a name that is taken gets the
    batch id, and a number after that, so no archived file is replaced.
    """
    name = entry["name"]
    candidates = chain(
        [f"{target}_{name}", f"{target}_{batch_id}_{name}"],
        (f"{target}_{batch_id}_{number}_{name}" for number in count(2)),
    )
    free = next(path for path in (f"{zones.raw_archive}/{c}" for c in candidates) if not files.exists(spark, path))
    files.move(spark, entry["path"], free)
    return free


def run_bronze(
    spark: SparkSession,
    zones: Zones,
    targets: Sequence[Target],
    clock: BatchClock,
    batch_id: str,
    trail: AuditTrail,
    options: ReadOptions = ReadOptions(),
    fail_fast: bool = False,
    at_once: int = 1,
) -> bool:
    """Ingest what lies in landing; False when there was nothing."""
    start = now()
    entries = landing_entries(spark, zones.landing)
    if not entries:
        trail.record(ALL_TARGETS, BRONZE, start, Outcome(SKIPPED_NO_FILES))
        trail.flush()
        return False
    patterns = [(target.name, target.file_pattern) for target in targets if target.file_pattern]
    routed = routed_entries(spark, entries, patterns)

    def work(target: Target) -> None:
        mine = [entry for entry in routed if entry["target_table"] == target.name]
        if mine:
            _ingest_and_archive(spark, target, mine, zones, clock, batch_id, trail, options, fail_fast)

    try:
        in_priority_order(targets, work, at_once)
        for entry in routed:
            if entry["target_table"] is None:
                trail.record(ALL_TARGETS, BRONZE, start, Outcome(UNMATCHED, source_file=entry["name"]))
    finally:
        trail.flush()
    return True


def _ingest_and_archive(spark, target, mine, zones, clock, batch_id, trail, options, fail_fast) -> None:
    start = now()
    try:
        outcomes = ingest_target(spark, target, mine, zones, clock, batch_id, options)
    except Exception as error:  # noqa: BLE001 - audited below
        outcomes = {
            entry["path"]: Outcome(FAILED, error_message=str(error), source_file=entry["name"]) for entry in mine
        }

    def put_away(entry: dict) -> None:
        outcome = outcomes[entry["path"]]
        if outcome.status != FAILED:
            try:
                archive(spark, zones, target.name, entry, batch_id)
            except Exception as error:  # noqa: BLE001 - the rows are in bronze, the file waits for the next run
                outcome.status, outcome.error_message = FAILED, str(error)

    with ThreadPoolExecutor(_MOVES) as pool:
        list(pool.map(put_away, mine))
    for entry in mine:
        trail.record(target.name, BRONZE, start, outcomes[entry["path"]])
    broken = [outcome.error_message for outcome in outcomes.values() if outcome.status == FAILED]
    if broken and fail_fast:
        raise RuntimeError(broken[0])
