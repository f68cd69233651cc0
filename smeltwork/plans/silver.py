"""Bronze rows to clean silver rows and quarantined rows."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions import rules
from smeltwork.functions.casting import typed
from smeltwork.functions.clock import BatchClock
from smeltwork.functions.hashing import bucket_of, row_digest
from smeltwork.functions.naming import refs, standard_name, standardise
from smeltwork.operators.changes import CHANGE, change_set
from smeltwork.operators.dedup import drop_copies, keep_latest, merge_latest
from smeltwork.operators.joining import anti, semi
from smeltwork.operators.quarantine import VERDICT, Routed, route
from smeltwork.operators.scd import METADATA
from smeltwork.plans.audit import (
    ALL_TARGETS,
    BRONZE,
    SILVER,
    SKIPPED_NO_DATA,
    SKIPPED_NO_FILES,
    AuditTrail,
    Outcome,
)
from smeltwork.plans.control import Target, in_priority_order
from smeltwork.session import Scratch
from smeltwork.sources.zones import (
    QUARANTINE_BATCH,
    SilverState,
    Zones,
    bronze_attempts,
    read_attempts,
    read_quarantine,
    read_silver,
    silver_places,
    silver_state,
    write_changes,
    write_quarantine,
    write_silver,
)

SILVER_TIMESTAMP = "silver_timestamp"
ROW_HASH, RULE = "quarantine_row_hash", "quarantine_rule"


@dataclass(frozen=True)
class SilverOptions:
    """How to treat the cases a control row leaves open.

    ``fallback_to_last_good`` applies the rule before dedup, so an older good row
    takes the place of a bad newest one. ``incremental`` folds the bronze attempts not yet
    held into the rows kept so far instead of reading the whole history, and publishes what
    that changed, so that gold need not compare all of silver. Columns of ``types`` and
    ``ignore_in_copies`` that a target lacks are passed over. With ``buckets`` the rows of a target
    with keys lie in that many folders by a digest of their keys, and an incremental batch reads and
    writes only those that its keys fall into; rows elsewhere keep the ``silver_timestamp`` they have.
    """

    on_unknown: str = "clean"
    null_keys: str = "keep"
    on_error: str = "unknown"
    on_collision: str = "raise"
    fallback_to_last_good: bool = False
    incremental: bool = False
    buckets: int = 0
    ignore_in_copies: Sequence[str] = ()
    types: Mapping[str, str] = field(default_factory=dict)


def _verdict_settings(target: Target, options: SilverOptions) -> str:
    """All that a verdict on unchanged rows depends on, as text."""
    return json.dumps(
        [target.rule, target.keys, options.on_unknown, options.null_keys, options.on_error, sorted(options.types.items())])


def cleanse(bronze: DataFrame, keys: Sequence[str], rule: str | None, options: SilverOptions = SilverOptions()) -> Routed:
    """Standard names, one row per key (or per content), and a verdict for each row left."""
    frame = typed(standardise(bronze, options.on_collision), options.types)
    if not keys:
        ignored = [name for name in options.ignore_in_copies if name in frame.columns]
        return route(drop_copies(frame, ignored), rule, options.on_unknown, on_error=options.on_error)
    if not options.fallback_to_last_good:
        return route(keep_latest(frame, keys), rule, options.on_unknown, keys, options.null_keys, options.on_error)
    routed = route(frame, rule, options.on_unknown, keys, options.null_keys, options.on_error).flagged
    good = routed.where(F.col(VERDICT) == rules.CLEAN)
    rest = routed.where(F.col(VERDICT) != rules.CLEAN)
    return Routed(keep_latest(good, keys).unionByName(rest))


def _kept_so_far(spark: SparkSession, folder: str, buckets: Collection[int] | None = None) -> DataFrame | None:
    """Newest row per key of the published version, or of some of its buckets, good and bad alike."""
    sides = [read_silver(spark, folder, verdict, buckets) for verdict in (rules.CLEAN, rules.QUARANTINE, rules.DROPPED)]
    if sides[0] is None:
        return None
    return sides[0].unionByName(sides[1]).unionByName(sides[2]).drop(SILVER_TIMESTAMP)


def fold(state: DataFrame, batch: DataFrame | None, target: Target, options: SilverOptions) -> Routed:
    """The rows kept so far with new bronze rows folded in; equals a rescan of the whole history.

    Only keys that the new rows touch are ranked. The others pass as they are: no shuffle
    of the state while the batch is small. The rule is applied anew to every row.
    """
    both = typed(state, options.types)
    if batch is not None:
        fresh = typed(standardise(batch, options.on_collision), options.types)
        both = merge_latest(both, fresh, target.keys)
    return route(both, target.rule, options.on_unknown, target.keys, options.null_keys, options.on_error)


@dataclass(frozen=True)
class Folded:
    """Rows with their verdict, and what differs from the version before where that is known.

    ``kept`` are the folders of buckets whose rows are not among ``flagged`` and stay as they are.
    """

    flagged: DataFrame
    changes: DataFrame | None = None
    kept: tuple[tuple[int, str, str], ...] = ()


def fold_changes(
    state: DataFrame, batch: DataFrame | None, target: Target, options: SilverOptions, scratch: Scratch
) -> Folded:
    """``fold``, with the clean rows that it adds, changes or takes away.

    Verdicts on untouched keys must be those of the version before. What the touched keys
    held before and hold now is stored, so the state is read twice, as by ``fold``.
    """
    state = typed(state, options.types)
    if batch is None:
        fresh = state.limit(0)
    else:
        fresh = typed(standardise(batch, options.on_collision), options.types)

    def judged(rows: DataFrame) -> Routed:
        return route(rows, target.rule, options.on_unknown, target.keys, options.null_keys, options.on_error)

    before = scratch.store(semi(state, fresh, target.keys), "touched-before")
    touched = keep_latest(before.unionByName(fresh, allowMissingColumns=True), target.keys)
    after = scratch.store(touched, "touched-after")
    whole = after.unionByName(anti(state, fresh, target.keys), allowMissingColumns=True)
    changes = change_set(judged(before).clean, judged(after).clean, target.keys, METADATA)
    return Folded(judged(whole).flagged, changes)


def _touched(state: DataFrame, batch: DataFrame | None, target: Target, options: SilverOptions) -> set[int] | None:
    """The buckets that a batch's keys fall into, at most all of them; None where a column's type is another one.

    Rows of one type cannot be read with those of another, so all are written anew then.
    """
    if batch is None:
        return set()
    fresh = typed(standardise(batch, options.on_collision), options.types)
    before, after = dict(typed(state, options.types).dtypes), dict(fresh.dtypes)
    if any(before[name] != after[name] for name in before.keys() & after.keys()):
        return None
    named = fresh.select(*refs(target.keys)).select(bucket_of(target.keys, options.buckets).alias("bucket"))
    return {row["bucket"] for row in named.distinct().collect()}


def _folded(
    spark: SparkSession, zones: Zones, target: Target, attempts: Sequence[str], options: SilverOptions, scratch: Scratch
) -> Folded | None:
    """Rows with their verdict, from all of bronze or from the state and what it does not hold yet.

    A batch whose own silver run failed is folded by the next run, and so are stream batches.
    """
    bronze, silver = f"{zones.bronze}/{target.name}", f"{zones.silver}/{target.name}"
    state = _kept_so_far(spark, silver) if options.incremental and target.keys else None
    noted = silver_state(spark, silver) if state is not None else SilverState()
    held = set(noted.attempts)
    if state is None or not held:
        source = read_attempts(spark, bronze, attempts)
        return None if source is None else Folded(cleanse(source, target.keys, target.rule, options).flagged)
    missing = read_attempts(spark, bronze, [attempt for attempt in attempts if attempt not in held])
    columns = [*state.columns, *(missing.columns if missing is not None else ())]
    if noted.settings != _verdict_settings(target, options) or CHANGE in (standard_name(name) for name in columns):
        return Folded(fold(state, missing, target, options).flagged)
    touched = _touched(state, missing, target, options) if options.buckets and options.buckets == noted.buckets else None
    if touched is None:
        return fold_changes(state, missing, target, options, scratch)
    folded = fold_changes(_kept_so_far(spark, silver, touched), missing, target, options, scratch)
    return replace(folded, kept=tuple(place for place in silver_places(spark, silver, noted) if place[0] not in touched))


def new_quarantine_rows(bad: DataFrame, caught: DataFrame | None, batch_id: str) -> DataFrame:
    """Bad rows that no other batch has put into quarantine, so a rescan does not repeat them."""
    if caught is None:
        return bad
    return anti(bad, caught.where(F.col(QUARANTINE_BATCH) != batch_id), [ROW_HASH])


def cleanse_target(
    spark: SparkSession,
    target: Target,
    zones: Zones,
    clock: BatchClock,
    batch_id: str,
    options: SilverOptions = SilverOptions(),
) -> Outcome:
    """Publish one target's silver version and add its new bad rows to quarantine.

    The dedup runs once: clean and bad rows leave in the same write job, which also
    counts them; the few bad rows are then copied from what was written.
    """
    if options.incremental and options.fallback_to_last_good:
        raise ValueError("fallback_to_last_good needs the whole history, so it cannot be incremental")
    attempts = bronze_attempts(spark, f"{zones.bronze}/{target.name}")
    folder = f"{zones.silver}/{target.name}"
    with Scratch(spark) as scratch:
        folded = _folded(spark, zones, target, attempts, options, scratch)
        if folded is None:
            return Outcome(SKIPPED_NO_DATA)
        seen = Observation()
        counted = folded.flagged.withColumn(SILVER_TIMESTAMP, clock.now).observe(
            seen,
            F.count_if(F.col(VERDICT) == rules.CLEAN).alias("clean"),
            F.count_if(F.col(VERDICT) == rules.QUARANTINE).alias("bad"),
        )
        buckets = options.buckets if target.keys else 0
        state = SilverState(tuple(attempts), _verdict_settings(target, options), buckets, folded.kept)
        number = write_silver(counted, folder, state, bucket_of(target.keys, buckets) if buckets else None)
        if folded.changes is not None:
            write_changes(folded.changes.withColumn(SILVER_TIMESTAMP, clock.now), folder, number)
    totals = seen.get
    if folded.kept:  # counted from file footers
        totals = {name: read_silver(spark, folder, verdict).count() for name, verdict in (("clean", rules.CLEAN), ("bad", rules.QUARANTINE))}
    if totals["bad"]:
        _quarantine(spark, target, zones, clock, batch_id)
    return Outcome(rows_processed=totals["clean"], rows_quarantined=totals["bad"])


def _quarantine(spark: SparkSession, target: Target, zones: Zones, clock: BatchClock, batch_id: str) -> None:
    folder = f"{zones.quarantine}/{target.name}"
    bad = read_silver(spark, f"{zones.silver}/{target.name}", rules.QUARANTINE).drop(SILVER_TIMESTAMP)
    named = bad.select(
        "*",
        clock.now.alias("quarantined_at"),
        row_digest(sorted(bad.columns), "present").alias(ROW_HASH),
        F.lit(target.rule).alias(RULE),
    )
    caught = read_quarantine(spark, folder)
    write_quarantine(new_quarantine_rows(named, caught, batch_id), folder, batch_id)


def run_silver(
    spark: SparkSession,
    zones: Zones,
    targets: Sequence[Target],
    clock: BatchClock,
    batch_id: str,
    trail: AuditTrail,
    options: SilverOptions = SilverOptions(),
    fail_fast: bool = False,
    at_once: int = 1,
    own: Mapping[str, SilverOptions] | None = None,
) -> bool:
    """Cleanse every target; False when bronze found nothing in this run. ``own`` holds targets' own options."""
    if trail.upstream_skipped(BRONZE):
        trail.guard(ALL_TARGETS, SILVER, lambda: Outcome(SKIPPED_NO_FILES))
        trail.flush()
        return False

    def work(target: Target) -> None:
        trail.guard(
            target.name,
            SILVER,
            lambda: cleanse_target(spark, target, zones, clock, batch_id, (own or {}).get(target.name, options)),
            fail_fast,
        )

    try:
        in_priority_order(targets, work, at_once)
    finally:
        trail.flush()
    return True
