"""Silver rows to a published dimension."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions.clock import BatchClock
from smeltwork.functions.hashing import bucket_of
from smeltwork.functions.naming import ref, refs
from smeltwork.operators import scd
from smeltwork.operators.changes import CHANGE, GONE, newest_changes
from smeltwork.operators.snapshot import snapshot
from smeltwork.operators.surrogate import highest_key
from smeltwork.plans.audit import (
    ALL_TARGETS,
    GOLD,
    SILVER,
    SKIPPED_NO_DATA,
    SKIPPED_NO_FILES,
    AuditTrail,
    Outcome,
)
from smeltwork.plans.control import Target, in_priority_order
from smeltwork.session import Scratch
from smeltwork.sources.zones import (
    GoldState,
    Zones,
    current_version,
    read_changes,
    read_gold,
    read_silver,
    read_state,
    write_gold,
)

_VERSION = "_silver_version"


@dataclass(frozen=True)
class GoldOptions:
    """``check_keys`` refuses a batch with two rows for one key, at the price of a shuffle of the keys.

    Silver has one row per key by construction, so a run does not ask again. With ``buckets``
    the active rows lie in that many folders by a digest of their keys, and a batch reads and
    writes only those that its keys fall into; worth it where batches touch few of them.
    """

    check_keys: bool = False
    hash_mode: str = "joined"
    skip_unchanged: bool = False
    close_missing: bool = False
    dense_sk: bool = True
    seed: int = 0
    buckets: int = 0


def _merge_options(strategy: str | None, options: GoldOptions) -> dict[str, bool]:
    if strategy == "SCD1":
        return {"skip_unchanged": options.skip_unchanged}
    return {"close_missing": options.close_missing, "dense_sk": options.dense_sk}


def merge_silver(
    silver: DataFrame,
    dimension: DataFrame | None,
    target: Target,
    clock: BatchClock,
    options: GoldOptions = GoldOptions(),
    scratch: Scratch | None = None,
    max_key: int | None = None,
    gone: DataFrame | None = None,
) -> scd.Merge:
    """Stage silver rows, all of them or a change set, and merge them into the dimension by the target's strategy."""
    scd.check_source(silver.columns, target.keys, target.surrogate)
    batch = scd.batch_of(silver, target.keys, clock, options.hash_mode, options.check_keys)
    chosen = _merge_options(target.strategy, options)
    return scd.merge(target.strategy, dimension, batch, target.surrogate, scratch, max_key, gone, **chosen)


def _merge_settings(target: Target, options: GoldOptions) -> str:
    """All that decides what a merge makes of the same rows, as text."""
    chosen = sorted(_merge_options(target.strategy, options).items())
    return json.dumps([target.strategy, target.keys, options.hash_mode, chosen, options.buckets])


def _touched(
    batch: DataFrame, gone: DataFrame | None, dimension: DataFrame, target: Target, state: GoldState, options: GoldOptions
) -> set[int] | None:
    """The buckets that a batch touches, at most all of them; None where the whole dimension is concerned.

    That is so if the layout is another one, if digests have to be made anew because the columns or
    the keys' types are not the dimension's, or if rows that the batch does not name may end.
    """
    keys = target.keys
    types = [dict(frame.select(*refs(keys)).dtypes) for frame in (batch, dimension)]
    business = [scd.business_columns(names, keys) for names in (batch.columns, scd.source_columns(dimension, target.surrogate))]
    if not state.layout or state.settings != _merge_settings(target, options) or types[0] != types[1] or business[0] != business[1]:
        return None
    if options.close_missing and gone is None:
        return None
    named = batch.select(*refs(keys))
    named = named if gone is None else named.unionByName(gone)
    return {row["bucket"] for row in named.select(bucket_of(keys, options.buckets).alias("bucket")).distinct().collect()}


def pending_changes(
    spark: SparkSession, target: Target, folder: str, state: GoldState, version: int, options: GoldOptions
) -> DataFrame | None:
    """What silver changed since the version that gold holds; None where gold has to see all of silver.

    That is so if a version in between has no change set, if gold was made in another way, or if
    the strategy does something to unchanged rows: SCD1 stamps them unless it skips them, and
    numbers with gaps count them.
    """
    sparing = options.skip_unchanged if target.strategy == "SCD1" else options.dense_sk
    if not sparing or state.silver_version is None or state.settings != _merge_settings(target, options):
        return None
    changes = read_changes(spark, folder, state.silver_version, version, _VERSION)
    if changes is None:
        return None
    if version == state.silver_version + 1:
        return changes.drop(_VERSION)
    return newest_changes(changes, target.keys, _VERSION)


def publish_target(
    spark: SparkSession,
    target: Target,
    zones: Zones,
    clock: BatchClock,
    settings: Mapping[str, Any],
    options: GoldOptions = GoldOptions(),
) -> Outcome:
    """Merge one target and publish the result; a batch known to change nothing writes nothing.

    Where silver says what it changed since the version that gold holds, only that is merged:
    ``rows_processed`` then counts the changes. A gold version keeps its highest surrogate key.
    """
    if not target.keys:
        return Outcome(SKIPPED_NO_DATA, error_message="no natural keys: the target ends at silver")
    source = f"{zones.silver}/{target.name}"
    version = current_version(spark, source)
    silver = read_silver(spark, source)
    if silver is None:
        return Outcome(SKIPPED_NO_DATA)
    snapped = bool(settings.get("is_snapshot"))
    if options.close_missing and snapped:
        raise ValueError("close_missing would end every key outside the snapshot")
    folder = f"{zones.gold}/{target.name}"
    state = read_state(spark, folder)
    with Scratch(spark) as scratch:
        changes = None if snapped else pending_changes(spark, target, source, state, version, options)
        gone = None
        if changes is not None:
            changes = scratch.store(changes, "changes")
            rows = changes.count()
            if not rows:
                return Outcome(rows_inserted=0, rows_expired=0, rows_updated=0)
            silver = changes.where(ref(CHANGE) != GONE).drop(CHANGE)
            if options.close_missing:
                gone = changes.where(ref(CHANGE) == GONE).select(*refs(target.keys))
        elif snapped:
            reduced = snapshot(silver, settings, target.keys, options.seed, scratch)
            silver = reduced if reduced is silver else scratch.store(reduced, "snapshot")
        dimension, highest, bucket, layout = read_gold(spark, folder), state.max_key, None, ()
        if options.buckets:
            bucket = bucket_of(target.keys, options.buckets)
            touched = _touched(silver, gone, dimension, target, state, options) if dimension is not None else None
            if touched is not None:
                if highest is None:  # of all buckets
                    highest = highest_key(dimension, target.surrogate).first()["max_key"]
                dimension = read_gold(spark, folder, touched)
                layout = tuple(place for place in state.layout if place[0] not in touched)
        merged = merge_silver(silver, dimension, target, clock, options, scratch, highest, gone)
        if changes is None:
            rows = silver.count()
        if not merged.changed:
            return Outcome(rows_processed=rows, rows_inserted=0, rows_expired=0, rows_updated=0)
        seen = Observation()
        stamped = ref("is_active") & (ref("effective_start_date") == clock.now)
        counted = merged.current.observe(
            seen, F.count_if(~ref("is_active")).alias("expired"), F.count_if(stamped).alias("stamped")
        )
        held = None if snapped else version
        write_gold(counted, folder, GoldState(held, _merge_settings(target, options), merged.max_key, layout), bucket)
        return Outcome(
            rows_processed=rows,
            rows_inserted=merged.inserted,
            rows_expired=seen.get["expired"],
            rows_updated=seen.get["stamped"] - merged.inserted,
        )


def run_gold(
    spark: SparkSession,
    zones: Zones,
    targets: Sequence[Target],
    clock: BatchClock,
    settings: Mapping[str, Any],
    trail: AuditTrail,
    options: GoldOptions = GoldOptions(),
    fail_fast: bool = False,
    at_once: int = 1,
    own: Mapping[str, GoldOptions] | None = None,
) -> bool:
    """Publish every target; False when silver stood by in this run. ``own`` holds targets' own options."""
    if trail.upstream_skipped(SILVER):
        trail.guard(ALL_TARGETS, GOLD, lambda: Outcome(SKIPPED_NO_FILES))
        trail.flush()
        return False

    def work(target: Target) -> None:
        trail.guard(
            target.name,
            GOLD,
            lambda: publish_target(spark, target, zones, clock, settings, (own or {}).get(target.name, options)),
            fail_fast,
        )

    try:
        in_priority_order(targets, work, at_once)
    finally:
        trail.flush()
    return True
