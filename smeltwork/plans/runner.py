"""The layers in order for one batch."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from smeltwork.functions.clock import BatchClock
from smeltwork.plans.audit import AuditTrail
from smeltwork.plans.bronze import run_bronze
from smeltwork.plans.control import execution_settings, load_targets
from smeltwork.plans.gold import GoldOptions, run_gold
from smeltwork.plans.silver import SilverOptions, run_silver
from smeltwork.sources.readers import ReadOptions
from smeltwork.sources.zones import Zones


@dataclass(frozen=True)
class RunOptions:
    """``silver_of`` and ``gold_of`` hold the options of single targets, in place of the common ones."""

    read: ReadOptions = field(default_factory=ReadOptions)
    silver: SilverOptions = field(default_factory=SilverOptions)
    gold: GoldOptions = field(default_factory=GoldOptions)
    fail_fast: bool = False
    targets_at_once: int = 4
    silver_of: Mapping[str, SilverOptions] = field(default_factory=dict)
    gold_of: Mapping[str, GoldOptions] = field(default_factory=dict)


def run_layers(
    spark: SparkSession,
    zones: Zones,
    control: DataFrame,
    clock: BatchClock,
    batch_id: str,
    execution: DataFrame | None = None,
    options: RunOptions = RunOptions(),
) -> AuditTrail:
    """Bronze, then silver, then gold; an empty landing folder makes all three stand by.

    A failed unit is audited and the run goes on; with ``fail_fast`` it raises, so a
    scheduler's retry sees it.
    """
    targets = load_targets(control)
    how = (options.fail_fast, options.targets_at_once)
    trail = AuditTrail(spark, zones.audit, batch_id)
    run_bronze(spark, zones, targets, clock, batch_id, trail, options.read, *how)
    run_silver(spark, zones, targets, clock, batch_id, trail, options.silver, *how, options.silver_of)
    settings = execution_settings(execution)
    run_gold(spark, zones, targets, clock, settings, trail, options.gold, *how, options.gold_of)
    return trail
