"""The control table: which targets to process, in which order, and how."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.naming import surrogate_name

# The columns of the control table and of the execution settings.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("target_table", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("file_pattern", T.StringType()),
        T.StructField("row_tag", T.StringType()),
        T.StructField("scd_strategy", T.StringType()),
        T.StructField("natural_keys", T.ArrayType(T.StringType())),
        T.StructField("quarantine_rules", T.StringType()),
        T.StructField("process_priority", T.IntegerType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

EXECUTION_SCHEMA = T.StructType(
    [
        T.StructField("is_snapshot", T.BooleanType()),
        T.StructField("snapshot_layer", T.StringType()),
        T.StructField("sample_type", T.StringType()),
        T.StructField("row_limit", T.IntegerType()),
        T.StructField("sample_fraction", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Target:
    name: str
    file_pattern: str | None
    row_tag: str | None
    strategy: str | None
    keys: tuple[str, ...]
    rule: str | None
    priority: int | None

    @property
    def surrogate(self) -> str:
        return surrogate_name(self.name)


def active_targets(control: DataFrame) -> DataFrame:
    """Active control rows in processing order; equal priorities go by name."""
    return control.where(F.col("is_active")).orderBy("process_priority", "target_table")


def check_targets(targets: Sequence[Target]) -> None:
    """Refuse control rows that cannot run together, before any file moves.

    Two rows of one target, or of one gold folder's surrogate key name, would write to the
    same place at once; an empty pattern matches every file.
    """
    faults = []
    for what, value in (("target", lambda t: t.name), ("surrogate key", lambda t: t.surrogate)):
        counted = Counter(value(target) for target in targets)
        faults += [f"{n} active rows for the {what} {name}" for name, n in counted.items() if n > 1]
    for target in targets:
        if not target.name:
            faults.append("a row without a target")
        if target.file_pattern is not None and not target.file_pattern.strip():
            faults.append(f"an empty file pattern for {target.name}")
    if faults:
        raise ValueError("control table: " + "; ".join(faults))


def load_targets(control: DataFrame) -> list[Target]:
    """The active targets on the driver, in processing order: one small row per target."""
    targets = [
        Target(
            name=row["target_table"],
            file_pattern=row["file_pattern"],
            row_tag=row["row_tag"],
            strategy=row["scd_strategy"],
            keys=tuple(row["natural_keys"] or ()),
            rule=row["quarantine_rules"],
            priority=row["process_priority"],
        )
        for row in control.where(F.col("is_active")).collect()
    ]
    check_targets(targets)
    return sorted(targets, key=lambda target: (target.priority is not None, target.priority or 0, target.name))


def in_priority_order(targets: Sequence[Target], work: Callable[[Target], Any], at_once: int = 1) -> None:
    """Call ``work`` for every target, lower priorities first.

    Targets of equal priority do not wait for each other: up to ``at_once`` of them
    share the cluster, so a small one does not leave it idle.
    """
    for _, tier in groupby(targets, key=lambda target: target.priority):
        with ThreadPoolExecutor(at_once) as pool:
            for _ in pool.map(work, list(tier)):
                pass


def execution_settings(execution: DataFrame | None) -> dict[str, Any]:
    """The first row of the execution table, or no settings."""
    row = execution.first() if execution is not None else None
    return row.asDict() if row else {}


def change_strategy(control: DataFrame, target: str, strategy: str = "SCD2") -> DataFrame:
    """The control table with one target's history strategy changed."""
    changed = F.when(F.col("target_table") == target, F.lit(strategy)).otherwise(F.col("scd_strategy"))
    return control.withColumn("scd_strategy", changed)
