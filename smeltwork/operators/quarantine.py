"""Route rows by a rule, in one pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltwork.functions import rules
from smeltwork.functions.naming import ref

VERDICT = "quarantine_verdict"


@dataclass(frozen=True)
class Routed:
    """Rows with their verdict; both sides read the same plan."""

    flagged: DataFrame

    def _only(self, outcome: str) -> DataFrame:
        return self.flagged.where(F.col(VERDICT) == outcome).drop(VERDICT)

    @property
    def clean(self) -> DataFrame:
        return self._only(rules.CLEAN)

    @property
    def bad(self) -> DataFrame:
        return self._only(rules.QUARANTINE)


def null_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [ref(key).isNull() for key in keys], F.lit(False))


def route(
    frame: DataFrame,
    rule: str | None,
    on_unknown: str = "clean",
    keys: Sequence[str] = (),
    null_keys: str = "keep",
    on_error: str = "unknown",
) -> Routed:
    """Add the verdict column. ``null_keys="quarantine"`` also diverts rows without a full key."""
    if VERDICT in (name.lower() for name in frame.columns):
        raise ValueError(f"a source column uses the reserved name {VERDICT}")
    outcome = rules.verdict(rule, on_unknown, on_error)
    if null_keys == "quarantine" and keys:
        outcome = F.when(null_key(keys), F.lit(rules.QUARANTINE)).otherwise(outcome)
    elif null_keys != "keep" and keys:
        raise ValueError(f"unknown null_keys: {null_keys}")
    return Routed(frame.withColumn(VERDICT, outcome))


def with_violations(frame: DataFrame, named_rules: Mapping[str, str]) -> DataFrame:
    """Add ``violations``, the names of the rules each row breaks."""
    return frame.withColumn("violations", rules.violations(named_rules))


def verdict_counts(routed: Routed) -> DataFrame:
    """Rows per verdict, with a row for each verdict that occurs."""
    return routed.flagged.groupBy(VERDICT).agg(F.count(F.lit(1)).alias("row_count"))
