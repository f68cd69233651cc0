"""Read-only views for a person checking a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltwork.functions.naming import ref, refs
from smeltwork.operators.joining import semi

# Fixed value: rows shown by the validation view.
VALIDATION_ROWS = 7


def batch_validation(
    dimension: DataFrame, batch: DataFrame, keys: Sequence[str], rows: int = VALIDATION_ROWS
) -> DataFrame:
    """The first dimension rows, in key order, whose key was in the batch."""
    order = [*refs(keys), *[ref(name) for name in ("effective_start_date",) if name in dimension.columns]]
    return semi(dimension, batch, keys).orderBy(*order).limit(rows)


def control_rules(control: DataFrame, target: str) -> DataFrame:
    """The control rows of one target."""
    return control.where(F.col("target_table") == target)
