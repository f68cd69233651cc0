"""Global order without a one-task sort.

A frame is range-partitioned and sorted, and each row keeps its slice and its
position in that slice. The result is written to the shared folder, because Spark
samples the range borders anew for every job: two jobs over the lazy plan could
disagree on them, and a lost executor could not rebuild the same slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.naming import refs
from smeltwork.session import Scratch

SLICE, POSITION = "_slice", "_position"
_UNORDERED = (T.MapType, T.VariantType)
_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def with_ties(frame: DataFrame, order_by: Sequence[str]) -> list[str]:
    """``order_by`` and then every other sortable column, so that only whole copies are equal."""
    rest = [f.name for f in frame.schema.fields if f.name not in order_by and not isinstance(f.dataType, _UNORDERED)]
    return [*order_by, *rest]


def sorted_slices(frame: DataFrame, order_by: Sequence[str], scratch: Scratch) -> DataFrame:
    """``frame`` in contiguous sorted slices, with ``_slice`` and ``_position`` (from 0)."""
    clash = [name for name in frame.columns if name.lower() in (SLICE, POSITION)]
    if clash:
        raise ValueError(f"columns use reserved names: {clash}")
    ordered = frame.repartitionByRange(*refs(order_by)).sortWithinPartitions(*refs(order_by))
    placed = ordered.select(
        "*",
        F.spark_partition_id().alias(SLICE),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(POSITION),
    )
    return scratch.store(placed, "slices")


def unsliced(frame: DataFrame) -> DataFrame:
    return frame.drop(SLICE, POSITION)
