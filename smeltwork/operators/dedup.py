"""Keep one row per key, or one row per distinct content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.naming import free_name, ref, refs
from smeltwork.operators.joining import anti, semi


def _newest_first(frame: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list:
    """Newest first, ties settled by every other sortable column so reruns agree."""
    leading = list(order_by)
    if "source_file" in frame.columns and "source_file" not in leading:
        leading.append("source_file")
    rest = [
        field.name
        for field in frame.schema.fields
        if field.name not in leading and field.name not in keys and not isinstance(field.dataType, T.MapType)
    ]
    return [ref(name).desc_nulls_last() for name in [*leading, *rest]]


def keep_latest(frame: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("ingest_timestamp",)) -> DataFrame:
    """The newest row of every key; rows with a NULL key form one key.

    The ``row_number() = 1`` shape lets Spark cut each map task down to one row per
    key before the shuffle, so a key holding much of the data sends at most one row
    per task.
    """
    newest = Window.partitionBy(*refs(keys)).orderBy(*_newest_first(frame, keys, order_by))
    rank = free_name(frame.columns, "_rank")
    return frame.withColumn(rank, F.row_number().over(newest)).where(F.col(rank) == 1).drop(rank)


def merge_latest(
    state: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = ("ingest_timestamp",),
) -> DataFrame:
    """Fold a batch into the newest row per key; equals a rescan of the whole history.

    The state holds good and bad rows alike: a rule is applied after this step. Only keys
    in the batch are ranked: the other rows of the state pass without a shuffle while the
    batch is small enough to be broadcast.
    """
    touched = semi(state, batch, keys).unionByName(batch, allowMissingColumns=True)
    return keep_latest(touched, keys, order_by).unionByName(anti(state, batch, keys), allowMissingColumns=True)


def drop_copies(frame: DataFrame, ignoring: Sequence[str] = ()) -> DataFrame:
    """One row per distinct content, combined map-side before the shuffle.

    ``ignoring`` names columns that do not count as content, such as the file a row
    came from; the newest copy keeps its values for them.
    """
    content = [name for name in frame.columns if name not in ignoring]
    if len(content) == len(frame.columns):
        return frame.distinct()
    return keep_latest(frame, content, ignoring)
