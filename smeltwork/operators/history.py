"""Versions from a full change history, without waiting for batch after batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltwork.functions.clock import BatchClock
from smeltwork.functions.hashing import row_digest
from smeltwork.functions.naming import ref, refs
from smeltwork.operators.slices import POSITION, SLICE, sorted_slices
from smeltwork.session import Scratch

KEY = "_key"


def beside(frame: DataFrame, value: str, step: int, name: str) -> DataFrame:
    """Add the value one row before (-1) or after (+1) in the same key, in a struct; NULL without such a row.

    ``frame`` comes from ``sorted_slices``. The window runs per key and slice, so a
    key that fills many slices is spread over as many tasks. What a window cannot see
    is the row across a slice border; one border row per slice, at most as many as
    there are shuffle partitions, supplies it.
    """
    within = Window.partitionBy(KEY, SLICE).orderBy(POSITION)
    pick = F.max_by if step < 0 else F.min_by
    # The value travels in a struct: a row beside that holds NULL differs from no row beside.
    held = F.struct(F.col(value).alias("value"))
    edges = frame.groupBy(SLICE).agg(pick(F.struct(F.col(KEY), held.alias("held")), POSITION).alias("edge"))
    # One row per slice: this unpartitioned window never sees more rows than there are slices.
    across = Window.orderBy(SLICE)
    reach = (F.lag if step < 0 else F.lead)("edge").over(across)
    borders = edges.select(SLICE, reach.alias("_edge"))
    inside = (F.lag if step < 0 else F.lead)(held).over(within)
    outside = F.when(F.col("_edge")[KEY].eqNullSafe(F.col(KEY)), F.col("_edge")["held"])
    stepped = frame.withColumn("_inside", inside).join(F.broadcast(borders), SLICE, "left")
    return stepped.withColumn(name, F.coalesce(F.col("_inside"), outside)).drop("_inside", "_edge")


def last_marked(frame: DataFrame, value: str, marked: Column, name: str) -> DataFrame:
    """Add the value of the last ``marked`` row of the same key up to and with this one.

    Spread over slices like ``beside``; a slice without a marked row passes on what came before.
    """
    within = Window.partitionBy(KEY, SLICE).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.struct(F.col(KEY), F.col(value).alias("held"))
    edges = frame.groupBy(SLICE).agg(F.max_by(F.when(marked, held), F.when(marked, F.col(POSITION))).alias("edge"))
    across = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    borders = edges.select(SLICE, F.last("edge", ignorenulls=True).over(across).alias("_edge"))
    inside = F.last(F.when(marked, F.col(value)), ignorenulls=True).over(within)
    outside = F.when(F.col("_edge")[KEY].eqNullSafe(F.col(KEY)), F.col("_edge")["held"])
    stepped = frame.withColumn("_inside", inside).join(F.broadcast(borders), SLICE, "left")
    return stepped.withColumn(name, F.coalesce(F.col("_inside"), outside)).drop("_inside", "_edge")


def versions_from_history(
    history: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tracked: Sequence[str],
    clock_kind: str = "timestamp_ntz",
    scratch: Scratch | None = None,
    null_times: str = "raise",
) -> DataFrame:
    """One row per run of equal ``tracked`` values of a key, valid ``[start, end)``.

    ``order_by[0]`` is the time a row takes effect. Exact copies collapse map-side
    before anything is sorted. The result equals applying every row as its own batch
    of an SCD2 merge. A row without a time cannot be placed: it is refused unless
    ``null_times="drop"``.
    """
    if null_times == "drop":
        history = history.where(ref(order_by[0]).isNotNull())
    elif history.where(ref(order_by[0]).isNull()).limit(1).count():
        raise ValueError(f"rows without a time in {order_by[0]}")
    space = scratch or Scratch(history.sparkSession, keep=True)
    wanted = list(dict.fromkeys([*keys, *order_by, *tracked]))
    versions = history.select(*refs(wanted)).distinct().withColumn("hash_key", row_digest(sorted(tracked)))
    sliced = sorted_slices(versions, [*keys, *order_by, "hash_key"], space)
    sliced = sliced.withColumn(KEY, F.struct(*refs(keys)))

    with_previous = beside(sliced, "hash_key", -1, "_previous")
    starts = with_previous.where(F.col("_previous").isNull() | (F.col("_previous")["value"] != F.col("hash_key")))
    starts = space.store(starts.drop("_previous"), "version-starts")

    start = order_by[0]
    closed = beside(starts.withColumn("_start", ref(start)), "_start", 1, "_end")
    return closed.select(
        *refs(keys),
        *[ref(name) for name in tracked if name not in keys],
        F.col("_start").cast(clock_kind).alias("effective_start_date"),
        F.when(F.col("_end").isNull(), BatchClock("", clock_kind).open_end).otherwise(F.col("_end")["value"].cast(clock_kind)).alias("effective_end_date"),
        F.col("_end").isNull().alias("is_active"),
        F.col("hash_key"),
    )
