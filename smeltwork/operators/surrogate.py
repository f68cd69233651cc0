"""Surrogate keys: the highest one in use, and dense numbers for new rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltwork.functions.naming import ref
from smeltwork.operators.joining import lookup, semi
from smeltwork.operators.slices import POSITION, SLICE, sorted_slices, unsliced
from smeltwork.session import Scratch

# Fixed value: surrogate keys are padded with zeros to this many digits.
KEY_DIGITS = 3


def key_text(number: Column) -> Column:
    """The published form: zero-padded, and longer when the number needs it."""
    padded = F.format_string(f"%0{KEY_DIGITS}d", number)  # slow, so only where there is something to pad
    return F.when(number >= 10 ** (KEY_DIGITS - 1), number.cast("string")).otherwise(padded)


def highest_key(frame: DataFrame, sk: str) -> DataFrame:
    """One row, one column: the largest surrogate key, 0 when there is none."""
    return frame.agg(F.ifnull(F.max(ref(sk).cast("bigint")), F.lit(0).cast("bigint")).alias("max_key"))


@dataclass(frozen=True)
class Numbered:
    """Rows with their number, and how many there are."""

    rows: DataFrame
    count: int


def number_rows(
    frame: DataFrame,
    order_by: Sequence[str],
    name: str,
    start_after: int = 0,
    scratch: Scratch | None = None,
) -> Numbered:
    """Number rows ``start_after + 1, …`` in key order, on all tasks at once.

    Equals ``row_number() over (order by …)``, which would pull every row into one
    task. Only one count per slice reaches the driver: at most as many rows as the
    session has shuffle partitions, whatever the size of the data. They go back as
    one array literal, so the result is a plain projection of a stored scan and Spark
    knows its true size when it picks the joins that follow.
    """
    sliced = sorted_slices(frame, order_by, scratch or Scratch(frame.sparkSession, keep=True))
    sizes = {row[SLICE]: row["n"] for row in sliced.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = range(max(sizes, default=0) + 1)
    *before, total = accumulate((sizes.get(number, 0) for number in slices), initial=0)
    offsets = F.split(F.lit(",".join(str(start_after + rows) for rows in before)), ",").cast("array<bigint>")
    number = F.element_at(offsets, F.col(SLICE) + 1) + F.col(POSITION) + 1
    return Numbered(unsliced(sliced.withColumn(name, number)), total)


def existing_keys(dimension: DataFrame, batch: DataFrame, keys: Sequence[str], *carried: str) -> DataFrame:
    """Keys of the batch that the dimension already holds, with the carried columns.

    Reads only those columns of the dimension. When the batch keys are small Spark
    broadcasts them and the dimension is not shuffled at all.
    """
    return semi(dimension.select(*[ref(name) for name in [*keys, *carried]]), batch, keys)


def preserve_keys(batch: DataFrame, dimension: DataFrame, keys: Sequence[str], sk: str) -> DataFrame:
    """The batch with the surrogate key its rows already have, NULL for new rows."""
    known = existing_keys(dimension, batch, keys, sk).distinct()
    return lookup(batch, known, keys, ref(sk))
