"""Reduced runs: process a fixed number or a share of the silver rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smeltwork.functions.hashing import row_digest
from smeltwork.functions.naming import free_name, ref, refs
from smeltwork.operators.joining import lookup
from smeltwork.operators.slices import with_ties
from smeltwork.operators.surrogate import number_rows
from smeltwork.session import Scratch

# What a missing setting means.
DEFAULT_ROW_LIMIT = 100
DEFAULT_FRACTION = 0.1
SNAPSHOT_LAYERS = ("gold", "all")

# Fixed value: a digest sample compares this many leading hex digits of the key's digest.
_DIGEST_DIGITS = 8
_HEAD_DIGITS = 3


def first_rows(frame: DataFrame, limit: int, order_by: Sequence[str], scratch: Scratch | None = None) -> DataFrame:
    """The first ``limit`` rows in key order, by one way for every limit.

    Counts per sorted slice say which slices and rows to keep, so no task gathers the
    rows. Equal keys are told apart by all other sortable columns, so that a key held by
    many rows fills several slices and reruns agree.
    """
    number = free_name(frame.columns, "_number")
    numbered = number_rows(frame, with_ties(frame, order_by), number, scratch=scratch).rows
    return numbered.where(F.col(number) <= limit).drop(number)


def by_key_digest(frame: DataFrame, fraction: float, keys: Sequence[str]) -> DataFrame:
    """About ``fraction`` of the keys, chosen by their digest: the same ones on every run and layout."""
    head = F.conv(F.substring(row_digest(keys), 1, _DIGEST_DIGITS), 16, 10).cast("bigint")
    return frame.where(head < int(fraction * 16**_DIGEST_DIGITS))


def exactly(frame: DataFrame, rows: int, keys: Sequence[str], strata: Sequence[str] = ()) -> DataFrame:
    """Exactly ``rows`` rows of every stratum (all, if it has fewer): those with the smallest key digests.

    Counts by stratum and head of the digest say up to which head all rows are taken, and how many
    of the head in which a stratum's last place falls; only the rows of that head are ranked. So no
    task sorts a stratum, however many rows are asked for, and the rows are the same on every layout.
    """
    if rows <= 0:
        return frame.where(F.lit(False))
    taken = free_name(frame.columns, "_digest")
    digest = row_digest(keys)
    marked = frame.withColumn(taken, F.struct(F.substring(digest, 1, _HEAD_DIGITS).alias("head"), digest.alias("digest")))
    by = [F.lit(0).alias("_all")] if not strata else [ref(name) for name in strata]
    counts = marked.groupBy(*by, F.col(taken)["head"].alias("_head")).agg(F.count("*").alias("_n"))
    names = strata or ["_all"]
    running = Window.partitionBy(*refs(names)).orderBy("_head")  # at most 4,096 heads in a stratum
    summed = counts.withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
    border = summed.where(f"_before < {rows} AND _before + _n >= {rows}")
    borders = border.select(*refs(names), F.col("_head").alias("_border"), (F.lit(rows) - F.col("_before")).alias("_room"))
    if not strata:
        marked = marked.withColumn("_all", F.lit(0))
    met = lookup(marked, borders, names, F.col("_border"), F.col("_room"))
    head = F.col(taken)["head"]
    whole = met.where(F.col("_border").isNull() | (head < F.col("_border")))
    last = met.where(head == F.col("_border"))
    rest = [ref(name) for name in with_ties(frame, keys)]
    place = Window.partitionBy(*refs(names)).orderBy(F.col(taken)["digest"], *rest)
    ranked = last.withColumn("_place", F.row_number().over(place)).where("_place <= _room").drop("_place")
    return whole.unionByName(ranked).select(*refs(frame.columns))


def snapshot(
    frame: DataFrame,
    settings: Mapping[str, Any],
    order_by: Sequence[str],
    seed: int = 0,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Apply the execution settings; without snapshot mode the frame passes unchanged."""
    layer = (settings.get("snapshot_layer") or "").lower()
    if not settings.get("is_snapshot") or layer not in SNAPSHOT_LAYERS:
        return frame
    limit = settings.get("row_limit")
    limit = DEFAULT_ROW_LIMIT if limit is None else limit
    if settings.get("sample_type") == "limit":
        return first_rows(frame, limit, order_by, scratch)
    if settings.get("sample_type") == "exact":
        return exactly(frame, limit, order_by, settings.get("strata") or ())
    fraction = settings.get("sample_fraction")
    fraction = DEFAULT_FRACTION if fraction is None else fraction
    if settings.get("sample_type") == "key_digest":
        return by_key_digest(frame, fraction, order_by)
    return frame.sample(False, fraction, seed)
