"""Accounting checks: nothing lost, nothing twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltwork.functions import rules
from smeltwork.functions.naming import refs
from smeltwork.operators.quarantine import VERDICT, Routed


def conservation(bronze: DataFrame, routed: Routed) -> DataFrame:
    """One row: rows in, and where each of them went."""
    fates = bronze.select(F.lit("in").alias(VERDICT)).unionAll(routed.flagged.select(VERDICT))

    def having(outcome: str):
        return F.count_if(F.col(VERDICT) == outcome)

    counted = fates.agg(
        having("in").alias("bronze_rows"),
        having(rules.CLEAN).alias("clean_rows"),
        having(rules.QUARANTINE).alias("bad_rows"),
        having(rules.DROPPED).alias("dropped_rows"),
    )
    routed_rows = F.col("clean_rows") + F.col("bad_rows") + F.col("dropped_rows")
    return counted.withColumn("superseded_rows", F.col("bronze_rows") - routed_rows)


def repeated_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    counted = frame.groupBy(*refs(keys)).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where("row_count > 1")


def require_unique(frame: DataFrame, keys: Sequence[str]) -> None:
    """Raise, with an example, when a key occurs twice."""
    repeated = repeated_keys(frame, keys).take(1)
    if repeated:
        raise ValueError(f"more than one row for the key {repeated[0].asDict()}")


def dimension_report(dimension: DataFrame, keys: Sequence[str], sk: str) -> DataFrame:
    """One row of counts that show whether a dimension is sound.

    Pre-aggregated per key first, so no distinct set of keys is built in one task.
    """
    per_key = dimension.groupBy(*refs(keys)).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("is_active")).alias("active"),
        F.count_if(F.col("effective_start_date") > F.col("effective_end_date")).alias("reversed"),
    )
    per_sk = dimension.groupBy(*refs([sk])).agg(F.count(F.lit(1)).alias("uses"))
    keys_side = per_key.agg(
        F.sum("versions").alias("version_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum("active").alias("active_rows"),
        F.count_if(F.col("active") > 1).alias("keys_with_two_active"),
        F.sum("reversed").alias("reversed_ranges"),
    )
    sk_side = per_sk.agg(F.count_if(F.col("uses") > 1).alias("repeated_surrogate_keys"))
    both = keys_side.unionByName(sk_side, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])
