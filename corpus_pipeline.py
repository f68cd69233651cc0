"""A training-data pipeline of five stages over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from smeltwork.llm import stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", stages.keep_quality),
    ("line_dedup", stages.drop_repeated_lines),
    ("simhash_near_dedup", stages.drop_near_duplicates),
    ("source_mixing", stages.mix_sources),
    ("length_bucket_packing", stages.pack_lengths),
]

# The classifier learns and the mix draws by seeded pseudo-random numbers, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet and read again; the last one's rows."""
    return stages.run_stages(spark, sf_dir, STAGES)
