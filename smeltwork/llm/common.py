"""What the operators of this subpackage share: words, row keys and table access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def n_words(column: Column) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def only(frame: DataFrame, **columns: str) -> DataFrame:
    """The named columns under private names, so that extra columns of any name do no harm."""
    return frame.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def whole_row(frame: DataFrame) -> Column:
    """All columns as one struct ``_row``, so that working columns cannot clash with theirs."""
    return F.struct(*[F.col(f"`{name}`") for name in frame.columns]).alias("_row")
