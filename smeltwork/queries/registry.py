"""What a query is, and the tables it reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """``sql`` is None where the result cannot be stated in SQL."""

    run: Run
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant_text(column: Column) -> Column:
    """A whole-second instant as text, so the open end is comparable in any client."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def text_list(columns: list[str]) -> str:
    """SQL select list with every column cast to text."""
    return ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in columns)


def digest_sql(columns: list[str]) -> str:
    """SQL for the joined row digest over columns already in name order."""
    parts = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '')" for name in columns)
    return f"sha256(concat_ws('||', {parts}))"
