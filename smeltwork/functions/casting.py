"""Text casts for bronze and typed casts for silver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.naming import ref

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _as_text(field: T.StructField, nested: str) -> Column:
    column = ref(field.name)
    if nested == "json" and isinstance(field.dataType, _NESTED):
        column = F.to_json(column, {"ignoreNullFields": "false"})
    return column.cast("string").alias(field.name)


def string_safe(frame: DataFrame, nested: str = "json") -> DataFrame:
    """Every column as text, so files of any format can share one dataset.

    Nested values become JSON that can be parsed again; ``nested="cast"`` gives
    Spark's display text instead.
    """
    return frame.select(*[_as_text(field, nested) for field in frame.schema.fields])


def typed(frame: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast those of the named text columns that there are; a value that does not parse becomes NULL."""
    return frame.withColumns({name: ref(name).try_cast(kind) for name, kind in types.items() if name in frame.columns})
