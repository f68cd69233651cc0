"""Equi joins on key lists where NULL equals NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from smeltwork.functions.naming import ref

_PREFIX = "_right_"


def right_side(frame: DataFrame, keys: Sequence[str], *carried: Column) -> DataFrame:
    """The right input of a key join: keys under private names plus the carried columns."""
    renamed = [ref(key).alias(f"{_PREFIX}{position}") for position, key in enumerate(keys)]
    return frame.select(*renamed, *carried)


def same_key(keys: Sequence[str], null_safe: bool = True) -> Column:
    """Left keys equal the right side's; ``null_safe`` matches NULL with NULL."""
    pairs = [(ref(key), ref(f"{_PREFIX}{position}")) for position, key in enumerate(keys)]
    tests = [left.eqNullSafe(right) if null_safe else left == right for left, right in pairs]
    return reduce(Column.__and__, tests)


def without_right(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.drop(*[f"{_PREFIX}{position}" for position in range(len(keys))])


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return left.join(right_side(right, keys), same_key(keys, null_safe), "left_semi")


def anti(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``."""
    return left.join(right_side(right, keys), same_key(keys, null_safe), "left_anti")


def lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], *carried: Column, null_safe: bool = True
) -> DataFrame:
    """All rows of ``left`` with the carried columns of the matching ``right`` row, else NULL."""
    joined = left.join(right_side(right, keys, *carried), same_key(keys, null_safe), "left")
    return without_right(joined, keys)
