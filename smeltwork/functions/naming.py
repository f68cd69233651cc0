"""Column and key names."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The parts of a target name that do not show in its surrogate key name.
LAYER_WORDS = ("gold_", "_dim", "_fact")
KEY_SUFFIX = "_sk"


def ref(name: str) -> Column:
    """A column by its literal name, even if that holds dots or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def refs(names: Iterable[str]) -> list[Column]:
    return [ref(name) for name in names]


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name in any case."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def path_text(part: Column) -> Column:
    """A part of a scan's file path as text: escapes decoded, only where there are any."""
    decoded = F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(part, F.lit("%")), decoded).otherwise(part)


def standard_name(name: str) -> str:
    """Trimmed, lower case, spaces as underscores."""
    return name.strip().lower().replace(" ", "_")


def standardise(frame: DataFrame, on_collision: str = "raise") -> DataFrame:
    """Give every column its standard name in one projection.

    Two headers that share a standard name raise, naming both; with
    ``on_collision="coalesce"`` they merge into the first non-null value.
    """
    groups: dict[str, list[int]] = defaultdict(list)
    for position, name in enumerate(frame.columns):
        groups[standard_name(name)].append(position)
    clashes = {
        name: [frame.columns[position] for position in positions]
        for name, positions in groups.items()
        if len(positions) > 1
    }
    if not clashes:
        return frame.toDF(*groups)
    if on_collision != "coalesce":
        raise ValueError(f"columns share a standard name: {clashes}")
    numbered = frame.toDF(*[f"_c{position}" for position in range(len(frame.columns))])
    return numbered.select(
        *[
            F.coalesce(*[F.col(f"_c{position}") for position in positions]).alias(name)
            for name, positions in groups.items()
        ]
    )


def surrogate_name(target: str) -> str:
    """``gold_employee_dim`` gives ``employee_sk``."""
    for word in LAYER_WORDS:
        target = target.replace(word, "")
    return target + KEY_SUFFIX


def surrogate_name_of(target: Column) -> Column:
    """``surrogate_name`` over a column of target names."""
    for word in LAYER_WORDS:
        target = F.replace(target, F.lit(word), F.lit(""))
    return F.concat(target, F.lit(KEY_SUFFIX))
