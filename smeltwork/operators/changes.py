"""Change sets: which keys of a layer were added, changed or went, and what several such sets say together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smeltwork.functions.hashing import row_digest
from smeltwork.functions.naming import ref, refs
from smeltwork.operators.joining import anti, lookup

CHANGE = "silver_change"
ADDED, CHANGED, GONE = "added", "changed", "gone"
_BEFORE = "_digest_before"


def change_set(before: DataFrame, after: DataFrame, keys: Sequence[str], ignoring: Sequence[str] = ()) -> DataFrame:
    """The rows of ``after`` that are new or differ in any column, and the bare keys that ``before`` alone holds.

    Both have one row per key, NULL equal to NULL; a column that one side lacks is NULL there.
    Columns in ``ignoring`` make no difference: a row delivered again unchanged is no change.
    """
    columns = sorted({*before.columns, *after.columns} - {*keys, *ignoring})
    old = before.select(*refs(keys), F.unhex(row_digest(columns, "struct", missing_in=before.columns)).alias(_BEFORE))
    # The other digest is worked out after the join, so the rows move without it.
    met = lookup(after, old, keys, ref(_BEFORE))
    now = F.unhex(row_digest(columns, "struct", missing_in=after.columns))
    differs = met.where(ref(_BEFORE).isNull() | (ref(_BEFORE) != now))
    kind = F.when(ref(_BEFORE).isNull(), F.lit(ADDED)).otherwise(F.lit(CHANGED))
    upserts = differs.withColumn(CHANGE, kind).drop(_BEFORE)
    gone = anti(before.select(*refs(keys)), after, keys).withColumn(CHANGE, F.lit(GONE))
    return upserts.unionByName(gone, allowMissingColumns=True)


def newest_changes(changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Several change sets as one: the newest word on every key.

    A key that came and went again is ``gone``, one that went and came back has its row; what
    the reader held before, it has to compare itself.
    """
    newest = Window.partitionBy(*refs(keys)).orderBy(ref(version).desc())
    return changes.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", version)
