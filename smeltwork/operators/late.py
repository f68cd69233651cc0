"""Changes that arrive late: versions are split where a change falls inside them.

A merge by batch instant can only add versions at the end. Here every change says when it took
effect, and may lie before, inside or after the versions a dimension has. Only keys that changes
touch are looked at. Their versions become events again, the changes join them, and runs of equal
content become versions: the ones that were there keep their surrogate keys, also where a change
moves their start, and those that a change opens get the next numbers.

A version holds one time, but its content may have been seen again later, which decides where a
late change ends. Such sightings are kept beside the dimension as ``confirmed`` (keys, time,
digest), so that changes give the same dimension in whatever order they come.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltwork.functions.clock import BatchClock
from smeltwork.functions.hashing import row_digest
from smeltwork.functions.naming import ref, refs
from smeltwork.operators.history import KEY, beside, last_marked
from smeltwork.operators.joining import anti, lookup, semi
from smeltwork.operators.scd import HASH, VALIDITY, aligned, check_source, dimension_columns, source_columns
from smeltwork.operators.slices import POSITION, SLICE, sorted_slices
from smeltwork.operators.surrogate import highest_key, key_text, number_rows
from smeltwork.session import Scratch

_TIME, _DIGEST, _SK, _CONTENT = "_time", "_digest", "_old_sk", "_content"
_NOTHING = ""  # the digest of a stretch without a version
_START, _END, _ACTIVE = VALIDITY


@dataclass(frozen=True)
class Spliced:
    """A dimension with late changes spliced in, the sightings to keep beside it, and its highest surrogate key."""

    rows: DataFrame
    confirmed: DataFrame
    inserted: int
    max_key: int


def _gaps(touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ends of versions that no other version follows at once: from there on the key has none."""
    ends = touched.where(~ref(_ACTIVE)).select(*refs(keys), ref(_END).alias(_TIME))
    starts = touched.select(*refs(keys), ref(_START).alias(_TIME))
    return anti(ends, starts, [*keys, _TIME]).distinct().withColumn(_DIGEST, F.lit(_NOTHING))


def _events(touched: DataFrame, confirmed: DataFrame | None, keys: Sequence[str], content: Sequence[str], sk: str) -> DataFrame:
    """What is known of the touched keys as events: starts of versions, later sightings, and ends without a successor."""
    whole = F.struct(*refs(content)).alias(_CONTENT)
    starts = touched.select(*refs(keys), ref(_START).alias(_TIME), ref(HASH).alias(_DIGEST), ref(sk).alias(_SK), whole)
    known = starts.unionByName(_gaps(touched, keys), allowMissingColumns=True)
    if confirmed is None:
        return known
    # Equal digests have equal content, so any version of the key with the digest supplies it.
    by_digest = starts.groupBy(*refs(keys), _DIGEST).agg(F.any_value(_CONTENT).alias(_CONTENT))
    seen = lookup(semi(confirmed, touched, keys), by_digest, [*keys, _DIGEST], F.col(_CONTENT))
    return known.unionByName(seen, allowMissingColumns=True)


def splice(
    dimension: DataFrame | None,
    confirmed: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    time: str,
    tracked: Sequence[str],
    sk: str,
    scratch: Scratch | None = None,
    kind: str = "timestamp",
    max_key: int | None = None,
) -> Spliced:
    """Put ``changes``, rows with the ``time`` they took effect, into a dimension; with None, begin one.

    ``tracked`` columns decide what a change is and are what the dimension's digests cover. Of changes
    of one key at one time the one with the greater digest comes last. A row without a time is refused.
    """
    check_source([name for name in changes.columns if name != time], keys, sk)
    if changes.where(ref(time).isNull()).limit(1).count():
        raise ValueError(f"rows without a time in {time}")
    space = scratch or Scratch(changes.sparkSession, keep=True)
    new = [name for name in changes.columns if name not in keys and name != time]
    old = [name for name in source_columns(dimension, sk) if name not in keys] if dimension is not None else []
    content = [*new, *[name for name in old if name not in new]]
    late = aligned(changes, [*keys, time, *content], dimension).select(
        *refs(keys), ref(time).cast(kind).alias(_TIME), row_digest(sorted(tracked)).alias(_DIGEST),
        F.lit(None).cast("string").alias(_SK), F.struct(*refs(content)).alias(_CONTENT),
    )
    untouched = other = None
    if dimension is not None:
        held = aligned(dimension, [sk, *keys, *content, *VALIDITY, HASH], changes)
        touched, untouched = space.store(semi(held, late, keys), "touched"), anti(held, late, keys)
        late = late.unionByName(_events(touched, confirmed, keys, content, sk), allowMissingColumns=True)
        other = anti(confirmed, changes, keys) if confirmed is not None else None

    # One event for each key, time and content; a version's own event speaks for its copies.
    own = F.struct(F.col(_SK).isNull().alias("late"), F.col(_SK), F.to_json(_CONTENT).alias("text"))
    events = late.groupBy(*refs(keys), _TIME, _DIGEST).agg(F.min(_SK).alias(_SK), F.min_by(_CONTENT, own).alias(_CONTENT))
    sliced = sorted_slices(events, [*keys, _TIME, _DIGEST], space).withColumn(KEY, F.struct(*refs(keys)))
    met = beside(sliced, _DIGEST, -1, "_previous")
    starts = F.col("_previous").isNull() | (F.col("_previous")["value"] != F.col(_DIGEST))
    marked = met.withColumn("_starts", starts).drop("_previous").withColumn("_self", F.struct(_TIME, _DIGEST))
    marked = space.store(last_marked(marked, "_self", F.col("_starts"), "_run"), "late-events")

    # A version whose start has moved hands its surrogate key to the event its run now starts with.
    moved = marked.where(~F.col("_starts") & F.col(_SK).isNotNull()).select(*refs(keys), "_run", F.col(_SK).alias("_moved"))
    closed = beside(marked.where("_starts"), _TIME, 1, "_after")
    versions = lookup(closed, moved, [*keys, "_run"], F.col("_moved")).where(F.col(_DIGEST) != _NOTHING)
    open_end = F.col("_after").isNull()
    shaped = versions.select(
        F.coalesce(_SK, "_moved").alias(sk), *refs(keys), *[F.col(_CONTENT)[name].alias(name) for name in content],
        F.col(_TIME).alias(_START), F.when(open_end, BatchClock("", kind).open_end).otherwise(F.col("_after")["value"]).alias(_END),
        open_end.alias(_ACTIVE), F.col(_DIGEST).alias(HASH),
    )
    # Read three times from here on: by the borders of the numbering, by the numbering and by the caller.
    shaped = space.store(shaped, "late-versions")
    base = max_key
    if base is None:
        base = highest_key(dimension, sk).first()["max_key"] if dimension is not None else 0
    opened = number_rows(shaped.where(ref(sk).isNull()).drop(sk), [*keys, _START], "_number", base, space)
    numbered = opened.rows.withColumn(sk, key_text(F.col("_number"))).drop("_number")
    columns = dimension_columns([*keys, *content], keys, sk)
    rows = aligned(shaped.where(ref(sk).isNotNull()), columns).unionByName(aligned(numbered, columns))
    if untouched is not None:
        rows = rows.unionByName(aligned(untouched, columns))
    again = marked.where(~F.col("_starts") & (F.col(_DIGEST) != _NOTHING)).select(*refs(keys), _TIME, _DIGEST)
    return Spliced(rows, again if other is None else again.unionByName(other), opened.count, base + opened.count)
