"""Dimension merges as pure functions: the new dimension from the old one and a batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.clock import BatchClock
from smeltwork.functions.hashing import packed, row_digest, unpacked
from smeltwork.functions.naming import ref, refs
from smeltwork.operators.joining import anti, lookup, right_side, same_key, without_right
from smeltwork.operators.quality import require_unique
from smeltwork.operators.surrogate import Numbered, existing_keys, highest_key, key_text, number_rows
from smeltwork.session import Scratch

# Columns that are not business content, and the columns a dimension ends with.
METADATA = ("ingest_timestamp", "source_file", "silver_timestamp")
VALIDITY = ("effective_start_date", "effective_end_date", "is_active")
HASH = "hash_key"

_HIT, _KNOWN, _NUMBER = "_hit", "_known_hash", "_number"


def business_columns(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """The hashed columns: everything but keys and metadata, in name order."""
    return sorted(name for name in columns if name not in keys and name not in METADATA)


def dimension_columns(columns: Sequence[str], keys: Sequence[str], sk: str) -> list[str]:
    """Column order of a dimension built from source columns."""
    metadata = [name for name in columns if name in METADATA]
    return [sk, *keys, *business_columns(columns, keys), *metadata, *VALIDITY, HASH]


def source_columns(frame: DataFrame, sk: str) -> list[str]:
    """Columns of a dimension or staged batch that came from the source."""
    added = {sk, HASH, *VALIDITY}
    return [name for name in frame.columns if name not in added]


def check_source(columns: Sequence[str], keys: Sequence[str], sk: str) -> None:
    """Refuse input that cannot become a dimension, with the reason."""
    if not keys:
        raise ValueError("a dimension needs at least one natural key")
    missing = [key for key in keys if key not in columns]
    if missing:
        raise ValueError(f"natural keys not in the source: {missing}")
    reserved = [name for name in columns if name in (sk, HASH, *VALIDITY)]
    if reserved:
        raise ValueError(f"source columns use reserved names: {reserved}")


@dataclass(frozen=True)
class Batch:
    """Silver rows to merge, one per key, and how they are stamped.

    Where the batch's columns are not the dimension's, digests cover the columns of both,
    NULL where one lacks them: a new column versions the rows that have a value in it.
    """

    silver: DataFrame
    keys: tuple[str, ...]
    clock: BatchClock
    hash_mode: str = "joined"
    hashed: tuple[str, ...] | None = None

    def stage(self, rows: DataFrame) -> DataFrame:
        """Rows of this batch with an open validity range and their digest."""
        business = self.hashed
        if business is None:
            business = [name for name in business_columns(rows.columns, self.keys) if name in self.silver.columns]
        return rows.select(
            "*",
            self.clock.now.alias(VALIDITY[0]),
            self.clock.open_end.alias(VALIDITY[1]),
            F.lit(True).alias(VALIDITY[2]),
            row_digest(business, self.hash_mode, missing_in=rows.columns).alias(HASH),
        )

    def against(self, dimension: DataFrame, sk: str) -> tuple[Batch, DataFrame, bool]:
        """This batch and the dimension with digests over the same columns, and whether they had others.

        With equal columns the stored digests are used as they are. Otherwise the active rows
        are hashed anew and keep the new digests, or the next batch would find all of them changed.
        """
        old = business_columns(source_columns(dimension, sk), self.keys)
        new = business_columns(self.silver.columns, self.keys)
        if old == new:
            return self, dimension, False
        hashed = tuple(sorted({*old, *new}))
        digest = row_digest(hashed, self.hash_mode, missing_in=dimension.columns)
        anew = F.when(F.col("is_active"), digest).otherwise(ref(HASH))
        return replace(self, hashed=hashed), dimension.withColumn(HASH, anew), True

    @property
    def staged(self) -> DataFrame:
        return self.stage(self.silver)


def batch_of(
    silver: DataFrame,
    keys: Sequence[str],
    clock: BatchClock,
    hash_mode: str = "joined",
    check_keys: bool = True,
) -> Batch:
    """A batch to merge. A key with two rows would fan out the dimension, so it is refused here
    unless the caller knows that keys are unique."""
    if check_keys:
        require_unique(silver, keys)
    return Batch(silver, tuple(keys), clock, hash_mode)


def aligned(frame: DataFrame, columns: Sequence[str], like: DataFrame | None = None) -> DataFrame:
    """Exactly these columns in this order; one the frame lacks is NULL, typed as in ``like``."""
    have = set(frame.columns)
    types = {field.name: field.dataType for field in like.schema.fields} if like is not None else {}
    return frame.select(
        *[
            ref(name) if name in have else F.lit(None).cast(types.get(name, T.StringType())).alias(name)
            for name in columns
        ]
    )


@dataclass(frozen=True)
class Merge:
    """A merged dimension, split the way it is stored.

    ``closed`` are versions that had already ended and do not change. ``current``
    are the rows that were active before, plus the new ones. ``inserted`` rows got a
    surrogate key in this batch; ``changed`` is false when ``current`` equals the
    active rows of the old dimension. ``max_key`` is the highest surrogate key then, None
    where only the rows can tell.
    """

    closed: DataFrame | None
    current: DataFrame
    inserted: int
    changed: bool = True
    max_key: int | None = None

    @property
    def rows(self) -> DataFrame:
        return self.current if self.closed is None else self.closed.unionByName(self.current)


def _merged_columns(dimension: DataFrame, batch: Batch, sk: str) -> list[str]:
    """Column order of the merged dimension: the batch's columns, then those only the dimension has."""
    new = batch.silver.columns
    old_only = [name for name in source_columns(dimension, sk) if name not in new]
    return dimension_columns([*new, *old_only], batch.keys, sk)


def _numbered(rows: DataFrame, keys: Sequence[str], sk: str, base: int, scratch: Scratch | None) -> Numbered:
    """Rows with the surrogate keys after ``base``."""
    done = number_rows(rows, keys, _NUMBER, base, scratch)
    return Numbered(done.rows.withColumn(sk, key_text(F.col(_NUMBER))).drop(_NUMBER), done.count)


def _base(dimension: DataFrame, sk: str, known: int | None) -> int:
    """The highest surrogate key; it is read from the rows only where it is not known."""
    return highest_key(dimension, sk).first()["max_key"] if known is None else known


def initial_load(batch: Batch, sk: str, scratch: Scratch | None = None) -> Merge:
    """The first version of a dimension: every row, numbered in key order.

    Numbering comes before the digest: the range borders are sampled in a pass of
    their own, which then hashes nothing.
    """
    done = _numbered(batch.silver, batch.keys, sk, 0, scratch)
    columns = dimension_columns(batch.silver.columns, batch.keys, sk)
    return Merge(None, aligned(batch.stage(done.rows), columns), done.count, max_key=done.count)


def _split_active(dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    return dimension.where(F.col("is_active")), dimension.where(~F.col("is_active"))


def scd1(
    dimension: DataFrame,
    batch: Batch,
    sk: str,
    skip_unchanged: bool = False,
    scratch: Scratch | None = None,
    max_key: int | None = None,
) -> Merge:
    """Update matching rows in place, insert new ones, delete nothing.

    Only active rows are matched, so a dimension that was versioned before keeps its
    ended versions. ``skip_unchanged`` leaves a row alone when its digest is equal: the
    rows that differ are found first, only they are merged, and a batch without any
    changes nothing. The dimension is the left side of the update join: a small batch is broadcast to
    it and the dimension stays where it is.
    """
    rehashed = False
    if skip_unchanged:  # else nothing is compared, and digests cover the batch's own columns
        batch, dimension, rehashed = batch.against(dimension, sk)
    keys, staged = batch.keys, batch.staged
    columns = _merged_columns(dimension, batch, sk)
    active, closed = _split_active(dimension)
    if skip_unchanged:
        space = scratch or Scratch(dimension.sparkSession, keep=True)
        differing = space.store(_differing(active, batch), "differing")
        if not rehashed and not differing.limit(1).count():
            return Merge(aligned(closed, columns, staged), aligned(active, columns, staged), 0, False, max_key)
        batch = replace(batch, silver=differing.select(*[ref(name) for name in batch.silver.columns]))
        staged = batch.staged
    fresh = anti(batch.silver, existing_keys(active, batch.silver, keys), keys)
    base = _base(dimension, sk, max_key)
    done = _numbered(fresh, keys, sk, base, scratch)

    carried = [name for name in columns if name in staged.columns and name not in keys]
    incoming = right_side(
        batch.silver, keys, F.lit(True).alias(_HIT), *[ref(name) for name in batch.silver.columns if name not in keys])
    held = aligned(active, columns, staged).withColumn(HASH, packed(ref(HASH)))
    old = held.select(*[ref(name) if name in keys else ref(name).alias(f"_old_{name}") for name in columns])
    # Digests of the batch are worked out beside the rows they replace: neither side moves them as text.
    met = batch.stage(old.join(incoming, same_key(keys), "left"))
    before = {name: ref(name) if name in keys else ref(f"_old_{name}") for name in columns}
    before[HASH] = unpacked(before[HASH])
    take = F.col(_HIT).isNotNull()
    if skip_unchanged:
        take = take & ~before[HASH].eqNullSafe(ref(HASH))
    updated = met.select(
        *[
            (F.when(take, ref(name)).otherwise(before[name]) if name in carried else before[name]).alias(name)
            for name in columns
        ]
    )
    added = aligned(batch.stage(done.rows), columns, dimension)
    return Merge(aligned(closed, columns, staged), updated.unionByName(added), done.count, max_key=base + done.count)


def new_versions(active: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows with no active row of the same key and digest: new keys and changed rows.

    Joined on the key alone: the cut of the active rows and this join then share one
    partitioning. An active key has one row, so nothing fans out.
    """
    return _unlike(_beside_known(active, staged, keys), packed(ref(HASH)))


def _differing(active: DataFrame, batch: Batch) -> DataFrame:
    """The batch's rows, unstaged, that ``new_versions`` finds; their digests are worked out after the join and not moved."""
    met = batch.stage(_beside_known(active, batch.silver, batch.keys))
    return _unlike(met, F.unhex(ref(HASH))).select(*refs(batch.silver.columns))


def _beside_known(active: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the packed digest of the active row of their key."""
    known = existing_keys(active.withColumn(HASH, packed(ref(HASH))), rows, keys, HASH)
    return lookup(rows, known, keys, ref(HASH).alias(_KNOWN))


def _unlike(met: DataFrame, digest: Column) -> DataFrame:
    return met.where(F.col(_KNOWN).isNull() | (F.col(_KNOWN) != digest)).drop(_KNOWN)


def expire(active: DataFrame, replaced: DataFrame, keys: Sequence[str], clock: BatchClock) -> DataFrame:
    """Active rows, ended at the batch instant where ``replaced`` holds their key."""
    slim = active.withColumn(HASH, packed(ref(HASH))) if HASH in active.columns else active
    met = lookup(slim, replaced, keys, F.lit(True).alias(_HIT))
    if HASH in active.columns:
        met = met.withColumn(HASH, unpacked(ref(HASH)))
    return _end_where_hit(met, active.columns, clock)


def _end_where_hit(met: DataFrame, columns: Sequence[str], clock: BatchClock) -> DataFrame:
    hit = F.col(_HIT).isNotNull()
    ended = {
        "effective_end_date": F.when(hit, clock.now).otherwise(F.col("effective_end_date")),
        "is_active": F.col("is_active") & ~hit,
    }
    return met.select(*[ended[name].alias(name) if name in ended else ref(name) for name in columns])


def scd2(
    dimension: DataFrame,
    batch: Batch,
    sk: str,
    close_missing: bool = False,
    dense_sk: bool = True,
    scratch: Scratch | None = None,
    max_key: int | None = None,
    gone: DataFrame | None = None,
) -> Merge:
    """End changed versions and add the new ones, at one instant.

    Surrogate keys count inserted rows only; ``dense_sk=False`` numbers the whole
    batch first and so leaves gaps for unchanged rows. ``close_missing`` also ends
    active rows whose key is not in the batch, or, where the batch is a change set, the
    keys that are ``gone``.
    """
    batch, dimension, rehashed = batch.against(dimension, sk)
    keys, staged = batch.keys, batch.staged
    columns = _merged_columns(dimension, batch, sk)
    active, closed = _split_active(dimension)
    base, highest = _base(dimension, sk, max_key), None
    if dense_sk:
        done = _numbered(_differing(active, batch), keys, sk, base, scratch)
        inserted, count, highest = batch.stage(done.rows), done.count, base + done.count
    else:
        everything = _numbered(batch.silver, keys, sk, base, scratch).rows
        inserted = new_versions(active, aligned(batch.stage(everything), [sk, *staged.columns]), keys)
        count = inserted.count()

    kept = expire(active, inserted, keys, batch.clock)
    if close_missing and gone is not None:
        met = lookup(kept, gone, keys, F.lit(True).alias("_gone"))
        marked = met.withColumn(_HIT, F.when(F.col("is_active") & F.col("_gone").isNotNull(), F.lit(True)))
        kept = _end_where_hit(marked, active.columns, batch.clock)
    elif close_missing:
        present = kept.join(right_side(staged, keys, F.lit(True).alias("_present")), same_key(keys), "left")
        absent = without_right(present, keys).withColumn(
            _HIT, F.when(F.col("is_active") & F.col("_present").isNull(), F.lit(True))
        )
        kept = _end_where_hit(absent, active.columns, batch.clock)
    current = aligned(kept, columns, staged).unionByName(aligned(inserted, columns, dimension))
    changed = count > 0 or close_missing or rehashed
    return Merge(aligned(closed, columns, staged), current, count, changed, highest)


STRATEGIES = ("SCD1", "SCD2")


def merge(
    strategy: str | None,
    dimension: DataFrame | None,
    batch: Batch,
    sk: str,
    scratch: Scratch | None = None,
    max_key: int | None = None,
    gone: DataFrame | None = None,
    **options: bool,
) -> Merge:
    """Apply the target's strategy; without a dimension yet, any strategy loads the batch.

    ``max_key`` is the dimension's highest surrogate key where the caller knows it. A batch
    that is a change set comes with the keys ``gone`` since.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown scd_strategy: {strategy}")
    if dimension is None:
        return initial_load(batch, sk, scratch)
    if strategy == "SCD1":
        return scd1(dimension, batch, sk, scratch=scratch, max_key=max_key, **options)
    return scd2(dimension, batch, sk, scratch=scratch, max_key=max_key, gone=gone, **options)
