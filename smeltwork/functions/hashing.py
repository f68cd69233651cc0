"""Row digests used to tell a changed row from an unchanged one, and buckets of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from smeltwork.functions.naming import ref

# Fixed value: the text between two column values in a joined digest.
SEPARATOR = "||"
DIGEST_BITS = 256
_UNPACKED = bytes(DIGEST_BITS // 8 + 1)  # longer than a packed digest, so that no text looks like one


def row_digest(columns: Sequence[str], mode: str = "joined", missing_in: Sequence[str] | None = None) -> Column:
    """SHA-256 over the columns in the order given; one not in ``missing_in``, if that is given, is NULL.

    ``joined`` hashes the values as separated text, where NULL and an empty string
    look alike. ``struct`` hashes JSON with names and explicit nulls, which also
    keeps a separator inside a value apart from a column border; ``present`` leaves the
    nulls out, so that a column which comes without a value changes no digest.
    """

    def value(name: str) -> Column:
        have = missing_in is None or name in missing_in
        return ref(name) if have else F.lit(None).cast("string").alias(name)

    if mode in ("struct", "present"):
        whole = F.struct(*[value(name) for name in columns]) if columns else F.struct(F.lit(0).alias("_none"))
        return F.sha2(F.to_json(whole, {"ignoreNullFields": str(mode == "present").lower()}), DIGEST_BITS)
    if mode != "joined":
        raise ValueError(f"unknown hash mode: {mode}")
    texts = [F.ifnull(value(name).cast("string"), F.lit("")) for name in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), DIGEST_BITS)


def packed(digest: Column) -> Column:
    """A digest in half the bytes, to be moved or compared; other text as its own bytes and a mark. NULL stays NULL."""
    likely = (F.length(digest) == DIGEST_BITS // 4) & (F.lower(digest) == digest)
    return F.coalesce(F.when(likely, F.unhex(digest)), F.concat(digest.cast("binary"), F.lit(_UNPACKED)))


def unpacked(digest: Column) -> Column:
    """The text that ``packed`` was given."""
    text = F.substring(digest, F.lit(1), F.length(digest) - len(_UNPACKED)).cast("string")
    return F.when(F.length(digest) == DIGEST_BITS // 8, F.lower(F.hex(digest))).otherwise(text)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: by its keys' text, NULL apart from the empty text."""
    return F.pmod(F.xxhash64(*[F.struct(ref(key).cast("string")) for key in keys]), F.lit(buckets)).cast("int")
