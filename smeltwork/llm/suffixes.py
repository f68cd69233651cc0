"""Suffix-array dedup: removes each byte covered by a string of ``length`` bytes that also starts elsewhere.

Sorting every suffix of a corpus moves many bytes for each byte of text. Here suffixes are put into buckets by their first
``gram`` bytes, and buckets are refined by the bucket identifiers of later offsets (bucket-pointer refinement):

- A suffix's initial bucket is that of its q-gram. In each round its identifier becomes the name of the pair (its bucket,
  the bucket of the suffix that starts where the first one's reach ends), so reach doubles and each round reuses the
  identifiers that the round before refined. A reach that is no such power is a pair whose second bucket overlaps the first.
- The name of a pair is a digest of its two identifiers, so that every task gives one bucket the same name; no numbering
  pass over the corpus is needed, and only identifiers that are looked at are worked out.
- A bucket of one is finished, and so is one whose members agree over all bytes asked for.

Neighbouring strings share nearly all bytes, so they are refined together, first by many, then by few:

1. Each string is stood for by an anchor: the place of the least initial bucket among its q-grams. Equal strings have their
   anchor at the same offset, and neighbouring ones mostly share one, so only about one suffix in a hundred takes part. A
   bucket of anchors is refined over all the bytes that their strings cover; where two agree, all their strings repeat.
2. What is left agrees in the q-gram but not throughout, as at the edge of a shared passage. Its strings are dealt by
   offset into cells of 16, whose buckets reach over the bytes common to all strings of the cell, and these are refined
   in the same way.
3. What is left of that is refined string by string: the bucket of its first bytes, then the one at the later offset.

One member stands for each finished bucket in the next step, so the others can still find it; the results of a step are
used by the next. Bucket and refined identifier decide together, 64 bits each. Texts are moved compressed, and only those
of documents with unfinished buckets are kept between steps.

Defined results: a null text is empty; matches do not cross documents; a text shorter than ``length`` loses nothing;
rows equal in id and text are copies of each other, and all copies lose what they share; overlapping copies inside one
text count; a very long text is read in pieces whose strings overlap; an empty table gives no rows; every member of a class of
equal strings is treated alike, so there are no ties.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.common import only, text_of
from smeltwork.session import Scratch

_CELL = 16
_OFFSET_BITS = 10
_STEP = 0x9E3779B97F4A7C15
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SPAN = "array<bigint>"


@dataclass(frozen=True)
class SuffixOptions:
    """``piece`` is about how many bytes are looked at together."""

    length: int = 400
    gram: int = 128
    piece: int = 1 << 17

    def __post_init__(self) -> None:
        if not 0 < self.gram <= self.length or self.length - self.gram >= 1 << _OFFSET_BITS:
            raise ValueError("gram must lie between 1 and length, and at most 1023 below it")


class Roller:
    """Digests of all substrings of one width, from prefix sums modulo 2**64."""

    def __init__(self) -> None:
        rng = np.random.default_rng(7)
        self.letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def grow(self, size: int) -> None:
        while len(self.up) < size:
            n = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.array([pow(_STEP, n, 1 << 64)], dtype=np.uint64)])
            self.down = np.concatenate([self.down, self.down * np.array([pow(_STEP, -n, 1 << 64)], dtype=np.uint64)])

    def sums(self, data: np.ndarray) -> np.ndarray:
        self.grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=out[1:])
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Buckets:
    """Bucket identifiers of the suffixes of one piece of text, from its prefix sums."""

    def __init__(self, data: np.ndarray, gram: int, roller: Roller) -> None:
        self.gram, self.roller, self.sums = gram, roller, roller.sums(data)

    def initial(self, at: np.ndarray | slice) -> np.ndarray:
        """The buckets by q-gram of the suffixes at ``at``."""
        if isinstance(at, slice):  # all of them, without a copy of the sums
            n = len(self.sums) - self.gram
            return _mixed((self.sums[self.gram:] - self.sums[:n]) * self.roller.down[:n])
        return _mixed((self.sums[at + self.gram] - self.sums[at]) * self.roller.down[at])

    def refined(self, at: np.ndarray, rounds: int) -> np.ndarray:
        """The buckets after so many rounds; they reach over ``gram << rounds`` bytes."""
        if rounds == 0:
            return self.initial(at)
        later = at + (self.gram << (rounds - 1))
        return _pair(self.refined(at, rounds - 1), self.refined(later, rounds - 1), rounds)

    def over(self, at: np.ndarray, width: np.ndarray) -> np.ndarray:
        """The identifiers of the next ``width`` bytes, ``gram`` at least: a refined bucket and one at a later offset."""
        out = np.zeros(len(at), dtype=np.uint64)
        rounds = np.frexp(width // self.gram)[1] - 1
        for count in np.unique(rounds).tolist():
            some = np.flatnonzero(rounds == count)
            here, reach = at[some], width[some]
            later = here + reach - (self.gram << count)
            out[some] = _pair(self.refined(here, count), self.refined(later, count), reach)
        return out


def _pair(first: np.ndarray, second: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    return _mixed(_mixed(first + np.asarray(salt).astype(np.uint64) * _PAIR) * _PAIR + second)


def _least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of the first least one."""
    least, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        n = len(least) - step
        take = least[step:] < least[:n]
        least = np.where(take, least[step:], least[:n])
        place = np.where(take, place[step:], place[:n])
        have += step
    return place


def _joined(texts: list[bytes], options: SuffixOptions) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset in it, bytes): short texts together, long ones in pieces that overlap by a string less a byte."""
    group, size = [], 0
    for i, raw in enumerate(texts):
        for begin in range(0, max(0, len(raw) - options.length + 1), options.piece):
            part = raw[begin: begin + options.piece + options.length - 1]
            group.append((i, begin, part))
            size += len(part)
            if size >= options.piece:
                yield group
                group, size = [], 0
    if group:
        yield group


def anchors(texts: list[bytes], options: SuffixOptions, roller: Roller) -> Iterator[tuple[np.ndarray, np.ndarray, Callable]]:
    """For some of the texts at a time: which text, the key and (place, key, identifier) of the anchors when asked for.

    A place holds the anchor and the offsets of its strings' starts.
    """
    length, gram = options.length, options.gram
    for group in _joined(texts, options):
        sizes = np.array([len(part) for _, _, part in group])
        base = np.cumsum(sizes) - sizes
        buckets = Buckets(np.frombuffer(b"".join(part for _, _, part in group), dtype=np.uint8), gram, roller)
        initial = buckets.initial(slice(None))
        of, number = _dealt(sizes - length + 1)  # strings that lie inside one text
        start = base[of] + number
        at = _least_in_window(initial, length - gram + 1)[start]
        edge = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        first, last, place = start[edge], start[np.r_[edge[1:], len(at)] - 1], at[edge]
        shift = np.array([begin for _, begin, _ in group]) - base

        def rows(buckets=buckets, initial=initial, first=first, last=last, place=place, shift=shift[of[edge]]):
            low, high = place - last, place - first
            identifier = _pair(buckets.over(first, last - first + length), _offsets(low, high), 0)
            return _columns([(_packed(place + shift, low, high), initial[place], identifier)])

        yield np.array([i for i, _, _ in group])[of[edge]], initial[place].view(np.int64), rows


def _offsets(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (low << _OFFSET_BITS | high).astype(np.uint64)


def _packed(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return at << (2 * _OFFSET_BITS) | low << _OFFSET_BITS | high


def _columns(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(column).view(np.int64) for column in zip(*found))


def _unpacked(place: Any) -> tuple[Any, Any, Any]:
    """(anchor, least, greatest offset) of a place or an array of places."""
    mask = (1 << _OFFSET_BITS) - 1
    return place >> (2 * _OFFSET_BITS), (place >> _OFFSET_BITS) & mask, place & mask


def _dealt(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``counts`` members each: which place a member is of, and its number there."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _cells(places: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, first offset of the cell, least and greatest offset used) of every cell of every place."""
    at, low, high = _unpacked(places)
    begin = low - low % _CELL
    of, number = _dealt((high - begin) // _CELL + 1)
    cell = begin[of] + number * _CELL
    return at[of], cell, np.maximum(low[of], cell), np.minimum(high[of], cell + _CELL - 1)


def _starts(places: np.ndarray) -> np.ndarray:
    """The starts of the strings of all places."""
    at, low, high = _unpacked(places)
    of, number = _dealt(high - low + 1)
    return (at - high)[of] + number


def _pieces(raw: bytes, begins: np.ndarray, options: SuffixOptions, gram: int,
            roller: Roller) -> Iterator[tuple[int, np.ndarray, Buckets]]:
    """Pieces of the text: where each begins, which members begin in it, and its buckets, enough for all their bytes."""
    of = begins // options.piece
    for piece in np.unique(of).tolist():
        begin = piece * options.piece
        data = np.frombuffer(raw, dtype=np.uint8, count=min(len(raw) - begin, options.piece + 2 * options.length), offset=begin)
        yield begin, np.flatnonzero(of == piece), Buckets(data, gram, roller)


def cell_rows(raw: bytes, places: np.ndarray, options: SuffixOptions, roller: Roller) -> tuple[np.ndarray, ...]:
    """(place, key, identifier) of the cells: the key is the bucket of the bytes that all strings of the full cell share."""
    length, common = options.length, max(0, options.length - _CELL + 1)
    gram = max(1, min(options.gram, common))
    at, cell, low, high = _cells(places)
    found = []
    for begin, some, buckets in _pieces(raw, at - high, options, gram, roller):
        a, c, least, most = at[some], cell[some], low[some], high[some]
        key = buckets.over(a - c - begin, np.full(len(a), common)) if common else np.zeros(len(a), dtype=np.uint64)
        identifier = buckets.over(a - most - begin, most - least + length)
        found.append((_packed(a, least, most), _pair(key, c.astype(np.uint64), 1),
                      _pair(identifier, _offsets(least, most), 0)))
    return _columns(found)


def string_rows(raw: bytes, places: np.ndarray, options: SuffixOptions, roller: Roller) -> tuple[np.ndarray, ...]:
    """(place, key, identifier) of single strings; here a place is a start, the key the bucket of its first bytes."""
    starts = _starts(places)
    rounds = (options.length // options.gram).bit_length() - 1
    found = []
    for begin, some, buckets in _pieces(raw, starts, options, options.gram, roller):
        here = starts[some] - begin
        found.append((starts[some], buckets.refined(here, rounds), buckets.over(here, np.full(len(here), options.length))))
    return _columns(found)


def _spans_of(places: Iterable[int], length: int) -> list[tuple[int, int]]:
    return [(at - high, at - low + length) for at, low, high in map(_unpacked, places)]


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, int, str, str]:
    """n_bytes, n_removed, n_spans, the digest of what is left, and its text, in which a character cut in two is replaced."""
    edges = [0, *(edge for span in spans for edge in span), len(raw)]
    kept = b"".join(raw[start:end] for start, end in zip(edges[::2], edges[1::2]))
    return len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")


def _pairs(flat: list[int] | None) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2])) if flat else []


def _flat(spans: list[tuple[int, int]]) -> list[int]:
    return [value for span in spans for value in span]


def _batch_of(batch: pa.RecordBatch, of: np.ndarray, found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """(id, tie, place, key, identifier) from the columns found and the rows of the batch that they are of."""
    index = pa.array(of)
    return pa.record_batch([batch.column("id").take(index), batch.column("tie").take(index), *map(pa.array, found)],
                           ["id", "tie", "place", "key", "identifier"])


def _rows_udf(rows_of: Callable, options: SuffixOptions, places_column: str) -> Callable:
    """From kept texts and places to (id, tie, place, key, identifier)."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, roller = zstandard.ZstdDecompressor().decompress, Roller()
        for batch in batches:
            texts, places = batch.column("packed").to_pylist(), batch.column(places_column).to_pylist()
            found = [rows_of(unpack(packed), np.array(wanted or (), dtype=np.int64), options, roller)
                     for packed, wanted in zip(texts, places)]
            if found:
                of = np.repeat(np.arange(len(found)), [len(columns[0]) for columns in found])
                yield _batch_of(batch, of, tuple(map(np.concatenate, zip(*found))))

    return rows


def _refined(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Single members (id, tie, place), and of the buckets that hold one: a member of every class.

    A class is what agrees in key and identifier; a class of two or more is finished.
    """
    classes = scratch.store(
        rows.groupBy("key", "identifier").agg(F.count("*").alias("n"), F.min(F.struct("id", "tie", "place")).alias("one")),
        "suffix-classes")
    # Stored, so that the join reads two plain shuffles and Spark may split a key with many classes.
    mixed = scratch.store(
        classes.groupBy(F.col("key").alias("_key"))
        .agg(F.count("*").alias("classes"), F.min("n").alias("least")).where("classes > 1 AND least = 1").select("_key"),
        "suffix-mixed")
    live = classes.join(mixed, F.col("key") == F.col("_key"), "left_semi").select("one.*")
    return classes.where("n = 1").select("one.*"), live


def _by_document(**kinds: DataFrame) -> DataFrame:
    """``_id, _tie`` and one array of places for each kind."""
    union = None
    for kind, frame in kinds.items():
        part = frame.select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), "place", F.lit(kind).alias("kind"))
        union = part if union is None else union.union(part)
    return union.groupBy("_id", "_tie").agg(
        *[F.collect_list(F.when(F.col("kind") == kind, F.col("place"))).alias(kind) for kind in kinds])


def _with_places(texts: DataFrame, places: DataFrame) -> DataFrame:
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    return texts.join(places, same, "left").drop("_id", "_tie")


def remove_repeats(docs: DataFrame, options: SuffixOptions = SuffixOptions(), id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, text`` of every row.

    ``spans`` are starts and ends in turn, ``text`` is what is left.
    """
    scratch = Scratch(docs.sparkSession, keep=True)
    rows = only(docs, id=id_column, text=text_column).select("id", text_of(F.col("text")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("tie"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    length = options.length

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            for _, key, _ in anchors([text.encode() for text in batch.column("text").to_pylist()], options, roller):
                yield pa.record_batch([pa.array(key)], ["key"])

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            for text, _, found in anchors([text.encode() for text in batch.column("text").to_pylist()], options, roller):
                yield _batch_of(batch, text, found())

    # Initial buckets: only keys that occur again go on.
    again = scratch.store(
        rows.select("text").mapInArrow(keys, "key long").groupBy("key").agg(F.count("*").alias("n"))
        .where("n > 1").select(F.col("key").alias("_key")), "suffix-keys")
    row_schema = f"id {kind}, tie long, place long, key long, identifier long"
    shared = scratch.store(
        rows.mapInArrow(places, row_schema).join(again, F.col("key") == F.col("_key"), "left_semi"), "suffix-places")
    single, live = _refined(shared, scratch)
    listed = _by_document(shared=shared, single=single, live=live)

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [pack(text.encode()) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), batch.column("tie"), pa.array(texts, pa.binary())],
                                  ["id", "tie", "packed"])

    result = (f"id {kind}, tie long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              f"text string, packed binary, spans {_SPAN}, live {_SPAN}")

    def settle(earlier: str | None, all_of: Callable, shape: Callable) -> Callable:
        """Adds the spans of the places that are not single; a document without live places is done."""

        def settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unpack = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    alone = set(row["single"] or ())
                    spans = shape([p for p in all_of(row) if p not in alone])
                    spans = merged(_pairs(row[earlier] if earlier else None) + spans)
                    left = sorted(set(row["next"] or ()))
                    numbers = (None,) * 5 if left else _cut(unpack(row["packed"]), spans)
                    out.append((*numbers, row["packed"] if left else None, _flat(spans), left))
                if out:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "packed", "spans", "live"]
                    columns = [pa.array(values, kind_) for values, kind_ in zip(zip(*out), types)]
                    yield pa.record_batch([batch.column("id"), batch.column("tie"), *columns], ["id", "tie", *names])

        return settled

    def cells_of(row: dict) -> list[int]:
        at, _, low, high = _cells(np.array(row["live"], dtype=np.int64))
        return _packed(at, low, high).tolist()

    def starts_of(row: dict) -> list[int]:
        return _starts(np.array(row["live"], dtype=np.int64)).tolist()

    texts = rows.mapInArrow(packed, f"id {kind}, tie long, packed binary")
    first = scratch.store(
        _with_places(texts, listed).withColumnRenamed("live", "next").mapInArrow(
            settle(None, lambda row: row["shared"] or (), lambda kept: _spans_of(kept, length)), result), "suffix-texts")
    waiting = first.where("packed IS NOT NULL")

    cells = waiting.mapInArrow(_rows_udf(cell_rows, options, "live"), row_schema)
    single, live = _refined(cells, scratch)
    second = scratch.store(
        _with_places(waiting.select("id", "tie", "packed", "spans", "live"), _by_document(single=single, next=live))
        .mapInArrow(settle("spans", cells_of, lambda kept: _spans_of(kept, length)), result), "suffix-texts")
    waiting = second.where("packed IS NOT NULL")

    strings = waiting.mapInArrow(_rows_udf(string_rows, options, "live"), row_schema)
    single, _ = _refined(strings, scratch)

    third = (
        _with_places(waiting.select("id", "tie", "packed", "spans", "live"), _by_document(single=single))
        .withColumn("next", F.lit(None).cast(_SPAN))
        .mapInArrow(settle("spans", starts_of, lambda kept: [(start, start + length) for start in kept]), result)
    )
    done = first.where("packed IS NULL").union(second.where("packed IS NULL")).union(third)
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text")
