"""Spelling variants: words that differ by one code point, found by permuterm rotations.

A word is marked with a terminator at its end and turned through all its rotations. If two words differ in one place, the
rotations that end at that place agree in all that comes before it: a replaced code point leaves two rotations with one
prefix and different last characters, and an inserted one leaves a rotation of the longer word whose prefix is a whole
rotation of the shorter. So each rotation is listed under its prefix without the last character, and also under itself;
sorting by prefix brings near words next to each other, and one scan over the sorted groups emits for every member how
many neighbours it has there and the best of them.

A prefix fixes the rest of its words, so a group has at most one member for each character of the alphabet and one whole
rotation: no group grows with the data, and its pairs need not be written out. A code point inserted into a run of equal
ones is met once for every place in the run; only the first place counts.

Defined results: a null text has no words; an empty table gives no rows; rows with equal ids are separate documents and
all count; a null id counts as empty text in the digest; of near words with equal n the smallest in code-point order is
the form; very long texts are read whole, and a task holds the tally of at most ``tally`` words at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.common import only, text_of
from smeltwork.session import Scratch

#: Marks the end of a word; no word holds it.
TERMINATOR = "$"
_RUN = r"[a-zÀ-ÿ]+"
_SCANNED = "word string, near long, n long, best string"


@dataclass(frozen=True)
class SpellingOptions:
    """``spoil``: of the runs whose digest it divides, one code point is deleted; ``ratio``: how much commoner a form is."""

    least_length: int = 5
    least_n: int = 3
    spoil: int = 97
    ratio: int = 2
    tally: int = 200_000

    def __post_init__(self) -> None:
        if self.ratio <= 1:
            raise ValueError("a form must be commoner than its word, or chains of forms could close")


def count_words(docs: DataFrame, options: SpellingOptions = SpellingOptions(), id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``word, n``: the runs of letters of all texts, A-Z in lower case, that are long and common enough."""

    def tallied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, tally = re.compile(_RUN), Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                lower = text.encode("utf-8", "replace").lower().decode()  # bytes: only A-Z
                for run, n in Counter(runs.findall(lower)).items():
                    digest = zlib.crc32(f"{id_}:{run}".encode())
                    if digest % options.spoil == 0:
                        at = digest % len(run)
                        run = run[:at] + run[at + 1:]
                    if len(run) >= options.least_length:
                        tally[run] += n
                if len(tally) > options.tally:
                    yield out()
                    tally.clear()
        yield out()

    texts = only(docs, id=id_column, text=text_column).select(text_of(F.col("id")).alias("id"), text_of(F.col("text")).alias("text"))
    return (
        texts.mapInArrow(tallied, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= options.least_n)
    )


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, last, word, n, first`` of (word, n): each rotation under its prefix, and under itself with ``last`` empty.

    ``first``: the last character does not repeat the one before it in the word.
    """
    marked = F.concat("word", F.lit(TERMINATOR))
    size = F.length("word")

    def turned(i, skip: int):
        """What follows place i (from 0) of the marked word, then what comes before it, without ``skip`` characters at it."""
        return F.concat(F.substring(marked, i + skip + 1, size + 1), F.substring(marked, F.lit(1), i))

    def at(i):
        return F.substring("word", i + 1, F.lit(1))

    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        turned(i, 0).alias("prefix"), F.lit("").alias("last"), F.lit(True).alias("first")))
    edited = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        turned(i, 1).alias("prefix"), at(i).alias("last"),
        ((i == 0) | (at(i) != F.substring("word", F.greatest(i, F.lit(1)), F.lit(1)))).alias("first")))
    return words.where(size > 0).select("word", "n", F.explode(F.concat(whole, edited)).alias("r")).select("r.*", "word", "n")


def _group(words: list[str], ns: list[int], last: list[str], first: list[bool]) -> Iterator[tuple[str, int, int, str]]:
    """(word, neighbours here, n of the best, the best) for the members of one group, the whole rotation first if there is one."""
    shorter = (-ns[0], words[0]) if last[0] == "" else None
    members = [(-n, word, f) for n, word, l, f in zip(ns, words, last, first) if l]
    ranked = sorted((n, word) for n, word, _ in members)[:2]
    longer = sorted((n, word) for n, word, f in members if f)
    if shorter and longer:
        yield words[0], len(longer), -longer[0][0], longer[0][1]
    for n, word, f in members:
        others = [one for one in ranked if one[1] != word][:1]
        if shorter and f:
            others.append(shorter)
        if others:
            best = min(others)
            yield word, len(members) - 1 + bool(shorter and f), -best[0], best[1]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of neighbouring rows with one prefix; a group may reach over the edge of a batch."""

    def neighbours(rows: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        columns = [rows.column(name) for name in ("word", "n", "last", "first")]
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if end - begin > 1:
                found.extend(_group(*(column.slice(begin, end - begin).to_pylist() for column in columns)))
        if found:
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(values, kind) for values, kind in zip(zip(*found), types)], ["word", "near", "n", "best"])

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        prefix = rows.column("prefix").combine_chunks()
        changed = pc.not_equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        starts = np.r_[0, np.flatnonzero(changed) + 1]
        yield from neighbours(rows, starts)
        held = rows.slice(int(starts[-1]))
    if held is not None:
        yield from neighbours(held, np.array([0, held.num_rows]))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of every one of (word, n) that has a near word."""
    ordered = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "last")
    return (
        ordered.select("prefix", "last", "word", "n", "first").mapInArrow(_scan, _SCANNED)
        .groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "best")).alias("top"))
        .select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.best").alias("best"))
    )


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` of (word, form): pointers are doubled until none moves; a form is commoner, so no chain closes."""
    links = scratch.store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        after = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = links.join(after, F.col("root") == F.col("_word"), "left")
        moved = scratch.store(
            moved.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "spelling-roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_groups(docs: DataFrame, options: SpellingOptions = SpellingOptions(), id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts."""
    scratch = Scratch(docs.sparkSession, keep=True)
    words = scratch.store(count_words(docs, options, id_column, text_column), "spelling-words")
    near = near_words(words).withColumnRenamed("word", "_word")
    common = F.col("best_n") >= options.ratio * F.col("n")
    formed = scratch.store(
        words.join(near, F.col("word") == F.col("_word"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best")).alias("form"), F.when(common, F.col("best_n")).alias("form_n")),
        "spelling-forms")
    roots = _roots(formed.where("form IS NOT NULL"), scratch).withColumnRenamed("word", "_word")
    return formed.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same result from wildcard and deletion keys of whole words; the digest is spelled out byte by byte.
SQL = r"""
WITH RECURSIVE digest_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
          FROM documents)
    GROUP BY doc_id, run
), bytes AS (
    SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs
), digested AS (
    SELECT run, n, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT)),
               lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS digest
    FROM bytes, digest_table
), spoiled AS (
    SELECT CASE WHEN digest % 97 = 0
                THEN run[1:digest % length(run)] || run[digest % length(run) + 2:] ELSE run END AS word, n
    FROM digested
), words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM spoiled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
    SELECT word, unnest(range(length(word))) AS i FROM words
), wild AS (
    SELECT word, i, word[1:i] || word[i + 2:] AS rest FROM places
), near AS (
    SELECT a.word, b.word AS other FROM wild a JOIN wild b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, w.word FROM wild a JOIN words w ON a.rest = w.word
    UNION SELECT w.word, a.word FROM wild a JOIN words w ON a.rest = w.word
), ranked AS (
    SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
           row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
    FROM near JOIN words o ON o.word = other
), formed AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
           CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
), chains AS (
    SELECT word, word AS root FROM formed
    UNION SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), ends AS (
    SELECT c.word, c.root FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON e.word = f.word
"""
