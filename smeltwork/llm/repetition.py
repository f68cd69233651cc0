"""Quality rules on repetition inside a document, from a suffix array over its words.

The suffix array is built by prefix doubling; the longest common prefix of neighbours in it gives, for every position,
the longest substring that starts there and occurs elsewhere in the document. The longest-common-prefix intervals are
the maximal repeated substrings; the union of their occurrences of ``least_words`` words or more is the covered part.
A document is rejected if the covered share of its word characters or its longest repeat passes a limit. Both limits lie
well inside the base rule on repeated windows of three words, which alone rejects what repeats over half of its words.

Defined results: null and empty texts have no words, fail the base rules and are not kept; one very long text is held by
one task, with a few numbers per word; rows with equal ids are judged each on its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from smeltwork.llm.common import only

_SPACE = " \t\n\r\x0b\x0c"
_SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = (", ".join(f"{name} long" for name in _LONGS)
           + ", base_failed boolean, kept boolean, covered double, longest_repeat long")


@dataclass(frozen=True)
class RepetitionOptions:
    """``longest_share`` limits the longest repeat as a share of the document's words, once it has ``longest_words``.

    A repeat of more than ``longest_most`` words is too long in a document of any length: a passage copied, not a phrase.
    """

    least_words: int = 8
    most_covered: float = 0.2
    longest_words: int = 60
    longest_share: float = 0.05
    longest_most: int = 200
    base_words: int = 50
    base_percent: int = 50


def doubled_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the runs of 1, 2, 4 ... words that start at each position, until all of them differ."""
    n = len(ids)
    levels, k = [ids + 1], 1
    while k < n and int(levels[-1].max()) < n:
        rank = levels[-1]
        key = rank * np.int64(n + 1)
        key[: n - k] += rank[k:]
        order = np.argsort(key, kind="stable")
        step = np.empty(n, dtype=np.int64)
        step[0] = 1
        step[1:] = key[order][1:] != key[order][:-1]
        named = np.empty(n, dtype=np.int64)
        named[order] = np.cumsum(step)
        levels.append(named)
        k *= 2
    return levels


def repeat_lengths(levels: list[np.ndarray]) -> np.ndarray:
    """For each position the longest substring from it, in words, that also starts elsewhere."""
    n = len(levels[0])
    array = np.argsort(levels[-1], kind="stable")
    a, b = array[:-1], array[1:]
    prefix = np.zeros(n - 1, dtype=np.int64) if n else np.zeros(0, dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        left, right = a + prefix, b + prefix
        inside = np.flatnonzero((left < n) & (right < n))
        same = inside[rank[left[inside]] == rank[right[inside]]]
        prefix[same] += 1 << level
    longest = np.zeros(n, dtype=np.int64)
    longest[a] = prefix
    longest[b] = np.maximum(longest[b], prefix)
    return longest


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def judge(text: str | None, options: RepetitionOptions) -> tuple:
    """The row of results for one text, in the order of the schema."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes split at ASCII space only
    n = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    word_chars = len(text) - (len(raw) - int(sizes.sum()))
    symbols = sum(raw.count(s) for s in _SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    dup_lines = len(lines) - len(set(lines))
    repeat_words, covered, longest = 0, 0.0, 0
    if n:
        names: dict[bytes, int] = {}
        ids = np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int64, count=n)
        levels = doubled_ranks(ids)
        lengths = repeat_lengths(levels)
        longest = int(lengths.max())
        third = np.flatnonzero(lengths >= 3)
        repeat_words = int(_covered(third, np.full(len(third), 3), n).sum())
        long = np.flatnonzero(lengths >= options.least_words)
        covered = float(sizes[_covered(long, lengths[long], n)].sum() / max(1, sizes.sum()))
    failed = n < options.base_words or 100 * repeat_words > options.base_percent * n
    too_long = longest >= options.longest_words and longest > min(options.longest_share * n, options.longest_most)
    kept = not failed and covered <= options.most_covered and not too_long
    return n, word_chars, symbols, dup_lines, repeat_words, failed, kept, covered, longest


def repetition_rules(docs: DataFrame, options: RepetitionOptions = RepetitionOptions(), id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the counts, the base rules' and the method's verdict."""
    texts = only(docs, doc_id=id_column, text=text_column)
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = [part.split()[0] for part in _SCHEMA.split(", ")]

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(text, options) for text in batch.column("text").to_pylist()]
            columns = [pa.array(values) for values in zip(*rows)]
            if columns:
                yield pa.record_batch([batch.column("doc_id"), *columns], ["doc_id", *names])

    return texts.mapInArrow(judged, f"doc_id {kind}, {_SCHEMA}")
