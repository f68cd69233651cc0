"""Language ID by mixtures: each word of a document comes from one of several languages.

A language is a distribution over letter trigrams, counted over all labelled documents. A word's likelihood under a language
is the product over its letters, each with both neighbours (outside the word: a space). Expectation-maximisation turns the
likelihoods of a document's words into the proportions of its languages. The languages are then taken in order of
proportion into growing sets; each set is fitted anew, and a set is kept as long as its log-likelihood, less a penalty that
grows with its size and with the logarithm of the number of words, rises. The prediction is the largest proportion of the
set, drawn towards equal shares by one word for each language, so that short texts score low.

Training counts letters inside tasks and sums them by language and bucket: what reaches the driver, and goes to the tasks
as the model, is at most languages x ``buckets`` numbers, however many documents there are.

Defined results: a null text, and a text without a letter, is ``und`` with score 0, and so is every text if nothing was
learned; documents with null language, and texts without letters, teach nothing; equal proportions go to the smallest
language in code-point order; repeated rows count and are judged each on its own; an empty table gives no rows; very long
texts are read whole, their likelihoods in pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.common import only, text_of

UNKNOWN = "und"
_SPACE = 0x20
_PIECE = 1 << 20


@dataclass(frozen=True)
class LanguageOptions:
    """``penalty``: for each further language, this many times the logarithm of the number of words."""

    buckets: int = 1 << 16
    smoothing: float = 0.05
    penalty: float = 3.0
    rounds: int = 60
    least_step: float = 1e-4


@dataclass(frozen=True)
class LanguageModel:
    """``names`` in code-point order; ``logs``: log-likelihood of each bucket, one row for each language."""

    names: tuple[str, ...]
    logs: np.ndarray


class _Letters:
    """Which code points are letters; the table grows as far as the texts need."""

    def __init__(self) -> None:
        self.known = np.zeros(0, dtype=bool)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        top = int(points.max(initial=0)) + 1
        if top > len(self.known):
            size = next(size for size in (1 << 10, 1 << 16, 0x110000) if size >= top)
            self.known = np.array([chr(point).isalpha() for point in range(size)])
        return self.known[points]


def _grams(texts: list[str], letters: _Letters, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the letters of all texts in order: bucket of the trigram round it, whether it starts a word, number of its text."""
    lower = [text.lower() for text in texts]
    sizes = np.array([len(text) + 1 for text in lower])
    points = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "replace"), dtype="<u4")
    is_letter = letters(points)
    at = np.flatnonzero(is_letter)
    plain = np.where(is_letter, points, _SPACE).astype(np.uint64)
    mixed = plain[at - 1] * np.uint64(0x9E3779B97F4A7C15) + plain[at] * np.uint64(0xC2B2AE3D27D4EB4F) + plain[at + 1] * np.uint64(0x165667B19E3779F9)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    bucket = (mixed >> np.uint64(33)) % np.uint64(buckets)
    text = np.searchsorted(np.cumsum(sizes), at, side="right")
    return bucket.astype(np.int64), ~is_letter[at - 1], text


def _portions(texts: Iterable[str]) -> Iterator[list[str]]:
    """Whole texts in lists of about ``_PIECE`` characters."""
    portion, size = [], 0
    for text in texts:
        portion.append(text)
        size += len(text)
        if size >= _PIECE:
            yield portion
            portion, size = [], 0
    if portion:
        yield portion


def train(docs: DataFrame, usable: Column, options: LanguageOptions = LanguageOptions(), text_column: str = "text",
          lang_column: str = "lang") -> LanguageModel | None:
    """The model of the languages of the ``usable`` rows (a condition on the columns of ``docs``); None if there are none."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, tally = _Letters(), {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in tally.items():
                bucket = np.flatnonzero(counts)
                yield pa.record_batch([pa.array([lang] * len(bucket), pa.string()), pa.array(bucket), pa.array(counts[bucket])],
                                      ["lang", "bucket", "n"])
            tally.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            begin = 0
            for portion in _portions(batch.column("text").to_pylist()):
                bucket, _, text = _grams(portion, letters, options.buckets)
                own = langs[begin: begin + len(portion)]
                begin += len(portion)
                for lang in set(own):
                    mine = np.array([one == lang for one in own])[text]
                    if mine.any():
                        counts = np.bincount(bucket[mine], minlength=options.buckets)
                        tally[lang] = tally[lang] + counts if lang in tally else counts
                if len(tally) > 64:
                    yield from out()
        yield from out()

    known = docs.where(usable & F.col(f"`{lang_column}`").isNotNull())
    rows = only(known, lang=lang_column, text=text_column).select(F.col("lang").cast("string"), text_of(F.col("text")).alias("text"))
    sums = (
        rows.mapInArrow(counted, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    if not sums.num_rows:
        return None
    langs = sums.column("lang").to_pylist()
    names = sorted(set(langs))
    place = {lang: i for i, lang in enumerate(names)}
    counts = np.zeros((len(names), options.buckets))
    counts[np.array([place[lang] for lang in langs]), sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    counts += options.smoothing
    return LanguageModel(tuple(names), np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def word_likelihoods(texts: list[str], model: LanguageModel, letters: _Letters) -> tuple[np.ndarray, np.ndarray]:
    """(likelihood of each word under each language, over its greatest; number of the word's text)."""
    bucket, starts, text = _grams(texts, letters, model.logs.shape[1])
    first = np.flatnonzero(starts)
    ends = np.r_[first[1:], len(bucket)]
    out = np.empty((len(first), len(model.names)))
    begin = 0
    while begin < len(first):  # a piece holds whole words
        end = max(begin + 1, int(np.searchsorted(ends, first[begin] + _PIECE, side="right")))
        piece = model.logs[:, bucket[first[begin]: ends[end - 1]]]
        out[begin:end] = np.add.reduceat(piece, first[begin:end] - first[begin], axis=1, dtype=np.float64).T
        begin = end
    out -= out.max(axis=1, keepdims=True)
    return np.exp(np.maximum(out, -30.0)), text[first]


def fit_mixture(likely: np.ndarray, starts: np.ndarray, allowed: np.ndarray, options: LanguageOptions) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) of each document by expectation-maximisation; ``starts``: each document's first word.

    ``allowed`` says which languages a document may have. A document that has come to rest leaves the rounds.
    """
    sizes = np.diff(np.r_[starts, len(likely)])
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    going = np.arange(len(starts))
    words, heads = likely, starts
    for _ in range(options.rounds):
        weights = words * np.repeat(shares[going], sizes[going], axis=0)
        weights /= weights.sum(axis=1, keepdims=True)
        now = np.add.reduceat(weights, heads, axis=0) / sizes[going, None]
        step = np.abs(now - shares[going]).max(axis=1)
        shares[going] = now
        if not (step > options.least_step).any():
            break
        if 2 * (step > options.least_step).sum() < len(going):
            rest = step <= options.least_step
            words = words[~np.repeat(rest, sizes[going])]
            going = going[~rest]
            heads = np.r_[0, np.cumsum(sizes[going])[:-1]]
    score = np.log((likely * np.repeat(shares, sizes, axis=0)).sum(axis=1))
    return shares, np.add.reduceat(score, starts)


def mixtures(likely: np.ndarray, starts: np.ndarray, options: LanguageOptions) -> np.ndarray:
    """Proportions of the languages of each document's chosen set; those outside of it have none."""
    n_docs, n_langs = len(starts), likely.shape[1]
    sizes = np.diff(np.r_[starts, len(likely)])
    every, _ = fit_mixture(likely, starts, np.ones((n_docs, n_langs)), options)
    order = np.argsort(-every, axis=1, kind="stable")
    best = np.zeros((n_docs, n_langs))
    best[np.arange(n_docs), order[:, 0]] = 1.0
    value = np.add.reduceat(np.log(likely[np.arange(len(likely)), np.repeat(order[:, 0], sizes)]), starts)
    price = options.penalty * np.log(sizes + 1.0)
    going = np.arange(n_docs)
    for size in range(2, n_langs + 1):
        # A language without half a word cannot pay its price.
        worth = every[going, order[going, size - 1]] * sizes[going] >= 0.5
        going = going[worth]
        if not len(going):
            break
        picked = np.zeros(n_docs, dtype=bool)
        picked[going] = True
        words = likely[np.repeat(picked, sizes)]
        heads = np.r_[0, np.cumsum(sizes[going])[:-1]]
        allowed = np.zeros((len(going), n_langs))
        np.put_along_axis(allowed, order[going, :size], 1.0, axis=1)
        shares, score = fit_mixture(words, heads, allowed, options)
        better = score - value[going] > price[going]
        going = going[better]
        best[going], value[going] = shares[better], score[better]
    return best


def identify(text: Column, model: LanguageModel | None, options: LanguageOptions = LanguageOptions()) -> Column:
    """Struct of ``lang``, ``score`` and ``mixture``: the languages of the chosen set with their shares, the largest first."""

    @F.pandas_udf("lang string, score double, mixture string")
    def judged(texts: pd.Series) -> pd.DataFrame:
        letters, out = _Letters(), []
        for portion in _portions(t if isinstance(t, str) else "" for t in texts):
            rows = [(UNKNOWN, 0.0, "")] * len(portion)
            if model is not None:
                likely, text_of_word = word_likelihoods(portion, model, letters)
                worded, starts = np.unique(text_of_word, return_index=True)
                if len(worded):
                    shares = mixtures(likely, starts, options)
                    sizes = np.diff(np.r_[starts, len(likely)])[:, None]
                    drawn = (shares * sizes + 1.0) / (sizes + len(model.names))
                    top = drawn.argmax(axis=1)
                    for i, doc in enumerate(worded.tolist()):
                        order = [k for k in np.argsort(-shares[i], kind="stable").tolist() if shares[i, k] > 0]
                        mixture = ",".join(f"{model.names[k]}:{shares[i, k]:.3f}" for k in order)
                        rows[doc] = (model.names[top[i]], float(drawn[i, top[i]]), mixture)
            out.extend(rows)
        return pd.DataFrame(out, columns=["lang", "score", "mixture"])

    return judged(text_of(text))
