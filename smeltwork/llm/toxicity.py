"""Toxicity scores from a factorization machine over hashed terms.

A document's terms are its words and their four- and five-letter prefixes, lower-cased, hashed to ``2 ** hash_bits``
numbers. The machine adds to the linear weight of each term the products of term vectors over all pairs of terms
present, so that two terms together can count more (an insult with a group's name) or less than apart. It learns by
logistic loss on a bounded, class-balanced sample; the bias is then moved to the labels' true shares. It learns in two
parts, whose sum is one machine: first the terms that differ most between the classes by themselves, then, on what these
leave unexplained, all terms of ``least_docs`` sampled documents, so that a pair counts whose terms say nothing alone. A
fifth of the sample, held back, tells how many steps of the second part help.

Defined results: null and empty texts have no terms and get the score of the bias alone; a null id is never held out;
ids whose labels disagree are not learned from; without labelled rows of both classes every score is the share of
label 1 (0 without labels). Rows with equal ids are scored each on its own; equal texts score alike. Very long texts are read
whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.learning import Sample, labelled_sample, sampled_texts

_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"
_MOST_CACHED = 500_000


@dataclass(frozen=True)
class FmOptions:
    """``per_class`` bounds the labelled rows of each class that the machine learns from.

    ``features`` bounds the terms of the first part only; the second takes all of ``least_docs`` documents, in batches of
    ``batch_rows``, and stops when the held-back rows gain nothing for ``patience`` steps.
    """

    per_class: int = 4000
    hash_bits: int = 20
    features: int = 2048
    least_docs: int = 4
    factors: int = 8
    steps: int = 300
    rate: float = 0.05
    l2: float = 3e-5
    seed: int = 5
    batch_rows: int = 1024
    patience: int = 100


@dataclass(frozen=True)
class FmModel:
    bias: float = -40.0
    hash_bits: int = 20
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))


def word_terms(word: str, hash_bits: int) -> tuple[int, ...]:
    word = word.strip(_EDGES)
    if not word:
        return ()
    names = ["w" + word]
    if len(word) > 4:
        names.append("4" + word[:4])
    if len(word) > 5:
        names.append("5" + word[:5])
    mask = (1 << hash_bits) - 1
    return tuple(zlib.crc32(name.encode("utf-8", "replace")) & mask for name in names)


def document_terms(text: str | None, hash_bits: int) -> list[int]:
    found: set[int] = set()
    for word in set((text or "").lower().split()):
        found.update(word_terms(word, hash_bits))
    return sorted(found)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, options: FmOptions = FmOptions(), label: str = "toxic",
        id_column: str = "doc_id", text_column: str = "text") -> FmModel:
    """A machine that tells label 1 from 0, learned from labelled rows for which ``usable`` holds."""
    sample = labelled_sample(labels, label, usable, options.per_class, options.seed)
    bits = options.hash_bits

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [document_terms(text, bits) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("label"), pa.array(terms, pa.list_(pa.int32()))], ["label", "terms"])

    rows = sampled_texts(docs, sample, id_column, text_column).mapInArrow(extract, "label int, terms array<int>").toArrow()
    return learn(np.asarray(rows.column("label")), rows.column("terms").combine_chunks(), sample.shares, options)


def learn(labels: np.ndarray, terms: pa.ListArray, shares: dict[int, float], options: FmOptions) -> FmModel:
    share = shares.get(1, 0.0)
    prior = math.log((share + 1e-9) / (1 - share + 1e-9))
    y = labels.astype(np.float64)
    n1, n0 = float(y.sum()), float((1 - y).sum())
    if not n1 or not n0:
        return FmModel(prior, options.hash_bits)
    sizes = np.asarray(pa.compute.list_value_length(terms))
    doc = np.repeat(np.arange(len(y)), sizes)
    flat = np.asarray(terms.flatten()).astype(np.int64)
    seen = np.bincount(flat, minlength=1 << options.hash_bits)
    known = np.flatnonzero((seen >= options.least_docs) & (seen < len(y)))
    if not len(known):
        return FmModel(prior, options.hash_bits)
    column = np.full(1 << options.hash_bits, -1, dtype=np.int32)
    column[known] = np.arange(len(known))
    hit = column[flat] >= 0
    doc, flat = doc[hit], column[flat[hit]]
    # Rows come in any order; a digest of their terms puts them into one.
    digest = np.bincount(doc, weights=np.sin(flat + 1.0), minlength=len(y))
    place = np.empty(len(y), dtype=np.int64)
    place[np.lexsort((digest, sizes, labels))] = np.arange(len(y))
    order = np.argsort(place[doc], kind="stable")
    rows = np.split(flat[order], np.cumsum(np.bincount(place[doc], minlength=len(y)))[:-1])
    y = np.sort(y)  # the order above is by label first
    held = np.arange(len(y)) % 5 == 4
    first = _first_part(_picked(rows, ~held), y[~held], len(known), options)
    offset, beyond = _logits(_picked(rows, ~held), *first), _logits(_picked(rows, held), *first)
    steps = _second_part(_picked(rows, ~held), y[~held], offset, len(known), options, options.steps,
                         (_picked(rows, held), y[held], beyond))[0]
    bias, theta = _first_part(rows, y, len(known), options)
    if steps:
        _, more, extra = _second_part(rows, y, _logits(rows, bias, theta), len(known), options, steps)
        bias, theta = bias + more, np.column_stack([theta[:, 0] + extra[:, 0], theta[:, 1:], extra[:, 1:]])
    used = np.flatnonzero(theta.any(axis=1))
    return FmModel(float(bias + prior - math.log(n1 / n0)), options.hash_bits, known[used],
                   theta[used, 0].astype(np.float64), theta[used, 1:].astype(np.float64))


def _picked(rows: list[np.ndarray], mask: np.ndarray) -> list[np.ndarray]:
    return [rows[i] for i in np.flatnonzero(mask)]


def _logits(rows: list[np.ndarray], bias: float, theta: np.ndarray) -> np.ndarray:
    out = np.full(len(rows), bias)
    for i, row in enumerate(rows):
        if len(row):
            part = theta[row]
            out[i] += part[:, 0].sum() + 0.5 * ((part[:, 1:].sum(0) ** 2).sum() - (part[:, 1:] ** 2).sum())
    return out


def _first_part(rows: list[np.ndarray], y: np.ndarray, m: int, options: FmOptions) -> tuple[float, np.ndarray]:
    """Bias and theta of a machine on the terms that differ most between the classes; theta is 0 for the others."""
    theta = np.zeros((m, options.factors + 1), dtype=np.float32)
    n1, n0 = float(y.sum()), float((1 - y).sum())
    if not n1 or not n0:
        return 0.0, theta
    doc, flat = np.repeat(np.arange(len(rows)), [len(row) for row in rows]), np.concatenate(rows)
    with1 = np.bincount(flat, weights=y[doc], minlength=m)
    with0 = np.bincount(flat, minlength=m) - with1
    p = (with1 + with0) / (n1 + n0)
    gap = with1 / n1 - with0 / n0
    chi = np.where((with1 + with0 >= options.least_docs) & (p < 1), gap**2 / np.maximum(p * (1 - p), 1e-9), 0.0)
    kept = np.sort(np.lexsort((np.arange(m), -chi))[: options.features])
    kept = kept[chi[kept] * (n1 * n0 / (n1 + n0)) > 10.83]  # the 0.1 % point of chi square
    if not len(kept):
        return math.log(n1 / n0), theta
    column = np.full(m, -1, dtype=np.int32)
    column[kept] = np.arange(len(kept))
    hit = column[flat] >= 0
    x = np.zeros((len(y), len(kept)), dtype=np.float32)
    x[doc[hit], column[flat[hit]]] = 1.0
    bias, weights, vectors = _descend(x, y, options)
    theta[kept, 0], theta[kept, 1:] = weights, vectors
    return float(bias), theta


def _second_part(rows: list[np.ndarray], y: np.ndarray, offset: np.ndarray, m: int, options: FmOptions, steps: int,
                 held: tuple[list[np.ndarray], np.ndarray, np.ndarray] | None = None) -> tuple[int, float, np.ndarray]:
    """Steps, bias and theta of a machine on all terms that is added to ``offset``.

    The largest move is ``rate``, all others are in proportion to their gradients: with moves of one size for every term,
    the many that say nothing would drown the few that do. With ``held`` rows, the steps are those at their least loss.
    """
    rng = np.random.default_rng(options.seed)
    batches = []
    for picked in np.array_split(rng.permutation(len(rows)), max(1, round(len(rows) / options.batch_rows))):
        picked = [i for i in picked if len(rows[i])]
        if picked:
            flat = np.concatenate([rows[i] for i in picked])
            sizes = np.array([len(rows[i]) for i in picked])
            by_term = np.argsort(flat, kind="stable")
            edge = np.flatnonzero(np.r_[True, np.diff(flat[by_term]) > 0])
            batches.append((flat, np.r_[0, np.cumsum(sizes)[:-1]], y[picked], offset[picked],
                            np.repeat(np.arange(len(picked)), sizes)[by_term], edge, flat[by_term][edge]))
    theta = np.zeros((m, options.factors + 1), dtype=np.float32)
    theta[:, 1:] = rng.normal(0, 0.02, (m, options.factors))
    bias, moved, most = 0.0, np.zeros_like(theta), np.zeros(2)
    best, at = (_loss(held[2], held[1]) if held else 0.0), 0
    for step in range(1, steps + 1 if batches else 1):
        flat, starts, labels, base, doc, edge, term = batches[(step - 1) % len(batches)]
        both = np.add.reduceat(theta[flat], starts, axis=0)
        sums = both[:, 1:]
        squares = np.add.reduceat((theta[:, 1:] ** 2).sum(1)[flat], starts)
        logit = base + bias + both[:, 0] + 0.5 * ((sums**2).sum(1) - squares)
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30)))) - labels).astype(np.float32) / len(labels)
        pull = np.add.reduceat(np.column_stack([error, error[:, None] * sums])[doc], edge, axis=0)
        pull[:, 1:] -= pull[:, :1] * theta[term, 1:]
        grad = options.l2 * theta
        grad[term] += pull
        most = np.maximum(0.99 * most, [np.abs(grad[:, 0]).max(), np.abs(grad[:, 1:]).max()])
        moved = 0.9 * moved + 0.1 * grad
        scale = options.rate / (1 - 0.9**step) / (most + 1e-12)
        theta[:, 0] -= scale[0] * moved[:, 0]
        theta[:, 1:] -= scale[1] * moved[:, 1:]
        bias -= options.rate * float(error.sum())
        if held and step % 20 == 0:
            loss = _loss(held[2] + _logits(held[0], bias, theta), held[1])
            if loss < best - 1e-4:
                best, at = loss, step
            elif step - at >= options.patience:
                break
    return (at if held else steps), bias, theta


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y == 1, -logit, logit)).mean()) if len(y) else 0.0


def _descend(x: np.ndarray, y: np.ndarray, options: FmOptions) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss of bias + x w + (|x V|^2 - x |V|^2) / 2, for binary x."""
    rng = np.random.default_rng(options.seed)
    n, m = x.shape
    theta = np.zeros((m, options.factors + 1), dtype=np.float32)
    theta[:, 1:] = rng.normal(0, 0.02, (m, options.factors))
    bias, first, second = 0.0, np.zeros_like(theta), np.zeros_like(theta)
    bias_first = bias_second = 0.0
    for step in range(1, options.steps + 1):
        both = x @ theta
        sums = both[:, 1:]
        logit = bias + both[:, 0] + 0.5 * ((sums**2).sum(1) - x @ (theta[:, 1:] ** 2).sum(1))
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30)))) - y).astype(np.float32) / n
        grad = np.empty_like(theta)
        pull = x.T @ np.column_stack([error, error[:, None] * sums])
        grad[:, 0] = pull[:, 0]
        grad[:, 1:] = pull[:, 1:] - pull[:, :1] * theta[:, 1:]
        grad += options.l2 * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        scale = math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        theta -= options.rate * scale * first / (np.sqrt(second) + 1e-8)
        pull_bias = float(error.sum())
        bias_first = 0.9 * bias_first + 0.1 * pull_bias
        bias_second = 0.999 * bias_second + 0.001 * pull_bias**2
        bias -= options.rate * scale * bias_first / (math.sqrt(bias_second) + 1e-8)
    return bias, theta[:, 0].astype(np.float64), theta[:, 1:].astype(np.float64)


def score(text: Column, model: FmModel) -> Column:
    """The probability of label 1, from the whole text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        position = {int(term): i for i, term in enumerate(model.terms)}
        squares = (model.vectors**2).sum(1)
        known: dict[str, tuple[int, ...]] = {}

        def columns(word: str) -> tuple[int, ...]:
            found = known.get(word)
            if found is None:
                if len(known) >= _MOST_CACHED:
                    known.clear()
                found = tuple(position[t] for t in word_terms(word, model.hash_bits) if t in position)
                known[word] = found
            return found

        for texts in batches:
            logits = np.full(len(texts), model.bias)
            for i, value in enumerate(texts):
                present: set[int] = set()
                if isinstance(value, str):
                    for word in set(value.lower().split()):
                        found = columns(word)
                        if found:
                            present.update(found)
                if present:
                    at = sorted(present)
                    total = model.vectors[at].sum(0)
                    logits[i] += model.weights[at].sum() + 0.5 * (total @ total - squares[at].sum())
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -40, 40))))

    return scored(text)
