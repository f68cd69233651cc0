"""Quality scores from Bradley-Terry preference pairs.

Every document is described by numbers on its words, lines and characters. In a preference pair the document labelled 1
should beat the one labelled 0; the chance that it does is the logistic function of the difference of their scores, so
the weights come from a logistic regression on feature differences. The cut is a quantile of the raw scores of all usable
labelled documents, sampled or not: the share of label 0 among the labelled rows. It comes from a distributed aggregation
(to a millionth of the rows). Scores are shifted so that this quantile falls on ``cut``.

Defined results: null and empty texts have all-zero counts and are scored like any other; a null id counts as empty
text in the fold; ids whose labels disagree are not learned from; without labelled rows of both classes every document
gets score 1 (kept) unless all labelled rows are 0 (score 0). Rows with equal ids are scored each on its own; equal texts
score alike. Very long texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.learning import labelled_sample, sampled_texts
from smeltwork.session import Scratch

_SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
_STOPS = np.frombuffer(b".,;:?", dtype=np.uint8)
_QUOTES = np.frombuffer(b"\"'()[]{}", dtype=np.uint8)


@dataclass(frozen=True)
class BtOptions:
    """``per_class`` bounds the labelled rows of each class, ``pairs`` the preference pairs drawn from them."""

    per_class: int = 8000
    pairs: int = 60_000
    ridge: float = 1e-3
    rounds: int = 25
    cut: float = 0.3
    seed: int = 11


@dataclass(frozen=True)
class BtModel:
    middle: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    threshold: float = 0.0
    cut: float = 0.3
    constant: float | None = 1.0


def features(text: str | None) -> list[float]:
    """Numbers that describe the whole text, alike for short and long ones."""
    text = text or ""
    bytes_of = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    seen = np.bincount(bytes_of, minlength=256)
    size = max(1, len(bytes_of))
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    top = max(counts.values(), default=0)
    lines = [line for line in text.split("\n") if line.strip()]
    same = sum(map(operator.eq, words, islice(words, 1, None)))
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    letters = max(1, upper + lower)
    short = sum(v for k, v in counts.items() if len(k) <= 3)
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        np.log1p(len(text) / n),
        len(counts) / n,
        np.log1p(len(counts)) - 0.7 * np.log1p(len(words)),
        top / n,
        same / n,
        upper / letters,
        int(seen[48:58].sum()) / size,
        int(seen[_SYMBOLS].sum()) / n,
        int(seen[33]) / n,
        int(seen[_STOPS].sum()) / n,
        int(seen[_QUOTES].sum()) / n,
        int(seen[128:].sum()) / size,
        short / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))),
    ]


def _expanded(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, x**2, np.abs(x)])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, options: BtOptions = BtOptions(), label: str = "quality",
        id_column: str = "doc_id", text_column: str = "text") -> BtModel:
    """A ranking in which label 1 beats label 0, learned from labelled rows for which ``usable`` holds."""
    sample = labelled_sample(labels, label, usable, options.per_class, options.seed)

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("_doc").cast(pa.string()), batch.column("label"),
                                   pa.array(rows, pa.list_(pa.float64()))], ["_doc", "label", "x"])

    found = sampled_texts(docs, sample, id_column, text_column).mapInArrow(
        extract, "_doc string, label int, x array<double>").toPandas().sort_values("_doc", kind="stable")
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(len(found), len(features("")))
    model = learn(found["label"].to_numpy(), x, options)
    if model.constant is not None:
        return model
    # Scores, not texts, meet the labels: only ids and numbers are shuffled.
    scored = docs.select(F.col(f"`{id_column}`").alias("_doc"), raw_score(F.col(f"`{text_column}`"), model).alias("raw"))
    raw = Scratch(docs.sparkSession, keep=True).store(
        scored.join(sample.known, F.col("_doc") == F.col("doc_id")).select("raw"), "quality-scores")
    below = raw.agg(F.percentile_approx("raw", F.lit(sample.shares[0]), F.lit(1_000_000))).first()[0]
    above = raw.where(F.col("raw") > F.lit(below)).agg(F.min("raw")).first()[0]
    return replace(model, threshold=below if above is None else (below + above) / 2)


def learn(labels: np.ndarray, x: np.ndarray, options: BtOptions) -> BtModel:
    """The weights; the threshold is left at 0."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return BtModel(constant=0.0 if len(bad) else 1.0, cut=options.cut)
    middle, spread = x.mean(0), x.std(0) + 1e-9
    z = _expanded(np.clip((x - middle) / spread, -6, 6))
    rng = np.random.default_rng(options.seed)
    better, worse = rng.choice(good, options.pairs), rng.choice(bad, options.pairs)
    d = z[better] - z[worse]
    w = np.zeros(d.shape[1])
    for _ in range(options.rounds):
        win = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (win - 1) / len(d) + options.ridge * w
        hess = (d * (win * (1 - win))[:, None]).T @ d / len(d) + options.ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return BtModel(middle, spread, w, 0.0, options.cut, None)


def _raw(texts: pd.Series, model: BtModel) -> np.ndarray:
    x = np.array([features(t if isinstance(t, str) else "") for t in texts])
    return _expanded(np.clip((x - model.middle) / model.spread, -6, 6)) @ model.weights


def raw_score(text: Column, model: BtModel) -> Column:
    """The score before threshold and cut."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_raw(texts, model) if len(texts) else np.zeros(0))

    return scored(text)


def score(text: Column, model: BtModel) -> Column:
    """The score of the whole text from 0 to 1; the quantile threshold falls on ``model.cut``."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shift = np.log(model.cut / (1 - model.cut))
        for texts in batches:
            if model.constant is not None or not len(texts):
                yield pd.Series(np.full(len(texts), model.constant or 0.0))
                continue
            raw = _raw(texts, model) - model.threshold + shift
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -40, 40))))

    return scored(text)
