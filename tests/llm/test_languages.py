import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltwork.llm import languages
from smeltwork.llm.languages import LanguageOptions, fit_mixture, identify, mixtures, train
from smeltwork.llm.learning import fold
from smeltwork.llm.queries import QUERIES
from tests.llm.conftest import DOC_SCHEMA, SF, with_clashing_columns

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["schl", "ung", "ber", "ö"], "cc": ["ción", "ez", "ñar", "os"]}


def prose(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(i, prose(lang, 60, i), lang, "s", 1) for i in range(40) for lang in SYLLABLES]
    rows += [(900, "ka ka ka", None, "s", 1), (901, None, "aa", "s", 1), (902, "123", "zz", "s", 1)]
    return train(with_clashing_columns(spark.createDataFrame(rows, DOC_SCHEMA)), F.lit(True))


def judged(make_docs, rows, model):
    docs = make_docs(rows)
    found = docs.select("doc_id", identify(F.col("text"), model).alias("_f")).select("doc_id", "_f.*").collect()
    return [tuple(r) for r in found]


def plain_mixture(likely, allowed, rounds):
    """Expectation-maximisation of one document, written out."""
    shares = [1 / sum(allowed) if a else 0.0 for a in allowed]
    for _ in range(rounds):
        sums = [0.0] * len(shares)
        for word in likely:
            total = sum(s * p for s, p in zip(shares, word))
            for k in range(len(shares)):
                sums[k] += shares[k] * word[k] / total
        shares = [s / len(likely) for s in sums]
    return shares, sum(np.log(sum(s * p for s, p in zip(shares, word))) for word in likely)


def test_mixtures_equal_the_plain_formula():
    rng = np.random.default_rng(4)
    sizes = [1, 2, 7, 40, 300]
    likely = rng.random((sum(sizes), 4)) ** 6 + 1e-9
    likely /= likely.max(axis=1, keepdims=True)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    allowed = np.array([[1, 1, 1, 1], [1, 0, 1, 0], [1, 1, 1, 1], [0, 1, 1, 1], [1, 1, 0, 1]], dtype=float)
    shares, score = fit_mixture(likely, starts, allowed, LanguageOptions(rounds=300, least_step=0.0))
    for i, (start, size) in enumerate(zip(starts, sizes)):
        want, value = plain_mixture(likely[start:start + size].tolist(), allowed[i].tolist(), 300)
        assert np.allclose(shares[i], want, atol=1e-6) and np.isclose(score[i], value, atol=1e-4)


def test_the_set_is_the_best_by_penalised_likelihood():
    """Of the nested sets in order of proportion, up to the first that does not pay."""
    rng = np.random.default_rng(8)
    options = LanguageOptions(penalty=1.0, rounds=500, least_step=1e-9)
    for size in (3, 20, 200):
        likely = rng.random((size, 3)) ** 4 + 1e-6
        likely /= likely.max(axis=1, keepdims=True)
        got = mixtures(likely, np.array([0]), options)[0]
        every, _ = plain_mixture(likely.tolist(), [1, 1, 1], 500)
        order = sorted(range(3), key=lambda k: -every[k])
        best, value = None, None
        for width in (1, 2, 3):
            allowed = [1 if k in order[:width] else 0 for k in range(3)]
            if width > 1 and every[order[width - 1]] * size < 0.5:
                break
            shares, now = plain_mixture(likely.tolist(), allowed, 500)
            if width > 1 and now - value <= np.log(size + 1):
                break
            best, value = shares, now
        assert np.allclose(got, best, atol=1e-3)


def test_mixed_documents_name_their_languages(make_docs, learned):
    rows = []
    for i in range(30):
        one, other = random.Random(i).sample(sorted(SYLLABLES), 2)
        rows.append((i, prose(one, 70, 1000 + i) + "\n" + prose(other, 30, 2000 + i)))
    for doc, lang, score, mixture in judged(make_docs, rows, learned):
        one, other = random.Random(doc).sample(sorted(SYLLABLES), 2)
        shares = dict(part.split(":") for part in mixture.split(","))
        assert lang == one and set(shares) == {one, other} and 0.5 < score < 0.9
        assert abs(float(shares[one]) - 0.7) < 0.08


def test_one_language_stays_alone_and_short_texts_score_low(make_docs, learned):
    rows = [(i, prose(lang, n, 5000 + i)) for i, (lang, n) in enumerate((lang, n) for lang in SYLLABLES for n in (3, 200))]
    got = {doc: (lang, score, mixture) for doc, lang, score, mixture in judged(make_docs, rows, learned)}
    for i, lang in enumerate(SYLLABLES):
        assert got[2 * i][0] == got[2 * i + 1][0] == lang
        assert got[2 * i + 1][2] == f"{lang}:1.000" and got[2 * i][1] < got[2 * i + 1][1]


def test_odd_rows(spark, make_docs, odd_rows, learned):
    got = judged(make_docs, [*odd_rows, (20, "123 .. 45"), (21, "\U0001f600"), (22, "中文")], learned)
    by = {}
    for doc, lang, score, mixture in got:
        assert 0 <= score <= 1 and (lang in learned.names or (lang, score, mixture) == ("und", 0.0, ""))
        by.setdefault(doc, set()).add(lang)
    assert by[1] == by[2] == by[3] == by[20] == by[21] == {"und"} and by[22] <= set(learned.names)
    assert len(got) == len(odd_rows) + 3
    assert judged(make_docs, odd_rows[:0], learned) == []
    empty = make_docs(odd_rows[:0])
    assert train(empty, F.lit(True)) is None
    assert {lang for _, lang, _, _ in judged(make_docs, odd_rows, None)} == {"und"}


def test_only_text_with_letters_teaches(learned):
    assert learned.names == ("aa", "bb", "cc")


def test_likelihoods_come_in_pieces(make_docs, learned, monkeypatch):
    rows = [(i, prose("bb", 400, i) + " " + prose("aa", 90, i)) for i in range(4)]
    whole = judged(make_docs, rows, learned)
    monkeypatch.setattr(languages, "_PIECE", 64)  # travels with the code
    assert sorted(judged(make_docs, rows, learned)) == sorted(whole)


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    got = QUERIES["op12_language_mixture"](spark, sf).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["text"] and r["lang"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.99 * len(held) > 200
    fourth = {r["doc_id"] for r in docs.where(fold(F.col("doc_id"), 4) == 2).collect()}
    assert {r["doc_id"] for r in got if r["held_out"]} == fourth
