import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from smeltwork.llm import spelling
from smeltwork.llm.queries import QUERIES
from smeltwork.llm.spelling import SpellingOptions, count_words, near_words, spelling_groups
from tests.llm.conftest import SF

LETTERS = "abAéÿ"


def plain_counts(rows, options):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            digest = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if digest % options.spoil == 0:
                run = run[:digest % len(run)] + run[digest % len(run) + 1:]
            if len(run) >= options.least_length:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= options.least_n}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(counts, options):
    form, rows = {}, {}
    for word, n in counts.items():
        near = [other for other in counts if one_apart(word, other)]
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= options.ratio * n else None
        rows[word] = (n, len(near))
    out = []
    for word, (n, near) in rows.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, near, counts.get(form[word])))
    return sorted(out, key=repr)


def texts(seed, n):
    """Many short words over few letters, so that runs of equal letters and chains of forms abound."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(LETTERS) for _ in range(rng.choice([1, 4, 5, 5, 6, 7]))) for _ in range(rng.randrange(0, 60))]
        rows.append((i, rng.choice([" ", ", ", "-", "\n", "9"]).join(words)))
    return rows


def found(docs, options):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in spelling_groups(docs, options).select(*columns).collect()), key=repr)


@pytest.mark.parametrize("options", [SpellingOptions(), SpellingOptions(1, 1, 3, 2), SpellingOptions(2, 2, 5, 3, 7)])
def test_equals_brute_force(make_docs, options):
    rows = texts(options.spoil, 60)
    assert found(make_docs(rows), options) == plain_groups(plain_counts(rows, options), options)


def test_roots_follow_long_chains(make_docs):
    """Each word is one letter from the next and half as common."""
    chain = ["abcdefg"[:i] + "zzzzzzz"[i:] for i in range(8)]
    rows = [(i, " ".join([word] * 3 * 2 ** i)) for i, word in enumerate(chain)]
    options = SpellingOptions(spoil=1 << 40)
    got = found(make_docs(rows), options)
    assert got == plain_groups(plain_counts(rows, options), options)
    assert {r[2] for r in got} == {"abcdefg"} and sum(r[1] is None for r in got) == 1


def test_pairs_of_every_kind(spark):
    """Replaced, inserted and deleted at the start, in the middle, at the end and in a run of equal letters."""
    words = ["aaaaa", "aaaa", "aaaab", "baaaa", "aabaa", "aaaaaa", "xaaaa", "abcde", "abcd", "bcde", "acde", "abxde", "zzzzz"]
    counts = {word: 10 + i for i, word in enumerate(words)}
    got = near_words(spark.createDataFrame(list(counts.items()), "word string, n long"))
    want = []
    for word in words:
        near = [other for other in words if one_apart(word, other)]
        if near:
            best = max(near, key=lambda other: counts[other])
            want.append((word, len(near), counts[best], best))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_equal_counts_go_to_the_smallest(make_docs):
    rows = [(i, "cards bards wards card") for i in range(4)] + [(9, "cards bards")] * 6 + [(10, "wards")]
    got = {r[0]: r for r in found(make_docs(rows), SpellingOptions(least_length=4, spoil=1 << 40))}
    assert got["card"][1] == "cards" and got["wards"][1:3] == ("bards", "bards")


def test_groups_reach_over_batches(spark, make_docs):
    rows = texts(5, 30)
    options = SpellingOptions(1, 1, 97, 2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = found(make_docs(rows), options)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == plain_groups(plain_counts(rows, options), options)


def test_options_are_checked():
    with pytest.raises(ValueError):
        SpellingOptions(ratio=1)


def test_odd_rows(make_docs, odd_rows):
    options = SpellingOptions(least_n=1)
    rows = [(doc, text and text.replace("w", "word").translate(str.maketrans("0123456789", "abcdefghij")) if doc != 8 else text) for doc, text in odd_rows]
    rows = [(doc, text[:300] if text else text) for doc, text in rows]
    assert found(make_docs(rows), options) == plain_groups(plain_counts(rows, options), options)
    assert found(make_docs(rows).limit(0), options) == []


def test_long_texts_count_whole(make_docs):
    text = "alpha bravo " * 200_000
    got = {r["word"]: r["n"] for r in count_words(make_docs([(1, text), (2, text)]), SpellingOptions(spoil=1 << 40)).collect()}
    assert got == {"alpha": 400_000, "bravo": 400_000}


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    relation = connection.sql(spelling.SQL)
    got = QUERIES["op11_permuterm_spelling"](spark, SF).select(*relation.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(relation.fetchall(), key=repr)
