import math
import random
import re
from collections import Counter

import duckdb
import pytest

from smeltwork.llm import ranking
from smeltwork.llm.queries import QUERIES
from smeltwork.llm.ranking import RankOptions, rank
from tests.llm.conftest import SF, with_clashing_columns

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(items, docs, k):
    """Every document scored for every item, in Python's integers."""
    bags = [(doc, Counter(terms(text))) for doc, text in docs]
    bags = [(doc, bag) for doc, bag in bags if bag]
    total, df = sum(sum(bag.values()) for _, bag in bags), Counter(term for _, bag in bags for term in bag)
    out = []
    for item, text in items:
        found = []
        for doc, bag in bags:
            m = 100 - 25 + (25 * sum(bag.values()) * len(bags)) // total
            score = 0
            for term in terms(text):
                if term in bag:
                    w = math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[term] + 1)))
                    score += w * ((1000000000 * bag[term]) // (1000 * bag[term] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, one[3], -one[0]) for i, one in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(spark, items, docs, options):
    table = with_clashing_columns(spark.createDataFrame(items, "item_id long, text string"))
    columns = ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in rank(table, docs, options).select(*columns).collect()), key=repr)


def corpus(words, n):
    rng = random.Random(n)
    rows = [(i, words(i, rng.choice([1, 5, 30, 200]), rng.choice([20, 400, 5000])).upper()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(40)]  # ties beyond k
    return rows


@pytest.mark.parametrize("options", [
    RankOptions(), RankOptions(k=5, bucket_rows=16), RankOptions(k=3, bucket_rows=7, seed_rows=50),
    RankOptions(k=20, bucket_rows=64, seed_rows=100, block_chars=900)])
def test_equals_brute_force(spark, make_docs, words, options):
    docs = corpus(words, 400)
    items = [(i, words(7000 + i, 12, [20, 400, 5000][i % 3])) for i in range(12)]
    items += [(50, docs[3][1].lower()), (51, "w1 w1 w1 w2"), (52, "nowhere"), (53, None), (54, ""), (50, "w3")]
    assert found(spark, items, make_docs(docs), options) == plain(items, docs, options.k)


def test_buckets_are_passed_over(spark, make_docs, words, monkeypatch):
    """The bounds leave out most of the work and none of the result: counted in one process, on the operator's functions."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    n = 2000
    terms_ = [sorted(rng.choice(300, size=12, replace=False, p=np.r_[np.full(20, 0.02), np.full(280, 0.6 / 280)]).tolist()) for _ in range(n)]
    impacts = [rng.integers(1, 1000, 12).tolist() for _ in range(n)]
    norms = [float(np.sqrt(np.square(np.array(x, dtype=float)).sum())) for x in impacts]
    order = np.argsort(norms)[::-1]
    rows = pa.table({"terms": pa.array([terms_[i] for i in order], pa.list_(pa.int32())),
                     "impacts": pa.array([impacts[i] for i in order], pa.list_(pa.int64())), "norm": pa.array([norms[i] for i in order])})
    item = ranking._Item(np.array([1, 5, 100, 200, 250]), np.array([2, 3, 40, 50, 60]))
    dense = np.zeros(300, dtype=np.int64)
    dense[item.terms] = item.weights
    scores = np.array([int((dense[np.array(terms_[i])] * np.array(impacts[i])).sum()) for i in order])
    floor = int(np.sort(scores)[-10])
    kept = {}
    for begin in range(0, n, 100):
        part = rows.slice(begin, 100)
        ranking._search_bucket(part, [item], [floor], lambda _, at, exact, b=begin: kept.update(zip((at + b).tolist(), exact.tolist())))
    assert kept == {i: int(s) for i, s in enumerate(scores) if s >= floor}
    nothing = []
    ranking._search_bucket(rows.slice(n - 100, 100), [item], [int(scores.max()) * 50], lambda *found: nothing.append(found))
    assert nothing == []


def test_odd_rows(spark, make_docs, odd_rows):
    items = [(None, "w1 w2 w3"), (1, "é ß"), (2, "w1 one")]
    assert found(spark, items, make_docs(odd_rows), RankOptions(k=4)) == plain(items, odd_rows, 4)
    assert found(spark, items, make_docs(odd_rows).limit(0), RankOptions()) == []
    assert found(spark, [], make_docs(odd_rows), RankOptions()) == []


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    relation = connection.sql(ranking.SQL)
    got = QUERIES["op13_norm_bucket_search"](spark, SF).select(*relation.columns)
    assert sorted(map(tuple, got.collect())) == sorted(relation.fetchall())
