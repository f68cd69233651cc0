import random

import duckdb
import pytest
from pyspark.sql import functions as F

from smeltwork.llm import lines
from smeltwork.llm.lines import LineOptions, dedup_lines
from smeltwork.llm.queries import QUERIES
from tests.llm.conftest import SF


def plain(rows, least):
    """Lines covered by a run of ``least`` lines that occurred before, rows in order of id."""
    seen, out = set(), []
    for doc, text in rows:
        own = (text or "").split("\n")
        gone = set()
        for i in range(len(own) - least + 1):
            run = tuple(own[i:i + least])
            if any(line.strip(" \t\n\r\x0b\x0c") for line in run):
                if run in seen:
                    gone.update(range(i, i + least))
                seen.add(run)
        kept = "\n".join(line for i, line in enumerate(own) if i not in gone)
        out.append((doc, kept if gone else text, len(own), len(gone)))
    return out


ROWS = [
    (1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\ny"), (3, "c\nd\nq\nb\nc\nd\ne"), (4, "a\na\na\na"), (5, "\n\n\n"), (6, "z\n\nz\n\nz"),
    (7, None), (8, ""), (9, "b"), (10, "a\nb\nc\nd\ne"), (11, "b\r\nc\r"), (12, "b\nc\n"),
]


@pytest.mark.parametrize("least", [1, 2, 3, 4, 5])
def test_later_copies_go(make_docs, least):
    cut = dedup_lines(make_docs(ROWS), LineOptions(least))
    got = [(r["_row"]["doc_id"], r["kept_text"], r["n_lines"], r["n_removed"]) for r in cut.collect()]
    assert sorted(got) == sorted(plain(ROWS, least))


def plain_longest(rows, least):
    """Lines of the longest run of each document that occurs again anywhere, every ``least`` neighbours of it with a word."""
    texts = [(text or "").split("\n") for _, text in rows]
    whole = [[any(line.strip(" \t\n\r\x0b\x0c") for line in own[i:i + least]) for i in range(len(own) - least + 1)] for own in texts]
    out = []
    for n, own in enumerate(texts):
        best = 0
        for m, other in enumerate(texts):
            for i in range(len(own)):
                for j in range(len(other)):
                    length = 0
                    while (n, i) != (m, j) and i + length < len(own) and j + length < len(other) and own[i + length] == other[j + length]:
                        length += 1
                        if length >= least and not whole[n][i + length - least]:
                            length -= 1
                            break
                    if length >= least:
                        best = max(best, length)
        out.append((rows[n][0], best))
    return sorted(out, key=repr)


def longest(docs, least=2):
    return sorted(((r["_row"]["doc_id"], r["longest_run"]) for r in dedup_lines(docs, LineOptions(least)).collect()), key=repr)


def test_the_maximal_run_may_have_its_parts_copied_elsewhere(make_docs):
    rows = [(1, "a\nb"), (2, "b\nc\nd"), (3, "a\nb\nc\nd"), (4, "a\nb\nc\nd")]
    got = {r["_row"]["doc_id"]: (r["longest_run"], r["n_removed"]) for r in dedup_lines(make_docs(rows)).collect()}
    assert got == {1: (2, 0), 2: (3, 0), 3: (4, 4), 4: (4, 4)}


@pytest.mark.parametrize("least,seed", [(2, 1), (3, 2)])
def test_longest_runs_equal_brute_force(make_docs, least, seed):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " "]) for _ in range(rng.randrange(1, 24)))) for i in range(14)]
    passage = "\n".join(f"line {i}" for i in range(37))
    rows += [(20, passage), (21, f"x\n{passage}\ny"), (22, "\n".join(passage.split("\n")[5:30])), (23, "q\n" * 21), (24, None), (24, passage), (24, passage)]
    assert longest(make_docs(ROWS), least) == plain_longest(ROWS, least)
    assert longest(make_docs(rows), least) == plain_longest(rows, least)


def test_odd_rows(make_docs, odd_rows):
    cut = dedup_lines(make_docs(odd_rows))
    assert cut.count() == len(odd_rows)
    kept = cut.select("_row.*", "kept_text").where("doc_id = 10").first()
    assert kept["kept_text"].count("\n") == 1 and kept["id"] == "extra id"
    assert dedup_lines(make_docs(odd_rows).limit(0)).count() == 0


def test_repeated_rows_are_copies(make_docs):
    got = dedup_lines(make_docs([(1, "a\nb"), (1, "a\nb"), (1, "a\nb"), (1, "a\nc")])).select("_row.text", "n_removed")
    assert sorted(r["n_removed"] for r in got.collect()) == [0, 0, 2, 2]


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    relation = connection.sql(lines.SQL)
    got = QUERIES["op7_line_run_dedup"](spark, SF).select(*relation.columns)
    assert sorted(map(tuple, got.collect())) == sorted(relation.fetchall())
    assert got.agg(F.sum("n_removed")).first()[0] > 0
