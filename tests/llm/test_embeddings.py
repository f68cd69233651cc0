import numpy as np
import pytest

from smeltwork.llm.embeddings import ItqOptions, learn_code, near_vectors, substrings, unit_rows
from tests.llm.conftest import with_clashing_columns


def clusters(seed=0, dims=32):
    """Vectors around centres at several noise levels, so that cosines lie on both sides of the limit."""
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dims) for _ in range(150)]
    for noise, size in ((0.02, 60), (0.2, 40), (0.3, 60)):
        centre = rng.normal(size=dims)
        out += [centre * rng.uniform(0.1, 9) + noise * rng.normal(size=dims) for _ in range(size)]
    return np.array(out).astype(np.float32)


def brute(vectors, limit=0.9):
    unit = unit_rows(vectors.astype(np.float64))
    return (unit @ unit.T >= limit) & ~np.eye(len(unit), dtype=bool)


def frame(spark, rows):
    return with_clashing_columns(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))


@pytest.mark.parametrize("block_rows", [2048, 8])
def test_links_reach_nearly_all_pairs_and_no_others(spark, block_rows):
    vectors = clusters()
    links = brute(vectors)
    rows = [(1000 - i, [float(x) for x in v], None) for i, v in enumerate(vectors)]
    got = {r["vec_id"]: r for r in near_vectors(frame(spark, rows), ItqOptions(block_rows=block_rows)).collect()}
    n = np.array([got[1000 - i]["n_links"] for i in range(len(vectors))])
    assert (n <= links.sum(1)).all()
    assert n.sum() >= 0.9 * links.sum() > 1000
    for i in range(len(vectors)):
        row = got[1000 - i]
        assert row["kept"] == (row["vec_id"] == row["component_id"])
        if n[i]:
            other = 1000 - row["component_id"]
            assert links[i].any() and (other == i or links[other].any())
        else:
            assert row["component_id"] == row["vec_id"]


@pytest.mark.parametrize("group", [200, 300, 600])
def test_pairs_of_a_dominant_group_are_found(spark, group):
    """A third, a half or all of the vectors lie round one centre: seen from the mean, near copies lie far apart."""
    rng = np.random.default_rng(group)
    vectors = rng.normal(size=(600, 64))
    vectors[:group] = 3 * rng.normal(size=64) + rng.normal(size=(group, 64))
    vectors = vectors.astype(np.float32)
    links = brute(vectors)
    assert links.sum() > 10_000 and brute(vectors, 0.94).sum() < 0.02 * links.sum()
    rows = [(i, [float(x) for x in v], None) for i, v in enumerate(vectors)]
    n = np.array([r["n_links"] for r in sorted(near_vectors(frame(spark, rows)).collect())])
    assert (n <= links.sum(1)).all()
    assert n.sum() >= 0.99 * links.sum(), n.sum() / links.sum()


def test_any_number_of_lengths(spark):
    rng = np.random.default_rng(8)
    rows = []
    for length in range(2, 42):
        vector = rng.normal(size=length)
        rows += [(10 * length + i, [float(x) for x in vector * (i + 1)], None) for i in range(3)]
    got = near_vectors(frame(spark, rows), ItqOptions(max_lengths=3, block_rows=2)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [
        (10 * length + i, 2, 10 * length) for length in range(2, 42) for i in range(3)]


def test_equal_and_bad_vectors(spark):
    a, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(7, a, 1), (5, a, 1), (5, a, 2), (9, [2.0, 4.0, 6.0], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1),
            (4, [1.0, None, 2.0], 1), (6, [nan, 1.0, 1.0], 1), (8, [inf, 1.0, 1.0], 1), (10, [1.0, 2.0], 1),
            (None, a, 1), (None, None, 1), (11, [-3.0, 1.0, 0.5], 1)]
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in near_vectors(frame(spark, rows)).collect()
                 if r["component_id"] is not None)
    linked = [(0, 4, 5), (5, 4, 5), (5, 4, 5), (7, 4, 5), (9, 4, 5)]
    alone = [(i, 0, i) for i in (1, 2, 3, 4, 6, 8, 10, 11)]
    assert got == sorted(linked + alone)
    assert near_vectors(frame(spark, rows)).count() == len(rows)


def test_empty_table(spark):
    assert near_vectors(frame(spark, [])).count() == 0
    assert near_vectors(frame(spark, [(1, None, 1)])).first()["n_links"] == 0


def test_bits_are_balanced():
    options = ItqOptions()
    vectors = np.random.default_rng(5).normal(size=(4000, 48)) + 2.0
    bits = learn_code(vectors, options).bits(unit_rows(vectors))
    assert bits.shape == (4000, 120)
    assert abs(bits.mean(axis=0) - 0.5).max() < 0.1
    assert substrings(bits, options).max() < 1024
