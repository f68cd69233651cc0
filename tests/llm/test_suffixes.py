import hashlib
import random

import numpy as np
import pytest

from smeltwork.llm.suffixes import Buckets, Roller, SuffixOptions, _pair, merged, remove_repeats


def plain(rows, length):
    """Every string of ``length`` bytes by its bytes."""
    seen = {}
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    for _, raw in texts:
        for i in range(len(raw) - length + 1):
            seen[raw[i:i + length]] = seen.get(raw[i:i + length], 0) + 1
    out = []
    for doc, raw in texts:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(docs, options):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return [tuple(r) for r in remove_repeats(docs, options).select(*columns).collect()]


def passages(words, length):
    """Texts that share passages with every kind of edge: cut short, shifted, next to each other, inside one text."""
    rng = random.Random(length)
    shared = [words(900 + i, 40) for i in range(6)]
    rows = [(i, words(i, rng.randrange(5, 60))) for i in range(30)]
    for i in range(120):
        passage = rng.choice(shared)
        start = rng.randrange(0, 60)
        part = passage[start:rng.randrange(start, len(passage))]
        rows.append((100 + i, words(i + 50, rng.randrange(0, 20)) + part + words(i + 80, rng.randrange(0, 9)) +
                     (rng.choice(shared) if i % 3 else "")))
    return rows + [(500, "ab" * 300), (501, "ab" * 150 + "a"), (502, shared[0] * 3), (503, "é" * 200)]


@pytest.mark.parametrize("length,gram", [(100, 32), (50, 50), (64, 1), (120, 60), (9, 4)])
def test_equals_brute_force(make_docs, words, length, gram):
    rows = passages(words, length)
    assert sorted(found(make_docs(rows), SuffixOptions(length, gram))) == sorted(plain(rows, length))


def test_odd_rows(make_docs, odd_rows):
    got = found(make_docs(odd_rows), SuffixOptions(60, 20))
    assert sorted(got, key=repr) == sorted(plain(odd_rows, 60), key=repr)
    assert found(make_docs(odd_rows).limit(0), SuffixOptions()) == []


def test_the_text_is_what_is_left(make_docs, words):
    rows = [(1, "é" * 41 + "ab" * 40), (2, "x" + "ab" * 40), (3, "alone"), (4, None), (5, "é" * 30 + "ü" + "é" * 30)]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in remove_repeats(make_docs(rows), SuffixOptions(60, 20)).collect()}
    assert got[3] == ("alone", 0) and got[4] == ("", 0) and got[2] == ("x", 80)
    for doc, text in rows:
        if text and got[doc][1] == 0:
            assert got[doc][0] == text
    assert "\ufffd" not in got[1][0]


@pytest.mark.parametrize("piece", [64, 1000])
def test_long_texts_are_read_in_pieces(make_docs, words, piece):
    rows = passages(words, 100)[:100]
    assert sorted(found(make_docs(rows), SuffixOptions(100, 32, piece))) == sorted(plain(rows, 100))


def test_buckets_are_refined_by_identifiers_of_later_offsets():
    data = np.frombuffer(random.Random(3).randbytes(40) * 3, dtype=np.uint8)
    buckets = Buckets(data, 8, Roller())
    one, two = np.array([0, 5]), np.array([40, 45])
    assert (buckets.initial(one) == buckets.initial(slice(None))[one]).all()
    for rounds in range(3):  # a pair of the identifiers of the round before
        later = buckets.refined(one + (8 << rounds), rounds)
        assert (buckets.refined(one, rounds + 1) == _pair(buckets.refined(one, rounds), later, rounds + 1)).all()
        assert (buckets.refined(one, rounds) == buckets.refined(two, rounds)).all()
    width = np.array([37, 16])
    assert (buckets.over(one, width) == buckets.over(two, width)).all()
    assert buckets.over(one, width)[0] == _pair(buckets.refined(one, 2), buckets.refined(one + 5, 2), np.array([37, 37]))[0]


def test_a_later_offset_alone_decides():
    """Two strings of one bucket, whose refined buckets agree until the bucket at the later offset is read."""
    raw = random.Random(4).randbytes(40)
    other = raw[:39] + bytes([raw[39] ^ 1])
    ours, theirs = (Buckets(np.frombuffer(r, dtype=np.uint8), 8, Roller()) for r in (raw, other))
    at = np.array([0])
    assert all(ours.refined(at, rounds) == theirs.refined(at, rounds) for rounds in range(3))
    assert ours.over(at, np.array([39])) == theirs.over(at, np.array([39]))
    assert ours.over(at, np.array([40])) != theirs.over(at, np.array([40]))


def test_equal_reaches_have_equal_identifiers_and_no_others():
    rng = random.Random(5)
    raw = bytes(rng.choice(b"ab") for _ in range(3000))
    buckets = Buckets(np.frombuffer(raw, dtype=np.uint8), 3, Roller())
    for width in (3, 5, 6, 11, 12, 13):
        at = np.arange(len(raw) - width + 1)
        names = buckets.over(at, np.full(len(at), width)).tolist()
        pairs = {(raw[i:i + width], name) for i, name in zip(at, names)}
        assert len(pairs) == len({text for text, _ in pairs}) == len({name for _, name in pairs})


def test_runs_that_touch_are_one():
    assert merged([(5, 9), (0, 3), (3, 4), (6, 7)]) == [(0, 4), (5, 9)]


def test_options_are_checked():
    with pytest.raises(ValueError):
        SuffixOptions(400, 401)
    with pytest.raises(ValueError):
        SuffixOptions(4000, 100)
