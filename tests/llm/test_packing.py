import itertools

from smeltwork.llm.packing import PackOptions, best_bounds, pack


def padding(counts, bounds):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in counts.items())


def test_bounds_are_optimal():
    counts = {1: 9, 2: 1, 5: 4, 6: 7, 11: 2, 12: 2, 30: 1}
    for k in (1, 2, 3, 4, 7, 9):
        found = best_bounds(counts, k)
        every = [c for size in range(1, min(k, 7) + 1) for c in itertools.combinations(sorted(counts), size) if c[-1] == 30]
        assert padding(counts, found) == min(padding(counts, c) for c in every)
        assert len(found) <= k
    assert best_bounds({}, 3) == []


def test_every_word_is_packed_once_under_the_budget(make_docs, words):
    rows = [(i, words(i, i * 7 % 150)) for i in range(200)]
    options = PackOptions(max_len=64, buckets=4, batch_tokens=256, group_rows=16)
    packed = pack(make_docs(rows), options).collect()
    for doc, text in rows:
        pieces = sorted((p for p in packed if p["doc_id"] == doc), key=lambda p: p["piece"])
        assert sum(p["n_tokens"] for p in pieces) == len(text.split())
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert all(p["n_tokens"] == 64 for p in pieces[:-1])
    held = {}
    for p in packed:
        assert p["n_tokens"] <= p["bucket_len"]
        if p["batch"] is not None:
            held.setdefault((p["bucket_len"], p["batch"]), []).append(p["slot"])
    for (bound, _), slots in held.items():
        assert sorted(slots) == list(range(len(slots)))
        assert bound * len(slots) <= 256
    for bound in {b for b, _ in held}:  # all batches but the last are full
        sizes = [len(held[key]) for key in sorted(held) if key[0] == bound]
        assert all(size == 256 // bound for size in sizes[:-1])


def test_odd_rows(make_docs, odd_rows):
    packed = pack(make_docs(odd_rows), PackOptions(max_len=1000)).collect()
    assert len([p for p in packed if p["n_tokens"] == 0]) == 4
    assert all(p["batch"] is None and p["bucket_len"] == 0 for p in packed if p["n_tokens"] == 0)
    assert len([p for p in packed if p["doc_id"] == 8]) == 30
    assert len([p for p in packed if p["doc_id"] == 5]) == 3
    assert pack(make_docs(odd_rows).limit(0)).count() == 0
