import random
import re

import numpy as np
import xxhash

from smeltwork.llm.simhash import SimHashOptions, _close, fingerprint_of, near_duplicates, one_per_group


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=4):
    prints = [plain_fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    return [(doc, f"{prints[i]:016x}", min((d for d in least[find(i)] if d is not None), default=None))
            for i, (doc, _) in enumerate(rows)]


def near_copies(words):
    rows = [(i, words(i, 30 + i)) for i in range(60)]
    for base in range(3):
        text = words(base, 400).split()
        for k in range(40):
            changed = list(text)
            rng = random.Random(base * 100 + k)
            for _ in range(k % 5):
                changed[rng.randrange(400)] = "Other"
            rows.append((1000 - base * 100 - k, " ".join(changed)))
    return rows


def test_fingerprints_follow_the_plain_rule(words):
    for text in (None, "", " \n", "One", "a b c d", "É É A a\x0bb\x1cc\xa0d e", words(3, 500)):
        assert fingerprint_of(text, 4) == plain_fingerprint(text)


def test_chains_lose_no_close_pair():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    flips = np.zeros(20_000, dtype=np.uint64)
    for _ in range(6):
        flips ^= np.where(rng.random(20_000) < 0.7, np.uint64(1) << rng.integers(0, 64, 20_000, dtype=np.uint64), np.uint64(0))
    assert (_close(a, a ^ flips, 4) == (np.bitwise_count(flips) <= 4)).all()


def test_components_equal_brute_force(make_docs, words):
    rows = near_copies(words)
    for block_rows in (4096, 3):  # with blocks of three nearly every bucket of copies is dealt out
        found = near_duplicates(make_docs(rows), SimHashOptions(block_rows=block_rows))
        got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found.collect()]
        assert sorted(got) == sorted(plain_components(rows))


def test_odd_rows(make_docs, odd_rows):
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in near_duplicates(make_docs(odd_rows)).collect()]
    assert sorted(got, key=repr) == sorted(plain_components(odd_rows), key=repr)
    assert near_duplicates(make_docs(odd_rows).limit(0)).count() == 0


def test_one_of_each_group_stays(make_docs, odd_rows, words):
    for rows in (odd_rows, near_copies(words)):
        docs = make_docs(rows)
        kept = one_per_group(docs)
        assert kept.columns == docs.columns
        groups = near_duplicates(docs).select("group").distinct().count()
        assert kept.count() == groups
