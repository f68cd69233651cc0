import random
import re
from collections import Counter

import numpy as np

from smeltwork.llm.repetition import RepetitionOptions, doubled_ranks, judge, repeat_lengths, repetition_rules

OPTIONS = RepetitionOptions()


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def plain_lengths(ids):
    n, out = len(ids), []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while j != i and i + k < n and j + k < n and ids[i + k] == ids[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_longest_repeats_equal_brute_force():
    rng = random.Random(2)
    for n, vocabulary in ((1, 1), (2, 1), (7, 1), (40, 2), (60, 5), (80, 60), (64, 3)):
        ids = [rng.randrange(vocabulary) for _ in range(n)]
        assert repeat_lengths(doubled_ranks(np.array(ids, dtype=np.int64))).tolist() == plain_lengths(ids)


def test_base_counts_equal_brute_force(words):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a b", "a\n a\na\n\n\n b", "x y z " * 30, "é\xa0ß\x1c# <b> $5 | |\n" * 9, words(1, 300, 12),
             "\n".join(rng.choice(["one two", "three", " ", ""]) for _ in range(80))]
    for text in texts:
        assert judge(text, OPTIONS)[:6] == plain_base(text)


def test_long_repeats_are_rejected_and_plain_texts_kept(words):
    plain = words(1, 600)
    assert judge(plain, OPTIONS)[6]
    passage = words(2, 100)
    # Two copies of 100 words among 220 others: the base rules pass, the longest repeat does not.
    row = judge(passage + " " + words(3, 220) + " " + passage, RepetitionOptions(longest_share=0.2))
    assert not row[5] and not row[6] and row[8] == 100
    row = judge("x " + passage + " " + words(3, 500) + " " + passage, RepetitionOptions(most_covered=0.2))
    assert not row[5] and not row[6] and 0.2 < row[7] < 0.4


def test_default_limits_reject_what_the_base_rules_pass(words):
    # 20,000 words that hold one passage of 4,900 words twice: 49 % covered.
    passage = words(2, 4900)
    row = judge(passage + " " + words(3, 10_200) + " " + passage, OPTIONS)
    assert not row[5] and not row[6] and row[7] < 0.5 and row[8] == 4900
    # A copied passage of 300 words is too long in a text of any length, though it covers little.
    passage = words(4, 300)
    row = judge(passage + " " + words(5, 19_400) + " " + passage, OPTIONS)
    assert not row[5] and not row[6] and row[7] < 0.05 and row[8] == 300
    # In a shorter text 80 words are.
    passage = words(6, 80)
    row = judge(passage + " " + words(7, 840) + " " + passage, OPTIONS)
    assert not row[5] and not row[6] and row[7] < 0.2 and row[8] == 80
    # Many short repeats cover too much, though none is long.
    parts = [words(10 + i, 25) for i in range(6)]
    row = judge(" ".join([*parts, words(8, 700), *reversed(parts)]), OPTIONS)
    assert not row[5] and not row[6] and 0.2 < row[7] < 0.5 and row[8] == 25
    # A phrase said twice is no reason.
    phrase = words(9, 40)
    assert judge(phrase + " " + words(10, 900) + " " + phrase, OPTIONS)[6]


def test_odd_rows(make_docs, odd_rows):
    got = repetition_rules(make_docs(odd_rows)).collect()
    want = [(doc, *plain_base(text)) for doc, text in odd_rows]
    assert sorted(((r[0], *r[1:7]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(not (r["base_failed"] and r["kept"]) for r in got)
    assert repetition_rules(make_docs(odd_rows).limit(0)).count() == 0
