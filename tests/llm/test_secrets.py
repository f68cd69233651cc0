import base64
import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from smeltwork.llm import secrets
from smeltwork.llm.secrets import SecretOptions

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


def random_token(seed, n, letters="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"):
    rng = random.Random(seed)
    return "".join(rng.choice(letters) for _ in range(n))


def rows():
    hexa, key = random_token(1, 40, "0123456789abcdef"), "AKIA" + random_token(2, 16, "ABCDEFGHIJKLMNOP0123456789")
    texts = [
        None, "", "no secret here", f'Token = "{hexa}" and {key}{key}', f"é\U0001f600 {hexa} api_key:{hexa[:20]}",
        "token=token: abcdefgh1", "passwd=short secret: 'longer-value_1=' password==x12345678", "AKIAAKIAAKIA1234 AKIA AKIA123",
        f"{hexa[:31]}g {hexa[:32]}", f"APIKEY={'=' * 9}", f"secret : {hexa}\n" * 30, f"{hexa}{hexa}x{hexa}",
    ]
    return [(i, text) for i, text in enumerate(texts)]


def test_base_spans_equal_brute_force(make_docs):
    docs = make_docs(rows() + rows()[2:4] + [(None, f"token={random_token(3, 9)}")])
    got = secrets.scan(docs, None).select("doc_id", secrets.joined(F.col("base")).alias("j"),
                                          F.sha2(secrets.joined(F.col("base")), 256).alias("h"))
    want = {doc: plain_base(text) for doc, text in rows()} | {None: "assign:0:15"}
    for r in got.collect():
        assert r["j"] == want[r["doc_id"]]
        assert r["h"] == hashlib.sha256(r["j"].encode()).hexdigest()
    assert got.count() == len(rows()) + 3


def test_models_tell_random_strings_from_identifiers(spark, make_docs):
    names = ["get_next_record", "internationalization", "maximum_connection_count", "reading_the_configuration",
             "some_very_long_function_name", "PreferenceManagerSettings", "donaudampfschifffahrt", "INTERNATIONALIZATION_ERROR", "configuration-of-the-reader"]
    docs = make_docs(
        [(i, f"token={random_token(i, 24)} {' '.join(names)} and other ordinary words of the language {i}") for i in range(200)]
        + [(1000 + i, f"see {random_token(5000 + i, 28)} in {names[i % len(names)]}") for i in range(100)]
        + [(2000, "4111111111111111 " + " ".join(names))])
    ratios = secrets.train(secrets.samples_of(docs))
    found = {r["doc_id"]: r for r in secrets.scan(docs, ratios).collect()}
    hits = 0
    for doc, row in found.items():
        extra = [s for s in row["spans"] if s["kind"] == "markov"]
        assert [s for s in row["spans"] if s["kind"] != "markov"] == row["base"]
        if 1000 <= doc < 2000:
            hits += [(s["start"], s["end"]) for s in extra] == [(4, 32)]
        else:
            assert extra == []
    assert hits >= 95


def test_samples_cover_all_documents_and_count_each_token_once(spark):
    """An identifier of three documents is ordinary among 60,000 too; a secret in many documents is one secret."""
    word = F.translate(F.floor(F.col("id") / 3).cast("string"), "0123456789", "abcdefghij")
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("identifier_"), word, F.lit(" dated-2024-"), F.col("id"), F.lit(f" token={random_token(1, 24)}")).alias("text"))
    got = secrets.samples_of(docs).collect()
    digest = base64.b64encode(hashlib.sha256(random_token(1, 24).encode()).digest()).decode().rstrip("=")
    assert {r["token"] for r in got if r["random"]} == {random_token(1, 24), digest}
    ordinary = [r["token"] for r in got if not r["random"]]
    assert sum(t.startswith("identifier_") for t in ordinary) == 20_000 == len(set(ordinary)) - 5  # 1 to 5 digits: five dated names
    assert {t for t in ordinary if t.startswith("dated")} == {f"dated-0000-{'0' * n}" for n in range(1, 6)}


def plain_counts(samples):
    counts = Counter()
    for token, kind in samples:
        folded = re.sub("[0-9]", "0", token.lower())
        counts.update((kind, "letter", a, b) for a, b in zip(folded, folded[1:]))
        if re.search("[a-z]", token) and re.search("[A-Z]", token):
            cased = re.sub("[^aA]", "0", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", token)))
            counts.update((kind, "case", a, b) for a, b in zip(cased, cased[1:]) if b != "0")
    return counts


def plain_total(token, counts, options=SecretOptions()):
    """The ratio by its formula: chances of a step and, where the row is thin, of its class, each transition clipped."""
    def chance(kind, chain, befores, afters, a, b):
        n = {(x, y): counts.get((kind, chain, x, y), 0) for x in befores for y in afters}
        often = {y: sum(n[x, y] for x in befores) + options.smoothing for y in afters}
        digit = [y for y in afters if (y == "0") == (b == "0")]
        alike = [x for x in befores if (x == "0") == (a == "0")]
        groups = [[y for y in afters if y != "0"], [y for y in afters if y == "0"]]
        to = [sum(n[x, y] for x in alike for y in group) + options.smoothing for group in groups if group]
        own = sum(n[x, y] for x in alike for y in digit) + options.smoothing
        lean = own / sum(to) * often[b] / sum(often[y] for y in digit)
        return (n[a, b] + options.backing * lean) / (sum(n[a, y] for y in afters) + options.backing)

    def step(chain, befores, afters, a, b):
        value = math.log(chance(True, chain, befores, afters, a, b) / chance(False, chain, befores, afters, a, b))
        return max(-options.most_step, min(options.most_step, value))

    known = "abcdefghijklmnopqrstuvwxyz0"
    folded = re.sub("[0-9]", "0", token.lower())
    total = sum(step("letter", known, known, a, b) for a, b in zip(folded, folded[1:]) if a in known and b in known)
    if re.search("[a-z]", token) and re.search("[A-Z]", token):
        cased = re.sub("[^aA]", "0", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", token)))
        total += sum(step("case", "aA0", "aA", a, b) for a, b in zip(cased, cased[1:]) if b != "0")
    return total


def test_the_ratio_equals_its_formula(make_docs):
    """Tokens near the limit on both sides: marked exactly where the plain formula says so."""
    secret = [random_token(i, 24) for i in range(12)] + [random_token(50 + i, 40, "0123456789abcdef") for i in range(4)]
    names = ["get_next_record", "maximum_connection", "PreferenceManager", "src/main/settings", "build-2024-nightly", "READ_ONLY_MODE"]
    samples = [(t, True) for t in secret] + [(n, False) for n in names]
    tokens = [random_token(100 + i, 16 + i % 9) for i in range(60)] + [n + random_token(200 + i, i % 12) for i, n in enumerate(names * 8)]
    tokens = [t for t in tokens if len(t) >= 16 and re.search("[A-Za-z]", t)]
    counts = plain_counts(samples)
    ratios = secrets.ratios_of(counts)
    want = {}
    for i, token in enumerate(tokens):
        total = plain_total(token, counts)
        want[i] = total >= 8.0 and total >= 0.3 * (len(token) - 1)
    got = {r["doc_id"]: len(r["spans"]) == 1 for r in secrets.scan(make_docs(list(enumerate(tokens))), ratios).collect()}
    assert got == want and {True, False} == set(want.values())


def test_recall_of_unseen_secrets_and_names_left_alone(spark, make_docs):
    names = ["build-2024-11-03-nightly", "src/main/java/settings", "get_next_record_batch", "internationalization", "PreferenceManagerSettings",
             "MAX_CONNECTION_TIMEOUT", "customer-orders-2024-q3", "user_profile_image_url", "release-2023-01-17-candidate"]
    kinds = ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]
    pasted, rng = random_token(7, 32), random.Random(8)
    words = ["".join(rng.choice(["tion", "er", "ma", "king", "pre", "sol", "ter", "ing", "con", "de"]) for _ in range(3)) for _ in range(150)]
    docs = [(i, f"token={random_token(i, 24)} in {re.sub('[0-9]', str(i % 10), names[i % 9])} and {' '.join(words)}") for i in range(300)]
    docs += [(1000 + i, f"see {random_token(5000 + i, 20 + i % 21, kinds[i % 3])} there") for i in range(600)]
    docs += [(2000 + i, f"as {name} says") for i, name in enumerate(names)] + [(3000 + i, f"key {pasted}") for i in range(30)]
    table = make_docs(docs)
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.scan(table, secrets.train(secrets.samples_of(table))).collect()}
    assert sum(found[1000 + i] == ["markov"] for i in range(600)) >= 570  # 0.95
    assert all(found[i] == ["assign"] for i in range(300)) and all(found[2000 + i] == [] for i in range(9))
    assert all(found[3000 + i] == ["markov"] for i in range(30))


def test_without_samples_or_rows(spark, make_docs):
    empty = make_docs(rows()).limit(0)
    assert secrets.train(secrets.samples_of(empty)) is None
    assert secrets.scan(empty, None).count() == 0
    only_words = make_docs([(1, "plain identifiers without any finding")])
    assert secrets.train(secrets.samples_of(only_words)) is None


def test_no_python_on_the_main_path(make_docs):
    docs = make_docs(rows())
    plan = secrets.scan(docs, [0.0] * (32**2 + 9))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_very_long_text(make_docs):
    text = ("word " * 20_000) + "token=" + random_token(9, 30) + " tail" * 20_000
    spans = secrets.scan(make_docs([(1, text)]), None, SecretOptions()).first()["base"]
    assert [(s["start"], s["end"]) for s in spans] == [(100_000, 100_036)]


def plain_spans(text):
    """The patterns' spans and, where the models mark every token with a letter, the tokens apart from them."""
    base = [tuple(map(int, span.split(":")[1:])) for span in plain_base(text).split(",") if span]
    tokens = [(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/_=-]+", text) if len(m[0]) >= 16 and re.search("[A-Za-z]", m[0])]
    return sorted(base + [(a, b) for a, b in tokens if all(b <= start or end <= a for start, end in base)])


def test_models_spans_overlap_no_patterns_span(make_docs):
    rng, texts = random.Random(11), []
    for i in range(150):
        parts = [rng.choice([f"password{rng.choice(['', chr(34)])}: {random_token(i, 12)}", "AKIA" + "Z9" * rng.randrange(5, 9), random_token(i, 33, "0123456789abcdef"),
                             random_token(rng.random(), rng.randrange(12, 30)), "1" * 20, "\U0001f600", "é", "see", "token=x "]) for _ in range(rng.randrange(300))]
        texts.append("".join(part + rng.choice([" ", " ", "\n", "", "/"]) for part in parts))
    found = secrets.scan(make_docs(list(enumerate(texts))), [1.0] * (32**2 + 9)).collect()
    assert {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found} == {i: plain_spans(text) for i, text in enumerate(texts)}


def test_work_grows_with_the_length_of_texts_and_tokens(make_docs):
    """Thousands of matches in one text and a token of many characters: with the square of either, this takes many minutes."""
    lines = "".join(f"{random_token(i, 32, '0123456789abcdef')} password: {random_token(i, 12)} and {random_token(-i, 20)}\n" for i in range(4000))
    docs = make_docs([(1, lines), (2, f"see {random_token(1, 50_000)} there")])
    began = time.monotonic()
    samples = secrets.samples_of(docs).where("random").count()
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in secrets.scan(docs, [1.0] * (32**2 + 9)).collect()}
    secrets.train(docs.sparkSession.createDataFrame([(random_token(2, 50_000), True), (random_token(3, 50_000), False)], "token string, random boolean"))
    assert time.monotonic() - began < 90
    assert samples == 16_000 and len(spans[1]) == 12_000 and spans == {1: sorted([m.span() for m in re.finditer(r'[0-9a-f]{32}|password: \w+|(?<=and )\w+', lines)]), 2: [(4, 50_004)]}
