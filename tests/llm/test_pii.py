import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quillmark.llm import pii, queries

NAMES = ("email", "ip", "card", "phone")
FORMATS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return [
        True, kind == 1 and all(int(p) <= 255 for p in value.split(".")),
        12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15,
    ][kind]


def brute(text):
    spans = [(m.start(), k, m.end()) for k, p in enumerate(FORMATS) for m in p.finditer(text or "") if good(k, m[0])]
    return sorted(spans)


PARTS = ["a.b", "x", "@", "mail.example", ".com", "-", "+", "1", "12", "255", "256", "007", ".", " ", "4111 1111 1111 1111", "4111-1111-1111-1112",
         "5500005555555559", "+44 (20) 7946 0958", "+1", "(", ")", "%", "é", "🙂", "\n", "1.2.3.4", "123456789012345678901", "  "]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    return made + ["", None, "a@b@c.com", "a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "+" * 50 + "1" * 12, "a" * 3000 + "@b.cd", "x" * 2000 + "@",
                   "a@" + "b." * 9000 + "c", "1 " * 30_000, "0000255.1.1.1", "1." * 9000]


def test_base_spans_equal_brute_force(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    rows = pii.find_personal_data(frame, None).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        listed = ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in spans)
        assert r["spans"] == listed, texts[r["doc_id"]][:200]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{n}"] for n in NAMES] == [sum(s[1] == k for s in spans) for k in range(4)]


def number(rng, valid):
    while True:
        digits = "".join(rng.choice("0123456789") for _ in range(16))
        if luhn(digits) == valid:
            return digits


@pytest.fixture(scope="module")
def labelled(spark):
    """Cards follow a word on payment and are mostly valid; other long numbers are mostly not."""
    rng = random.Random(13)
    rows = []
    for i in range(600):
        card = number(rng, True)
        rows.append((2 * i, f"Invoice {i}: paid by credit card {card[:4]} {card[4:8]} {card[8:12]} {card[12:]} today"))
        rows.append((2 * i + 1, f"Serial no {number(rng, False)} rev {i}"))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_trees_learn_format_and_context(spark, labelled):
    model = pii.fit(labelled)
    assert model is not None and model.threshold <= 0.95
    tests = [
        (1, "paid by credit card 4111 1111 1111 1112 today"),  # a slip in the last digit
        (2, "Serial no 4111111111111112 rev 3"), (3, "paid by credit card 4111 1111 1111 1111 today"),
    ]
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(spark.createDataFrame(tests, labelled.schema), model).collect()}
    assert found == {1: "model:20:39", 2: "", 3: "card:20:39"}


def test_expression_equals_the_fitted_model(spark, labelled):
    """The trees as a column expression give what the choices give in Python."""
    model = pii.fit(labelled)
    spans = labelled.select("text", F.explode(pii.candidate_spans(F.col("text"))).alias("span"))
    features = pii._features(F.col("text"), F.col("span"))
    rows = spans.select(*[v.alias(k) for k, v in features.items()], model.probability(features).alias("p")).limit(200).collect()

    def value(node, row):
        while not isinstance(node, float):
            name, limit, low, high = node
            node = low if row[name] <= limit else high
        return node

    import math

    for r in rows:
        margin = sum(w * value(t, r) for t, w in zip(model.trees, model.weights))
        assert r["p"] == pytest.approx(1 / (1 + math.exp(-2 * margin)), abs=1e-9)


def test_no_python_on_the_main_path(spark, labelled):
    plan = pii.find_personal_data(labelled, pii.fit(labelled))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange hashpartitioning", "Join"))


def test_too_few_candidates_give_no_model(spark, awkward, nothing):
    assert pii.fit(awkward) is None and pii.fit(nothing) is None
    assert pii.find_personal_data(nothing, None).count() == 0
    assert pii.find_personal_data(awkward, None).count() == 10


def test_redaction(spark, awkward):
    rows = [(1, "é mail a@b.co or +44 20 7946 0958."), (2, "clean"), (3, None), (4, "1.2.3.4")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.redact(frame, None).collect()} == {
        1: "é mail [personal] or [personal].", 2: "clean", 3: None, 4: "[personal]"}
    assert pii.redact(awkward, None).exceptAll(awkward).isEmpty()


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op8_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        listed = ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in brute(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


LOOSE = ["jane{} (at) example{} (dot) com", "jane{}(at)mail{}.org", "pat{} [at] example{}.net"]


@pytest.fixture(scope="module")
def personal(spark):
    """Texts with strict forms among prose and plain numbers, for training, and loose ones, for the test."""
    rng = random.Random(17)
    words = "the of and report sent house open water light green never about".split()
    prose = lambda n: " ".join(rng.choices(words, k=n))
    train = []
    for i in range(900):
        forms = [f"mail jane{i}@example{i}.com", f"call +44 20 {rng.randrange(1000, 9999)} {rng.randrange(1000, 9999)}",
                 f"card {number(rng, True)}", f"order {rng.randrange(10**6, 10**7)}", f"in {rng.randrange(1900, 2030)}-{rng.randrange(1900, 2030)}"]
        train.append((i, f"{prose(6)} {rng.choice(forms)} {prose(4)} {rng.choice(forms)} {prose(3)}"))
    tests = []
    for i in range(200):
        loose = rng.choice(LOOSE).format(i, i) if i % 2 else f"44 20 {rng.randrange(1000, 9999)} {rng.randrange(1000, 9999)}"
        tests.append((i, f"{prose(5)} {'mail' if i % 2 else 'call'} ", loose, f" {prose(4)}"))
    return spark.createDataFrame(train, "doc_id long, text string").repartition(4), tests, prose


def test_trees_add_loose_forms(spark, personal):
    train, tests, prose = personal
    model = pii.fit(train)
    assert model is not None
    frame = spark.createDataFrame([(i, a + b + c) for i, a, b, c in tests], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(frame, model).collect()}
    caught = sum(f"model:{len(a)}:{len(a + b)}" in found[i].split(",") for i, a, b, _ in tests)
    assert caught >= 0.9 * len(tests)
    clean = spark.createDataFrame([(i, f"{prose(5)} order {1234567 + i} {prose(5)}") for i in range(200)], "doc_id long, text string")
    assert sum(r["spans"] != "" for r in pii.find_personal_data(clean, model).collect()) <= 0.05 * 200


def test_free_candidates_equal_brute_force(spark):
    rng = random.Random(23)
    rows = []
    for i in range(60):
        spans = lambda n: [(a, 0, a + rng.randrange(1, 9), "v") for a in (rng.randrange(300) for _ in range(n))]
        rows.append((i, spans(rng.randrange(0, 30)), spans(rng.randrange(0, 150))))
    kind = pii._SPANS
    frame = spark.createDataFrame(rows, f"id long, base {kind}, found {kind}")
    for r, (_, base, found) in zip(frame.select("id", pii._free("found", "base").alias("free")).orderBy("id").collect(), rows, strict=True):
        wanted = sorted((a, k, b, v) for a, k, b, v in found if not any(s < b and a < e for s, _, e, _ in base))
        assert sorted(tuple(x) for x in r["free"]) == wanted


def test_time_grows_with_the_matches(spark):
    import time

    def seconds(n):
        frame = spark.createDataFrame([(1, "a@b.co 1.2.3.4 " * n)], "doc_id long, text string")
        start = time.perf_counter()
        assert pii.find_personal_data(frame, None).first()["n_email"] == n
        return time.perf_counter() - start

    seconds(100)
    small, large = (min(seconds(n) for _ in range(2)) for n in (20_000, 40_000))
    assert large < 3 * small


def test_every_document_takes_part_in_the_fit(spark, labelled, monkeypatch):
    staged = []
    stage = pii.stage
    monkeypatch.setattr(pii, "stage", lambda table, name: staged.append(stage(table, name)) or staged[-1])
    plain = spark.range(10_000, 50_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id") % 7).alias("text"))
    assert pii.fit(labelled.unionByName(plain)) is not None
    kinds = staged[0]
    # Examples with equal features are one row, and none is left out.
    assert kinds.agg(F.sum("n")).first()[0] == pii._examples(labelled).count() > kinds.count()
