import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillmark.llm import digests
from quillmark.llm.arrow_text import text_bytes
from quillmark.llm.digests import Digests, entropy_bins, entropy_counts, likeness, rarity_ranks
from quillmark.llm.fingerprints import compare_with_next, fingerprint, fit_rarity


def buffer(*texts):
    return text_bytes(pa.array(texts, pa.string()))


def prose(seed, n):
    random = np.random.default_rng(seed)
    words = ["".join(random.choice(list("etaoinshrdlu"), random.integers(2, 9))) for _ in range(400)]
    return " ".join(random.choice(words, n))


@pytest.fixture(scope="module")
def ranks():
    return rarity_ranks(entropy_counts(*buffer(*[prose(i, 300) for i in range(20)])))


def test_entropy_equals_its_definition():
    text = (prose(1, 60) + "aaaa" * 40 + "é" * 30).encode()
    got = entropy_bins(np.frombuffer(text, np.uint8))
    for i in range(0, len(text) - 63, 7):
        entropy = -sum(c / 64 * math.log2(c / 64) for c in Counter(text[i : i + 64]).values())
        assert abs(got[i] - 1000 * entropy / 6) <= 1.01


def test_windows_are_those_inside_texts():
    texts = ["", "a" * 63, "b" * 64, prose(2, 50)]
    assert entropy_counts(*buffer(*texts)).sum() == 1 + len(texts[3]) - 63


def test_votes_equal_brute_force(ranks):
    text = prose(3, 120).encode()
    data, bounds = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    rank = ranks[entropy_bins(data)]
    votes = Counter(min(range(i, i + 64), key=lambda p: (rank[p], p)) for i in range(len(rank) - 63))
    place, count = digests._votes(data, bounds, ranks)
    assert dict(zip(place.tolist(), count.tolist())) == dict(votes)


def test_long_texts_in_parts_are_as_in_one(ranks, monkeypatch):
    data, bounds = buffer("short", prose(4, 3000), "", prose(5, 40))
    whole, counts = Digests(data, bounds, ranks), entropy_counts(data, bounds)
    monkeypatch.setattr(digests, "PIECE_BYTES", 512)
    monkeypatch.setattr(digests, "groups", lambda bounds: __import__("quillmark.llm.arrow_text", fromlist=["x"]).groups(bounds, 512))
    cut = Digests(data, bounds, ranks)
    assert [cut.text(i) for i in range(4)] == [whole.text(i) for i in range(4)]
    assert (entropy_counts(data, bounds) == counts).all()


def test_a_text_has_the_same_digest_in_any_batch(ranks):
    texts = [prose(i, 100) for i in range(5)] + ["", "é", "x" * 200]
    together = Digests(*buffer(*texts), ranks)
    for i, text in enumerate(texts):
        assert Digests(*buffer(text), ranks).text(0) == together.text(i)
    assert together.text(5) == ""


def test_likeness(ranks):
    text, other = prose(6, 900), prose(7, 900)
    half = text[: len(text) // 2] + other[: len(text) // 2]
    found = Digests(*buffer(text, half, other, text, ""), ranks)
    near = lambda a, b: likeness(found.chain(a), found.chain(b))
    assert near(0, 3) == 1.0 and near(4, 4) == 1.0 and near(0, 4) == 0.0
    assert near(0, 1) == near(1, 0) > 0.3 and near(0, 2) == near(2, 0) < 0.1


def following(rows):
    ordered = sorted(rows, key=lambda r: r[0])
    return {a[0]: (a[1] or "", b[1] or "") for a, b in zip(ordered, ordered[1:] + ordered[:1])}


def test_edited_texts_and_successors(spark, tiny_dir):
    docs = spark.read.parquet(f"{tiny_dir}/documents.parquet").select("doc_id", "text")
    ranks = fit_rarity(docs)
    rows = compare_with_next(docs.repartition(5), ranks).collect()
    wanted = following([tuple(r) for r in docs.collect()])
    alone = {r["doc_id"]: r["fingerprint"] for r in fingerprint(docs, ranks).collect()}
    assert len(rows) == len(wanted)
    for r in rows:
        text, after = wanted[r["doc_id"]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == alone[r["doc_id"]]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    long = [r for r in rows if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.85


def test_awkward_rows(spark, awkward, nothing):
    docs = awkward.select("doc_id", "text")
    ranks = fit_rarity(docs)
    rows = compare_with_next(docs, ranks).collect()
    assert len(rows) == 10
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (2, 3)} == {""}
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 1}) == 1
    assert compare_with_next(nothing, fit_rarity(nothing)).count() == 0
    single = compare_with_next(spark.createDataFrame([(9, "abcd")], "doc_id long, text string"), ranks).first()
    assert single["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert single["near_next"] == 1.0
