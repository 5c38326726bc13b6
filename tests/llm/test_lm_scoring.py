import math
import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from quillmark.llm import lm_scoring
from quillmark.llm.lm_scoring import score_documents

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, backoff=0.4):
    """Stupid-backoff scores of each text by the counts of all others."""
    own = [words(t) for _, t in docs]
    all_words = Counter(w for ws in own for w in ws)
    all_pairs = Counter(p for ws in own for p in zip(ws, ws[1:]))
    found = {}
    for (d, _), ws in zip(docs, own):
        n, pairs = Counter(ws), Counter(zip(ws, ws[1:]))
        rest = max(sum(all_words.values()) - len(ws), 1)

        def alone(w):
            return ((all_words[w] - n[w]) or backoff) / rest

        score = math.log(alone(ws[0])) if ws else 0.0
        for a, b in zip(ws, ws[1:]):
            left = all_pairs[a, b] - pairs[a, b]
            score += math.log(left / (all_words[a] - n[a]) if left else backoff * alone(b))
        before = found.get(d, (0, 0.0))
        found[d] = (before[0] + len(ws), before[1] + score)
    return found


def corpus(n, seed=1):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(60)]
    return [(i, " ".join(rng.choices(pool, [1 / (k + 1) for k in range(60)], k=rng.choice([0, 1, 2, 30, 200])))) for i in range(n)]


def held_to_brute(rows, docs):
    wanted = brute(docs)
    assert len(rows) == len(wanted)
    for r in rows:
        n, score = wanted[r["doc_id"]]
        assert r["n_words"] == n
        assert r["score"] == pytest.approx(score, abs=1e-5 * (n + 1))
        assert r["mean_score"] == pytest.approx(score / n if n else 0.0, abs=2e-5)


def test_equal_to_brute_force(spark):
    docs = corpus(60)
    docs += [(7, docs[8][1]), (7, "w1 w2 rare w2"), (None, "w1 w2"), (None, "w3 rare"), (100, docs[9][1]), (101, None)]
    held_to_brute(score_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect(), docs)


def test_ids_may_be_strings(spark):
    docs = [(f"d{d}", t) for d, t in corpus(20, 4)]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    held_to_brute(score_documents(frame, held_words=9, held_pairs=9).collect(), docs)


def test_reruns_agree(spark):
    frame = spark.createDataFrame(corpus(40, 2), "doc_id long, text string")
    first, again = (score_documents(frame.repartition(n)).collect() for n in (3, 7))
    assert sorted(first) == sorted(again)


def test_awkward_rows(awkward, nothing):
    rows = {r["doc_id"]: r for r in score_documents(awkward).collect()}
    assert set(rows) == {1, 2, 3, 4, None, 5, 6, 7, 8}
    for doc_id in (2, 3, 4):
        assert (rows[doc_id]["n_words"], rows[doc_id]["score"], rows[doc_id]["mean_score"]) == (0, 0.0, 0.0)
    assert rows[1]["n_words"] == 12
    assert rows[5]["score"] == rows[8]["score"] < 0
    assert score_documents(nothing).count() == 0


def test_a_long_text_counts_whole(spark):
    docs = [(1, "a b " * 200_000), (2, "b a b c")]
    rows = {r["doc_id"]: r for r in score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for doc_id, (n, score) in brute(docs).items():
        assert rows[doc_id]["n_words"] == n
        assert rows[doc_id]["score"] == pytest.approx(score, abs=1.0)


def test_one_text_alone_backs_off_throughout(spark):
    row = score_documents(spark.createDataFrame([(1, "a b a b")], "doc_id long, text string")).first()
    assert row["score"] == pytest.approx(math.log(0.4) * 7, abs=1e-4)


def test_no_word_is_too_rare_to_count(spark):
    many = [f"v{i}" for i in range(70_000)]
    docs = [(1, " ".join(many)), (2, "rare1 rare2 v7 v8 rare1 rare2"), (3, "once never seen rare1 rare2"),
            (4, " ".join(many[:40_000] * 2))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for more in ({}, {"held_words": 2, "held_pairs": 1}):
        held_to_brute(score_documents(frame, **more).collect(), docs)


def test_gibberish_scores_less_than_text(spark):
    docs = corpus(60, 5) + [(100, " ".join(f"q{i}x" for i in range(50))), (101, " ".join(f"w{i % 20}" for i in range(50)))]
    rows = {r["doc_id"]: r["mean_score"] for r in score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[100] < rows[101] - 2


@pytest.mark.parametrize("held", [(0, 0), (3, 2), (20, 500)])
def test_what_is_held_and_the_buckets_change_no_score(spark, held):
    frame = spark.createDataFrame(corpus(40, 3), "doc_id long, text string").repartition(3)
    own = score_documents(frame, held_words=held[0], held_pairs=held[1], bucket_pairs=20).collect()
    assert sorted(own) == sorted(score_documents(frame).collect())


def test_a_task_holds_the_arrays_of_one_group(monkeypatch):
    """Peak memory of the step that makes packets, in bytes for each byte of a group of texts."""
    monkeypatch.setattr(lm_scoring, "SPAN_BYTES", 1 << 20)
    monkeypatch.setattr(lm_scoring, "id_and_text", lambda docs: docs)
    steps = []
    docs = SimpleNamespace(dtypes=[("doc_id", "bigint")], mapInArrow=lambda step, schema: steps.append(step))
    none = lm_scoring.Held(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    lm_scoring.pair_packets(docs, lm_scoring.Model(none, none, 10**6, 0.4), 128)
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(50_000)}" for _ in range(400)) for _ in range(1500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1500), pa.int64()), "text": pa.array(texts)})
    assert sum(1 for _ in steps[0](iter([batch]))) >= 3  # several groups; the tables of powers are made
    tracemalloc.start()
    try:
        for made in steps[0](iter([batch])):
            del made
        assert tracemalloc.get_traced_memory()[1] < 36 * (1 << 20)
    finally:
        tracemalloc.stop()
