import hashlib
import random

from pyspark.sql import functions as F

from quillmark.llm import mixing


def brute(rows):
    """The mix of (doc_id, source, size) rows, by sorting."""
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, t, n in rows if t == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    limited = set()
    while True:
        spare = 1.5 * sum(size.values()) - sum(2 * size[s] for s in limited)
        open_weight = sum(weight[s] for s in sources if s not in limited)
        target = {s: 2.0 * size[s] if s in limited else spare / open_weight * weight[s] for s in sources}
        over = {s for s in sources if s not in limited and target[s] > 2 * size[s]}
        if not over:
            break
        limited |= over
    hashes = {d: int(hashlib.md5(str("null" if d is None else d).encode()).hexdigest()[:15], 16) for d, _, _ in rows}
    taken = []
    for s in sources:
        own = [(d, n) for d, t, n in rows if t == s]
        full = 1 if size[s] and target[s] >= size[s] else 0
        rest, before = target[s] - full * size[s], 0
        for h in sorted({hashes[d] for d, _ in own}):
            group = [(d, n) for d, n in own if hashes[d] == h]
            upto = before + sum(n for _, n in group)
            extra = upto <= rest or (before <= rest and upto - rest < rest - before)
            taken += [(d, s, n, (full + extra) * n) for d, n in group]
            before = upto
    return target, sorted(taken, key=repr)


def check(spark, rows):
    docs = spark.createDataFrame([(d, s, "w " * n) for d, s, n in rows], "doc_id long, source string, text string")
    target, taken = brute(rows)
    got = mixing.mix(docs).join(docs.select("doc_id", "source").distinct(), "doc_id").collect()
    assert sorted([(r["doc_id"], r["source"], r["size"], r["taken"]) for r in got], key=repr) == taken
    assert all(abs(r["target"] - target[r["source"]]) < 1e-6 for r in got)


def test_equal_to_sorting(spark):
    random.seed(3)
    check(spark, [(i, random.choice("abcdéz"), random.randint(0, 30)) for i in range(300)])


def test_a_source_that_holds_nearly_everything(spark):
    check(spark, [(i, "hot" if i % 10 else f"s{i}", 1 + i % 7) for i in range(200)])


def test_one_document_and_one_source(spark):
    check(spark, [(1, "a", 5)])


def test_awkward_rows(awkward, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == 10
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert len({(r["size"], r["taken"]) for r in rows if r["doc_id"] == 1}) == 1
    assert mixing.mix(nothing).count() == 0
    assert mixing.mix(awkward.where("doc_id in (2, 3)")).agg(F.sum("taken")).first()[0] == 0


def test_documents_of_the_mix(awkward, nothing):
    made = mixing.mixed_documents(awkward)
    assert made.columns == [*awkward.columns, "_copy_no"]
    wanted = mixing.mix(awkward).where("size > 0").agg(F.sum("taken")).first()[0]
    assert made.agg(F.sum(mixing.words(F.col("text")))).first()[0] == wanted
    assert mixing.mixed_documents(nothing).count() == 0


def test_reruns_agree(spark, tiny_dir):
    docs = spark.read.parquet(f"{tiny_dir}/documents.parquet")
    first, again = mixing.mix(docs), mixing.mix(docs.repartition(7))
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()
