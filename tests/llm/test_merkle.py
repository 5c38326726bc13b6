import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quillmark.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes, fanout):
    made = [nodes]
    while len(made[-1]) > 1:
        below = made[-1]
        made.append([digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return made


def climb(node, pos, tree, fanout):
    proof = ""
    for level in tree[:-1]:
        first = pos - pos % fanout
        left, right = "".join(level[first:pos]), "".join(level[pos + 1 : first + fanout])
        proof, node, pos = proof + left + right, digest(left + node + right), pos // fanout
    return node, proof


def brute(rows, fanout=2):
    """Rows are doc_id, source, lang, n_chars, text."""
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: levels([leaf(r) for r in groups[g]], fanout) for g in langs}
    top = levels([trees[g][-1][0] for g in langs], fanout) if langs else None
    found = []
    for at, g in enumerate(langs):
        for pos, r in enumerate(groups[g]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            start = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            sub, low = climb(start, pos, trees[g], fanout)
            folded, high = climb(sub, at, top, fanout)
            root = top[-1][0]
            found.append((r[0], leaf(r), trees[g][-1][0], root, digest(low + high), folded, folded == root))
    return sorted(found, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def check(spark, rows, fanout=2):
    got = merkle.audit(spark.createDataFrame(rows, SCHEMA), fanout).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, fanout)


@pytest.mark.parametrize("n, fanout", [(1, 2), (17, 2), (700, 2), (100, 3), (70, 20)])
def test_equal_to_brute_force(spark, n, fanout):
    random.seed(n)
    # One language holds most rows.
    check(spark, [(i * 3, "s", "hot" if i % 5 else f"l{i % 7}", i, f"text {i} ü") for i in range(n)], fanout)


def test_many_groups_of_one(spark):
    check(spark, [(i, None, f"é{i}", None, None) for i in range(40)])


def test_ties_nulls_and_repeats(spark):
    rows = [(1, "a", "en", 1, "x"), (1, "a", "en", 1, "x"), (1, "b", "en", 2, "y"), (None, None, None, None, None),
            (None, "a", None, 3, ""), (7, "a", "", 0, ""), (2, "-", "en", None, "1:-")]
    check(spark, rows)


def test_awkward_rows(awkward, nothing):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in awkward.select(*columns).collect()]
    got = merkle.audit(awkward).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert merkle.audit(nothing).collect() == []


def test_a_changed_row_fails_and_changes_the_root(spark):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(50)]
    found = {r["doc_id"]: r for r in merkle.audit(spark.createDataFrame(rows, SCHEMA)).collect()}
    changed = {i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert changed and {i for i, r in found.items() if not r["verified"]} == changed
    rows[3] = (3, "s", "en", 3, "other text")
    other = merkle.audit(spark.createDataFrame(rows, SCHEMA)).first()
    assert other["root"] != found[0]["root"]


def test_no_path_passes_for_another_leaf(spark):
    leaves = spark.range(40).select("id", F.lit("g").alias("group"), merkle.leaf(F.col("id")).alias("leaf"))
    made = merkle.manifest(leaves, [F.col("id")], fanout=4)
    wrong = made.select(merkle.fold(F.reverse("leaf"), F.col("path")).alias("folded"), "root")
    assert wrong.where("folded = root").count() == 0
    assert made.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == 40


def test_rows_stay_in_slices(spark):
    """No window over a whole group, no cross join, no Python."""
    rows = [(i, "s", "en", i, "t") for i in range(100)]
    plan = merkle.audit(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().toString()
    for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert word not in plan
