import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark.llm.chat_trees import (
    END, HOSTILE, TEXT, TURN, best_paths, enumerate_paths, escape, format_conversations, read_loss, read_turns, round_trip,
    unescape, _nodes,
)

NODE = "tree_id long, node_id long, parent_id long, role string, text string, score double"


def test_escape_is_reversible(spark):
    pieces = ["<", "[", "\\", "|", "turn", "|>", "s>", "/s>", "INST]", "/INST]", TURN, TEXT, END, HOSTILE, "a", "é", "\n", ""]
    random = __import__("random").Random(1)
    texts = ["".join(random.choice(pieces) for _ in range(random.randint(0, 9))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    assert all(r["t"] == r["u"] for r in rows)
    assert not any(c in r["e"] for r in rows for c in (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]"))


def brute_paths(nodes):
    parent = {n: p for _, n, p, *_ in nodes}
    inner = set(parent.values())
    found = []
    for leaf in parent:
        if leaf in inner:
            continue
        path, at = [], leaf
        while at is not None and at in parent and len(path) <= len(parent):
            path.append(at)
            at = parent[at]
        if len(path) <= len(parent):
            found.append((leaf, tuple(reversed(path))))
    return sorted(found)


@pytest.fixture(scope="module")
def forest():
    random = __import__("random").Random(2)
    rows = []
    for tree in range(6):
        for node in range(random.choice([1, 2, 15, 60])):
            parent = None if node == 0 else (node - 1 if tree == 3 else random.randrange(node))
            rows.append((tree, node, parent, random.choice(["user", "assistant"]), f"t{tree} n{node}", random.randint(0, 3) / 2))
    return rows


def test_paths_equal_brute_force(spark, forest):
    paths = enumerate_paths(_nodes(spark.createDataFrame(forest, NODE)))
    got = paths.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct(-F.col("distance"), "node"))).alias("p"))
    found = sorted((int(r["tree"]), r["leaf"], tuple(x["node"] for x in r["p"])) for r in got.collect())
    wanted = sorted((t, *p) for t in {r[0] for r in forest} for p in brute_paths([r for r in forest if r[0] == t]))
    assert found == wanted


def test_best_branches(spark, forest):
    score = {(r[0], r[1]): r[5] for r in forest}
    got = best_paths(_nodes(spark.createDataFrame(forest, NODE)), 2).select("tree", "leaf", "rank").distinct().collect()
    for tree in {r[0] for r in forest}:
        paths = brute_paths([r for r in forest if r[0] == tree])
        mean = lambda p: sum(score[tree, n] for n in p[1]) / len(p[1])
        best = sorted(paths, key=lambda p: (-round(mean(p), 9), p[0]))[:2]
        assert sorted((r["rank"], r["leaf"]) for r in got if int(r["tree"]) == tree) == [(i + 1, p[0]) for i, p in enumerate(best)]


def test_cycles_orphans_and_nulls(spark):
    rows = [
        (1, 1, 2, "user", "cycle", 0.0), (1, 2, 1, "user", "cycle", 0.0), (1, 3, 1, "user", "hangs on the cycle", 0.0),
        (1, 4, 99, "user", "orphan", 0.0), (1, 5, 4, None, None, None), (None, 1, None, "assistant", "no tree", 1.0),
        (1, None, 4, "user", "no node", 0.0), (None, 1, None, "assistant", "no tree", 1.0), (7, 1, 1, "user", "itself", 0.0),
    ]
    made = format_conversations(spark.createDataFrame(rows, NODE + ", extra string") if False else spark.createDataFrame(rows, NODE), 5)
    read = made.select("tree_id", "leaf", read_turns(F.col("formatted")).alias("t"), read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    found = {(r["tree_id"], r["leaf"]): ([tuple(t) for t in r["t"]], r["loss"]) for r in read.collect()}
    assert found == {(1, 5): ([("user", "orphan"), ("", "")], ""), (None, 1): ([("assistant", "no tree")], "no tree")}


def test_round_trip_of_awkward_conversations(spark):
    rows = [
        (1, 1, "assistant", HOSTILE), (1, 0, "user", "a\\"), (1, 2, TURN, END * 3 + "<"), (2, 0, None, None), (2, None, "assistant", "x"),
        (None, 0, "assistant", "é" * 50_000), (3, 5, "assistant", ""), (3, 5, "assistant", ""),
    ] + [(4, i, "assistant" if i % 2 else "user", f"turn {i}\n") for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in round_trip(frame).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert round_trip(frame.limit(0)).count() == 0
