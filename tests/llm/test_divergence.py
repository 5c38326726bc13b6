import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillmark.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "text string, lang string, source string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, top):
    docs = [(TERM.findall(lowered(t or "")), lang or "", source or "") for t, lang, source in rows]
    found = []
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        seen = Counter(t for words, _, _ in own for t in set(words))
        kept = {t for t, n in seen.items() if n >= least}
        counts = defaultdict(Counter)
        for words, _, source in own:
            counts[source].update(t for t in words if t in kept)
        whole = sum(counts.values(), Counter())
        def shares(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}
        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, *x, i) for i, x in enumerate(items[:limit], 1)]
    return sorted(found)


def check(spark, rows, least=2, top=5):
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA), least, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, top)


def rows_of(n, n_sources, seed=1):
    random.seed(seed)
    words = [f"{a}{b}" for a in "abcdéZ" for b in "xyzß"] + ["ZA-zz", "l'été", "#", "12"]
    return [
        (" ".join(random.choices(words, k=random.randint(0, 12))), random.choice(["en", "de"]),
         "hot" if random.random() < 0.4 else f"s{random.randrange(n_sources)}")
        for _ in range(n)
    ]


def test_equal_to_brute_force(spark):
    check(spark, rows_of(300, 6))


def test_equal_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_TERMS", 3)
    monkeypatch.setattr(divergence, "TILE_SOURCES", 2)
    check(spark, rows_of(200, 9, 2))


def test_nulls_ties_and_groups_without_terms(spark):
    rows = [("Ab ab CD", "en", "a"), ("ab cd", "en", "b"), ("ab cd", "en", "b"), (None, "en", "c"), ("", "en", "d"),
            (None, None, None), ("x x", "", "q"), ("12 -- ..", "fr", "a"), ("once", "fr", "b"), ("alone", "es", "z")]
    check(spark, rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [tuple(r) for r in awkward.select("text", "lang", "source").collect()]
    got = divergence.audit(awkward, 2, 5).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 5)
    assert divergence.audit(nothing).collect() == []


def test_a_long_text_without_a_break(spark):
    check(spark, [("é" * 3_000_000, "en", "a"), ("é" * 3_000_000 + " b", "en", "b")])


def test_counts_leave_a_task_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    import pyarrow as pa
    texts = [" ".join(f"t{'abcdefghij'[j]}{'xyz'[i % 3]}" for j in range(10)) for i in range(9)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 9), pa.array(["a"] * 9), pa.array(texts)], ["lang", "source", "text"])
    made = list(divergence._count(iter([batch])))
    assert len(made) > 1
    total = Counter()
    for part in made:
        for term, n in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
            total[term] += n
    assert {t: n for t, n in total.items() if t} == dict(Counter(w for t in texts for w in t.split()))


@pytest.mark.parametrize("n, total, v", [(10**15, 10**16 + 3, 10**6), (2 * 10**17, 10**18 + 7, 3), (0, 0, 7), (4, 0, 0)])
def test_shares_are_exact(spark, n, total, v):
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(v)).alias("p")).first()["p"]
    assert got == (1 + 10**9 * (n + 5) // (total + 5 * v) if v else 0)
