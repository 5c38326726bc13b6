import hashlib
import random
import re

import pytest

from quillmark.llm import decontamination
from quillmark.llm.decontamination import contamination, find_passages, keep_clean

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    found = []
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for name, item in items:
            w = words(item)
            for i in range(max(len(w) - 9, 1) if w else 0):
                window = w[i : i + 10]
                for at in range(len(own) - len(window) + 1):
                    if own[at : at + len(window)] == window:
                        hit |= set(range(at, at + len(window)))
                        names.add(str(name))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(found, key=repr)


def result(spark, docs, items, **options):
    made = contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"), **options)
    return sorted([tuple(r) for r in made.collect()], key=repr)


@pytest.fixture(scope="module")
def planted():
    random.seed(5)
    pool = ["a", "bb", "the", "ünd", "Éa", "x1", "word", "longerword", "z" * 40]
    text = lambda n: "".join(random.choice(pool) + random.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(random.choice([1, 2, 3, 9, 10, 11, 30]))) for i in range(25)] + [(3, text(15)), (30, ""), (31, None)]
    docs = [(i, text(random.choice([0, 1, 5, 40, 400]))) for i in range(60)]
    docs += [(100 + i, text(20) + " " + (item or "").upper() + "." + text(20)) for i, (_, item) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "%%% ..."), (202, "%%% ...")]
    return docs, items


def test_equal_to_brute_force(spark, planted):
    docs, items = planted
    assert result(spark, docs, items) == brute(docs, items)


def test_a_benchmark_in_several_blocks(spark, planted, monkeypatch):
    docs, items = planted
    build = decontamination.build_patterns
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, names = find_passages(frame, bench)
    made = []
    monkeypatch.setattr(decontamination, "build_patterns", lambda *given: made.append(build(*given)) or made[-1])
    many, _ = find_passages(frame, bench, block_bytes=500)
    assert len(made) > 8 and max(p.numbers.nbytes for p in made) < 2500
    assert many._jdf.queryExecution().toString().count("MapInArrow ") <= 4  # one in each of the four plans
    columns = ["doc_id", *names.values()]
    assert sorted(one.select(*columns).collect(), key=repr) == sorted(many.select(*columns).collect(), key=repr)


def test_long_texts_are_searched_whole(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    filler = " ".join(f"w{i % 900}" for i in range(200_000))
    rows = result(spark, [(1, f"{filler} {passage} {filler} {passage}"), (2, filler)], [(7, passage)])
    assert [(r[0], r[1], r[2], r[3], r[5]) for r in rows] == [(1, 400_024, 24, 1, True), (2, 200_000, 0, 0, False)]


def test_clean_documents_stay(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "The CAT sat, on the mat!"), (None, "ß"), (2, None)], "item_id long, text string")
    kept = keep_clean(awkward, bench)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([2, 3, 4, None, 5, 6, 8], key=repr)
    assert keep_clean(nothing, bench).count() == 0
    assert keep_clean(awkward, bench.limit(0)).count() == awkward.count()
    assert contamination(awkward, bench).where("contaminated").count() == 3


def test_windows_are_those_of_the_items(spark, planted):
    _, items = planted
    made = decontamination.windows_of(spark.createDataFrame(items, "item_id long, text string")).collect()
    wanted = {(str(n), " ".join(w[i : i + 10])) for n, w in ((n, words(t)) for n, t in items) if w
              for i in range(max(len(w) - 9, 1))}
    assert len(made) == len(wanted) and {tuple(r) for r in made} == wanted


def test_no_patterns():
    assert decontamination.build_patterns([]).classes == []
