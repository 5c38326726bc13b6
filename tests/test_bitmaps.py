"""Document frequency by bitmaps against the distinct rows that it replaces."""

import random

import pytest
from pyspark.sql import functions as F

from frames import rows
from quillmark.functions import tokenizers
from quillmark.operators import bitmaps, counts
from quillmark.sources import readers
from quillmark.sources.staging import stage


def _words():
    return tokenizers.unicode_tokens(F.col("line"))


def _both(docs, **options):
    by_bitmaps = bitmaps.document_frequency(docs, "doc_id", _words(), **options)
    by_rows = counts.document_frequency(docs, _words(), chunks_of=["doc_id"])
    return rows(by_bitmaps, "term", "df"), rows(by_rows, "term", "df")


def _pieces(spark, numbers, kind="long"):
    random.seed(3)
    words = ["hot"] * 20 + [f"w{i}" for i in range(60)]
    data = [(n, " ".join(random.choices(words, k=6))) for n in numbers for _ in range(3)]
    return spark.createDataFrame(data, f"doc_id {kind}, line string").repartition(5)


@pytest.mark.parametrize("least_bits", [1, 8, 10**9])
def test_equal_to_distinct_rows(spark, least_bits):
    around = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**62, -(2**62)]
    docs = _pieces(spark, [*range(300), *around, None])
    got, expected = _both(docs, least_bits=least_bits)
    assert got == expected and dict(expected)["hot"] > 250


def test_other_integers_null_texts_and_empty_tables(spark):
    got, expected = _both(_pieces(spark, range(-40, 40), "int"), least_bits=1)
    assert got == expected
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a a b"), (None, "a"), (2, "A")], "doc_id long, line string")
    assert _both(docs, least_bits=1)[0] == [("a", 2), ("b", 1)]
    assert _both(docs.limit(0))[0] == []


def test_one_document_in_many_pieces(spark):
    docs = spark.range(5000).select(F.lit(7).alias("doc_id"), F.lit("same words here").alias("line"))
    assert _both(docs, least_bits=1)[0] == [("here", 1), ("same", 1), ("words", 1)]


def test_documents_at_the_ends_of_words_and_bitmaps(spark):
    size = 64 * bitmaps.WORDS
    ends = [end + i for end in (64, size, 2 * size, -64, -size) for i in (-1, 0, 1)]
    numbers = [*ends, -1, 0, 2**63 - 1, 2**63 - 2, -(2**63), -(2**63) + 1]
    data = [(n, line) for n in numbers for line in ("all", "all once" if n == size else "all more")]
    docs = spark.createDataFrame(data, "doc_id long, line string").repartition(5)
    got, expected = _both(docs, least_bits=1)
    assert got == expected == [("all", len(numbers)), ("more", len(numbers) - 1), ("once", 1)]


def test_text_is_read_once_and_no_term_is_sorted(spark, tmp_path, monkeypatch):
    _pieces(spark, range(300)).write.parquet(f"{tmp_path}/docs")
    read = []
    make = bitmaps.frequent_filter

    def noted(terms, least, term, cells):
        read.extend(terms.inputFiles())
        return make(terms, least, term, cells=cells)

    monkeypatch.setattr(bitmaps, "frequent_filter", noted)
    result = bitmaps.document_frequency(spark.read.parquet(f"{tmp_path}/docs"), "doc_id", _words(), least_bits=1)
    read.extend(result.inputFiles())
    assert read and not [path for path in read if str(tmp_path) in path]
    assert not [p.nodeName() for p in _plans(result._jdf.queryExecution().executedPlan()) if "Sort" in p.nodeName()]


def _plans(plan):
    """Nodes of an executed plan, those of its stages included."""
    yield plan
    name = plan.getClass().getSimpleName()
    below = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else []
    children = plan.children()
    for child in below or [children.apply(i) for i in range(children.size())]:
        yield from _plans(child)


def _bytes_sent(df):
    """Bytes that the shuffles of a query wrote, after running it."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    exchanges = [p for p in _plans(execution.executedPlan()) if p.getClass().getSimpleName() == "ShuffleExchangeExec"]
    return sum(p.metrics().apply("shuffleBytesWritten").value() for p in exchanges)


def test_fewer_bytes_are_sent(spark, sf_dir, monkeypatch):
    # At sf0.01, with 125 documents a task, it does not pay.
    docs = spark.read.parquet(f"{sf_dir}/../sf0.1/documents.parquet").select("doc_id", "text")
    # Eight files, so that no shuffle of the input is counted.
    docs = stage(docs.repartitionByRange(8, "doc_id"), "docs")
    lines = readers.line_documents(docs, ["doc_id"])
    keep = tokenizers.keep(min_length=2)
    sketched = []
    make = bitmaps.frequent_filter

    def counted(terms, least, term, cells):
        named = terms.select(F.pmod(F.hash(term), F.lit(16)).alias("part"), F.xxhash64(term).bitwiseAND(F.lit((1 << 31) - 1)).alias("n"))
        sketches = named.groupBy("part").agg(F.count_min_sketch("n", F.lit(2 / cells), F.lit(0.75), F.lit(7)).alias("s"))
        sketched.append(_bytes_sent(sketches))
        return make(terms, least, term, cells=cells)

    monkeypatch.setattr(bitmaps, "frequent_filter", counted)
    by_bitmaps = _bytes_sent(bitmaps.document_frequency(lines, "doc_id", _words(), keep=keep))
    by_rows = _bytes_sent(counts.document_frequency(lines, _words(), keep=keep, chunks_of=["doc_id"]))
    print(f"rows {by_rows}, bitmaps {by_bitmaps}, sketch {sketched[0]}")
    assert by_bitmaps + sketched[0] < 0.85 * by_rows
