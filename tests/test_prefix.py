"""Prefixes, corpus preparation, sentiment, streams, plans."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from frames import rows
from quillmark.functions import tokenizers
from quillmark.operators import joins, prefix, resume, sentiment
from quillmark.plans import corpus_prep
from quillmark.sources.staging import output_path
from quillmark.streaming import messages

SIZES = [random.Random(7).randrange(1, 60) for _ in range(500)]


def wanted_prefix(sizes, target):
    """The sequential rule: add items until the total reaches the target."""
    kept, total = [], 0
    for number, size in enumerate(sizes):
        total += size
        kept.append((number, total))
        if target > 0 and total >= target:
            break
    return kept


@pytest.mark.parametrize("target", [0, 1, 59, 1000, sum(SIZES[:100]), sum(SIZES), sum(SIZES) + 1])
def test_running_prefix(spark, target):
    df = spark.createDataFrame(list(enumerate(SIZES)), "id long, size long").repartition(5)
    got = prefix.running_prefix(df, ["id"], F.col("size"), target)
    assert rows(got, "id", "running_total") == wanted_prefix(SIZES, target)
    assert got.columns == ["id", "size", "running_total"]


def test_running_prefix_uses_no_global_window(spark):
    df = spark.range(1000)
    plan = prefix.running_prefix(df, ["id"], F.lit(1), 0)._jdf.queryExecution().toString()
    # The only window in one task is the one over slices.
    assert plan.split("== Physical Plan ==")[1].count("SinglePartition") == 1


@pytest.mark.parametrize("k", [1, 7, 400])
def test_top_k(spark, monkeypatch, k):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SIZES)], "id long, c long")
    order = [F.desc("c"), F.col("id")]
    want = [(r + 1, i) for r, (i, _) in enumerate(sorted(enumerate(SIZES), key=lambda p: (-p[1], p[0]))[:k])]
    assert rows(prefix.top_k(df, order, k), "rank", "id") == want
    monkeypatch.setattr(prefix, "SMALL_K", 0)
    assert rows(prefix.top_k(df, order, k), "rank", "id") == want


def test_select_books(spark):
    plain = "text/plain"
    entry = '{{"id": {0}, "title": "t", "formats": {{"{1}": "u{0}"}}}}'
    pages = [(p, '{"results": [' + ", ".join(entry.format(p * 10 + i, plain) for i in range(3)) + "]}") for p in (1, 2)]
    pages = spark.createDataFrame(pages, "page_no long, body string")
    raw = spark.createDataFrame([(f"u{p * 10 + i}", "x" * 10) for p in (1, 2) for i in range(3) if p + i != 3],
                                "url string, raw string")
    saved = spark.createDataFrame([("10_t.txt", 25), ("11_t.txt", 0), ("99_t.txt", 5)], "file_name string, n_bytes long")
    # 12 and 21 have no text; 10 is saved; the saved 11 is empty, so it counts anew.
    for budget in (1, 1 << 20):
        got = corpus_prep.select_books(pages, raw, saved, 40, budget=budget)
        assert rows(got, "id", "existing", "n_bytes", "running_bytes") == [
            (10, True, 25, 25), (11, False, 10, 35), (20, False, 10, 45)]
        files = corpus_prep.new_files(got, raw)
        assert rows(files, "file_name", "body") == [("11_t.txt", "x" * 10), ("20_t.txt", "x" * 10)]
    books = spark.createDataFrame([(10, "10_t.txt"), (11, "11_t.txt"), (12, "12_t.txt")], "id long, file_name string")
    assert rows(resume.pending(books, saved), "id") == [(11,), (12,)]
    assert rows(resume.already_saved(books, saved), "id", "saved_bytes") == [(10, 25)]


@pytest.mark.parametrize("budget", [1, 1 << 20])
def test_books_with_equal_names(spark, budget):
    """The first that has a text writes the file; to later ones it is there, with its size."""
    formats = ', "formats": {{"text/plain": "{}"}}'
    pages = [(n, '{"results": [{"x": 1' + formats.format(url) + "}]}") for n, url in enumerate(["empty", "z", "a", "gone"])]
    pages += [(9, '{"results": [{"id": 1, "title": "s"' + formats.format("s") + "}]}")]
    pages = spark.createDataFrame(pages, "page_no long, body string")
    raw = spark.createDataFrame([("z", "xxxxx"), ("a", "y"), ("empty", ""), ("s", "never read")], "url string, raw string")
    # A file listed twice counts once.
    saved = spark.createDataFrame([("1_s.txt", 3), ("1_s.txt", 7)], "file_name string, n_bytes long")
    got = corpus_prep.select_books(pages, raw, saved, 0, budget=budget)
    assert rows(got, "page_no", "file_name", "existing", "n_bytes", "running_bytes") == [
        (0, "0_book.txt", False, 0, 0), (1, "0_book.txt", False, 5, 5), (2, "0_book.txt", True, 5, 10),
        (3, "0_book.txt", True, 5, 15), (9, "1_s.txt", True, 7, 22)]
    assert rows(corpus_prep.new_files(got, raw), "file_name", "body") == [("0_book.txt", "xxxxx")]


def test_texts_are_cleaned_after_the_join(spark):
    raw = spark.createDataFrame([("u", "t")], "url string, raw string")
    chosen = spark.createDataFrame([(1, 0, "u", "f", False)], "page_no long, position int, url string, file_name string, existing boolean")
    plan = corpus_prep.new_files(chosen, raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("substring") < plan.index("Join")


@pytest.mark.parametrize("budget", [1, 1 << 20])
def test_sentiment(spark, budget):
    lexicon = spark.createDataFrame([("good", 2), ("bad", -1), ("awful", -3)], "term string, polarity int")
    docs = [(1, "Good good bad"), (2, "bad day"), (3, "good bad BAD"), (4, "none"), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sentiment.lexicon_sentiment(df, "doc_id", tokenizers.unicode_tokens(F.col("text")), lexicon, budget)
    assert rows(got, "doc_id", "score", "sentiment") == [
        (1, 3, "positive"), (2, -1, "negative"), (3, 0, "neutral"), (4, 0, "neutral"), (5, 0, "neutral")]


@pytest.mark.parametrize("name", ["lexicon_sentiment", "df_side_table_scores"])
def test_rows_of_a_join_beyond_the_budget_are_computed_once(spark, tiny_dir, monkeypatch, name):
    wanted = registry.queries()[name](spark, tiny_dir).collect()
    for module in (joins, sentiment):
        monkeypatch.setattr(module, "BROADCAST_BYTES", 1)
    for function in (joins.join_on_key, joins.with_df, sentiment.lexicon_sentiment):
        monkeypatch.setattr(function, "__defaults__", tuple(1 if d == 64 * 1024 * 1024 else d for d in function.__defaults__))
    again = registry.queries()[name](spark, tiny_dir)
    # What is tokenized is staged, so the texts are split in no branch of the plan but one over all documents.
    assert again._jdf.queryExecution().optimizedPlan().toString().count("split(") == 0
    assert sorted(again.collect()) == sorted(wanted)


def test_stream_in_batches_and_resume(spark, tmp_path):
    texts = [f"message {i} " + "w " * i for i in range(12)]
    source = str(tmp_path / "topic")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sent = messages.as_messages(df, ["id"])
    messages.publish(sent.where("id < 8").repartition(4), "parquet", path=source)
    out, checkpoint = output_path(spark, "out"), output_path(spark, "out-checkpoint")

    def run():
        stream = messages.folder_stream(spark, source, sent.schema, maxFilesPerTrigger="1")
        query = messages.land(messages.count_words(stream, ["id"]), out, checkpoint)
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    assert sum(run()) == 8
    messages.publish(sent.where("id >= 8").coalesce(1), "parquet", path=source)
    assert run() == [4]  # only what was not there before
    want = [(i, len(t.split())) for i, t in enumerate(texts)]
    assert rows(spark.read.parquet(out), "id", "n_words") == want
    assert rows(messages.count_words(sent, ["id"]), "id", "n_words") == want


def test_text_files_as_messages(spark, tmp_path):
    for name, body in (("a.txt", "one\ntwo"), ("b.txt", "drei é")):
        (tmp_path / name).write_text(body)
    stream = messages.text_file_stream(spark, str(tmp_path))
    out = output_path(spark, "files")
    messages.land(messages.count_words(stream), out, output_path(spark, "files-checkpoint")).awaitTermination()
    assert rows(spark.read.parquet(out), "n_words") == [(2,), (2,)]


LAZY = ["ws_word_count", "re_term_frequency", "re_document_frequency", "re_tfidf_smooth", "ws_tfidf_by_doc",
        "line_tfidf", "corpus_tfidf_as_run", "lexicon_sentiment"]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_in_the_jvm(spark, tiny_dir, name):
    plan = registry.queries()[name](spark, tiny_dir)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in physical


def test_term_frequency_has_no_shuffle(spark, corpus):
    from quillmark.operators.counts import term_frequency

    df = term_frequency(corpus, ["doc_id"], tokenizers.whitespace_tokens(F.col("text")))
    assert "Exchange" not in df._jdf.queryExecution().toString()


def test_corpus_chain_shuffles_words_once(spark, tiny_dir):
    plan = registry.queries()["corpus_tfidf_as_run"](spark, tiny_dir)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning(word") == 1


def test_no_text_is_dealt_out_unless_a_caller_asks(spark, tiny_dir):
    spark.conf.set("spark.quillmark.partitions", "0")
    try:
        for name in ("ws_word_count", "re_term_frequency", "line_documents"):
            assert "RoundRobin" not in registry.queries()[name](spark, tiny_dir)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.quillmark.partitions", "8")
