"""Figures of a running job, bucketed side tables, listings, messages that cannot be read, functions of SQL."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from frames import rows
from quillmark.functions import scoring, sql, tokenizers
from quillmark.operators import counts, joins, profile, resume
from quillmark.plans import vectors
from quillmark.sources import readers, staging, writers
from quillmark.streaming import messages


def ws():
    return tokenizers.whitespace_tokens(F.col("text"))


def test_figures_of_the_steps_of_one_action(spark, corpus):
    watch = profile.Watch()
    texts = watch.through(corpus, "texts", **profile.records_and_bytes(F.col("text"), F.size(F.split("text", "\n"))))
    words = watch.through(counts.word_count(texts, ws()), "words", records=F.count("*"), tokens=F.sum("tf"))
    writers.materialise(words)
    n_bytes = sum(len(r["text"].encode()) + 1 for r in corpus.collect())
    assert watch.figures("texts") == {"records": 4, "n_bytes": n_bytes}
    assert watch.figures("words") == {"records": 10, "tokens": 14}
    shown = profile.input_profile(spark, {"texts": watch.figures("texts"), "none": {"records": 0, "n_bytes": 0}})
    assert rows(shown, "stage", "records", "bytes_per_record") == [("none", 0, 0.0), ("texts", 4, n_bytes / 4)]


def test_figures_of_nothing(corpus):
    watch = profile.Watch()
    writers.materialise(watch.through(corpus.where("false"), "none", records=F.count("*"), total=F.sum("doc_id")))
    assert watch.figures("none") == {"records": 0, "total": 0}


def test_one_tokenizing_pass(spark, corpus):
    """The observed steps are one plan: the texts are scanned once."""
    watch = profile.Watch()
    words = watch.through(counts.word_count(watch.through(corpus, "texts", n=F.count("*")), ws()), "words", n=F.count("*"))
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 2 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_a_bucketed_side_table_is_not_shuffled(spark, corpus):
    side = spark.createDataFrame([("the", 3), ("cat", 2), ("zebra", 9)], "word string, df long")
    path = staging.output_path(spark, "df")
    table = writers.write_bucketed(side, "test_df_buckets", path, "word")
    try:
        words = counts.word_count(corpus, ws())
        joined = joins.with_bucketed_df(words, table)
        assert rows(joined, "word", "df") == rows(joins.with_df(words, side), "word", "df")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # One exchange: that of the word count, which the join needs no other for.
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
    finally:
        spark.sql("DROP TABLE test_df_buckets")


def test_files_are_listed_without_being_read(spark, tmp_path):
    folder = str(tmp_path / "saved")
    docs = spark.createDataFrame([("a b.txt", "xyz"), ("c.txt", "é")], "file_name string, text string")
    writers.write_documents(docs, "file_name", folder)
    (tmp_path / "saved" / "file_name=empty.txt").mkdir()
    (tmp_path / "saved" / "file_name=empty.txt" / "part-0").touch()
    listing = readers.list_files(spark, folder)
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    saved = resume.saved_files(listing)
    assert rows(saved, "file_name", "n_bytes") == [("a b.txt", 4), ("c.txt", 3)]
    books = spark.createDataFrame([(1, "a b.txt"), (2, "empty.txt"), (3, "new.txt")], "id long, file_name string")
    assert rows(resume.pending(books, saved), "id") == [(2,), (3,)]


@pytest.fixture
def bad_messages(spark):
    path = staging.output_path(spark, "bad-messages")
    values = [bytearray(b"two words"), bytearray(b"\xc3("), None, bytearray(b""), bytearray("é à".encode()), bytearray(b"a \xff b")]
    spark.createDataFrame(list(enumerate(values)), "id long, value binary").repartition(3).write.parquet(path)
    return path


GOOD = [(0, 2), (3, 0), (4, 2)]
DEAD = [(1, bytearray(b"\xc3("), "not UTF-8"), (2, None, "no value"), (5, bytearray(b"a \xff b"), "not UTF-8")]


def test_unreadable_messages_stop_no_stream(spark, bad_messages):
    good, dead, checkpoint = (staging.output_path(spark, name) for name in ("good", "dead", "checkpoint"))

    def run():
        stream = messages.folder_stream(spark, bad_messages, "id long, value binary", maxFilesPerTrigger="1")
        messages.land_readable(stream, good, dead, checkpoint, ["id"]).awaitTermination()
        assert rows(spark.read.parquet(good), "id", "n_words") == GOOD
        assert rows(spark.read.parquet(dead), "id", "value", "reason") == DEAD

    run()
    # A batch whose end was not recorded is run again: it replaces what it wrote.
    batches = sorted(p for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit())
    assert len(batches) >= 3
    batches[-1].unlink()
    for crc in Path(checkpoint, "commits").glob(f".{batches[-1].name}.crc"):
        crc.unlink()
    run()
    run()


def test_functions_of_sql_equal_the_columns(spark):
    assert "unicode_tokens" in sql.register(spark)
    sql.register(spark)
    texts = ["The CAT, the\tdog\r\nÉTÉ naïve_x 12 a", "", "  ", None, "don't   x\x1cy"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    columns = {"whitespace_tokens": tokenizers.whitespace_tokens, "unicode_tokens": tokenizers.unicode_tokens,
               "ascii_tokens": tokenizers.ascii_tokens}
    for name, column in columns.items():
        got = docs.select("id", F.expr(f"{name}(text)"))
        assert got.collect() == docs.select("id", F.array_remove(column(F.col("text")), "")).collect()
    assert docs.selectExpr("message_words(text)").collect() == docs.select(tokenizers.message_words(F.col("text"))).collect()
    for name in ("idf_plain", "idf_ml", "idf_smooth"):
        want = getattr(scoring, name)(F.lit(10).cast("bigint"), F.lit(3).cast("bigint"))
        assert spark.range(1).select(F.expr(f"{name}(10L, 3L)")).first()[0] == spark.range(1).select(want).first()[0]


def test_functions_of_sql_run_no_python(spark, corpus):
    sql.register(spark)
    corpus.createOrReplaceTempView("sql_corpus")
    found = spark.sql("SELECT word, count(*) AS tf FROM (SELECT whitespace_tokens(text) AS words FROM sql_corpus) "
                      "LATERAL VIEW explode(words) AS word GROUP BY word")
    assert rows(found, "word", "tf") == rows(counts.word_count(corpus, ws()), "word", "tf")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "whitespace_tokens" not in plan


def _layout(folder):
    """Lines of the files of each folder that a scan reads."""
    found = {}
    for file in sorted(Path(folder).rglob("*")):
        if file.is_file() and not file.name.startswith((".", "_")):
            found.setdefault(str(file.parent.relative_to(folder)), []).append(sorted(file.read_bytes().split(b"\n")))
    return {below: sorted(contents) for below, contents in found.items()}


def test_documents_are_written_as_spark_writes_them(spark, tmp_path):
    ours, sparks = str(tmp_path / "ours"), str(tmp_path / "sparks")
    names = ["a b.txt", "a/b:c%d=e", "x'\"#*?\\{[]^\x01\x7f}", "", None, "c", "c"]
    texts = ["xyz\n", "two\nlines", "", "empty key", "null key", "same", "same"]
    docs = spark.createDataFrame([*zip(names, texts), ("null", None)], "k string, text string").repartition(2, "k")
    docs.select("k", "text").write.partitionBy("k").text(sparks)
    for _ in range(2):  # the second run replaces what the first one wrote
        writers.write_documents(docs, "k", ours)
    assert _layout(ours) == _layout(sparks) and Path(ours, "_SUCCESS").exists()
    # No checksum beside a text: it costs a file and a process.
    assert not list(Path(ours).rglob(".part*"))
    writers.write_documents(docs.where("false"), "k", ours)
    assert _layout(ours) == {} and readers.read_whole_files(spark, ours, recursive=True).count() == 0


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    folder = str(tmp_path / "many")
    most = readers.LISTING_TASKS * spark.sparkContext.defaultParallelism
    writers.write_documents(spark.range(3 * most).select("id", F.lit("a b").alias("text")), "id", folder)
    tracker = spark.sparkContext.statusTracker()
    before = spark.conf.get(readers._LISTING)
    for number, read in enumerate((readers.read_lines, readers.read_whole_files)):
        spark.sparkContext.setJobGroup(f"listing-{number}", "listing")
        try:
            files = read(spark, folder, recursive=True)
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(f"listing-{number}")]
        tasks = [tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
        assert tasks and max(tasks) <= most
        assert files.count() == 3 * most
    assert spark.conf.get(readers._LISTING) == before


def test_streams_of_files_list_by_few_tasks(spark, tiny_dir, monkeypatch):
    land, seen = messages.land, []

    def watched(*arguments):
        running = land(*arguments)
        running.awaitTermination()
        seen.append(int(spark.conf.get(readers._LISTING)))
        return running

    monkeypatch.setattr(messages, "land", watched)
    found = entry.queries()["stream_text_files"](spark, tiny_dir)
    assert found.count() == spark.read.parquet(f"{tiny_dir}/documents.parquet").count()
    most = readers.LISTING_TASKS * spark.sparkContext.defaultParallelism
    assert len(seen) == 2 and max(seen) <= most < int(spark.conf.get(readers._LISTING))


def test_vectorizer_stages_no_counts(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, []), (4, None)], "id long, tokens array<string>")
    with staging.job(spark) as folder:
        model = vectors.TermVectorizer(keyCols=["id"]).fit(docs)
        parts = vectors.vector_parts(model.transform(docs), ["id"])
        assert rows(parts.select("id", "indices"), "id", "indices") == [(1, [0, 1]), (2, [1]), (3, []), (4, [])]
        assert not [p.name for p in Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("document-terms")]
