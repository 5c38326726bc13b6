"""Golden corpus, model properties, and the join beyond its broadcast budget."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RegexTokenizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from frames import rows
from quillmark.functions import scoring, tokenizers
from quillmark.functions.stopwords import ENGLISH_STOP_WORDS
from quillmark.operators import counts, joins
from quillmark.plans import tfidf, vectors
from quillmark.sources import readers

LONG = tokenizers.keep(2)
LINE_KEEP = tokenizers.keep(2, ENGLISH_STOP_WORDS)


def ws():
    return tokenizers.whitespace_tokens(F.col("text"))


def unicode():
    return tokenizers.unicode_tokens(F.col("text"))


def line():
    return tokenizers.ascii_tokens(F.col("line"))


def scored(df, *keys):
    return {tuple(r[k] for k in keys): round(r["tfidf"], 6) for r in df.collect()}


def word_counts(corpus):
    return counts.word_count(corpus, ws())


WORDS = {"a": 1, "café": 1, "cat": 2, "cat,": 1, "dog": 1, "dog_1": 1, "don't": 1, "sit": 1, "the": 4, "ÉtÉ": 1}


def test_corpus_word_count(corpus):
    assert dict(rows(word_counts(corpus), "word", "tf")) == WORDS


def test_corpus_chain(corpus):
    n_docs = F.lit(3)
    first = scored(tfidf.corpus_tfidf_first_pass(word_counts(corpus), n_docs), "word")
    assert first == {(w,): {"the": 1.62186, "cat": 0.81093}.get(w, 0.405465) for w in WORDS}
    final = scored(tfidf.corpus_tfidf_as_run(word_counts(corpus), n_docs), "word")
    assert final == {(w,): 0.405465 if w == "the" else 0.0 for w in WORDS}
    assert set(rows(tfidf.corpus_document_frequency(word_counts(corpus)), "df")) == {(1,)}


def test_document_scores_plain(corpus):
    got = scored(tfidf.document_tfidf(corpus, ["doc_id"], ws(), scoring.idf_plain), "doc_id", "term")
    once = 0.405465
    assert got == {
        (1, "a"): once, (1, "café"): once, (1, "cat,"): once, (1, "dog"): once, (1, "ÉtÉ"): once,
        (1, "the"): -0.575364,
        (2, "dog_1"): once, (2, "don't"): once, (2, "sit"): once, (2, "the"): -0.287682,
        (3, "cat"): 0.81093, (3, "the"): -0.287682,
    }


SMOOTH = {
    (1, "café"): 1.693147, (1, "dog"): 1.693147, (1, "été"): 1.693147, (1, "cat"): 1.287682, (1, "the"): 2.0,
    (2, "dog_1"): 1.693147, (2, "don"): 1.693147, (2, "sit"): 1.693147, (2, "the"): 1.0,
    (3, "cat"): 2.575364, (3, "the"): 1.0,
}


def test_document_scores_smooth(corpus):
    got = scored(tfidf.document_tfidf(corpus, ["doc_id"], unicode(), scoring.idf_smooth, LONG), "doc_id", "term")
    assert got == SMOOTH


@pytest.mark.parametrize("budget", [0.5, 100, 200, 10_000])
def test_scores_do_not_depend_on_the_budget(corpus, budget):
    df = tfidf.document_tfidf(corpus, ["doc_id"], unicode(), scoring.idf_smooth, LONG, budget=budget)
    assert scored(df, "doc_id", "term") == SMOOTH


def line_model(lines, keep=LINE_KEEP, **limits):
    terms = counts.term_frequency(lines, [], line(), keep=keep, document_rows=True)
    return tfidf.fit(counts.term_statistics(terms), **limits)


def test_line_scores_rows_and_vectors(corpus):
    lines = readers.line_documents(corpus, ["doc_id"])
    want = {(1, 0, "cat"): 0.510826, (3, 0, "cat"): 1.021651}
    key = ["doc_id", "line_no"]
    got = tfidf.document_tfidf(lines, key, line(), scoring.idf_ml, LINE_KEEP, min_df=2, vocab_size=500_000)
    assert scored(got, *key, "term") == want
    model = line_model(lines, min_df=2)
    staged = tfidf.document_tfidf(lines, key, line(), scoring.idf_ml, LINE_KEEP, min_df=2, stage_counts=True)
    assert scored(staged, *key, "term") == want
    model = line_model(lines, min_df=2)
    terms = tfidf.document_terms(lines, key, line(), LINE_KEEP)
    index = vectors.index_terms(model)
    parts = vectors.document_vectors(terms, key, index)
    assert scored(vectors.vector_rows(parts, key, index), *key, "term") == want
    ml = vectors.as_ml_vectors(parts)
    assert {(r[0], r[1], r[2]) for r in ml.collect()} >= {(2, 0, Vectors.sparse(1, [], []))}
    filled = vectors.vector_parts(ml, key).where("size(indices) > 0")
    assert [r[:3] for r in rows(filled, *key, "size")] == [(1, 0, 1), (3, 0, 1)]
    nothing = vectors.index_terms(line_model(lines, min_df=9))
    empty = vectors.document_vectors(terms, key, nothing)
    assert {r["size"] for r in empty.collect()} == {0} and empty.count() == lines.count()
    assert vectors.vector_rows(empty, key, nothing).isEmpty()


@pytest.mark.parametrize("budget", [0.5, 100, 10_000])
def test_vectors_do_not_depend_on_the_budget(corpus, budget):
    terms = tfidf.document_terms(corpus, ["doc_id"], tokenizers.ascii_tokens(F.col("text")), LONG)
    model = tfidf.fit(counts.term_statistics(terms))
    index = vectors.index_terms(model)
    want = sorted((r["doc_id"], tuple(r["indices"])) for r in vectors.document_vectors(terms, ["doc_id"], index).collect())
    parts = vectors.document_vectors(terms, ["doc_id"], index, budget)
    assert sorted((r["doc_id"], tuple(r["indices"])) for r in parts.collect()) == want
    got = vectors.vector_rows(parts, ["doc_id"], index, budget=budget)
    assert {tuple(r) for r in got.select("doc_id", "term").collect()} == {
        tuple(r) for r in terms.where("term IS NOT NULL").select("doc_id", "term").collect()
    }


def test_vectors_leave_no_terms_on_the_driver(corpus):
    """Terms are joined; no term is a literal of the plan, and no Python runs."""
    terms = tfidf.document_terms(corpus, ["doc_id"], tokenizers.ascii_tokens(F.col("text")), LONG)
    index = vectors.index_terms(tfidf.fit(counts.term_statistics(terms)))
    plan = vectors.document_vectors(terms, ["doc_id"], index)._jdf.queryExecution().toString()
    assert "LocalTableScan" not in plan and "LogicalRDD" not in plan and "Python" not in plan and "Join" in plan


def test_a_saved_pipeline_gives_the_same_vectors(corpus, tmp_path):
    stages = [
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern=tokenizers.NON_WORD_ASCII, minTokenLength=2),
        vectors.TermVectorizer(keyCols=["doc_id"], minDF=1, vocabSize=5),
    ]
    model = Pipeline(stages=stages).fit(corpus)
    path = str(tmp_path / "pipeline")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert rows(loaded.transform(corpus), "doc_id", "tfidf") == rows(model.transform(corpus), "doc_id", "tfidf")
    assert {v.size for _, v in rows(loaded.transform(corpus), "doc_id", "tfidf")} == {5}
    unknown = corpus.sparkSession.createDataFrame([(9, "zzz unseen"), (8, None)], "doc_id long, text string")
    known = PipelineModel(loaded.stages[1:])
    tokens = unknown.select("doc_id", F.split("text", " ").alias("tokens"))
    assert rows(known.transform(tokens), "doc_id", "tfidf") == [(8, Vectors.sparse(5, [], [])), (9, Vectors.sparse(5, [], []))]


def test_blank_lines_and_empty_documents_are_documents(spark, corpus):
    lines = readers.line_documents(corpus, ["doc_id"])
    blank = spark.createDataFrame([(9, "x\n\ny\n"), (10, "")], "doc_id long, text string")
    more = readers.line_documents(corpus.union(blank), ["doc_id"])
    assert more.count() == lines.count() + 3
    assert line_model(more).n_docs == lines.count() + 3
    assert tfidf.fit(counts.document_term_statistics(corpus.union(blank), ws())).n_docs == 5


def test_null_texts_are_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    assert tfidf.fit(counts.document_term_statistics(docs, ws())).n_docs == 3
    by_row = counts.term_frequency(docs, ["doc_id"], ws(), document_rows=True)
    assert rows(by_row.where("term is null"), "doc_id", "tf") == [(1, 0), (2, 0), (3, 0)]
    from quillmark.operators import profile

    assert profile.token_profile(docs, ws()).first()[:] == (3, 2, 2 / 3, 2)


def test_documents_in_several_rows(spark):
    docs = spark.createDataFrame([(1, "the cat"), (1, "the"), (2, "cat"), (2, None)], "doc_id long, text string")
    counted = counts.term_frequency(docs, ["doc_id"], ws(), chunked=True)
    assert rows(counted, "doc_id", "term", "tf") == [(1, "cat", 1), (1, "the", 2), (2, "cat", 1)]
    whole = counts.term_frequency(docs, ["doc_id"], ws(), document_rows=True, chunked=True)
    assert rows(whole.where("term is null"), "doc_id", "tf") == [(1, 0), (2, 0)]
    assert rows(counts.document_frequency(docs, ws(), chunks_of=["doc_id"]), "term", "df") == [("cat", 2), ("the", 1)]


def test_null_keys_stay_out_of_the_shuffle(spark):
    data = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)] * 50, "key string, id int")
    table = spark.createDataFrame([("a", 5)], "key string, value long")
    split = joins.join_on_key(data, table, "key", "left", budget=1)
    assert rows(split.fillna(-1).fillna("-"), "key", "id", "value") == sorted([("-", 1, -1), ("a", 2, 5), ("b", 3, -1)] * 50)


def test_no_documents_is_an_error(corpus):
    with pytest.raises(ValueError):
        tfidf.fit(counts.document_term_statistics(corpus.where("false"), ws()))


@pytest.mark.parametrize("budget", [1, 10_000])
def test_side_table_default(spark, corpus, budget):
    side = spark.createDataFrame([("the", 7), ("sit", 2), ("unused", 5)], "word string, df long")
    got = rows(joins.with_df(word_counts(corpus), side, budget=budget), "word", "tf", "df")
    assert got == sorted((w, n, {"the": 7, "sit": 2}.get(w, 1)) for w, n in WORDS.items())


def test_hot_keys_join(spark):
    """A third of the rows on one key, more rows on a key that the table lacks."""
    data = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "gone").otherwise(
            F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"), "id")
    table = spark.range(9000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
                                     F.col("id").alias("value"))
    table = table.union(spark.createDataFrame([("hot", -1)], "key string, value long"))
    for how in ("inner", "left"):
        want = rows(data.join(table, "key", how).fillna(-9), "key", "id", "value")
        split = joins.join_on_key(data, table, "key", how, budget=2000)
        assert rows(split.fillna(-9), "key", "id", "value") == want
        assert "Union" in split._jdf.queryExecution().toString()


def test_token_and_df_properties(corpus):
    tokens = counts.explode_tokens(corpus, ["doc_id"], ws())
    assert tokens.count() == word_counts(corpus).agg(F.sum("tf")).first()[0]
    assert counts.document_frequency(corpus, ws()).agg(F.max("df")).first()[0] <= corpus.count()
    grouped = tokens.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    assert rows(counts.term_frequency(corpus, ["doc_id"], ws()), "doc_id", "term", "tf") == rows(
        grouped, "doc_id", "term", "tf")
    assert rows(counts.document_frequency(corpus, ws()), "term", "df") == rows(
        counts.document_term_statistics(corpus, ws()).where("term is not null"), "term", "df")
    both = counts.term_statistics(counts.term_frequency(corpus, [], ws(), document_rows=True))
    assert both.where("term is null").select("df", "c").first()[:] == (3, 0)
    assert rows(both.where("term is not null"), "term", "c") == rows(word_counts(corpus), "word", "tf")


def test_limited_vocabulary(corpus):
    lines = readers.line_documents(corpus, ["doc_id"])
    assert rows(line_model(lines, LONG, vocab_size=2).vocabulary, "term", "c") == [("cat", 3), ("the", 4)]
    ranked = rows(line_model(lines, LONG).ranked(), "rank", "term")
    assert [term for _, term in ranked] == ["the", "cat", "caf", "dog", "dog_1", "don", "sit"]
