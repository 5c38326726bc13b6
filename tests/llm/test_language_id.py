import numpy as np
from pyspark.sql import functions as F

from quillmark.llm import language_id, queries
from quillmark.llm.language_id import LanguageModel, fit, held_out, identify, keep_identified


def test_held_out_accuracy(spark, sf_dir):
    found = queries.op1_language_id(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").select("lang", "lang_pred", "score", "accepted").collect()
    assert len(rows) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97
    assert np.mean([r["accepted"] for r in rows]) >= 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_follows_crc32(spark):
    import zlib

    ids = spark.range(200).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in ids)


def test_n_grams_equal_brute_force():
    """The n-grams of a text are those of its folded words with a blank at both ends, however it is cut."""

    def brute(text):
        folded = bytes(language_id._FOLD[b] for b in text.encode())
        form = b" " + b" ".join(folded.split()) + b" " if folded.split() else b" "
        grams = []
        for n in language_id.N_GRAMS:
            grams += [form[i : i + n] for i in range(len(form) - n + 1) if b" " not in form[i + 1 : i + n - 1]]
        return grams

    texts = ["Ab, c dé!", "", "  x ", "aaa\nbbb aaa", "é"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    owners, buckets = language_id.ngram_buckets(data, bounds)
    names = {}
    for i, text in enumerate(texts):
        grams = brute(text)
        assert np.count_nonzero(owners == i) == len(grams)
        alone = language_id.ngram_buckets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[1]
        assert sorted(alone.tolist()) == sorted(buckets[owners == i].tolist())
        for gram in grams:
            names.setdefault(gram, None)


def test_long_texts_are_read_whole(documents):
    model = fit(documents([(i, f"the cat {i} and dog", "en") for i in range(9)] + [(i, f"der und {i} ist", "de") for i in range(9, 18)]))
    once = "der hund und die katze ist "
    rows = identify(documents([(1, once * 2), (2, once * 60_000)]), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows] == ["de", "de"]
    assert abs(rows[0]["score"] - rows[1]["score"]) < 1e-3


def test_awkward_rows(awkward, nothing):
    model = fit(awkward)
    rows = {r["doc_id"]: r for r in identify(awkward, model).collect()}
    assert awkward.count() == 10 and identify(awkward, model).count() == 10
    for doc_id in (2, 3, 4, 6):
        assert (rows[doc_id]["lang_pred"], rows[doc_id]["score"], rows[doc_id]["accepted"]) == ("und", 0.0, False)
    kept = keep_identified(awkward, model)
    assert kept.columns == awkward.columns
    assert kept.where("doc_id in (2, 3, 4, 6)").count() == 0
    assert keep_identified(nothing, fit(nothing)).count() == 0
    without = identify(awkward, fit(nothing))
    assert {r["lang_pred"] for r in without.collect()} == {"und"}


def test_text_unlike_any_training_text_is_rejected(spark, sf_dir, documents):
    model = fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = identify(documents([(1, "ыва олд жщз цук енг шщх ъфы ролд"), (2, "the and of that with are this for")]), model)
    assert {r["doc_id"]: r["accepted"] for r in rows.collect()} == {1: False, 2: True}


def test_a_model_without_languages():
    model = LanguageModel([], np.zeros((4, 1)), np.zeros(0), 1.0, 0.0, 0.0)
    assert language_id.judge(model, __import__("pyarrow").array(["a"]), np.array([True]))[0].tolist() == ["und"]


def test_the_sample_is_bounded_whatever_repeats(spark):
    rows = [("one text that stands there many times", "en")] * 30_000 + [(f"der Text Nummer {i} ist ein anderer", "de") for i in range(900)]
    rows += [(f"language {i} has this text", f"x{i:03}") for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(8)
    sample = language_id.labelled_sample(docs, texts_per_language=50, most_languages=10).collect()
    counts = {}
    for r in sample:
        counts[r["lang"]] = counts.get(r["lang"], 0) + 1
    assert len(counts) == 10 and counts["de"] == 50 and max(counts.values()) == 50
    whole = language_id.labelled_sample(docs, texts_per_language=50).collect()
    assert sum(r["lang"] == "en" for r in whole) == 1
