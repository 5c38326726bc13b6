"""Tokenizers, clean-up, catalog, records and profiles on hand-made cases."""

import sys

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from frames import rows
from quillmark.functions import stopwords, text, tokenizers
from quillmark.operators import counts, profile
from quillmark.sources import catalog, readers, writers
from quillmark.sources import staging
from quillmark.sources.staging import staging_path


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


def tokens(spark, value, tokenizer, keep=tokenizers.NOT_EMPTY):
    df = spark.createDataFrame([(value,)], "x string")
    return [r[0] for r in counts.explode_tokens(df, [], tokenizer(F.col("x")), keep=keep).collect()]


def test_whitespace_tokens(spark):
    assert tokens(spark, "", tokenizers.whitespace_tokens) == []
    assert tokens(spark, " \t\r\n ", tokenizers.whitespace_tokens) == []
    assert tokens(spark, "a\r\nb", tokenizers.whitespace_tokens) == ["a", "b"]
    assert tokens(spark, "Ab\x0bC É", tokenizers.whitespace_tokens) == ["ab\x0bc É"]
    assert one(spark, "AÉz", tokenizers.ascii_lower) == "aÉz"


def test_ascii_tokens(spark):
    got = tokens(spark, "Für ÉTÉ don't naïve_x 12 a", tokenizers.ascii_tokens, tokenizers.keep(2))
    assert got == ["don", "na", "ve_x", "12"]


def test_unicode_word_class_is_pythons(spark):
    import re

    codes = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in codes], "code int, x string")
    # The JVM may know an older Unicode version; compare the characters that it knows.
    known = df.where(~F.col("x").rlike(r"\p{Cn}"))
    got = known.select("code", (~F.col("x").rlike(tokenizers.NON_WORD_UNICODE)).alias("word")).collect()
    assert len(got) > 90_000
    assert [c for c, word in got if word != bool(re.fullmatch(r"\w", chr(c)))] == []


def test_message_words_are_pythons(spark):
    spaces = [c for c in range(1, sys.maxunicode) if chr(c).isspace()]
    cases = ["", "  a b ", "a　b c", "x"] + [f"a{chr(c)}b" for c in spaces] + ["a​b", "a﻿b"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    got = dict(rows(df.select("i", tokenizers.message_words(F.col("x")).alias("n")), "i", "n"))
    assert got == {i: len(c.split()) for i, c in enumerate(cases)}


def test_payload_round_trip_and_bad_bytes(spark):
    df = spark.createDataFrame([("naïve — ÉTÉ",)], "x string")
    back = df.select(tokenizers.from_payload(tokenizers.to_payload(F.col("x"))))
    assert back.first()[0] == "naïve — ÉTÉ"
    bad = spark.createDataFrame([(bytearray(b"\xff\xfe"),)], "v binary")
    with pytest.raises(Exception):
        bad.select(tokenizers.from_payload(F.col("v"))).collect()


def test_stop_words_are_sparks(spark):
    assert sorted(stopwords.ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


A, B = text.START_MARKERS
EA, EB = text.END_MARKERS


@pytest.mark.parametrize("raw, body", [
    (f"head\n{A} X ***\nbody é\n{EA} X\nfoot", "\nbody é\n"),
    (f"head\n{B} X***\nbody\n{EB} X\nfoot", "\nbody\n"),
    (f"{A}\none {EA} two {EA} three", "\none " + EA + " two "),
    (f"{A}\na\n{A}\nb", f"\na\n{A}\nb"),
    (f"{B} first\nx\n{A} second\ny", "\ny"),
    (f"text {A} no newline", f"text {A} no newline"),
    (f"{EA} early\n{A}\nrest", f"{EA} early\n{A}\nrest"),
    (f"only end {EA} x", "only end "),
    (f"{EA} at once", f"{EA} at once"),
    ("no marker", "no marker"),
    ("", ""),
])
def test_strip_boilerplate(spark, raw, body):
    assert one(spark, raw, text.strip_boilerplate) == body


@pytest.mark.parametrize("number, title, name", [
    (1, "A Tale\tof: Two—Cities", "1_A_Tale_of_TwoCities.txt"),
    (2, "???", "2_book.txt"),
    (3, "x" * 80, "3_" + "x" * 60 + ".txt"),
    (4, "a-b_c", "4_a-b_c.txt"),
])
def test_safe_file_name(spark, number, title, name):
    assert one(spark, title, lambda c: text.safe_file_name(F.lit(number), c)) == name


def test_size_in_bytes():
    assert text.size_in_bytes(2, "GB") == text.size_in_bytes(2, "gb") == 2 * 1024**3
    assert text.size_in_bytes(3, "MB") == text.size_in_bytes(3, "Gb") == 3 * 1024**2


def book(number, formats, title='"T"'):
    return f'{{"id": {number}, "title": {title}, "formats": {formats}}}'


def test_catalog(spark):
    utf8, ascii_, plain = text.TEXT_MEDIA_TYPES
    pages = [
        (1, '{"results": [' + ", ".join([
            book(1, f'{{"{utf8}": "u.zip", "{ascii_}": "a.txt", "{plain}": "p.txt"}}'),
            book(2, '{"text/plain; charset=z": "z", "text/plain; charset=iso": "i"}'),
            book(3, '{"text/html": "h"}'),
            '{"id": 4, "title": "no formats"}',
            book(5, f'{{"{plain}": 7, "text/plain; charset=q": "q"}}'),
            f'{{"formats": {{"{plain}": "d"}}}}',
            book(7, f'{{"{plain}": "x.zip"}}'),
        ]) + ']}'),
        (2, '{"results": ['),
        (3, '{"results": []} tail'),
        (4, ""),
        (5, '{"results": [' + book(8, f'{{"{plain}": "e"}}') + ']}'),
        (6, '{"results": []}'),
        (7, '{"results": [' + book(9, f'{{"{plain}": "late"}}') + ']}'),
    ]
    df = spark.createDataFrame(pages, "page_no long, body string")
    books = catalog.text_books(catalog.read_catalog(df))
    assert rows(books, "page_no", "position", "id", "url", "file_name") == [
        (1, 0, 1, "a.txt", "1_T.txt"),
        (1, 1, 2, "i", "2_T.txt"),
        (1, 4, 5, "q", "5_T.txt"),
        (1, 5, 0, "d", "0_book.txt"),
        (5, 0, 8, "e", "8_T.txt"),
    ]


@pytest.mark.parametrize("body", ["[1]", "{}", '{"results": 5}', "3", "null"])
def test_catalog_ends_without_a_list(spark, body):
    good = '{"results": [{"id": 1, "formats": {"text/plain": "u"}}]}'
    df = spark.createDataFrame([(1, good), (2, body), (3, good)], "page_no long, body string")
    assert rows(catalog.read_catalog(df), "page_no") == [(1,)]


def test_catalog_languages(spark):
    plain = '"formats": {"text/plain": "u"}'
    body = '{"results": [%s]}' % ", ".join([
        '{"id": 1, "languages": ["en"], %s}' % plain, '{"id": 2, "languages": ["fr", "de"], %s}' % plain,
        '{"id": 3, %s}' % plain, '{"id": 4, "languages": [], %s}' % plain, '{"id": 5, "languages": "en", %s}' % plain,
        '{"id": 6, "languages": ["en", null], %s}' % plain,
    ])
    books = catalog.read_catalog(spark.createDataFrame([(1, body)], "page_no long, body string"))
    assert rows(catalog.text_books(books, ["en", "de"]), "id") == [(1,), (2,), (6,)]
    assert rows(catalog.text_books(books), "id") == [(1,), (2,), (3,), (4,), (5,), (6,)]


def test_key_value_records(spark):
    lines = ["no tab", "w\tx", "w\t2", "w\t1.62", "w\t-0.4", "\t5", "a\tb\t3", "w\t +7 z", ""]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    assert rows(readers.parse_key_values(df), "word", "n") == [("w", 0), ("w", 1), ("w", 2), ("w", 7)]
    assert rows(readers.parse_key_values(df, strict=False), "word", "n") == [
        ("", 5), ("a", 0), ("w", 0), ("w", 0), ("w", 1), ("w", 2), ("w", 7)]
    assert rows(counts.sum_by_key(readers.parse_key_values(df)), "word", "n") == [("w", 10)]


def test_record_lines_round_trip(spark):
    words = [('"the', 1), ("#h", 2), ("\\x", 3), ("a'b", 4), ("é,", 5)]
    df = spark.createDataFrame(words, "word string, n long")
    path = staging_path(spark, "records")
    writers.write_lines(writers.key_value_lines(df, "word", "n"), path, single_file=True)
    assert rows(readers.parse_key_values(spark.read.text(path)), "word", "n") == sorted(words)
    scores = spark.createDataFrame([("a", 1.5), ("b", -0.4054651081)], "word string, s double")
    assert rows(writers.score_lines(scores, "word", "s"), "value") == [("a\t1.500000",), ("b\t-0.405465",)]


def test_sorted_parts(spark):
    df = spark.createDataFrame([(w, 1) for w in "q w e r t y u i o p".split()], "word string, n long")
    assert [r[0] for r in writers.sorted_by_word(df, "word").collect()] == sorted("qwertyuiop")


def test_parquet_in_parts(spark):
    path = staging_path(spark, "parts")
    writers.write_table(spark.range(100), path, files=3)
    assert len(spark.read.parquet(path).inputFiles()) == 3
    writers.write_table(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7


def test_staging_folder(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    assert staging.staging_root(spark) == root
    assert staging_path(spark, "x").startswith(root + "/quillmark-")
    staged = staging.stage(spark.range(5), "five")
    assert staged.count() == 5
    monkeypatch.setattr(staging, "_SETTING", "spark.checkpoint.not.set")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(RuntimeError):
        staging.staging_root(spark)
    monkeypatch.undo()
    written = staging.output_path(spark, "kept")
    writers.write_table(spark.range(3), written)
    staging.drop_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(staged.inputFiles()[0]).count()
    assert spark.read.parquet(written).count() == 3


def test_a_job_takes_its_staged_tables_with_it(spark):
    outside = staging.stage(spark.range(2), "outside")
    with staging.job(spark):
        inside = staging.stage(spark.range(5), "inside")
        assert inside.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(inside.inputFiles()[0]).count()
    assert outside.count() == 2


def test_file_scans(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes(b"one\ntwo\n\nthree\n")
    (tmp_path / "sub" / "b.txt").write_bytes(b"four")
    path = str(tmp_path)
    assert rows(readers.read_lines(spark, path), "line") == [("",), ("one",), ("three",), ("two",)]
    assert readers.read_lines(spark, path, recursive=True).count() == 5
    whole = readers.read_whole_files(spark, path, recursive=True)
    assert rows(whole, "text") == [("four",), ("one\ntwo\n\nthree\n",)]
    by_scan = rows(readers.read_lines(spark, path, recursive=True), "line")
    assert rows(readers.line_documents(whole, ["path"]), "line") == by_scan


@pytest.mark.parametrize("body", ["a\r\nb\rc", "a\n", "\n", "a\n\n", "x", "a\r\n"])
def test_lines_in_a_row_equal_a_line_scan(spark, tmp_path, body):
    (tmp_path / "f.txt").write_bytes(body.encode())
    scan = [r[0] for r in spark.read.text(str(tmp_path)).collect()]
    df = spark.createDataFrame([(1, body)], "doc_id long, text string")
    assert [line for _, line in rows(readers.line_documents(df, ["doc_id"]), "line_no", "line")] == scan


def test_profiles(spark, corpus):
    empty = spark.createDataFrame([(4, "")], "doc_id long, text string")
    docs = corpus.union(empty)
    got = profile.corpus_profile(docs).first()
    texts = [r["text"] for r in docs.collect()]
    assert got["n_docs"] == 4
    assert got["total_chars"] == sum(map(len, texts))
    assert got["total_bytes"] == sum(len(t.encode()) for t in texts)
    assert got["total_lines"] == 4
    unicode = tokenizers.unicode_tokens(F.col("text"))
    assert profile.token_profile(docs, unicode, tokenizers.keep(2)).first()[:] == (4, 13, 3.25, 8)
    nothing = profile.token_profile(docs.where("false"), unicode).first()
    assert nothing[:] == (0, 0, 0.0, 0)
    with pytest.raises(ValueError):
        profile.require_documents(docs.where("false"))
