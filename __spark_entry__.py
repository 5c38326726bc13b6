"""Registered queries, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import scoring, sql, text, tokenizers
from quillmark.functions.stopwords import ENGLISH_STOP_WORDS
from quillmark.operators import bitmaps, counts, joins, prefix, profile, resume, sentiment, sketches
from quillmark.plans import corpus_prep, tfidf, vectors
from quillmark.sources import catalog, readers, writers
from quillmark.sources.staging import output_path, stage, stage_each
from quillmark.streaming import messages

# The operators for training data are a part that can be left out.
try:
    import corpus_pipeline
    from quillmark.llm import queries as _training_data
except ImportError:
    _TRAINING_DATA_QUERIES, _TRAINING_DATA_ORACLE = {}, {}
else:
    _TRAINING_DATA_QUERIES = _training_data.QUERIES | {"pipeline": corpus_pipeline.run}
    _TRAINING_DATA_ORACLE = _training_data.ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL equivalent."""

    def register(function: Query) -> Query:
        _QUERIES[name] = function
        _ORACLE[name] = sql
        return function

    return register


def entry(spark: SparkSession) -> DataFrame:
    """Smoothed TF-IDF of every term in every document."""
    return queries()["re_tfidf_smooth"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {name: _with_folder(function) for name, function in (_QUERIES | _TRAINING_DATA_QUERIES).items()}


def _with_folder(function: Query) -> Query:
    """A local session that names no shared folder gets a temporary one, as in tests."""

    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and context.master.startswith("local") and not context.master.startswith("local-cluster"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="quillmark-"))
        return function(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return _ORACLE | _TRAINING_DATA_ORACLE


# Inputs

DOC = ["doc_id"]
LINE = ["doc_id", "line_no"]
LONG = tokenizers.keep(min_length=2)
LINE_KEEP = tokenizers.keep(min_length=2, stop_words=ENGLISH_STOP_WORDS)


# Columns need a session, so they are made when a query runs.


def _text() -> Column:
    return F.col("text")


def _ws() -> Column:
    return tokenizers.whitespace_tokens(_text())


def _re() -> Column:
    return tokenizers.unicode_tokens(_text())


def _line_tokens() -> Column:
    return tokenizers.ascii_tokens(F.col("line"))


def _table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """Columns of a table, over as many tasks as the session asks for; 0 takes the scan as it is."""
    partitions = int(spark.conf.get("spark.quillmark.partitions", "0"))
    return readers.read_table(spark, f"{sf_dir}/{name}.parquet", columns, partitions)


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _table(spark, sf_dir, "documents", ["doc_id", "text", *columns])


def _n_docs(spark: SparkSession, sf_dir: str) -> Column:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").agg(F.count("*")).scalar()


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.line_documents(_docs(spark, sf_dir), DOC)


def _rounded(scores: DataFrame, column: str = "tfidf") -> DataFrame:
    return scores.withColumn(column, scoring.six_decimals(F.col(column)))


# SQL shared by several oracles

_UPPER, _LOWER = tokenizers.ASCII_UPPER, tokenizers.ASCII_LOWER
_SQL_WS = (
    "ws AS (SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split_regex("
    rf"translate(text, '{_UPPER}', '{_LOWER}'), '[ \t\n\r]+')) AS word FROM documents) WHERE word <> '')"
)
_SQL_RE = (
    "re AS (SELECT doc_id, term FROM (SELECT doc_id, unnest(string_split_regex("
    r"lower(text), '[^\p{L}\p{N}_]+')) AS term FROM documents) WHERE length(term) >= 2)"
)
_SQL_N = "n AS (SELECT count(*)::DOUBLE AS n FROM documents)"
_SQL_RE_TF = f"{_SQL_RE}, tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM re GROUP BY ALL)"
_SQL_RE_DF = f"{_SQL_RE_TF}, df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term)"
_SQL_WC = f"{_SQL_WS}, wc AS (SELECT word, count(*)::BIGINT AS tf FROM ws GROUP BY word)"
_SQL_LINES = (
    "lines AS (SELECT doc_id, source, unnest(range(len(l)))::INT AS line_no, unnest(l) AS line FROM "
    r"(SELECT doc_id, source, string_split(regexp_replace(text, '\n\z', ''), chr(10)) AS l "
    "FROM documents WHERE text <> ''))"
)
_STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
_SQL_LINE_TOKENS = (
    f"{_SQL_LINES}, tokens AS (SELECT doc_id, line_no, token FROM (SELECT doc_id, line_no, "
    "unnest(string_split_regex(lower(line), '[^a-z0-9_]+')) AS token FROM lines) "
    f"WHERE length(token) >= 2 AND token NOT IN ({_STOP_LIST}))"
)
_SQL_VOCABULARY = (
    f"{_SQL_LINE_TOKENS}, ltf AS (SELECT doc_id, line_no, token AS term, count(*) AS tf FROM tokens GROUP BY ALL), "
    "known AS (SELECT term, sum(tf)::BIGINT AS c, count(*)::BIGINT AS df FROM ltf GROUP BY term HAVING count(*) >= 2), "
    "vocabulary AS (SELECT term, df, c, row_number() OVER (ORDER BY c DESC, term) AS rank FROM known "
    "QUALIFY rank <= 500000), n AS (SELECT count(*)::DOUBLE AS n FROM lines)"
)


# Word counts and tokens


@query("ws_word_count", f"WITH {_SQL_WC} SELECT word, tf FROM wc")
def ws_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.word_count(_docs(spark, sf_dir), _ws())


@query("sql_word_count", f"WITH {_SQL_WC} SELECT word, tf FROM wc")
def sql_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word count as one statement over the library's SQL functions."""
    sql.register(spark)
    return spark.sql(
        "SELECT word, count(*) AS tf FROM (SELECT whitespace_tokens(text) AS words FROM {docs}) "
        "LATERAL VIEW explode(words) AS word GROUP BY word",
        docs=_docs(spark, sf_dir),
    )


@query("text_line_word_count", f"WITH {_SQL_WC} SELECT word, tf FROM wc")
def text_line_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word count from text files read by line."""
    path = output_path(spark, "corpus-text")
    writers.write_lines(_table(spark, sf_dir, "documents", ["text"]), path)
    return counts.word_count(readers.read_lines(spark, path), tokenizers.whitespace_tokens(F.col("line")))


@query("ws_tokens", f"WITH {_SQL_WS} SELECT doc_id, word FROM ws")
def ws_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.explode_tokens(_docs(spark, sf_dir), DOC, _ws(), "word")


@query("re_tokens", f"WITH {_SQL_RE} SELECT doc_id, term FROM re")
def re_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.explode_tokens(_docs(spark, sf_dir), DOC, _re(), keep=LONG)


@query(
    "re_distinct_terms",
    f"WITH {_SQL_RE} SELECT doc_id, count(DISTINCT term)::BIGINT AS n_terms FROM documents LEFT JOIN re USING (doc_id) "
    "GROUP BY doc_id",
)
def re_distinct_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_enough = F.filter(F.array_distinct(_re()), lambda t: F.length(t) >= 2)
    return _docs(spark, sf_dir).select("doc_id", F.size(long_enough).cast("bigint").alias("n_terms"))


@query(
    "ascii_word_count",
    "SELECT term, count(*)::BIGINT AS tf FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9_]+')) AS term "
    "FROM documents) WHERE length(term) >= 2 GROUP BY term",
)
def ascii_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.word_count(_docs(spark, sf_dir), tokenizers.ascii_tokens(_text()), "term", keep=LONG)


# Document TF-IDF


@query("re_term_frequency", f"WITH {_SQL_RE_TF} SELECT doc_id, term, tf FROM tf")
def re_term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.term_frequency(_docs(spark, sf_dir), DOC, _re(), keep=LONG)


@query("re_document_frequency", f"WITH {_SQL_RE_DF} SELECT term, df FROM df")
def re_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.document_frequency(_docs(spark, sf_dir), _re(), keep=LONG)


@query(
    "re_idf_smooth",
    f"WITH {_SQL_RE_DF}, {_SQL_N} SELECT term, df, round(ln((n + 1) / (df + 1)) + 1, 6) + 0.0::DOUBLE AS idf FROM df, n",
)
def re_idf_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tfidf.fit(counts.document_term_statistics(_docs(spark, sf_dir), _re(), LONG))
    return _rounded(model.idf(scoring.idf_smooth), "idf")


@query(
    "idf_with_missing_texts",
    f"WITH d AS (SELECT doc_id, CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS text FROM documents), "
    f"{_SQL_RE_DF.replace('FROM documents', 'FROM d')}, {_SQL_N} "
    "SELECT term, df, round(ln((n + 1) / (df + 1)) + 1, 6) + 0.0::DOUBLE AS idf FROM df, n",
)
def idf_with_missing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text is null or empty count as documents."""
    rest = F.col("doc_id") % 11
    missing = F.when(rest == 0, F.lit(None)).when(rest == 1, "").otherwise(_text())
    docs = _docs(spark, sf_dir).withColumn("text", missing)
    return _rounded(tfidf.fit(counts.document_term_statistics(docs, _re(), LONG)).idf(scoring.idf_smooth), "idf")


@query("re_term_frequency_of_lines", f"WITH {_SQL_RE_TF} SELECT doc_id, term, tf FROM tf")
def re_term_frequency_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of documents that come in several rows, here their lines."""
    tokens = tokenizers.unicode_tokens(F.col("line"))
    return counts.term_frequency(_lines(spark, sf_dir), DOC, tokens, keep=LONG, chunked=True)


@query("re_document_frequency_of_lines", f"WITH {_SQL_RE_DF} SELECT term, df FROM df")
def re_document_frequency_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokenizers.unicode_tokens(F.col("line"))
    return counts.document_frequency(_lines(spark, sf_dir), tokens, keep=LONG, chunks_of=DOC)


@query("bitmap_document_frequency", f"WITH {_SQL_RE_DF} SELECT term, df FROM df")
def bitmap_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from bitmaps of document numbers."""
    return bitmaps.document_frequency(_lines(spark, sf_dir), "doc_id", tokenizers.unicode_tokens(F.col("line")), keep=LONG)


_SQL_RE_TFIDF = (
    f"WITH {_SQL_RE_DF}, {_SQL_N} SELECT doc_id, term, round(tf * (ln((n + 1) / (df + 1)) + 1), 6) + 0.0::DOUBLE "
    "AS tfidf FROM tf JOIN df USING (term), n"
)


def _document_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents as text files, one in a folder of its own each, and these dealt to sub-folders if they are many."""
    path = output_path(spark, "document-files")
    docs = _docs(spark, sf_dir)
    writers.write_documents(docs, "doc_id", path, folders=writers.folders_for(docs.count()))
    return path


def _id_from_path() -> Column:
    return F.regexp_extract("path", r"doc_id=(\d+)/", 1).cast("bigint").alias("doc_id")


@query("file_tfidf_smooth", _SQL_RE_TFIDF)
def file_tfidf_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document job over a folder of files, each read whole."""
    files = readers.by_folder(spark, _document_files(spark, sf_dir), readers.read_whole_files, "document-texts")
    files = files.select(_id_from_path(), "text")
    return _rounded(tfidf.document_tfidf(files, DOC, _re(), scoring.idf_smooth, LONG))


@query("file_line_documents", "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents")
def file_line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a folder and its sub-folders, with the file that each comes from."""
    lines = readers.by_folder(spark, _document_files(spark, sf_dir), readers.read_lines, "document-lines")
    return lines.select(_id_from_path(), "line")


@query("sorted_counts", f"WITH {_SQL_WC} SELECT word, tf AS n FROM wc")
def sorted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts exported in word order, within and across the parts."""
    path = output_path(spark, "sorted-counts")
    ordered = writers.sorted_by_word(ws_word_count(spark, sf_dir), "word")
    writers.write_lines(writers.key_value_lines(ordered, "word", "tf"), path)
    return readers.parse_key_values(spark.read.text(path))


@query(
    "re_tfidf_smooth",
    _SQL_RE_TFIDF,
)
def re_tfidf_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tfidf.document_tfidf(_docs(spark, sf_dir), DOC, _re(), scoring.idf_smooth, LONG))


@query(
    "ws_term_frequency",
    f"WITH {_SQL_WS} SELECT doc_id, word, count(*)::BIGINT AS tf FROM ws GROUP BY ALL",
)
def ws_term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.term_frequency(_docs(spark, sf_dir), DOC, _ws(), "word")


@query(
    "ws_document_frequency",
    f"WITH {_SQL_WS} SELECT word, count(DISTINCT doc_id)::BIGINT AS df FROM ws GROUP BY word",
)
def ws_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.document_frequency(_docs(spark, sf_dir), _ws(), "word")


@query(
    "ws_tfidf_by_doc",
    f"WITH {_SQL_WS}, {_SQL_N}, tf AS (SELECT doc_id, word, count(*) AS tf FROM ws GROUP BY ALL), "
    "df AS (SELECT word, count(*) AS df FROM tf GROUP BY word) "
    "SELECT doc_id, word, round(tf * ln(n / (df + 1)), 6) + 0.0::DOUBLE AS tfidf FROM tf JOIN df USING (word), n",
)
def ws_tfidf_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = tfidf.document_tfidf(_docs(spark, sf_dir), DOC, _ws(), scoring.idf_plain)
    return _rounded(scores.withColumnRenamed("term", "word"))


@query(
    "df_side_table_scores",
    f"WITH {_SQL_WC}, {_SQL_N}, cw AS (SELECT DISTINCT conv_id, turn, word FROM (SELECT conv_id, turn, "
    rf"unnest(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '[ \t\n\r]+')) AS word FROM conversations) "
    "WHERE word <> ''), df AS (SELECT word, count(*) AS df FROM cw GROUP BY word) "
    "SELECT word, coalesce(df, 1)::BIGINT AS df, round(tf * ln(n / (coalesce(df, 1) + 1)), 6) + 0.0::DOUBLE AS tfidf "
    "FROM wc LEFT JOIN df USING (word), n",
)
def df_side_table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus counts scored with document frequencies of another corpus; missing words get 1."""
    turns = _table(spark, sf_dir, "conversations", ["text"])
    side = tfidf.fit(counts.document_term_statistics(turns, _ws())).vocabulary.withColumnRenamed("term", "word")
    scored = joins.with_df(counts.word_count(_docs(spark, sf_dir), _ws()), side)
    score = F.col("tf") * scoring.idf_plain(_n_docs(spark, sf_dir), F.col("df"))
    return _rounded(scored.select("word", "df", score.alias("tfidf")))


@query(
    "bucketed_side_table_scores",
    f"WITH {_SQL_WC}, {_SQL_N}, cw AS (SELECT DISTINCT conv_id, turn, word FROM (SELECT conv_id, turn, "
    rf"unnest(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '[ \t\n\r]+')) AS word FROM conversations) "
    "WHERE word <> ''), df AS (SELECT word, count(*) AS df FROM cw GROUP BY word) "
    "SELECT word, coalesce(df, 1)::BIGINT AS df, round(tf * ln(n / (coalesce(df, 1) + 1)), 6) + 0.0::DOUBLE AS tfidf "
    "FROM wc LEFT JOIN df USING (word), n",
)
def bucketed_side_table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores from a side table that is kept bucketed by word."""
    turns = _table(spark, sf_dir, "conversations", ["text"])
    path = output_path(spark, "df-buckets")
    side = writers.write_bucketed(
        counts.document_frequency(turns, _ws(), "word"), f"df_buckets_{path.rsplit('-', 1)[1]}", path, "word"
    )
    scored = joins.with_bucketed_df(counts.word_count(_docs(spark, sf_dir), _ws()), side)
    score = F.col("tf") * scoring.idf_plain(_n_docs(spark, sf_dir), F.col("df"))
    return _rounded(scored.select("word", "df", score.alias("tfidf")))


# Corpus TF-IDF as the chained jobs compute it


@query("corpus_df_as_run", f"WITH {_SQL_WC} SELECT word, count(*)::BIGINT AS df FROM wc GROUP BY word")
def corpus_df_as_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.corpus_document_frequency(ws_word_count(spark, sf_dir))


_SQL_STAGE1 = (
    f"{_SQL_WC}, {_SQL_N}, df AS (SELECT word, count(*) AS df FROM wc GROUP BY word), "
    "s1 AS (SELECT word, df, n, round(tf * ln(n / (df + 1)), 6) + 0.0::DOUBLE AS tfidf FROM wc JOIN df USING (word), n)"
)


@query("corpus_tfidf_stage1", f"WITH {_SQL_STAGE1} SELECT word, tfidf FROM s1")
def corpus_tfidf_stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = tfidf.corpus_tfidf_first_pass(ws_word_count(spark, sf_dir), _n_docs(spark, sf_dir))
    return _rounded(first.select("word", "tfidf"))


@query(
    "corpus_tfidf_as_run",
    f"WITH {_SQL_STAGE1} SELECT word, round(trunc(tfidf) * ln(n / (df + 1)), 6) + 0.0::DOUBLE AS tfidf FROM s1",
)
def corpus_tfidf_as_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.corpus_tfidf_as_run(ws_word_count(spark, sf_dir), _n_docs(spark, sf_dir))


# Profiles


@query(
    "corpus_profile",
    f"WITH {_SQL_LINES} SELECT count(*)::BIGINT AS n_docs, sum(length(text))::BIGINT AS total_chars, "
    "sum(strlen(text))::BIGINT AS total_bytes, (SELECT count(*) FROM lines)::BIGINT AS total_lines, "
    "sum(length(text))::DOUBLE / 1048576.0::DOUBLE AS total_mb FROM documents",
)
def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return profile.corpus_profile(profile.require_documents(docs))


@query(
    "token_profile",
    f"WITH {_SQL_RE} SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs, count(*)::BIGINT AS total_tokens, "
    "count(*)::DOUBLE / (SELECT count(*) FROM documents) AS avg_tokens_per_doc, "
    "count(DISTINCT term)::BIGINT AS vocab_size FROM re",
)
def token_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.token_profile(_docs(spark, sf_dir), _re(), keep=LONG)


@query(
    "stage_profile",
    f"WITH {_SQL_STAGE1}, p AS (SELECT 'count' AS stage, sum(len(string_split(text, chr(10)))) AS records, "
    "sum(strlen(text) + 1) AS n_bytes FROM documents "
    "UNION ALL SELECT 'score', count(*), sum(strlen(word || tf::VARCHAR) + 2) FROM wc "
    "UNION ALL SELECT 'export', count(*), sum(strlen(word || printf('%.6f', tfidf)) + 2) FROM s1) "
    "SELECT stage, records::BIGINT AS records, n_bytes::BIGINT AS n_bytes, n_bytes::DOUBLE / 1048576.0::DOUBLE AS mb, "
    "n_bytes::DOUBLE / records::DOUBLE AS bytes_per_record FROM p",
)
def stage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and bytes of the text records that the steps of the corpus job read, taken while it runs."""
    watch = profile.Watch()
    text_lines = F.size(F.split("text", readers.LINE_BREAK))
    texts = _table(spark, sf_dir, "documents", ["text"])
    texts = watch.through(texts, "count", **profile.records_and_bytes(_text(), text_lines))
    words = counts.word_count(texts, _ws())
    words = watch.through(words, "score", **profile.records_and_bytes(F.concat_ws("\t", "word", F.col("tf").cast("string"))))
    scores = tfidf.corpus_tfidf_first_pass(words, _n_docs(spark, sf_dir)).withColumn("tfidf", scoring.six_decimals(F.col("tfidf")))
    scores = watch.through(scores, "export", **profile.records_and_bytes(F.format_string("%s\t%.6f", "word", "tfidf")))
    writers.materialise(scores)
    return profile.input_profile(spark, {name: watch.figures(name) for name in ("count", "score", "export")})


@query(
    "stage_rows",
    f"WITH {_SQL_RE_DF} SELECT 'tokens' AS stage, count(*)::BIGINT AS n_rows, count(DISTINCT doc_id)::BIGINT AS n_docs FROM re "
    "UNION ALL SELECT 'tf', count(*)::BIGINT, count(DISTINCT doc_id)::BIGINT FROM tf "
    "UNION ALL SELECT 'tfidf', count(*)::BIGINT, count(DISTINCT doc_id)::BIGINT FROM tf JOIN df USING (term)",
)
def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and documents that the steps of the document job leave, taken while it runs; the texts are tokenized once."""
    watch = profile.Watch()
    docs = _docs(spark, sf_dir).select("doc_id", _re().alias("tokens"))
    docs = watch.through(docs, "docs", n_docs=F.count_if(F.exists("tokens", LONG)))
    terms = counts.term_frequency(docs, DOC, F.col("tokens"), keep=LONG, document_rows=True)
    terms = watch.through(terms, "tf", n_rows=F.count("term"), n_tokens=F.sum("tf"))
    terms = stage(terms, "document-terms")
    scores = tfidf.score(terms, DOC, tfidf.fit(counts.term_statistics(terms)), scoring.idf_smooth)
    scored = scores.groupBy(*DOC).agg(F.count("*").alias("n")).agg(F.sum("n"), F.count("*")).first()
    n_docs, tf = watch.figures("docs")["n_docs"], watch.figures("tf")
    return spark.createDataFrame(
        [("tokens", tf["n_tokens"], n_docs), ("tf", tf["n_rows"], n_docs), ("tfidf", scored[0] or 0, scored[1])],
        "stage string, n_rows long, n_docs long",
    )


# Lines as documents


@query("line_documents", f"WITH {_SQL_LINES} SELECT doc_id, source, line_no, line FROM lines")
def line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.line_documents(_docs(spark, sf_dir, "source"), ["doc_id", "source"])


@query("stopword_filtered_tokens", f"WITH {_SQL_LINE_TOKENS} SELECT doc_id, line_no, token FROM tokens")
def stopword_filtered_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.explode_tokens(_lines(spark, sf_dir), LINE, _line_tokens(), "token", LINE_KEEP)


@query(
    "vocabulary_top_k",
    f"WITH {_SQL_VOCABULARY} SELECT term, c, df, rank FROM vocabulary WHERE rank <= 100",
)
def vocabulary_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_terms(spark, sf_dir, 100)


@query(
    "vocabulary_top_12000",
    f"WITH {_SQL_VOCABULARY} SELECT term, c, df, rank FROM vocabulary WHERE rank <= 12000",
)
def vocabulary_top_12000(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit beyond what one task sorts."""
    return _top_terms(spark, sf_dir, 12_000)


def _top_terms(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    lines = counts.term_frequency(_lines(spark, sf_dir), [], _line_tokens(), keep=LINE_KEEP)
    known = stage(counts.term_statistics(lines).where("df >= 2"), "terms")
    return prefix.top_k(known, [F.desc("c"), F.col("term")], k).select("term", "c", "df", "rank")


VOCAB_SIZE = 500_000


def _line_model(lines: DataFrame) -> tfidf.TermModel:
    terms = counts.term_frequency(lines, [], _line_tokens(), keep=LINE_KEEP, document_rows=True)
    return tfidf.fit(counts.term_statistics(terms), min_df=2, vocab_size=VOCAB_SIZE)


@query(
    "line_vocabulary",
    f"WITH {_SQL_VOCABULARY} SELECT term, c, df, rank, round(ln((n + 1) / (df + 1)), 6) + 0.0::DOUBLE AS idf "
    "FROM vocabulary, n",
)
def line_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted vocabulary of the line job, with its idf."""
    model = _line_model(_lines(spark, sf_dir))
    idf = scoring.idf_ml(F.lit(model.n_docs), F.col("df"))
    return _rounded(model.ranked().select("term", "c", "df", "rank", idf.alias("idf")), "idf")


@query(
    "pruned_line_vocabulary",
    f"WITH {_SQL_VOCABULARY} SELECT term, c, df, rank, round(ln((n + 1) / (df + 1)), 6) + 0.0::DOUBLE AS idf "
    "FROM vocabulary, n",
)
def pruned_line_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vocabulary, with rare terms pruned by sketches before the shuffle."""
    statistics = tfidf.pruned_statistics(_lines(spark, sf_dir), _line_tokens(), 2, LINE_KEEP)
    model = tfidf.fit(statistics, min_df=2, vocab_size=VOCAB_SIZE)
    idf = scoring.idf_ml(F.lit(model.n_docs), F.col("df"))
    return _rounded(model.ranked().select("term", "c", "df", "rank", idf.alias("idf")), "idf")


@query(
    "vocabulary_size_by_source",
    f"WITH {_SQL_RE}, t AS (SELECT source, term FROM re JOIN documents USING (doc_id)) SELECT source, "
    "count(DISTINCT term)::BIGINT AS vocab_size, true AS within_error FROM t GROUP BY source "
    "UNION ALL SELECT NULL, count(DISTINCT term)::BIGINT, true FROM t",
)
def vocabulary_size_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct terms of each source and of all, and whether stored and merged sketches give them within their error."""
    terms = counts.explode_tokens(_docs(spark, sf_dir, "lang", "source"), ["lang", "source"], _re(), keep=LONG)
    stored = stage(sketches.distinct_sketches(terms, ["lang", "source"]), "vocabulary-sketches")
    by_source, whole = sketches.merged_estimate(stored, ["source"]), sketches.merged_estimate(stored, [])
    estimates = by_source.unionByName(whole.withColumn("source", F.lit(None).cast("string")))
    distinct = terms.select("source", "term").distinct()
    exact = distinct.groupBy("source").agg(F.count("*").alias("vocab_size")).unionByName(
        distinct.select(F.lit(None).cast("string").alias("source"), "term").distinct()
        .groupBy("source").agg(F.count("*").alias("vocab_size"))
    )
    near = sketches.within_error(F.col("vocab_size"), F.col("estimate")).alias("within_error")
    other = estimates.withColumnRenamed("source", "_source")
    return exact.join(other, F.col("source").eqNullSafe(F.col("_source"))).select("source", "vocab_size", near)


_SQL_LINE_TFIDF = (
    f"WITH {_SQL_VOCABULARY} SELECT doc_id, line_no, term, round(tf * ln((n + 1) / (df + 1)), 6) + 0.0::DOUBLE AS tfidf "
    "FROM ltf JOIN vocabulary USING (term), n"
)


@query("line_tfidf", _SQL_LINE_TFIDF)
def line_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = tfidf.document_tfidf(
        _lines(spark, sf_dir), LINE, _line_tokens(), scoring.idf_ml, LINE_KEEP, min_df=2, vocab_size=VOCAB_SIZE
    )
    return _rounded(scores)


def _line_index(lines: DataFrame) -> tuple[DataFrame, vectors.TermIndex]:
    """Counts of the line documents, tokenized once, and the term index fitted to them."""
    terms = tfidf.document_terms(lines, LINE, _line_tokens(), LINE_KEEP)
    model = tfidf.fit(counts.term_statistics(terms), min_df=2, vocab_size=VOCAB_SIZE)
    return terms, vectors.index_terms(model)


@query("ml_line_tfidf", _SQL_LINE_TFIDF)
def ml_line_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores as sparse vectors of Spark ML, turned back into rows."""
    terms, index = _line_index(_lines(spark, sf_dir))
    found = vectors.as_ml_vectors(vectors.document_vectors(terms, LINE, index))
    return _rounded(vectors.vector_rows(vectors.vector_parts(found, LINE), LINE, index))


_SQL_LINE_VECTORS = (
    f"WITH {_SQL_VOCABULARY} SELECT doc_id, line_no, (SELECT count(*) FROM vocabulary)::INT AS size, "
    "coalesce(string_agg((rank - 1)::VARCHAR, ',' ORDER BY rank), '') AS indices, coalesce(string_agg("
    "printf('%.6f', round(tf * ln((n + 1) / (df + 1)), 6) + 0.0::DOUBLE), ',' ORDER BY rank), '') AS vector_values "
    "FROM lines LEFT JOIN (SELECT * FROM ltf JOIN vocabulary USING (term), n) USING (doc_id, line_no) GROUP BY ALL"
)


def _printed_vectors(parts: DataFrame) -> DataFrame:
    """Vectors with their lists as text."""
    printed = F.transform("values", lambda v: F.format_string("%.6f", scoring.six_decimals(v)))
    return parts.select(
        *LINE, "size", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
        F.array_join(printed, ",").alias("vector_values"),
    )


@query("line_vectors", _SQL_LINE_VECTORS)
def line_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line vectors themselves, written as a table and read back; lists as text."""
    path = output_path(spark, "line-vectors")
    terms, index = _line_index(_lines(spark, sf_dir))
    writers.write_table(vectors.document_vectors(terms, LINE, index), path)
    return _printed_vectors(spark.read.parquet(path))


@query("saved_pipeline_vectors", _SQL_LINE_VECTORS)
def saved_pipeline_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line vectors of a Spark ML pipeline that was fitted, saved and loaded again."""
    path = output_path(spark, "line-pipeline")
    lines = _lines(spark, sf_dir)
    stages = [
        RegexTokenizer(inputCol="line", outputCol="all_tokens", pattern=tokenizers.NON_WORD_ASCII, minTokenLength=2),
        StopWordsRemover(inputCol="all_tokens", outputCol="tokens", stopWords=ENGLISH_STOP_WORDS),
        vectors.TermVectorizer(keyCols=LINE, minDF=2, vocabSize=VOCAB_SIZE),
    ]
    Pipeline(stages=stages).fit(lines).write().overwrite().save(path)
    return _printed_vectors(vectors.vector_parts(PipelineModel.load(path).transform(lines), LINE))


# Corpus preparation

_MARKED = {
    0: ("Header\n{0} EBOOK ***\n".format(text.START_MARKERS[0]), "\n{0} EBOOK ***\nFooter".format(text.END_MARKERS[0])),
    1: ("Header\n{0} EBOOK***\n".format(text.START_MARKERS[1]), "\n{0} EBOOK***\nFooter".format(text.END_MARKERS[1])),
    2: ("Header\n{0} EBOOK ***\n".format(text.START_MARKERS[0]), ""),
}


def _raw_book() -> Column:
    """Document text as a raw book: both markers, the other pair, only a start, or none."""
    variant = F.col("doc_id") % 4
    raw = _text()
    for number, (before, after) in _MARKED.items():
        raw = F.when(variant == number, F.concat(F.lit(before), _text(), F.lit(after))).otherwise(raw)
    return raw


def _sql_raw_book() -> str:
    cases = " ".join(
        f"WHEN {number} THEN replace('{before}', '\n', chr(10)) || text || replace('{after}', '\n', chr(10))"
        for number, (before, after) in _MARKED.items()
    )
    return f"CASE doc_id % 4 {cases} ELSE text END"


def _sql_strip(raw: str) -> str:
    """SELECT body for the ``raw`` column of a table that has doc_id."""
    first = " ".join(f"WHEN contains(raw, '{m}') THEN strpos(raw, '{m}')" for m in text.START_MARKERS)
    last = " ".join(
        f"WHEN contains(raw, '{m}') THEN length(raw) - length(list_last(string_split(raw, '{m}'))) - {len(m)}"
        for m in text.END_MARKERS
    )
    return (
        f"raw AS ({raw}), m AS (SELECT *, CASE {first} END AS s, CASE {last} ELSE length(raw) END AS e FROM raw), "
        "b AS (SELECT *, CASE WHEN s IS NOT NULL AND strpos(substr(raw, s), chr(10)) > 0 "
        "THEN s + strpos(substr(raw, s), chr(10)) - 2 ELSE 0 END AS b FROM m), "
        "clean AS (SELECT * EXCLUDE (s, e, b), CASE WHEN e > b THEN substr(raw, b + 1, e - b) ELSE raw END AS body FROM b)"
    )


@query(
    "strip_boilerplate",
    f"WITH {_sql_strip(f'SELECT doc_id, {_sql_raw_book()} AS raw FROM documents')} SELECT doc_id, body FROM clean",
)
def strip_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _docs(spark, sf_dir).select("doc_id", _raw_book().alias("raw"))
    return raw.select("doc_id", text.strip_boilerplate(F.col("raw")).alias("body"))


@query(
    "safe_file_name",
    r"SELECT doc_id, doc_id::VARCHAR || '_' || left(coalesce(nullif(regexp_replace(translate(text, ' ' || chr(9), '__'), "
    r"'[^A-Za-z0-9_\-]+', '', 'g'), ''), 'book'), 60) || '.txt' AS file_name FROM documents",
)
def safe_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text.safe_file_name(F.col("doc_id"), _text()).alias("file_name"))


def _book_url(kind: str) -> Column:
    return F.concat(F.lit("http://books/"), F.col("doc_id").cast("string"), F.lit(kind))


def _catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed page per document; its ``formats`` depend on the language, and pages from
    two sources are not JSON. One book in seven has neither id nor title, and a page near the
    end has no books, which ends the catalog."""
    utf8, ascii_, plain = text.TEXT_MEDIA_TYPES
    lang = F.col("lang")
    formats = (
        F.when(lang == "en", F.create_map(F.lit(utf8), _book_url(".txt"), F.lit(ascii_), _book_url(".zip")))
        .when(lang == "fr", F.create_map(F.lit(utf8), _book_url(".zip"), F.lit(ascii_), _book_url("-a.txt"),
                                         F.lit(plain), _book_url("-p.txt")))
        .when(F.col("source") != "src1", F.create_map(F.lit("text/plain; charset=z"), _book_url("-z.txt"),
                                                      F.lit("text/plain; charset=iso-8859-1"), _book_url("-i.txt")))
    )
    # Null fields are left out of the JSON.
    named = F.col("doc_id") % 7 != 3
    book = F.struct(F.when(named, F.col("doc_id")).alias("id"), F.when(named, _title()).alias("title"),
                    formats.alias("formats"), F.array("lang").alias("languages"))
    page = F.to_json(F.struct(F.array(book).alias("results")))
    broken = F.col("source").isin("src6", "src13")
    docs = _table(spark, sf_dir, "documents", ["doc_id", "lang", "source"])
    last = docs.agg(F.max("doc_id") - 5).scalar()
    body = F.when(F.col("doc_id") == last, '{"results": []}').when(broken, F.concat(page, F.lit("}"))).otherwise(page)
    return docs.select(F.col("doc_id").alias("page_no"), body.alias("body"))


CATALOG_LANGUAGES = ["en", "fr", "de"]


def _title() -> Column:
    return F.concat_ws(" ", F.lit("Tale\tof:"), "lang", "source", F.lit("— no."), F.col("doc_id").cast("string"))


_SQL_URL = (
    "'http://books/' || doc_id::VARCHAR || CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '-a.txt' ELSE '-i.txt' END"
)
_SQL_NAME = (
    "CASE WHEN doc_id % 7 = 3 THEN '0_book.txt' ELSE "
    "doc_id::VARCHAR || '_Tale_of_' || lang || '_' || source || '__no_' || doc_id::VARCHAR || '.txt' END"
)
_SQL_BOOKS = (
    f"books AS (SELECT doc_id AS page_no, 0 AS position, CASE WHEN doc_id % 7 = 3 THEN 0 ELSE doc_id END AS id, "
    f"{_SQL_URL} AS url, {_SQL_NAME} AS file_name FROM documents WHERE lang IN ('en', 'fr', 'de') "
    "AND (lang <> 'de' OR source <> 'src1') AND source NOT IN ('src6', 'src13') "
    "AND doc_id < (SELECT max(doc_id) - 5 FROM documents))"
)
_SQL_SAVED = (
    f"saved AS (SELECT file_name, max(n_bytes) AS n_bytes FROM (SELECT {_SQL_NAME} AS file_name, "
    "(n_chars * quality)::BIGINT AS n_bytes FROM documents JOIN labels USING (doc_id) WHERE doc_id % 7 <> 3 "
    "UNION ALL SELECT doc_id::VARCHAR || '_Tale_of_' || lang || '_' || source || '__no_' || doc_id::VARCHAR || '.txt', 1 "
    "FROM documents WHERE doc_id % 4 = 0) GROUP BY file_name)"
)


@query("catalog_text_url", f"WITH {_SQL_BOOKS} SELECT page_no, position::INT AS position, id, url, file_name FROM books")
def catalog_text_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.text_books(catalog.read_catalog(_catalog_pages(spark, sf_dir)), CATALOG_LANGUAGES)


def _saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an earlier run: those of labelled documents, empty where quality is 0. Some are listed twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = text.safe_file_name(F.col("doc_id"), _title()).alias("file_name")
    size = (F.col("n_chars") * F.col("quality")).cast("bigint").alias("n_bytes")
    again = docs.where("doc_id % 4 = 0").select(name, F.lit(1).cast("bigint").alias("n_bytes"))
    return docs.join(labels, "doc_id").where("doc_id % 7 <> 3").select(name, size).unionByName(again)


@query(
    "resume_pending",
    f"WITH {_SQL_BOOKS}, {_SQL_SAVED} SELECT id, file_name FROM books "
    "WHERE file_name NOT IN (SELECT file_name FROM saved WHERE n_bytes > 0)",
)
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = catalog_text_url(spark, sf_dir)
    return resume.pending(books, _saved(spark, sf_dir)).select("id", "file_name")


@query(
    "resume_saved",
    f"WITH {_SQL_BOOKS}, {_SQL_SAVED} SELECT id, file_name, n_bytes AS saved_bytes FROM books JOIN saved USING (file_name) "
    "WHERE n_bytes > 0",
)
def resume_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = catalog_text_url(spark, sf_dir)
    return resume.already_saved(books, _saved(spark, sf_dir)).select("id", "file_name", "saved_bytes")


@query(
    "resume_from_folder",
    f"WITH {_SQL_BOOKS}, f AS (SELECT {_SQL_NAME} AS file_name, strlen(text)::BIGINT + 1 AS saved_bytes FROM documents "
    "WHERE doc_id % 3 = 0 AND doc_id % 7 <> 3) "
    "SELECT page_no, file_name, saved_bytes FROM books LEFT JOIN f USING (file_name)",
)
def resume_from_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books with the size of the files that an earlier run wrote; one of its files is empty, so it is still to fetch."""
    books = stage(catalog_text_url(spark, sf_dir), "books")
    folder = output_path(spark, "saved-books")
    named = books.where("page_no % 7 <> 3").select(F.col("page_no").alias("doc_id"), "file_name")
    texts = _docs(spark, sf_dir).where("doc_id % 3 = 0").join(named, "doc_id")
    writers.write_documents(texts, "file_name", folder)
    empty = books.where("id % 3 = 1").agg(F.min("file_name")).first()[0]
    writers.write_lines(books.where("false").select(F.col("file_name").alias("value")), f"{folder}/file_name={empty}")
    saved = resume.saved_files(readers.list_files(spark, folder))
    return resume.with_saved_bytes(books, saved).select("page_no", "file_name", "saved_bytes")


@query(
    "byte_budget_prefix",
    "SELECT doc_id, n_bytes, running_bytes FROM (SELECT doc_id, strlen(text)::BIGINT AS n_bytes, "
    "(sum(strlen(text)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS running_bytes FROM documents) "
    "WHERE running_bytes - n_bytes < 1048576",
)
def byte_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = corpus_prep.text_sizes(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    target = text.size_in_bytes(1, "MB")
    return prefix.running_prefix(sizes, ["doc_id"], F.col("n_bytes"), target, "running_bytes")


@query(
    "corpus_running_bytes",
    "SELECT doc_id, strlen(text)::BIGINT AS n_bytes, "
    "(sum(strlen(text)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS running_bytes FROM documents",
)
def corpus_running_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The byte budget without a limit."""
    sizes = corpus_prep.text_sizes(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    return prefix.running_prefix(sizes, ["doc_id"], F.col("n_bytes"), 0, "running_bytes")


def _raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed raw texts by URL."""
    kind = F.when(F.col("lang") == "en", ".txt").when(F.col("lang") == "fr", "-a.txt").otherwise("-i.txt")
    docs = _docs(spark, sf_dir, "lang")
    return docs.select(_book_url("").alias("base"), kind.alias("kind"), _raw_book().alias("raw")).select(
        F.concat("base", "kind").alias("url"), "raw"
    )


_SQL_SELECTED = (
    f"{_SQL_BOOKS}, {_SQL_SAVED}, {_sql_strip(f'SELECT {_SQL_URL} AS url, {_sql_raw_book()} AS raw FROM documents')}, "
    "taken AS (SELECT page_no, id, file_name, body, s.n_bytes AS saved_bytes, "
    "arg_min(strlen(body), page_no) FILTER (strlen(body) > 0) OVER (PARTITION BY file_name ORDER BY page_no "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS written FROM books JOIN clean USING (url) "
    "LEFT JOIN (SELECT * FROM saved WHERE n_bytes > 0) s USING (file_name)), "
    "sized AS (SELECT page_no, id, file_name, coalesce(saved_bytes, written) IS NOT NULL AS existing, "
    "coalesce(saved_bytes, written, strlen(body))::BIGINT AS n_bytes, body FROM taken), "
    "selected AS (SELECT *, (sum(n_bytes) OVER (ORDER BY page_no ROWS UNBOUNDED PRECEDING))::BIGINT AS running_bytes "
    "FROM sized QUALIFY running_bytes - n_bytes < 1048576)"
)


@query(
    "prepared_corpus",
    f"WITH {_SQL_SELECTED} SELECT id, file_name, existing, n_bytes, running_bytes FROM selected",
)
def prepared_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = corpus_prep.select_books(
        _catalog_pages(spark, sf_dir), _raw_texts(spark, sf_dir), _saved(spark, sf_dir), text.size_in_bytes(1, "MB"),
        CATALOG_LANGUAGES,
    )
    return selected.select("id", "file_name", "existing", "n_bytes", "running_bytes")


@query("prepared_files", f"WITH {_SQL_SELECTED} SELECT file_name, body FROM selected WHERE NOT existing")
def prepared_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that a run adds to the corpus, written as a table and read back."""
    raw = _raw_texts(spark, sf_dir)
    selected = corpus_prep.select_books(
        _catalog_pages(spark, sf_dir), raw, _saved(spark, sf_dir), text.size_in_bytes(1, "MB"), CATALOG_LANGUAGES
    )
    path = output_path(spark, "prepared-files")
    writers.write_table(corpus_prep.new_files(selected, raw), path)
    return spark.read.parquet(path)


# Key-value text


def _mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts as lines: no tab, no number, a count, a decimal, or a negative count."""
    sort = F.col("tf") % 5
    tf = F.col("tf").cast("string")
    tail = (
        F.when(sort == 0, F.lit(""))
        .when(sort == 1, F.lit("\tx"))
        .when(sort == 2, F.concat(F.lit("\t"), tf))
        .when(sort == 3, F.concat(F.lit("\t"), tf, F.lit(".62")))
        .otherwise(F.concat(F.lit("\t-"), tf))
    )
    return ws_word_count(spark, sf_dir).select(F.concat("word", tail).alias("value"))


@query(
    "kv_parse",
    f"WITH {_SQL_WC} SELECT word, CASE WHEN tf % 5 = 4 THEN -tf ELSE tf END AS n FROM wc WHERE tf % 5 >= 2",
)
def kv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.parse_key_values(_mixed_records(spark, sf_dir))


@query(
    "kv_parse_lenient",
    f"WITH {_SQL_WC} SELECT word, CASE tf % 5 WHEN 4 THEN -tf WHEN 1 THEN 0 ELSE tf END AS n FROM wc WHERE tf % 5 >= 1",
)
def kv_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.parse_key_values(_mixed_records(spark, sf_dir), strict=False)


@query("kv_sum", "SELECT source AS word, sum(n_chars)::BIGINT AS n FROM documents GROUP BY source")
def kv_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return counts.sum_by_key(readers.parse_key_values(writers.key_value_lines(docs, "source", "n_chars")))


@query("kv_text_round_trip", f"WITH {_SQL_WC} SELECT word, tf AS n FROM wc")
def kv_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = output_path(spark, "counts-text")
    writers.write_lines(writers.key_value_lines(ws_word_count(spark, sf_dir), "word", "tf"), path)
    return readers.parse_key_values(spark.read.text(path))


@query("score_text_round_trip", f"WITH {_SQL_STAGE1} SELECT word, trunc(tfidf)::BIGINT AS n FROM s1")
def score_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed scores read back as integers."""
    path = output_path(spark, "scores-text")
    writers.write_lines(writers.score_lines(corpus_tfidf_stage1(spark, sf_dir), "word", "tfidf"), path)
    return readers.parse_key_values(spark.read.text(path))


# Sentiment

LEXICON = [("the", 1), ("of", -1), ("de", 1), ("la", -1), ("der", 1), ("und", -1)]
_SQL_LEXICON = ", ".join(f"('{term}', {polarity})" for term, polarity in LEXICON)


@query(
    "lexicon_sentiment",
    f"WITH {_SQL_RE}, lexicon(term, polarity) AS (VALUES {_SQL_LEXICON}), s AS (SELECT doc_id, "
    "coalesce(sum(polarity), 0)::BIGINT AS score FROM documents LEFT JOIN (re JOIN lexicon USING (term)) USING (doc_id) "
    "GROUP BY doc_id) SELECT doc_id, score, CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' "
    "ELSE 'neutral' END AS sentiment FROM s",
)
def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = spark.createDataFrame(LEXICON, "term string, polarity int")
    return sentiment.lexicon_sentiment(_docs(spark, sf_dir), "doc_id", _re(), lexicon)


# Messages

_SQL_WORDS = r"len(list_filter(string_split_regex(text, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'), lambda w: w <> ''))::BIGINT"


@query("message_word_count", f"SELECT conv_id, turn, {_SQL_WORDS} AS n_words FROM conversations")
def message_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    return messages.count_words(messages.as_messages(turns, ["conv_id", "turn"]), ["conv_id", "turn"])


@query("kafka_payload", "SELECT doc_id, strlen(text)::BIGINT AS n_bytes, md5(text) AS digest FROM documents")
def kafka_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.as_messages(spark.read.parquet(f"{sf_dir}/documents.parquet"), DOC)
    return sent.select("doc_id", F.octet_length("value").cast("bigint").alias("n_bytes"), F.md5("value").alias("digest"))


def _landed(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there, and read the folder that it wrote."""
    spark = stream.sparkSession
    path = output_path(spark, name)
    messages.land(stream, path, output_path(spark, f"{name}-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern that only this name fits, because a stream takes a plain path for a folder and the table may be a file.
    path = f"{sf_dir}/documents.parquet"
    return messages.folder_stream(spark, f"{sf_dir}/documents.parque[t]", spark.read.parquet(path).schema, maxFilesPerTrigger="4")


@query("stream_text_files", f"SELECT doc_id, {_SQL_WORDS} AS n_words FROM documents")
def stream_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of text files as messages, in several micro-batches, with a stop and a restart in between.

    A file source keeps the names of all its files on the driver, so each sub-folder of many files is a stream of its own.
    """
    docs, folder = _docs(spark, sf_dir), output_path(spark, "message-files")
    landed, checkpoint = output_path(spark, "file-words"), output_path(spark, "file-words-checkpoint")
    n_docs = docs.count()
    folders = writers.folders_for(n_docs)
    streams = [f"/folder={k}" for k in range(folders)] or [""]
    n_files = max(n_docs // (6 * len(streams)), 1)
    for part in (0, 1):
        writers.write_documents(docs.where(F.col("doc_id") % 2 == part), "doc_id", f"{folder}/{part}", folders=folders)
        with readers.small_files(spark):
            for below in streams:
                path = f"{folder}/*{below}" if below else folder
                files = messages.text_file_stream(spark, path, recursiveFileLookup="true", maxFilesPerTrigger=str(n_files))
                words = messages.count_words(files.select(_id_from_path(), "value"), DOC)
                messages.land(words, f"{landed}{below}", f"{checkpoint}{below}").awaitTermination()
    if not folders:
        return spark.read.parquet(landed)
    # Each folder by the log of its sink.
    return stage_each(spark, (spark.read.parquet(f"{landed}{below}") for below in streams), "file-words")


@query("stream_message_words", f"SELECT doc_id, {_SQL_WORDS} AS n_words FROM documents")
def stream_message_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.as_messages(_document_stream(spark, sf_dir), DOC)
    return _landed(messages.count_words(sent, DOC), "message-words")


@query("stream_landing", "SELECT doc_id, text FROM documents")
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(messages.as_messages(_document_stream(spark, sf_dir), DOC), "landed-messages")
    return landed.select("doc_id", tokenizers.from_payload(F.col("value")).alias("text"))


@query(
    "stream_dead_letters",
    f"SELECT doc_id, CASE WHEN doc_id % 5 <> 0 AND doc_id % 17 <> 1 THEN {_SQL_WORDS} END AS n_words, "
    "CASE WHEN doc_id % 17 = 1 THEN NULL WHEN doc_id % 5 = 0 THEN strlen(text)::BIGINT + 2 END AS n_bytes, "
    "CASE WHEN doc_id % 17 = 1 THEN 'no value' WHEN doc_id % 5 = 0 THEN 'not UTF-8' END AS reason FROM documents",
)
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of messages of which some are cut inside a character and some have no value: both sinks together."""
    sent = messages.as_messages(_document_stream(spark, sf_dir), DOC)
    cut = F.concat(F.unhex(F.lit("C328")), F.col("value"))
    broken = F.when(F.col("doc_id") % 17 == 1, F.lit(None)).when(F.col("doc_id") % 5 == 0, cut).otherwise(F.col("value"))
    good, dead = output_path(spark, "read-messages"), output_path(spark, "dead-letters")
    stream = sent.withColumn("value", broken)
    messages.land_readable(stream, good, dead, output_path(spark, "dead-letters-checkpoint"), DOC).awaitTermination()
    words = spark.read.parquet(good).select("doc_id", "n_words")
    letters = spark.read.parquet(dead).select("doc_id", F.octet_length("value").cast("bigint").alias("n_bytes"), "reason")
    return words.unionByName(letters, allowMissingColumns=True)


@query("publish_round_trip", f"SELECT conv_id, turn, {_SQL_WORDS} AS n_words FROM conversations")
def publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages published in a batch, then consumed as a stream."""
    key = ["conv_id", "turn"]
    topic = output_path(spark, "topic")
    sent = messages.as_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet"), key)
    messages.publish(sent, "parquet", path=topic)
    received = messages.folder_stream(spark, topic, sent.schema)
    return _landed(messages.count_words(received, key), "received-words")
