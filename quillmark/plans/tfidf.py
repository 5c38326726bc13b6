"""TF-IDF at document, line and corpus scope.

Document and line scope go through two steps. ``fit`` aggregates terms into a vocabulary, the
only step that always shuffles, and what it shuffles is one row per task and term. ``score``
counts the terms inside each row and joins the two. Both steps tokenize; a caller for whom
tokenizing is dearer than writing and reading the counts stages them with ``document_terms``.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.functions.scoring import idf_plain, printed_integer, six_decimals
from quillmark.functions.tokenizers import NOT_EMPTY, Keep
from quillmark.operators.counts import (
    document_term_statistics,
    explode_tokens,
    lines_by_key,
    term_frequency,
    term_statistics,
)
from quillmark.operators.joins import BROADCAST_BYTES, join_on_key
from quillmark.operators.prefix import running_prefix, top_k
from quillmark.operators.sketches import frequent_filter, maybe_frequent
from quillmark.sources.staging import stage

Idf = Callable[[Column, Column], Column]


# Upper bound for a vocabulary row without its term: two numbers and the row itself.
NUMBERS_BYTES = 64


@dataclass(frozen=True)
class TermModel:
    """Number of documents, the vocabulary ``(term, df)`` as a staged table, and its size in terms and bytes.

    The vocabulary also has the corpus count ``c`` if the statistics had it.
    """

    n_docs: int
    vocabulary: DataFrame
    n_terms: int
    n_bytes: int

    def idf(self, formula: Idf) -> DataFrame:
        """``(term, df, idf)``."""
        return self.vocabulary.select("term", "df", formula(F.lit(self.n_docs), F.col("df")).alias("idf"))

    def ranked(self) -> DataFrame:
        """Vocabulary with ``rank`` from 1, by corpus count and then by term.

        One task ranks a vocabulary that it may also get by broadcast; a larger one is ranked in slices.
        """
        if self.n_bytes <= BROADCAST_BYTES:
            return self.vocabulary.withColumn("rank", F.row_number().over(W.orderBy(*_by_count())).cast("bigint"))
        return running_prefix(self.vocabulary, _by_count(), F.lit(1), 0, "rank")


def document_terms(docs: DataFrame, keys: list[str], tokens: Column, keep: Keep = NOT_EMPTY) -> DataFrame:
    """Staged ``(keys, term, tf)``, with a null-term row for every document."""
    return stage(term_frequency(docs, keys, tokens, keep=keep, document_rows=True), "document-terms")


def fit(statistics: DataFrame, min_df: int = 1, vocab_size: int | None = None) -> TermModel:
    """Vocabulary from term statistics that hold the number of documents under the null term.

    Terms in fewer than ``min_df`` documents are left out. Of the others the ``vocab_size``
    most frequent are kept, by corpus count and then by term.
    """
    stats = stage(statistics, "terms")
    n_docs, n_terms, n_bytes = _measure(stats, min_df)
    known = stats.where(F.col("term").isNotNull() & (F.col("df") >= min_df))
    if vocab_size is not None and n_terms > vocab_size:
        known = stage(top_k(known, _by_count(), vocab_size).drop("rank"), "vocabulary")
        n_terms, n_bytes = vocab_size, known.agg(_vocabulary_bytes(F.col("term"))).first()[0]
    return TermModel(n_docs, known, n_terms, n_bytes)


def pruned_statistics(docs: DataFrame, tokens: Column, min_df: int, keep: Keep = NOT_EMPTY) -> DataFrame:
    """``(term, df, c)`` of the terms in ``min_df`` documents or more, and of few others, with the null term.

    A pass over the tokens fills Count-Min sketches of bounded size; by them most terms that ``fit`` would leave
    out go before the shuffle, and the rest are counted exactly. It pays where rare terms are most of what tasks
    send: with a high ``min_df``, or few tasks. The texts are tokenized twice.
    """
    known = frequent_filter(explode_tokens(docs, [], F.array_distinct(tokens), keep=keep), min_df)
    terms = term_frequency(docs, [], tokens, keep=keep, document_rows=True)
    return term_statistics(maybe_frequent(terms, known))


def _by_count() -> list[Column]:
    return [F.desc("c"), F.col("term")]


def _vocabulary_bytes(term: Column) -> Column:
    return F.coalesce(F.sum(F.octet_length(term).cast("bigint") + NUMBERS_BYTES), F.lit(0))


def _measure(stats: DataFrame, min_df: int) -> tuple[int, int, int]:
    """Documents (from the null term), and number and bytes of the terms that are kept."""
    kept = F.when(F.col("df") >= min_df, F.col("term"))
    documents = F.max(F.when(F.col("term").isNull(), F.col("df")))
    n_docs, n_terms, n_bytes = stats.agg(documents, F.count(kept), _vocabulary_bytes(kept)).first()
    if n_docs is None:
        raise ValueError("no documents found in the input")
    return n_docs, n_terms, n_bytes


def score(counts: DataFrame, keys: list[str], model: TermModel, formula: Idf,
          budget: int = BROADCAST_BYTES) -> DataFrame:
    """``(keys, term, tfidf)`` with ``tfidf = tf * idf``, for the terms of the vocabulary."""
    terms = counts.where("term is not null")
    # df is the number of count rows of a term, so it doubles as the join's key frequency.
    joined = join_on_key(terms, model.idf(formula), "term", frequency="df", size=model.n_bytes, budget=budget)
    return joined.select(*keys, "term", (F.col("tf") * F.col("idf")).alias("tfidf"))


def document_tfidf(docs: DataFrame, keys: list[str], tokens: Column, formula: Idf, keep: Keep = NOT_EMPTY,
                   min_df: int = 1, vocab_size: int | None = None, budget: int = BROADCAST_BYTES,
                   stage_counts: bool = False) -> DataFrame:
    """Both steps over one corpus. ``stage_counts`` tokenizes once and keeps the counts in a staged table."""
    if stage_counts:
        counts = document_terms(docs, keys, tokens, keep)
        return score(counts, keys, fit(term_statistics(counts), min_df, vocab_size), formula, budget)
    if vocab_size is None:
        statistics = document_term_statistics(docs, tokens, keep)
    else:  # the vocabulary is ranked by corpus counts
        statistics = term_statistics(term_frequency(docs, [], tokens, keep=keep, document_rows=True))
    model = fit(statistics, min_df, vocab_size)
    return score(term_frequency(docs, keys, tokens, keep=keep), keys, model, formula, budget)


def corpus_tfidf_first_pass(counts: DataFrame, n_docs: Column) -> DataFrame:
    """``(word, tfidf)`` from corpus counts, with document frequencies as the chain has them.

    The chain takes the document frequency of a word from the lines of the count table,
    which has one line per word. Both figures therefore come from one aggregate over a table
    that is already partitioned by word.
    """
    stats = counts.groupBy("word").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    return stats.select("word", (F.col("tf") * idf_plain(n_docs, F.col("df"))).alias("tfidf"), "df")


def corpus_tfidf_as_run(counts: DataFrame, n_docs: Column) -> DataFrame:
    """``(word, tfidf)`` as the three chained jobs leave it: the score step runs twice.

    The second run reads the printed score of the first as an integer. Not a useful
    weighting; ``document_tfidf`` is the one to use.
    """
    first = corpus_tfidf_first_pass(counts, n_docs)
    again = printed_integer(F.col("tfidf")) * idf_plain(n_docs, F.col("df"))
    return first.select("word", six_decimals(again).alias("tfidf"))


def corpus_document_frequency(counts: DataFrame) -> DataFrame:
    """``(word, df)`` as the chained jobs count it: lines of the count table."""
    return lines_by_key(counts)
