"""Word, term and document counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.tokenizers import NOT_EMPTY, Keep


def explode_tokens(docs: DataFrame, keys: list[str], tokens: Column, term: str = "term",
                   keep: Keep = NOT_EMPTY) -> DataFrame:
    """One row per token that ``keep`` accepts."""
    return docs.select(*keys, F.explode(tokens).alias(term)).where(keep(F.col(term)))


def word_count(docs: DataFrame, tokens: Column, word: str = "word", n: str = "tf",
               keep: Keep = NOT_EMPTY) -> DataFrame:
    """Corpus-wide count of every word. Hot words shrink to one row per task before the shuffle."""
    return explode_tokens(docs, [], tokens, word, keep).groupBy(word).agg(F.count("*").alias(n))


def sum_by_key(records: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """Sum of the numbers of equal words."""
    return records.groupBy(word).agg(F.sum(n).alias(n))


def lines_by_key(records: DataFrame, word: str = "word", df: str = "df") -> DataFrame:
    """Number of records of each word, whatever their number says."""
    return records.groupBy(word).agg(F.count("*").alias(df))


def _some(tokens: Column) -> Column:
    """A null text has no tokens, but is a document."""
    return F.coalesce(tokens, F.array().cast("array<string>"))


def _term_runs(docs: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """Sorted tokens of each row, and the 1-based positions where a run of equal ones ends."""
    ordered = docs.select(*keys, F.sort_array(_some(tokens)).alias("_sorted"))
    run_ends = F.filter(
        F.sequence(F.lit(1), F.size("_sorted")),
        lambda i: ~F.get("_sorted", i - 1).eqNullSafe(F.get("_sorted", i)),
    )
    return ordered.select(*keys, "_sorted", run_ends.alias("_ends"))


def _run_counts(term: str, n: str) -> Column:
    """Array of ``(term, count)`` from the columns of ``_term_runs``."""
    return F.transform(
        F.col("_ends"),
        lambda end, i: F.struct(
            F.get("_sorted", end - 1).alias(term),
            (end - F.coalesce(F.get("_ends", i - 1), F.lit(0))).cast("bigint").alias(n),
        ),
    )


def term_frequency(docs: DataFrame, keys: list[str], tokens: Column, term: str = "term",
                   tf: str = "tf", keep: Keep = NOT_EMPTY, document_rows: bool = False,
                   chunked: bool = False) -> DataFrame:
    """Count of every term in every document, without a shuffle.

    A document is one row, so its terms are counted inside the row: sort the tokens, measure
    the runs. Grouping the exploded tokens would send about as many bytes as the corpus
    holds over the network.

    ``chunked`` is for documents that are cut into several rows with equal ``keys``: the counts
    of the rows are then added up, which is a shuffle of one row for each row and term.

    ``document_rows`` adds a row with a null term and 0 for every document, so that the
    documents, also those without a term, can be counted from the result.
    """
    runs = _term_runs(docs, keys, tokens)
    pairs, kept = _run_counts(term, tf), keep(F.col(term))
    if document_rows:
        document = F.struct(F.lit(None).cast("string").alias(term), F.lit(0).cast("bigint").alias(tf))
        pairs, kept = F.array_append(pairs, document), F.col(term).isNull() | kept
    counted = runs.select(*keys, F.inline(pairs)).where(kept)
    return counted.groupBy(*keys, term).agg(F.sum(tf).alias(tf)) if chunked else counted


def document_frequency(docs: DataFrame, tokens: Column, term: str = "term", df: str = "df",
                       keep: Keep = NOT_EMPTY, chunks_of: list[str] | None = None) -> DataFrame:
    """Number of documents that hold each term.

    ``chunks_of`` names the keys of documents that are cut into several rows; a term then
    counts once for each key.
    """
    terms = explode_tokens(docs, chunks_of or [], F.array_distinct(tokens), term, keep)
    return lines_by_key(terms.distinct() if chunks_of else terms, term, df)


def term_statistics(counts: DataFrame) -> DataFrame:
    """``(term, df, c)``: documents and tokens of each term, from counts per document.

    If ``counts`` has document rows, the null term's ``df`` is the number of documents. It
    comes from the same pass over the text and, unlike an observed metric, stays exact when
    a lost executor makes tasks run again.
    """
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("c"))


def document_term_statistics(docs: DataFrame, tokens: Column, keep: Keep = NOT_EMPTY) -> DataFrame:
    """``(term, df)`` straight from the documents, with the null term as above."""
    terms = F.array_append(F.array_distinct(_some(tokens)), F.lit(None).cast("string"))
    kept = F.col("term").isNull() | keep(F.col("term"))
    return lines_by_key(docs.select(F.explode(terms).alias("term")).where(kept), "term")
