"""IDF formulas and score formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def idf_plain(n_docs: Column, df: Column) -> Column:
    """``ln(N / (df + 1))``: zero or negative for terms in nearly every document."""
    return F.log(n_docs.cast("double") / (df + F.lit(1)))


def idf_smooth(n_docs: Column, df: Column) -> Column:
    """``ln((N + 1) / (df + 1)) + 1``."""
    return idf_ml(n_docs, df) + F.lit(1.0)


def idf_ml(n_docs: Column, df: Column) -> Column:
    """``ln((N + 1) / (df + 1))``, the formula of Spark ML's ``IDF``."""
    return F.log((n_docs + F.lit(1.0)) / (df + F.lit(1.0)))


def six_decimals(score: Column) -> Column:
    """Round as a ``%.6f`` print does; adding 0.0 turns -0.0 into 0.0."""
    return F.round(score, 6) + F.lit(0.0)


def printed_integer(score: Column) -> Column:
    """Integer part of a printed score, as an integer scan of ``%.6f`` text reads it."""
    return F.round(score, 6).cast("bigint")


def megabytes(n_bytes: Column) -> Column:
    return n_bytes / F.lit(1024.0 * 1024.0)


def per(total: Column, count: Column) -> Column:
    """``total / count``, 0.0 where there is nothing to divide by."""
    return F.when(count > 0, total / count.cast("double")).otherwise(F.lit(0.0))
