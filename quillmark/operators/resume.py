"""Split of a catalog by what an earlier run saved."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.operators.joins import BROADCAST_BYTES, join_on_key
from quillmark.sources.staging import stage


def with_saved_bytes(books: DataFrame, saved: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """``books`` with ``saved_bytes`` of ``saved (file_name, n_bytes)``; null if not saved or empty.

    One join serves both halves: null rows are still to fetch, the others are there. A file
    that is listed several times counts once, with its largest size.
    """
    filled = saved.where("n_bytes > 0").groupBy("file_name").agg(F.max("n_bytes").alias("saved_bytes"))
    filled = stage(filled, "saved-files")  # measured, then joined
    return join_on_key(books, filled, "file_name", "left", budget=budget)


def saved_files(listing: DataFrame) -> DataFrame:
    """``(file_name, n_bytes)`` of a listed folder with a ``file_name=`` folder for each file; empty files are not there."""
    return listing.groupBy("file_name").agg(F.sum("n_bytes").alias("n_bytes"))


def pending(books: DataFrame, saved: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """Books that still have to be fetched."""
    return with_saved_bytes(books, saved, budget).where("saved_bytes is null").drop("saved_bytes")


def already_saved(books: DataFrame, saved: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """Books that need no fetch, with their size."""
    return with_saved_bytes(books, saved, budget).where("saved_bytes is not null")
