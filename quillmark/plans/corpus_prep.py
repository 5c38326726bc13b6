"""From landed catalog pages and raw texts to a corpus of a given size."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.text import strip_boilerplate
from quillmark.operators.joins import BROADCAST_BYTES, join_on_key
from quillmark.operators.prefix import running_prefix
from quillmark.operators.resume import with_saved_bytes
from quillmark.sources.catalog import read_catalog, text_books
from quillmark.sources.staging import stage


def clean_texts(raw: DataFrame) -> DataFrame:
    """``(url, raw)`` as ``(url, body)``."""
    return raw.select("url", strip_boilerplate(F.col("raw")).alias("body"))


def text_sizes(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Staged ``(key, n_bytes)``: the texts are read once, whatever follows."""
    return stage(docs.select(key, F.octet_length(text).cast("bigint").alias("n_bytes")), "text-sizes")


def _place() -> Column:
    return F.struct("page_no", "position")


def with_earlier_files(books: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """``existing`` and ``n_bytes`` of books that are taken in catalog order.

    Books with equal file names write the same file, so the first one that has a text writes
    it, and to each later one the file is there with its size. The first of a name is an
    aggregate, so a name that many books share is no hot key.
    """
    writers = books.where("saved_bytes is null and clean_bytes > 0")
    firsts = writers.groupBy("file_name").agg(F.min(F.struct("page_no", "position", "clean_bytes")).alias("first"))
    firsts = stage(firsts.select(
        "file_name", F.struct("first.page_no", "first.position").alias("written_at"),
        F.col("first.clean_bytes").alias("written_bytes"),
    ), "written-files")
    placed = join_on_key(books, firsts, "file_name", "left", budget=budget)
    written = F.coalesce(F.col("written_at") < _place(), F.lit(False))
    size = F.coalesce("saved_bytes", F.when(written, F.col("written_bytes")), "clean_bytes")
    existing = F.col("saved_bytes").isNotNull() | written
    return placed.select("page_no", "position", "id", "url", "file_name", existing.alias("existing"), size.alias("n_bytes"))


def select_books(pages: DataFrame, raw: DataFrame, saved: DataFrame, target_bytes: int,
                 languages: Sequence[str] = (), budget: int = BROADCAST_BYTES) -> DataFrame:
    """Books of the corpus in catalog order, up to the one that reaches ``target_bytes``.

    Columns: page_no, position, id, url, file_name, existing, n_bytes, running_bytes. Saved
    files, and files that an earlier book of the run writes, count as existing with their
    size; other books count with the size of their clean text, and are left out without one.
    Only texts that are still to fetch are cleaned, and only sizes are sorted.
    """
    books = stage(with_saved_bytes(text_books(read_catalog(pages), languages), saved, budget), "books")
    wanted = books.where("saved_bytes is null").select("url").distinct()
    sizes = clean_texts(raw.join(wanted, "url", "left_semi")).select(
        "url", F.octet_length("body").cast("bigint").alias("clean_bytes")
    )
    # Staged: the join measures this table first, and texts should be cleaned once for it.
    sized = join_on_key(books, stage(sizes, "clean-sizes"), "url", "left", budget=budget)
    sized = stage(with_earlier_files(sized, budget).where("n_bytes is not null"), "sized-books")
    return running_prefix(sized, ["page_no", "position"], F.col("n_bytes"), target_bytes, "running_bytes")


def new_files(selected: DataFrame, raw: DataFrame) -> DataFrame:
    """``(file_name, body)`` of the selected books that were not there before, one per name.

    Of several books that write a file the last one leaves its text; only the last of them can
    have one. Texts are cleaned after the join, which drops most of them.
    """
    wanted = selected.where("not existing").groupBy("file_name").agg(F.max_by("url", _place()).alias("url"))
    return raw.join(wanted, "url").select("file_name", strip_boilerplate(F.col("raw")).alias("body"))
