"""Landed catalog pages: JSON text with a ``results`` list of books."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.text import DEFAULT_TITLE, plain_text_url, safe_file_name
from quillmark.sources.staging import stage


def _book(book: Column) -> Column:
    """Typed fields of a book. A missing id is 0, a missing title "book"; only URLs that are
    strings are kept."""
    formats = F.map_filter(
        F.try_variant_get(book, "$.formats", "map<string,variant>"),
        lambda kind, url: F.schema_of_variant(url) == "STRING",
    )
    return F.struct(
        F.coalesce(F.try_variant_get(book, "$.id", "bigint"), F.lit(0)).alias("id"),
        F.coalesce(F.try_variant_get(book, "$.title", "string"), F.lit(DEFAULT_TITLE)).alias("title"),
        F.transform_values(formats, lambda kind, url: F.try_variant_get(url, "$", "string")).alias("formats"),
        F.try_variant_get(book, "$.languages", "array<string>").alias("languages"),
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """``(page_no, is_json, books)`` of ``(page_no, body)`` pages; no list gives null books."""
    # In brackets, a body with anything after its JSON value is no longer taken as JSON.
    listing = F.try_parse_json(F.concat(F.lit("["), "body", F.lit("]")))
    values = pages.select("page_no", F.try_variant_get(listing, "$", "array<variant>").alias("values"))
    results = F.try_variant_get(F.get("values", 0), "$.results", "array<variant>")
    return values.select(
        "page_no",
        F.coalesce(F.size("values") == 1, F.lit(False)).alias("is_json"),
        F.transform(results, _book).alias("books"),
    )


def read_catalog(pages: DataFrame) -> DataFrame:
    """Books of the pages as ``(page_no, position, id, title, formats, languages)``.

    Pages that are not JSON are skipped. The first other page without a filled ``results``
    list ends the catalog: later pages are not used. Books without ``formats`` are dropped.
    """
    # Staged, so that each page is parsed once: filters on parsed values would otherwise be
    # pushed down and parse the page again.
    parsed = stage(parse_pages(pages), "catalog-pages").where("is_json")
    last = parsed.where("coalesce(size(books), 0) <= 0").agg(F.min("page_no")).scalar()
    used = parsed.where(last.isNull() | (F.col("page_no") < last))
    books = used.select("page_no", F.posexplode("books").alias("position", "book"))
    return books.select("page_no", "position", "book.*").where("formats is not null")


def text_books(books: DataFrame, languages: Sequence[str] = ()) -> DataFrame:
    """Books with a plain-text URL: ``(page_no, position, id, url, file_name)``.

    With ``languages``, only books in one of them; a book that names no language is in none.
    """
    if languages:
        books = books.where(F.arrays_overlap("languages", F.array(*[F.lit(x) for x in languages])))
    return books.select(
        "page_no",
        "position",
        "id",
        plain_text_url(F.col("formats")).alias("url"),
        safe_file_name(F.col("id"), F.col("title")).alias("file_name"),
    ).where("url is not null")
