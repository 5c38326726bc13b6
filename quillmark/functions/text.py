"""Clean-up of raw books and catalog entries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Boilerplate marker lines, in order of preference.
START_MARKERS = ["*** START OF THE PROJECT GUTENBERG", "***START OF THE PROJECT GUTENBERG"]
END_MARKERS = ["*** END OF THE PROJECT GUTENBERG", "***END OF THE PROJECT GUTENBERG"]

# Preferred media types, in order; then any other type with this prefix.
TEXT_MEDIA_TYPES = [
    "text/plain; charset=utf-8",
    "text/plain; charset=us-ascii",
    "text/plain",
]
TEXT_PREFIX = "text/plain"

# Longest file name without id and ending, and the name of a book without a title.
MAX_NAME_LENGTH = 60
DEFAULT_TITLE = "book"


def _last_position(raw: Column, marker: str) -> Column:
    """Characters before the last occurrence of ``marker``; null if there is none."""
    behind = F.length(F.substring_index(raw, marker, -1))  # the whole text if there is none
    return F.when(behind < F.length(raw), F.length(raw) - behind - len(marker))


def strip_boilerplate(raw: Column) -> Column:
    """Body between the first start marker's line and the last end marker.

    The newline that ends the start line is kept. With no start marker, or none followed by
    a newline, the body starts at the first character; with no end marker it runs to the
    last one. An empty span gives the text back unchanged.
    """
    start = F.coalesce(*[F.nullif(F.instr(raw, m), F.lit(0)) for m in START_MARKERS])
    newline = F.call_function("locate", F.lit("\n"), raw, start)  # 0 if there is none
    begin = F.greatest(newline - 1, F.lit(0))
    end = F.coalesce(*[_last_position(raw, m) for m in END_MARKERS], F.length(raw))
    return F.when(end > begin, F.substring(raw, begin + 1, end - begin)).otherwise(raw)


def safe_file_name(book_id: Column, title: Column) -> Column:
    """``<id>_<title>.txt`` with blanks as ``_``, unsafe characters dropped, 60 at most."""
    # The JVM's \w is ASCII, as the class of letters, digits and underscore here has to be.
    cleaned = F.regexp_replace(F.translate(title, " \t", "__"), r"[^\w\-]+", "")
    name = F.substring(F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(DEFAULT_TITLE)), 1, MAX_NAME_LENGTH)
    return F.concat(book_id.cast("string"), F.lit("_"), name, F.lit(".txt"))


def plain_text_url(formats: Column) -> Column:
    """Plain-text URL from a media type to URL map, never a zip; null if there is none.

    Preferred media types come first, then any other ``text/plain`` type in key order.
    """
    plain = F.map_filter(formats, lambda kind, url: kind.startswith(TEXT_PREFIX) & ~url.contains(".zip"))
    others = F.transform(F.array_sort(F.map_entries(plain)), lambda entry: entry["value"])
    return F.coalesce(*[F.try_element_at(plain, F.lit(k)) for k in TEXT_MEDIA_TYPES], F.get(others, 0))


def size_in_bytes(size: int, unit: str) -> int:
    """A size with its unit as bytes; anything that is not GB counts as MB."""
    return size * (1024**3 if unit in ("GB", "gb") else 1024**2)
