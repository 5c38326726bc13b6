"""Tokenizers as array columns.

The three corpus tokenizers give different vocabularies on purpose and must not share a
pattern. Their arrays may hold empty strings and short or stop words; operators drop those
with a ``Keep`` predicate after the explode, where it runs as generated code, instead of a
lambda over each array.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII letters that a byte-wise lowercase folds, and the delimiters.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
BLANKS = "\t\n\r"

# Characters outside letters, numbers and underscore: the complement of Python's ``\w``.
NON_WORD_UNICODE = r"[^\p{L}\p{N}_]+"
# Characters outside ``[a-zA-Z0-9_]``. Written as the predefined class: the JVM takes over ten
# times as long for the same set spelt out as a negated range.
NON_WORD_ASCII = r"\W+"
# Whitespace as Python's ``str.split()`` sees it: Unicode white space and U+001C to U+001F.
PYTHON_SPACE = r"(?U)[\s\x1c-\x1f]+"

Keep = Callable[[Column], Column]


def keep(min_length: int = 1, stop_words: Sequence[str] = ()) -> Keep:
    """Predicate for tokens of ``min_length`` characters or more that are no stop words."""

    def predicate(token: Column) -> Column:
        long_enough = F.length(token) >= min_length
        return long_enough & ~token.isin(list(stop_words)) if stop_words else long_enough

    return predicate


NOT_EMPTY = keep()


def ascii_lower(text: Column) -> Column:
    """Fold A-Z only; every other character keeps its case."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def whitespace_tokens(text: Column) -> Column:
    """ASCII-lowercase words cut at space, tab, LF and CR; punctuation stays on the word.

    The translate that folds case also turns every delimiter into a space, so the split is
    on one literal character and needs no regex engine.
    """
    folded = F.translate(text, ASCII_UPPER + BLANKS, ASCII_LOWER + " " * len(BLANKS))
    return F.split(folded, " ")


def unicode_tokens(text: Column) -> Column:
    """Unicode-lowercase runs of letters, numbers and underscore."""
    return F.split(F.lower(text), NON_WORD_UNICODE)


def ascii_tokens(text: Column) -> Column:
    """Unicode lowercase, then runs of ``[a-z0-9_]``; accented letters are separators."""
    return F.split(F.lower(text), NON_WORD_ASCII)


def message_words(text: Column) -> Column:
    """Number of words in a message, as Python's ``len(text.split())``."""
    return F.size(F.array_remove(F.split(text, PYTHON_SPACE), "")).cast("bigint")


def to_payload(text: Column) -> Column:
    """UTF-8 bytes of a text, the value of a topic message."""
    return F.encode(text, "UTF-8")


def from_payload(value: Column) -> Column:
    """Text of a message; bytes that are not UTF-8 raise, as a strict decode does."""
    return F.validate_utf8(value.cast("string"))
