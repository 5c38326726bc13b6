"""The tokenizers and formulas as functions of SQL, for users who write statements instead of columns.

``register`` makes them temporary functions of the session. Their bodies are SQL, which Spark puts into the plan
as if it had been written there: no Python runs, and filters and columns reach the scan as before. They give what
the functions of ``tokenizers`` and ``scoring`` give, without the empty strings of a split. A generator takes
their result as a column: explode it from a select below, or in a lateral view over one.
"""

from pyspark.sql import SparkSession

from quillmark.functions.tokenizers import ASCII_LOWER, ASCII_UPPER, NON_WORD_ASCII, NON_WORD_UNICODE, PYTHON_SPACE

_SPACES = " " * 3


def _split(text: str, pattern: str) -> str:
    # A raw literal: patterns keep their backslashes.
    return f"array_remove(split({text}, r'{pattern}'), '')"


# Name and parameters, type, body.
FUNCTIONS = {
    "whitespace_tokens(t STRING)": (
        "ARRAY<STRING>", _split(rf"translate(t, '{ASCII_UPPER}\t\n\r', '{ASCII_LOWER}{_SPACES}')", " ")
    ),
    "unicode_tokens(t STRING)": ("ARRAY<STRING>", _split("lower(t)", NON_WORD_UNICODE)),
    "ascii_tokens(t STRING)": ("ARRAY<STRING>", _split("lower(t)", NON_WORD_ASCII)),
    "message_words(t STRING)": ("BIGINT", f"CAST(size({_split('t', PYTHON_SPACE)}) AS BIGINT)"),
    "idf_plain(n_docs BIGINT, df BIGINT)": ("DOUBLE", "ln(CAST(n_docs AS DOUBLE) / (df + 1))"),
    "idf_ml(n_docs BIGINT, df BIGINT)": ("DOUBLE", "ln((n_docs + 1D) / (df + 1D))"),
    "idf_smooth(n_docs BIGINT, df BIGINT)": ("DOUBLE", "ln((n_docs + 1D) / (df + 1D)) + 1D"),
    "six_decimals(score DOUBLE)": ("DOUBLE", "round(score, 6) + 0D"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session, in place of earlier ones of their names; their names."""
    for signature, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    return [signature.split("(")[0] for signature in FUNCTIONS]
