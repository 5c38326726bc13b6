import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table from (doc_id, text) or longer rows."""

    def make(rows, extra=""):
        full = [tuple(r) + (None,) * (5 - len(r)) if len(r) < 5 else tuple(r) for r in rows]
        return spark.createDataFrame(full, SCHEMA + extra)

    return make


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text, and clashing column names."""
    long_text = " ".join(f"word{i % 5000} ünd" for i in range(60_000))
    rows = [
        (1, "the cat sat on the mat", "en", "b"), (1, "the cat sat on the mat", "en", "b"),
        (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", None, "a"), (None, "the dog ate the bone", "en", None),
        (5, long_text, "de", "a"), (6, "12 %% 34", "xx", "é"), (7, "ß", "de", "b"), (8, long_text, "de", "a"),
    ]
    # Names that operators use themselves.
    return spark.createDataFrame(
        [r + (None if r[1] is None else len(r[1]), 1, True, "x", [1]) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, copy_no int, accepted boolean, spans string, "
        "items array<int>",
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
