"""Texts of Arrow batches as NumPy byte arrays.

The operators that run NumPy inside tasks share this: the UTF-8 bytes of a text column are
taken from the Arrow buffers without a copy and without Python strings, and handed out in
pieces of bounded size, so that the temporary arrays of a step stay small whatever the
length of a batch.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Bytes of text that a step looks at together.
PIECE_BYTES = 1 << 18


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a string column in a row, and the bounds of each (n + 1).

    A null is an empty text.
    """
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def groups(bounds: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` bytes together; a longer text is a range of its own."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def pieces(data: np.ndarray, bounds: np.ndarray, breaks: np.ndarray,
           limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, bytes, bounds)`` of ``groups``; a long text comes in several pieces.

    A long text is cut after a byte for which ``breaks`` (a table of 256) holds, if its last
    ``limit`` bytes have one.
    """
    for first, last in groups(bounds, limit):
        start, end = int(bounds[first]), int(bounds[last])
        if last - first > 1 or end - start <= limit:
            yield first, data[start:end], bounds[first : last + 1] - start
            continue
        while start < end:
            stop = min(start + limit, end)
            if stop < end:
                cuts = np.flatnonzero(breaks[data[start:stop]])
                stop = start + int(cuts[-1]) + 1 if len(cuts) else stop
            yield first, data[start:stop], np.array([0, stop - start])
            start = stop


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``function`` over the Arrow batches of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                if made is not None:
                    yield made

    return df.mapInArrow(run, schema)


def id_and_text(docs: DataFrame, text: str = "text", *columns: str) -> DataFrame:
    """``doc_id``, further columns, and the text with null as empty."""
    return docs.select("doc_id", *columns, F.coalesce(F.col(text), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
